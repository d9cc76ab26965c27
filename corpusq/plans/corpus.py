"""Queries over corpus bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.functions import text as X
from corpusq.functions.values import STATUS_MIGRATION
from corpusq.operators import corpus as C
from corpusq.operators.ordered import latest, pick
from corpusq.plans.base import query
from corpusq.plans.expected import SUSPECT_CLASS
from corpusq.sources.tables import table

_DESC = "count({0}) AS n, round(avg({0}), 6) AS mean, round(quantile_cont({0}, 0.5), 6) AS median, round(coalesce(stddev_samp({0}), 0), 6) AS std, round(min({0}), 6) AS lo, round(max({0}), 6) AS hi"
_LABELLED = rf"""WITH s AS (SELECT d.doc_id, lang, source, n_chars, quality, round((0.8 * coalesce(quality, 0) + 0.2 * (1 - CASE WHEN length(text) > 0
  THEN (length(text) - length(regexp_replace(text, '{SUSPECT_CLASS}', '', 'g'))) / length(text) ELSE 0 END)) * 100, 1) AS score
  FROM documents d LEFT JOIN labels l USING (doc_id)) """


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", X.suspicious_ratio(F.col("text")).alias("suspicious"))
    rated = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rated.withColumn("score", X.quality_score(F.coalesce("quality", F.lit(0)), F.col("suspicious")))


@query(_LABELLED + f"SELECT lang, {_DESC.format('score')} FROM s GROUP BY lang ORDER BY lang")
def stratum_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy("lang").agg(*C.describe("score")).orderBy("lang")


_BUCKET = "CASE WHEN n_chars / 500 <= 5 THEN 'short' WHEN n_chars / 500 <= 20 THEN 'medium' ELSE 'long' END"


@query(_LABELLED + ", k AS (SELECT score, lang, source, coalesce(quality::VARCHAR, 'unknown') AS quality, " + _BUCKET + f" AS bucket FROM s) SELECT CASE WHEN lang IS NOT NULL THEN 'lang' WHEN source IS NOT NULL THEN 'source' WHEN quality IS NOT NULL THEN 'quality' ELSE 'bucket' END AS dimension, coalesce(lang, source, quality, bucket) AS stratum, {_DESC.format('score')} FROM k GROUP BY GROUPING SETS ((lang), (source), (quality), (bucket))")
def stratify_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stratify(_scored(spark, sf_dir).withColumn("bucket", X.size_bucket(F.col("n_chars") / 500)), ["lang", "source", "quality", "bucket"], "score")


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL ORDER BY n DESC, lang, source")
def value_counts_lang_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.value_counts(table(spark, sf_dir, "documents"), "lang", "source")


@query(f"SELECT {_BUCKET} AS bucket, count(*) AS n FROM documents GROUP BY ALL")
def size_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(X.size_bucket(F.col("n_chars") / 500).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) SELECT CASE WHEN n <= 2 THEN 'xs' WHEN n <= 5 THEN 's' WHEN n <= 10 THEN 'm' WHEN n <= 20 THEN 'l' WHEN n <= 60 THEN 'xl' ELSE 'xxl' END AS bucket, count(*) AS docs, sum(n)::BIGINT AS pages FROM c GROUP BY ALL")
def page_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(X.page_bucket(F.col("n")).alias("bucket")).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("pages"))


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'fr' AND source IN ('src1', 'src2', 'src3') AND contains(lower(replace(translate(text, 'éóèñçüêäöíÉÈÑÓÇÄÊÜÖÍ', 'eoencueaoiEENOCAEUOI'), 'ß', 'ss')), 'ea') ORDER BY doc_id")
def catalog_filter_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = X.fold(F.col("text"))
    d = table(spark, sf_dir, "documents").where((F.col("lang") == "fr") & F.col("source").isin("src1", "src2", "src3") & F.contains(head, F.lit("ea")))
    return d.select("doc_id", "lang", "source").orderBy("doc_id")


@query("SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL UNION ALL SELECT 'quality', coalesce(quality::VARCHAR, 'unknown'), count(*) FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL")
def catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    d = d.select("lang", "source", F.coalesce(F.col("quality").cast("string"), F.lit("unknown")).alias("quality"))
    return d.unpivot([], ["lang", "source", "quality"], "field", "value").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, n_chars // 100 AS page, source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang, n_chars // 100 ORDER BY regexp_extract(source, '[0-9]+')::INT, doc_id) = 1")
def source_precedence_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Competing sources of one page: the one with the lowest number wins."""
    d = table(spark, sf_dir, "documents").select("lang", F.floor(F.col("n_chars") / 100).alias("page"), "source", "doc_id")
    return pick(d, ["lang", "page"], [F.regexp_extract("source", "[0-9]+", 0).cast("int"), F.col("doc_id")])


@query("""WITH a AS (SELECT DISTINCT c_custkey AS k FROM customer), b AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT DISTINCT o_custkey AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')
SELECT 0 AS stage, 'listed' AS name, (SELECT count(*) FROM a) AS n, 0::BIGINT AS lost UNION ALL SELECT 1, 'ordered', (SELECT count(*) FROM b), (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b))
UNION ALL SELECT 2, 'returned', (SELECT count(*) FROM c), (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM c))""")  # fmt: skip
def funnel_anti_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    back = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    listed = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    ordered, returned = orders.select(F.col("o_custkey").alias("k")), orders.join(back, "o_orderkey", "left_semi").select(F.col("o_custkey").alias("k"))
    return C.funnel([("listed", listed), ("ordered", ordered), ("returned", returned)], "k")


@query("""WITH a AS (SELECT n_nationkey AS k, n_regionkey * 60 AS claimed FROM nation), b AS (SELECT c_nationkey AS k, count(*) AS computed FROM customer GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, claimed::BIGINT AS claimed, computed, CASE WHEN claimed IS NOT DISTINCT FROM computed THEN 'OK' ELSE 'DRIFT' END AS status FROM a FULL JOIN b ON a.k = b.k""")  # fmt: skip
def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    claimed = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 60).cast("long").alias("v"))
    computed = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    return C.drift(claimed, computed, "k", "v")


@query("""WITH a AS (SELECT o_custkey AS k, max(o_totalprice) / 1e5 AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, max(o_totalprice) / 1e5 AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
m AS (SELECT k, a.v AS old, b.v AS new, b.v - a.v AS delta FROM a JOIN b USING (k) WHERE abs(b.v - a.v) > 0.05)
SELECT k, round(old, 9) AS old, round(new, 9) AS new, round(delta, 9) AS delta, CASE WHEN count(*) OVER () > 5 THEN 'stale' ELSE 'minor' END AS verdict FROM m""")  # fmt: skip
def snapshot_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = lambda s: table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg((F.max("o_totalprice") / 1e5).alias("v"))
    d = C.snapshot_drift(by("O"), by("F"), "k", "v")
    return d.select("k", *[F.round(c, 9).alias(c) for c in ("old", "new", "delta")], "verdict")


@query(f"SELECT 'part' AS source, {_DESC.format('p_retailprice')}, round(sum(p_retailprice), 4) AS total FROM part UNION ALL SELECT 'orders', {_DESC.format('o_totalprice')}, round(sum(o_totalprice), 4) FROM orders")
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda t, c: table(spark, sf_dir, t).select(F.lit(t).alias("source"), F.col(c).alias("v"))
    return C.summary(one("part", "p_retailprice").unionByName(one("orders", "o_totalprice")), ["source"], "v", F.round(F.sum("v"), 4).alias("total"))


@query("SELECT user_id, CASE event_type WHEN 'view' THEN 'open' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'done' ELSE event_type END AS status, events FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS events FROM events GROUP BY user_id)")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = latest(table(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"])
    return last.select("user_id", C.migrate(F.col("event_type"), STATUS_MIGRATION).alias("status"), "events")


@query("SELECT event_type AS stream, CASE WHEN value < 20 THEN 'open' WHEN value < 60 THEN 'in_progress' ELSE 'done' END AS status, count(*) AS n, count(DISTINCT user_id) AS docs FROM events GROUP BY ALL")
def status_history_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("value") < 20, "open").when(F.col("value") < 60, "in_progress").otherwise("done")
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("stream"), status.alias("status"), "user_id")
    return e.groupBy("stream", "status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("docs"))


@query("SELECT lang, source, doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY md5('42|' || doc_id), doc_id) AS place FROM documents QUALIFY place <= 3")
def stratified_sample_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.stratified_sample(table(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "doc_id", 3, 42)


@query("""WITH c AS (SELECT lang, source, count(*) AS size FROM documents GROUP BY ALL), e AS (SELECT *, size * 150 / sum(size) OVER () AS x FROM c), f AS (SELECT *, floor(x)::BIGINT AS fl FROM e),
g AS (SELECT *, 150 - sum(fl) OVER () AS rest, row_number() OVER (ORDER BY round(x - fl, 9) DESC, lang, source) AS p FROM f)
SELECT lang, source, size, least(size, fl + CASE WHEN p <= rest THEN 1 ELSE 0 END) AS share FROM g""")  # fmt: skip
def largest_remainder_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("size"))
    return C.largest_remainder(cells, ["lang", "source"], "size", 150)


@query("""WITH o AS (SELECT event_id, month(ts) AS wave, value FROM events), n AS (SELECT event_id + 1000000000 AS event_id, wave, value * 2 AS value FROM o WHERE wave = (SELECT max(wave) FROM o) AND event_id % 2 = 0)
SELECT event_id, wave, round(value, 6) AS value FROM (SELECT * FROM o WHERE wave NOT IN (SELECT wave FROM n) UNION ALL SELECT * FROM n)""")  # fmt: skip
def upsert_by_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "events").select("event_id", F.month("ts").alias("wave"), "value")
    last = old.agg(F.max("wave").alias("wave"))
    new = old.join(last, "wave", "left_semi").where("event_id % 2 = 0").select(F.col("event_id") + 1000000000, "wave", (F.col("value") * 2).alias("value")).toDF("event_id", "wave", "value")
    return C.upsert(old, new, "wave").select("event_id", "wave", F.round("value", 6).alias("value"))


@query("""WITH r AS (SELECT user_id, day(ts) AS run, avg(value) AS v FROM events GROUP BY ALL), d AS (SELECT user_id, count(*) AS runs, avg(v) AS mean, coalesce(stddev_samp(v), 0) AS std, max(v) - min(v) AS spread FROM r GROUP BY 1)
SELECT count(*) AS docs, round(avg(std), 6) AS mean_std, round(max(std), 6) AS max_std, round(max(spread), 6) AS max_range FROM d""")  # fmt: skip
def run_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").groupBy("user_id", F.day("ts").alias("run")).agg(F.avg("value").alias("v"))
    docs = runs.groupBy("user_id").agg(F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("std"), (F.max("v") - F.min("v")).alias("spread"))
    return docs.agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg("std"), 6).alias("mean_std"), F.round(F.max("std"), 6).alias("max_std"), F.round(F.max("spread"), 6).alias("max_range"))


@query("""WITH c AS (SELECT conv_id, count(*) AS found, max(turn) + 1 + conv_id % 3 AS claimed, (conv_id % 2)::BIGINT AS cover, count(*) FILTER (role = 'user') // 4 AS split FROM conversations GROUP BY 1),
g AS (SELECT *, abs(claimed - found) AS gap FROM c), r AS (SELECT *, greatest(0, gap - least(gap, cover + split)) AS rest FROM g)
SELECT conv_id, found, claimed, cover, split, gap, rest, CASE WHEN rest = 0 THEN 'OK' WHEN found / claimed < 0.8 OR found / claimed > 1.3 THEN 'MISMATCH' ELSE 'MINOR' END AS status FROM r""")  # fmt: skip
def completeness_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("found"), (F.max("turn") + 1 + F.col("conv_id") % 3).alias("claimed"),
        (F.col("conv_id") % 2).alias("cover"), F.floor(F.count_if(F.col("role") == "user") / 4).alias("split"),
    )
    return C.reconcile_pages(c, F.col("claimed"), F.col("found"), F.col("cover"), F.col("split"))


@query("""WITH p AS (SELECT conv_id, turn, length(text) AS n FROM conversations), w AS (SELECT *, avg(CASE WHEN n > 50 THEN n END) OVER (PARTITION BY conv_id) AS mean FROM p),
k AS (SELECT *, CASE WHEN n < 50 THEN 'empty' WHEN n < 200 THEN 'short' WHEN n < 0.3 * mean THEN 'thin' ELSE 'ok' END AS kind FROM w)
SELECT conv_id, count(*) AS pages, count(*) FILTER (kind = 'empty') AS empty, count(*) FILTER (kind = 'short') AS short, count(*) FILTER (kind = 'thin') AS thin, CASE WHEN bool_and(kind = 'ok') THEN 'OK' ELSE 'WARNING' END AS status FROM k GROUP BY 1""")  # fmt: skip
def completeness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    n = F.col("n")
    p = table(spark, sf_dir, "conversations").select("conv_id", F.length("text").alias("n"))
    p = p.withColumn("mean", F.avg(F.when(n > 50, n)).over(Window.partitionBy("conv_id")))
    kind = F.when(n < 50, "empty").when(n < 200, "short").when(n < 0.3 * F.col("mean"), "thin").otherwise("ok")
    p = p.withColumn("kind", kind)
    return p.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("empty", "short", "thin")],
        F.when(F.bool_and(F.col("kind") == "ok"), "OK").otherwise("WARNING").alias("status"),
    )


@query("SELECT CASE WHEN x < .01 THEN 0 WHEN x < .02 THEN 1 WHEN x < .03 THEN 2 WHEN x < .05 THEN 3 WHEN x < .08 THEN 4 ELSE 5 END AS bin, count(*) AS n FROM (SELECT l_discount AS x FROM lineitem) WHERE x <= 1 GROUP BY ALL")
def fixed_edge_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, edges = F.col("l_discount"), [0.01, 0.02, 0.03, 0.05, 0.08]
    bin_ = F.coalesce(*[F.when(x < e, F.lit(k)) for k, e in enumerate(edges)], F.lit(len(edges)))
    return table(spark, sf_dir, "lineitem").where(x <= 1).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_mktsegment = '', c_mktsegment, try_cast(regexp_extract(c_name, '[0-9]+') AS INT) NULLS LAST, c_name LIMIT 50")
def natural_order_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's first 50 rows: empty values last, then by number, then by name."""
    c = table(spark, sf_dir, "customer")
    number = F.expr("try_cast(regexp_extract(c_name, '[0-9]+', 0) as int)")
    return c.orderBy(F.col("c_mktsegment") == "", "c_mktsegment", number.asc_nulls_last(), "c_name").limit(50).select("c_custkey", "c_name")
