"""Queries over judgments of finds, their store, samples and reports. Orders stand in for cases, their lines for judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.operators import reviews as R
from corpusq.plans.base import query
from corpusq.sources.tables import sized, table
from corpusq.storage import stored


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged finds: case, doc, wave, verdict, reason."""
    o = table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_orderkey AS case_id", "o_custkey AS doc", "concat('wave-', year(o_orderdate), CASE WHEN o_orderkey % 4 = 0 THEN '-recall' ELSE '-precision' END) AS wave",
        "CASE WHEN o_orderstatus = 'F' THEN 'correct' WHEN o_orderstatus = 'O' THEN 'wrong' ELSE 'undecidable' END AS verdict", "CASE WHEN o_orderstatus = 'O' AND o_orderkey % 7 > 0 THEN o_orderpriority END AS reason",
    )


_MARKS = """m AS (SELECT o_orderkey AS case_id, o_custkey AS doc, 'wave-' || year(o_orderdate) || CASE WHEN o_orderkey % 4 = 0 THEN '-recall' ELSE '-precision' END AS wave,
  CASE WHEN o_orderstatus = 'F' THEN 'correct' WHEN o_orderstatus = 'O' THEN 'wrong' ELSE 'undecidable' END AS verdict, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 7 > 0 THEN o_orderpriority END AS reason FROM orders) """


@query("WITH " + _MARKS + "SELECT wave, regexp_extract(wave, '^wave-([0-9]+)', 1) AS snapshot, ends_with(wave, '-recall') AS tagged, contains(wave, 'recall') AS named, count(*) AS n FROM m GROUP BY ALL")
def wave_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot in a wave's name, and both readings of its membership."""
    w = F.col("wave")
    m = _marks(spark, sf_dir).groupBy("wave").agg(F.count(F.lit(1)).alias("n"))
    return m.select("wave", F.regexp_extract(w, "^wave-([0-9]+)", 1).alias("snapshot"), F.endswith(w, F.lit("-recall")).alias("tagged"), F.contains(w, F.lit("recall")).alias("named"), "n")


@query("WITH " + _MARKS + "SELECT wave, count(*) FILTER (verdict <> 'undecidable') AS decidable, count(*) FILTER (verdict = 'correct') AS correct, round(count(*) FILTER (verdict = 'correct') / nullif(count(*) FILTER (verdict <> 'undecidable'), 0), 9) AS rate FROM m GROUP BY wave")
def precision_by_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.precision(_marks(spark, sf_dir), ["wave"])


@query("""WITH """ + _MARKS + """, s AS (SELECT l_orderkey AS case_id, min(l_linestatus) AS second FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1), p AS (SELECT l_orderkey AS case_id, max(l_quantity) AS place FROM lineitem GROUP BY 1), c AS (SELECT c_custkey AS doc, md5(c_name) AS digest FROM customer)
SELECT case_id, m.doc, verdict, second, place, digest, CASE WHEN second IS NULL THEN NULL ELSE (verdict = 'correct') = (second = 'F') END AS agrees FROM m LEFT JOIN s USING (case_id) LEFT JOIN p USING (case_id) LEFT JOIN c ON c.doc = m.doc""")
def verdict_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with their verdict, the second reader's, the place and the digest of the text they were judged on."""
    li = table(spark, sf_dir, "lineitem")
    second = li.where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("case_id")).agg(F.min("l_linestatus").alias("second"))
    place = li.groupBy(F.col("l_orderkey").alias("case_id")).agg(F.max("l_quantity").alias("place"))
    texts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), F.md5("c_name").alias("digest"))
    met = _marks(spark, sf_dir).join(second, "case_id", "left").join(place, "case_id", "left").join(texts, "doc", "left")
    agrees = F.when(F.col("second").isNotNull(), (F.col("verdict") == "correct") == (F.col("second") == "F"))
    return met.select("case_id", "doc", "verdict", "second", "place", "digest", agrees.alias("agrees"))


@query("""WITH p AS (SELECT conv_id AS doc, turn AS page, string_split(text, ' ')[1:3] AS w FROM conversations), u AS (SELECT doc, page, generate_subscripts(w, 1) AS k, unnest(w) AS surface FROM p)
SELECT doc, page, k, surface, CASE WHEN (doc + page + k) % 3 = 0 THEN 'missed' ELSE 'found' END AS status, CASE WHEN (doc + page + k) % 3 = 0 THEN CASE WHEN k = 1 THEN 'spelling' ELSE 'unlisted' END END AS cause FROM u""")
def recall_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their mentions to one row per mention; only a missed one has a cause."""
    p = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), F.posexplode(F.slice(F.split("text", " "), 1, 3)).alias("i", "surface"))
    p = p.withColumn("k", F.col("i") + 1)
    missed = (F.col("doc") + F.col("page") + F.col("k")) % 3 == 0
    return p.select("doc", "page", "k", "surface", F.when(missed, "missed").otherwise("found").alias("status"), F.when(missed, F.when(F.col("k") == 1, "spelling").otherwise("unlisted")).alias("cause"))


@query("""WITH """ + _MARKS + """, x AS (SELECT * FROM m UNION ALL SELECT * FROM m WHERE case_id % 50 = 0), c AS (SELECT o_orderkey AS case_id, o_custkey + CASE WHEN o_orderkey % 90 = 0 THEN 1 ELSE 0 END AS doc FROM orders WHERE o_orderkey % 60 > 0)
SELECT 'duplicate' AS violation, case_id FROM x GROUP BY case_id HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'unknown_case', case_id FROM x WHERE case_id NOT IN (SELECT case_id FROM c)
UNION ALL SELECT DISTINCT 'other_page', x.case_id FROM x JOIN c ON x.case_id = c.case_id AND x.doc <> c.doc UNION ALL SELECT 'no_mark', case_id FROM c WHERE case_id NOT IN (SELECT case_id FROM x)
UNION ALL SELECT DISTINCT 'no_reason', case_id FROM x WHERE verdict = 'wrong' AND reason IS NULL""")
def store_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every violation of the store: repeated marks, marks without a case, other pages, cases without a mark, wrong without a reason."""
    m = _marks(spark, sf_dir)
    k = F.col("o_orderkey")
    cases = table(spark, sf_dir, "orders").where("o_orderkey % 60 > 0").select(k.alias("case_id"), (F.col("o_custkey") + F.when(k % 90 == 0, 1).otherwise(0)).alias("doc"))
    return R.violations(m.unionByName(m.where("case_id % 50 = 0")), cases)


@query("WITH " + _MARKS + ", n AS (SELECT verdict, count(*) AS computed FROM m GROUP BY 1), p AS (SELECT * FROM (VALUES ('correct', 700), ('wrong', 20), ('missing', 3)) t(verdict, pinned)) SELECT coalesce(n.verdict, p.verdict) AS verdict, pinned::BIGINT AS pinned, computed, coalesce(pinned, 0) = coalesce(computed, 0) AS same FROM n FULL JOIN p ON n.verdict = p.verdict")
def distribution_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict counts against the pinned ones."""
    pinned = spark.createDataFrame([("correct", 700), ("wrong", 20), ("missing", 3)], "verdict string, pinned long")
    n = _marks(spark, sf_dir).groupBy("verdict").agg(F.count(F.lit(1)).alias("computed"))
    zero = F.lit(0)
    return n.join(pinned, "verdict", "full").select("verdict", "pinned", "computed", (F.coalesce("pinned", zero) == F.coalesce("computed", zero)).alias("same"))


@query("SELECT doc_id FROM documents WHERE md5(text) <> md5(CASE WHEN doc_id % 9 = 0 THEN text || '.' ELSE text END)")
def text_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text changed since it was judged, by digest."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("now"), F.md5(F.expr("CASE WHEN doc_id % 9 = 0 THEN text || '.' ELSE text END")).alias("judged"))
    return d.where("now <> judged").select("doc_id")


@query("""WITH """ + _MARKS + """, r AS (SELECT wave, verdict, row_number() OVER (PARTITION BY doc ORDER BY wave DESC, case_id DESC) AS k FROM m)
SELECT count(*) AS cases, count(*) FILTER (verdict <> 'undecidable') AS decidable, round(count(*) FILTER (verdict = 'correct') / count(*) FILTER (verdict <> 'undecidable'), 9) AS precision, count(DISTINCT wave) AS waves FROM r WHERE k = 1""")
def quality_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision over what could be decided, on each document's latest judgment."""
    m = _marks(spark, sf_dir).groupBy("doc").agg(F.max(F.struct("wave", "case_id", "verdict")).alias("x")).select("x.*")
    ok, sure = F.count_if(F.col("verdict") == "correct"), F.count_if(F.col("verdict") != "undecidable")
    return m.agg(F.count(F.lit(1)).alias("cases"), sure.alias("decidable"), F.round(ok / sure, 9).alias("precision"), F.countDistinct("wave").alias("waves"))


@query("WITH " + _MARKS + """, k AS (SELECT CASE WHEN doc % 5 = 0 THEN 'held_out' WHEN doc % 11 = 0 THEN 'special' ELSE 'dev' END AS split, coalesce(reason, 'none') AS rule, verdict FROM m)
SELECT CASE WHEN split IS NOT NULL THEN 'split' ELSE 'rule' END AS dimension, coalesce(split, rule) AS value, count(*) FILTER (verdict = 'correct') AS hits, count(*) FILTER (verdict = 'wrong') AS misses FROM k GROUP BY GROUPING SETS ((split), (rule))""")
def group_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and misses by split and by rule, in one pass of grouping sets."""
    m = _marks(spark, sf_dir).select(R.split_of(F.col("doc")).alias("split"), F.coalesce("reason", F.lit("none")).alias("rule"), "verdict")
    g = m.groupingSets([[F.col("split")], [F.col("rule")]], F.col("split"), F.col("rule")).agg(F.count_if(F.col("verdict") == "correct").alias("hits"), F.count_if(F.col("verdict") == "wrong").alias("misses"))
    return g.select(F.when(F.col("split").isNotNull(), "split").otherwise("rule").alias("dimension"), F.coalesce("split", "rule").alias("value"), "hits", "misses")


@query("SELECT CASE WHEN o_custkey % 5 = 0 THEN 'held_out' WHEN o_custkey % 11 = 0 THEN 'special' ELSE 'dev' END AS split, count(DISTINCT o_custkey) AS docs FROM orders GROUP BY 1")
def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(R.split_of(F.col("o_custkey")).alias("split")).agg(F.countDistinct("o_custkey").alias("docs"))


@query("SELECT lang, source, count(*) AS docs, sum(n_chars // 500 + 1)::BIGINT AS pages FROM documents WHERE n_chars > 0 GROUP BY ALL")
def recall_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the recall sample: those with pages."""
    d = table(spark, sf_dir, "documents").where("n_chars > 0")
    return d.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.floor(F.col("n_chars") / 500) + 1).alias("pages"))


@query("WITH " + _MARKS + ", k AS (SELECT wave, coalesce(reason, 'none') AS rule, case_id, row_number() OVER (PARTITION BY wave, coalesce(reason, 'none') ORDER BY md5('11|' || case_id), case_id) AS place FROM m) SELECT wave, rule, case_id, place FROM k WHERE place <= 5")
def precision_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five cases of each wave and rule, by a seeded hash."""
    from corpusq.operators.corpus import stratified_sample

    m = _marks(spark, sf_dir).select("wave", F.coalesce("reason", F.lit("none")).alias("rule"), "case_id")
    return stratified_sample(m, ["wave", "rule"], "case_id", 5, 11)


@query("WITH " + _MARKS + "SELECT case_id, doc FROM m WHERE verdict = 'correct' AND reason IS NULL AND doc % 2 = 0 UNION ALL SELECT case_id, doc FROM m WHERE verdict = 'wrong' AND reason IS NOT NULL")
def merged_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches as one; a case in both is an error."""
    m = _marks(spark, sf_dir)
    return R.merged(m.where("verdict = 'correct' AND reason IS NULL AND doc % 2 = 0").select("case_id", "doc"), m.where("verdict = 'wrong' AND reason IS NOT NULL").select("case_id", "doc"), "case_id")


@query("WITH " + _MARKS + ", r AS (SELECT l_orderkey AS case_id, min(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) AS tier FROM lineitem GROUP BY 1) SELECT case_id, doc FROM m WHERE verdict = 'correct' AND case_id IN (SELECT case_id FROM r WHERE tier = 1)")
def reviewed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finds judged correct that the scan still reports in the first tier."""
    tier = F.min(F.when(F.col("l_returnflag") == "R", 2).otherwise(1)).alias("tier")
    kept = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("case_id")).agg(tier).where("tier = 1")
    return _marks(spark, sf_dir).where("verdict = 'correct'").join(kept, "case_id", "left_semi").select("case_id", "doc")


@query("""WITH """ + _MARKS + """, z AS (SELECT c_custkey AS doc, c_nationkey * 100 AS a, c_nationkey * 100 + 800 AS b FROM customer)
SELECT verdict, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM z WHERE z.doc = m.doc AND case_id % 3000 >= a AND case_id % 3000 < b)) AS outside FROM m GROUP BY verdict""")
def convention_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all finds and of those outside the zones a convention leaves out."""
    z = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("_d"), (F.col("c_nationkey") * 100).alias("a"))
    m = _marks(spark, sf_dir)
    at = F.col("case_id") % 3000
    inside = m.join(z, (F.col("doc") == F.col("_d")) & (at >= F.col("a")) & (at < F.col("a") + 800), "left_semi").select("case_id", F.lit(1).alias("in"))
    return m.join(inside, "case_id", "left").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("in").isNull()).alias("outside"))


@query("""WITH g AS (SELECT o_custkey AS doc, o_orderkey AS spot, o_orderstatus = 'F' AS truth FROM orders), d AS (SELECT DISTINCT l_orderkey AS spot FROM lineitem WHERE l_returnflag = 'R')
SELECT count(*) FILTER (truth) AS zones, count(*) FILTER (truth AND d.spot IS NOT NULL) AS found, round(count(*) FILTER (truth AND d.spot IS NOT NULL) / count(*) FILTER (truth), 9) AS recall, round(count(*) FILTER (NOT truth AND d.spot IS NOT NULL) / count(*) FILTER (NOT truth), 9) AS false_alarm FROM g LEFT JOIN d USING (spot)""")
def detector_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall and false alarm rate of a detector against known zones."""
    d = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("at"), F.lit(True).alias("hit")).distinct()
    g = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("at"), (F.col("o_orderstatus") == "F").alias("truth")).join(d, "at", "left")
    hit, truth = F.col("hit").isNotNull(), F.col("truth")
    return g.agg(
        F.count_if(truth).alias("zones"), F.count_if(truth & hit).alias("found"), F.round(F.count_if(truth & hit) / F.count_if(truth), 9).alias("recall"),
        F.round(F.count_if(~truth & hit) / F.count_if(~truth), 9).alias("false_alarm"),
    )


@query("""WITH k AS (SELECT o_orderpriority AS rule, o_orderstatus AS evidence, o_custkey AS doc FROM orders)
SELECT CASE WHEN rule IS NOT NULL THEN 'rule' WHEN evidence IS NOT NULL THEN 'evidence' ELSE 'total' END AS part, coalesce(rule, evidence, '') AS value, count(*) AS n, count(DISTINCT doc) AS docs FROM k GROUP BY GROUPING SETS ((rule), (evidence), ())""")
def scan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a scan, by rule and by evidence."""
    rule, evidence = F.col("rule"), F.col("evidence")
    k = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("rule"), F.col("o_orderstatus").alias("evidence"), F.col("o_custkey").alias("doc"))
    g = k.groupingSets([[rule], [evidence], []], rule, evidence).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc").alias("docs"))
    return g.select(F.when(rule.isNotNull(), "rule").when(evidence.isNotNull(), "evidence").otherwise("total").alias("part"), F.coalesce(rule, evidence, F.lit("")).alias("value"), "n", "docs")


@query("WITH k AS (SELECT o_orderpriority AS category, o_custkey AS gid, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS auto FROM orders GROUP BY ALL) SELECT category, gid, n, auto, row_number() OVER (PARTITION BY category ORDER BY n DESC, gid) AS place FROM k QUALIFY place <= 10")
def corpus_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten commonest entities of each category (a report's top list)."""
    from corpusq.operators.ordered import top_per_group

    k = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("category"), F.col("o_custkey").alias("gid")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("auto"))
    return top_per_group(k, ["category"], [F.col("n").desc(), F.col("gid")], 10)


_ROWS = "o AS (SELECT c_custkey AS gid, c_mktsegment AS category, count(o_orderkey) AS mentions, count(*) FILTER (o_orderstatus = 'F') AS auto, count(DISTINCT o_orderdate) AS docs FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) "


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gid"), F.col("c_mktsegment").alias("category"))
    o = sized(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("gid"), "o_orderkey", "o_orderstatus", "o_orderdate"), "gid")
    return c.join(o, "gid", "left").groupBy("gid", "category").agg(F.count("o_orderkey").alias("mentions"), F.count_if(F.col("o_orderstatus") == "F").alias("auto"), F.countDistinct("o_orderdate").alias("docs"))


@query("WITH " + _ROWS + "SELECT 'none' AS filter, gid FROM o WHERE mentions = 0 UNION ALL SELECT 'noauto', gid FROM o WHERE auto = 0 AND mentions > 0 UNION ALL SELECT 'category', gid FROM o WHERE category = 'BUILDING'")
def entity_row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows each filter of the entity table shows."""
    o = _rows(spark, sf_dir)
    pick = lambda name, c: o.where(c).select(F.lit(name).alias("filter"), "gid")
    return pick("none", "mentions = 0").unionByName(pick("noauto", "auto = 0 AND mentions > 0")).unionByName(pick("category", "category = 'BUILDING'"))


@query("WITH " + _ROWS + """SELECT 'zero' AS sorter, gid, row_number() OVER (ORDER BY mentions > 0, gid) AS place FROM o QUALIFY place <= 25 UNION ALL SELECT 'mentions', gid, row_number() OVER (ORDER BY mentions DESC, gid) AS place FROM o QUALIFY place <= 25
UNION ALL SELECT 'docs', gid, row_number() OVER (ORDER BY docs DESC, mentions DESC, gid) AS place FROM o QUALIFY place <= 25 UNION ALL SELECT 'reviewshare', gid, row_number() OVER (ORDER BY round(CASE WHEN mentions > 0 THEN (mentions - auto) / mentions ELSE -1 END, 9) DESC, gid) AS place FROM o QUALIFY place <= 25""")
def entity_sorters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 25 rows (a page of the table) under each sorter."""
    o = stored(_rows(spark, sf_dir), "entity-rows")  # read once for each sorter
    share = F.round(F.when(F.col("mentions") > 0, (F.col("mentions") - F.col("auto")) / F.nullif("mentions", F.lit(0))).otherwise(-1), 9)
    sorters = {"zero": [F.col("mentions") > 0, F.col("gid")], "mentions": [F.col("mentions").desc(), F.col("gid")], "docs": [F.col("docs").desc(), F.col("mentions").desc(), F.col("gid")], "reviewshare": [share.desc(), F.col("gid")]}
    found = None
    for name, order in sorters.items():
        first = o.orderBy(*order).limit(25)
        one = first.select(F.lit(name).alias("sorter"), "gid", F.row_number().over(Window.orderBy(*order)).alias("place"))  # 25 rows
        found = one if found is None else found.unionByName(one)
    return found
