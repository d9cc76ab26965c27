"""Queries over error rates. A conversation's turns are the pages of a document; the transcription under test is a damaged copy.

Some pages are missing there, and one document in five numbers its pages otherwise, so that pages
meet by their place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.functions import edits
from corpusq.functions import text as X
from corpusq.functions.values import FOLD_FROM, FOLD_TO
from corpusq.operators.corpus import summary
from corpusq.operators.ordered import top_per_group
from corpusq.operators.pages import pair_pages
from corpusq.plans.base import query
from corpusq.plans.expected import folded
from corpusq.sources.tables import spread, table
from corpusq.storage import stored

#: SQL that both engines run: the damage of a transcription.
_DAMAGE = "concat(CASE WHEN (conv_id + turn) % 3 = 0 THEN replace(replace(replace(replace({0}, 'the', 'tbe'), 'ou', '0u'), ' of ', ' '), 'an', 'a-n') ELSE {0} END, CASE WHEN turn % 4 = 1 THEN repeat('x', 60) ELSE '' END)"
_PAGE = "CASE WHEN conv_id % 5 = 4 THEN turn + 101 ELSE turn + 1 END"
_PAIRS = f"""a AS (SELECT conv_id AS doc, role, turn + 1 AS page, {folded('text')} AS ref FROM conversations),
b AS (SELECT conv_id AS doc, {_PAGE} AS page, {_DAMAGE.format(folded('text'))} AS hyp FROM conversations WHERE NOT (conv_id % 5 = 3 AND turn = 1)),
m AS (SELECT a.doc, role, a.page, ref, hyp FROM a JOIN b ON a.doc = b.doc AND a.page = b.page),
x AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page) AS k FROM a WHERE doc NOT IN (SELECT doc FROM m)), y AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page) AS k FROM b WHERE doc NOT IN (SELECT doc FROM m)),
p AS (SELECT * FROM m UNION ALL SELECT x.doc, role, x.page, ref, hyp FROM x JOIN y ON x.doc = y.doc AND x.k = y.k) """


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, role, page, ref, hyp of every page both sides have."""
    plain = F.replace(F.translate("text", FOLD_FROM, FOLD_TO), F.lit("ß"), F.lit("ss")).alias("t")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", plain)
    ref = c.selectExpr("conv_id AS doc", "role", "turn + 1 AS page", "t AS ref")
    hyp = c.where("NOT (conv_id % 5 = 3 AND turn = 1)").selectExpr("conv_id AS doc", f"{_PAGE} AS page", f"{_DAMAGE.format('t')} AS hyp")
    return spread(pair_pages(ref, hyp, "doc", "page"), "doc", "page")


def _sql_cer(ref: str = "ref", hyp: str = "hyp") -> str:
    return f"(CASE WHEN length({ref}) = 0 THEN CASE WHEN length({hyp}) = 0 THEN 0.0 ELSE 1.0 END ELSE levenshtein({hyp}, {ref})::DOUBLE / length({ref}) END)"


_CER = _sql_cer()


@query("WITH " + _PAIRS + f"SELECT doc, page, levenshtein(hyp, ref) AS distance, round({_CER}, 9) AS cer FROM p")
def cer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, hyp = F.col("ref"), F.col("hyp")
    return _pairs(spark, sf_dir).select("doc", "page", X.distance(hyp, ref).alias("distance"), F.round(X.cer(ref, hyp), 9).alias("cer"))


@query("WITH " + _PAIRS + f"SELECT role, count(*) AS pairs, round(sum(({_CER}) * length(ref)) / sum(length(ref)), 9) AS weighted, round(avg({_CER}), 9) AS mean FROM p GROUP BY role")
def weighted_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = X.cer(F.col("ref"), F.col("hyp")), F.length("ref")
    return _pairs(spark, sf_dir).groupBy("role").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.sum(c * n) / F.sum(n), 9).alias("weighted"), F.round(F.avg(c), 9).alias("mean"))


@query("WITH " + _PAIRS + f"SELECT doc, page, round({_CER}, 9) AS cer FROM p WHERE {_CER} > 0.1 ORDER BY cer DESC, doc, page")
def outlier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A sort reads its rows twice, first for the bounds of its ranges; a filter would move before the dealing.
    rates = stored(_pairs(spark, sf_dir).select("doc", "page", X.cer(F.col("ref"), F.col("hyp")).alias("cer")), "rates")
    return rates.where("cer > 0.1").select("doc", "page", F.round("cer", 9).alias("cer")).orderBy(F.col("cer").desc(), "doc", "page")


_REGIMES = ["raw", "nfc", "nfc_hyphen", "nfc_hyphen_case"]
#: After a regime both sides go to ASCII, as one engine's distance counts bytes: a combining accent or a long dash is one sign.
_ASCII = "replace(replace(replace(" + "{0}" + ", chr(769), '~'), chr(8208), '='), chr(173), '_')"
_SQL_REGIMES = {
    "raw": "{0}", "nfc": "nfc_normalize({0})", "nfc_hyphen": "replace(replace(nfc_normalize({0}), chr(173), ''), chr(8208), '-')",
    "nfc_hyphen_case": "lower(replace(replace(replace(nfc_normalize({0}), chr(173), ''), chr(8208), '-'), 'ß', 'ss'))",
}
_VARIED = "replace(replace(replace(CASE WHEN conv_id % 2 = 0 THEN replace(text, 'é', 'e' || {acute}) ELSE text END, 'on', 'o' || {hyphen} || 'n'), 'en', 'e' || {soft} || 'n'), 'L', 'l')"


@query("WITH t AS (SELECT text AS r, " + _VARIED.format(acute="chr(769)", hyphen="chr(8208)", soft="chr(173)") + " AS h FROM conversations), k AS (SELECT unnest([" + ", ".join("{'regime': '" + k + "', 'r': " + folded(_ASCII.format(f.format("r"))) + ", 'h': " + folded(_ASCII.format(f.format("h"))) + "}" for k, f in _SQL_REGIMES.items()) + "]) AS x FROM t) SELECT x.regime AS regime, count(*) AS n, round(avg(" + _sql_cer("x.r", "x.h") + "), 9) AS mean, round(quantile_cont(" + _sql_cer("x.r", "x.h") + ", 0.5), 9) AS median, round(max(" + _sql_cer("x.r", "x.h") + "), 9) AS hi FROM k GROUP BY 1")
def multi_norm_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rate under the four regimes; the copy has decomposed accents, typographic and soft hyphens and small capitals."""
    varied = F.expr(_VARIED.format(acute="'\u0301'", hyphen="'\u2010'", soft="'\u00ad'"))
    plain = lambda c: F.replace(F.translate(F.translate(c, "\u0301\u2010\u00ad", "~=_"), FOLD_FROM, FOLD_TO), F.lit("ß"), F.lit("ss"))
    c = spread(table(spark, sf_dir, "conversations"), "conv_id", "turn").select(F.col("text").alias("r"), varied.alias("h"))
    each = F.array(*[F.struct(F.lit(k).alias("regime"), plain(X.regime(F.col("r"), k)).alias("r"), plain(X.regime(F.col("h"), k)).alias("h")) for k in _REGIMES])
    rates = c.select(F.inline(each)).select("regime", X.cer(F.col("r"), F.col("h")).alias("c"))
    return summary(rates, ["regime"], "c", digits=9).select("regime", "n", "mean", "median", "hi")


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = [edits.words_as_chars(r, h) for r, h in zip(b.column("ref").to_pylist(), b.column("hyp").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("page"), pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["doc", "page", "ref", "hyp"])


@query()
def wer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word error rate: words become single characters, then the JVM's Levenshtein counts."""
    coded = _pairs(spark, sf_dir).select("doc", "page", "ref", "hyp").mapInArrow(_coded, "doc long, page long, ref string, hyp string")
    return coded.select("doc", "page", X.cer(F.col("ref"), F.col("hyp")).alias("wer"))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for d, n, r, h in zip(*(b.column(c).to_pylist() for c in ("doc", "page", "ref", "hyp"))):
            rows += [(d, n, t, a, e, r[a:e], h[x:y], edits.category(r[a:e], h[x:y]), r[max(0, a - 20) : e + 20]) for t, a, e, x, y in edits.opcodes(r, h) if t != "equal"]
        cols = list(zip(*rows)) or [()] * 9
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc", "page", "tag", "start", "end", "ref", "hyp", "category", "context"])


def _diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pairs(spark, sf_dir).where("ref <> hyp").select("doc", "page", "ref", "hyp")
    return p.mapInArrow(_differences, "doc long, page long, tag string, start long, end long, ref string, hyp string, category string, context string")


@query("WITH " + _PAIRS + ", q AS (SELECT doc, page, levenshtein(hyp, ref) AS distance, CASE WHEN (page - 1) % 4 = 1 THEN 60 ELSE 0 END AS scope FROM p WHERE ref <> hyp) SELECT doc, page, distance, distance - scope AS fidelity, scope FROM q")
def edit_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real errors and long insertions of the edit script; the damage inserts 60 characters on every fourth page."""
    n = F.greatest(F.length("ref"), F.length("hyp"))
    scope = (F.col("tag") == "insert") & (F.length("hyp") >= edits.SCOPE_RUN)
    return _diff_rows(spark, sf_dir).groupBy("doc", "page").agg(F.sum(n).alias("distance"), F.sum(F.when(scope, 0).otherwise(n)).alias("fidelity"), F.sum(F.when(scope, n).otherwise(0)).alias("scope"))


@query()
def error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, characters and up to three examples per category."""
    chars = F.greatest(F.length("ref"), F.length("hyp")).alias("chars")
    d = stored(_diff_rows(spark, sf_dir).select("doc", "page", "start", "ref", "hyp", "category", chars), "differences")  # read twice
    counts = d.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    first = top_per_group(d, ["category"], [F.col("doc"), F.col("page"), F.col("start")], 3)
    shown = first.groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat_ws("→", "ref", "hyp").alias("x")))), lambda x: x["x"]).alias("examples"))
    return counts.join(shown, "category")


@query()
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters replaced, inserted (no reference) and deleted (no text)."""
    empty = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    pairs = F.arrays_zip(empty(F.col("ref")).alias("r"), empty(F.col("hyp")).alias("h"))
    d = _diff_rows(spark, sf_dir).select(F.explode(pairs).alias("x")).select(F.col("x.r").alias("ref"), F.col("x.h").alias("hyp"))
    return d.groupBy("ref", "hyp").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + _PAIRS + f", o AS (SELECT doc, page, {_CER} AS a, {_sql_cer('lower(ref)', 'lower(hyp)')} AS b FROM p) SELECT count(*) AS n, count(*) FILTER (b < a - 1e-6) AS better, count(*) FILTER (b > a + 1e-6) AS worse, count(*) FILTER (abs(b - a) <= 1e-6) AS unchanged, round(avg(b - a), 9) AS mean_change FROM o")
def paired_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same documents: better, worse, unchanged."""
    a, b = X.cer(F.col("ref"), F.col("hyp")), X.cer(F.lower("ref"), F.lower("hyp"))
    d = _pairs(spark, sf_dir).select((b - a).alias("c"))
    return d.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") < -1e-6).alias("better"), F.count_if(F.col("c") > 1e-6).alias("worse"),
        F.count_if(F.abs("c") <= 1e-6).alias("unchanged"), F.round(F.avg("c"), 9).alias("mean_change"),
    )


@query("WITH " + _PAIRS + f", g AS (SELECT doc, sum(({_CER}) * length(ref)) / sum(length(ref)) AS weighted, avg({_CER}) AS mean, string_agg(ref, ' ' ORDER BY page) AS r, string_agg(hyp, ' ' ORDER BY page) AS h, count(*) AS n FROM p GROUP BY doc) SELECT doc, round(CASE WHEN n < 4 THEN levenshtein(h, r)::DOUBLE / length(r) ELSE coalesce(weighted, mean) END, 9) AS cer, CASE WHEN n < 4 THEN 'full' WHEN weighted IS NOT NULL THEN 'weighted' ELSE 'mean' END AS source FROM g")
def doc_cer_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's rate: that of its whole text where it has one (here: under four pages), else the weighted, else the plain mean."""
    c, n = X.cer(F.col("ref"), F.col("hyp")), F.length("ref")
    text = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", name))), lambda x: x[name]), " ")
    few = F.count(F.lit(1)).over(Window.partitionBy("doc")) < 4
    p = _pairs(spark, sf_dir).withColumn("few", few)
    whole = p.where("few").groupBy("doc").agg(text("ref").alias("r"), text("hyp").alias("h")).select("doc", X.cer(F.col("r"), F.col("h")).alias("full"))
    g = p.groupBy("doc").agg((F.sum(c * n) / F.sum(n)).alias("weighted"), F.avg(c).alias("mean")).join(whole, "doc", "left")
    source = F.when(F.col("full").isNotNull(), "full").when(F.col("weighted").isNotNull(), "weighted").otherwise("mean")
    return g.select("doc", F.round(F.coalesce("full", "weighted", "mean"), 9).alias("cer"), source.alias("source"))


@query("WITH " + _PAIRS + f", k AS (SELECT role, {_CER} AS c FROM p), g AS (SELECT 'all' AS stratum, c FROM k UNION ALL SELECT role, c FROM k) SELECT stratum, count(*) AS n, round(avg(c), 9) AS mean, round(quantile_cont(c, 0.5), 9) AS median, round(coalesce(stddev_samp(c), 0), 9) AS std, round(min(c), 9) AS lo, round(max(c), 9) AS hi FROM g GROUP BY 1")
def overall_and_strata_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median, sample deviation and range of the pages' rates, overall and by stratum."""
    k = _pairs(spark, sf_dir).select(F.col("role").alias("stratum"), X.cer(F.col("ref"), F.col("hyp")).alias("c"))
    both = k.select(F.explode(F.array("stratum", F.lit("all"))).alias("stratum"), "c")
    return summary(both, ["stratum"], "c", digits=9)


@query("WITH " + _PAIRS + """, d AS (SELECT doc, sum(length(ref) - length(replace(ref, 'ou', ''))) / 2 AS ou, sum(length(ref) - length(replace(ref, 'an', ''))) / 2 AS an, sum(length(ref) - length(replace(ref, 'the', ''))) / 3 AS the FROM p WHERE (doc + page - 1) % 3 = 0 GROUP BY doc),
u AS (UNPIVOT d ON ou, an, the INTO NAME category VALUE n), s AS (SELECT doc, category, n, n / nullif(sum(n) OVER (PARTITION BY doc), 0) AS share FROM u WHERE n > 0)
SELECT category, sum(n)::BIGINT AS n, round(avg(share), 9) AS mean_share FROM s GROUP BY 1""")
def normalised_error_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute counts per category, and the mean of the documents' shares."""
    return _category_shares(spark, sf_dir).groupBy("category").agg(F.sum("n").alias("n"), F.round(F.avg("share"), 9).alias("mean_share"))


def _category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _pairs(spark, sf_dir).where("(doc + page - 1) % 3 = 0")
    n = lambda w: F.sum(F.regexp_count("ref", F.lit(w))).alias(w)
    d = p.groupBy("doc").agg(n("ou"), n("an"), n("the")).unpivot("doc", ["ou", "an", "the"], "category", "n").where("n > 0")
    return d.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("doc")))


@query("WITH " + _PAIRS + """, d AS (SELECT doc, sum(length(ref) - length(replace(ref, 'ou', ''))) / 2 AS ou, sum(length(ref) - length(replace(ref, 'an', ''))) / 2 AS an, sum(length(ref) - length(replace(ref, 'the', ''))) / 3 AS the FROM p WHERE (doc + page - 1) % 3 = 0 GROUP BY doc),
u AS (UNPIVOT d ON ou, an, the INTO NAME category VALUE n), s AS (SELECT doc, category, n / nullif(sum(n) OVER (PARTITION BY doc), 0) AS share FROM u WHERE n > 0)
SELECT doc, category, round(share, 9) AS share, row_number() OVER (PARTITION BY doc ORDER BY share DESC, category) AS place FROM s QUALIFY place <= 2""")
def doc_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's largest error categories."""
    d = top_per_group(_category_shares(spark, sf_dir), ["doc"], [F.col("share").desc(), F.col("category")], 2)
    return d.select("doc", "category", F.round("share", 9).alias("share"), "place")


@query("WITH " + _PAIRS + f", o AS (SELECT doc, page, ref, hyp, {_CER} AS c FROM p) SELECT doc, page, round(c, 9) AS cer, length(ref) AS chars, round(sum(c * length(ref)) OVER (PARTITION BY doc) / sum(length(ref)) OVER (PARTITION BY doc), 9) AS doc_cer, c > 0.05 AS shown FROM o")
def pagewise_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per matched page its rate and length, the document's weighted rate, and whether its differences are shown."""
    c, n, doc = X.cer(F.col("ref"), F.col("hyp")), F.length("ref"), Window.partitionBy("doc")
    o = _pairs(spark, sf_dir).select("doc", "page", c.alias("c"), n.alias("chars"))
    total = F.sum(F.col("c") * F.col("chars")).over(doc) / F.sum("chars").over(doc)
    return o.select("doc", "page", F.round("c", 9).alias("cer"), "chars", F.round(total, 9).alias("doc_cer"), (F.col("c") > 0.05).alias("shown"))
