"""Queries over entities and mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.functions import text as X
from corpusq.operators import entities as E
from corpusq.operators import matcher
from corpusq.operators.ordered import top_per_group
from corpusq.plans.base import query
from corpusq.sources.tables import table


@query("""WITH b AS (SELECT c_custkey AS doc, c_name AS surface, c_nationkey AS gid, c_mktsegment AS category, CASE WHEN c_custkey % 3 = 0 THEN 'headword' ELSE 'variant' END AS source, CASE WHEN c_custkey % 5 = 0 THEN 'case-tolerant' WHEN c_custkey % 97 = 0 THEN 'exact:suspect' ELSE 'exact' END AS rule FROM customer),
s AS (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 4 AND count(*) > 60),
f AS (SELECT *, source <> 'headword' AS a, rule = 'case-tolerant' AS b, NOT contains(surface, ' ') AS c, length(surface) <= 12 AS d, category = 'BUILDING' AS e, gid IN (SELECT * FROM s) AS g, gid >= 24 AS x, contains(rule, ':suspect') AS y FROM b),
p AS (SELECT *, a::INT * 2 + b::INT * 2 + c::INT * 2 + d::INT + e::INT + g::INT + x::INT * 99 + y::INT * 99 AS score FROM f)
SELECT 'f' || lpad((row_number() OVER (ORDER BY score DESC, doc))::VARCHAR, 4, '0') AS case_id, doc, score::INT AS score, CASE WHEN score >= 4 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS stratum,
  array_to_string(list_filter([CASE WHEN a THEN 'variant_form_source' END, CASE WHEN b THEN 'case_tolerant_rule' END, CASE WHEN c THEN 'single_token_surface' END, CASE WHEN d THEN 'short_surface' END, CASE WHEN e THEN 'category_work' END, CASE WHEN g THEN 'shared_surname_gid' END, CASE WHEN x THEN 'gid_not_listed' END, CASE WHEN y THEN 'suspect_rule_in_tier1' END], lambda z : z IS NOT NULL), ',') AS features FROM p""")  # fmt: skip
def risk_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rule = F.when(k % 5 == 0, "case-tolerant").when(k % 97 == 0, "exact:suspect").otherwise("exact")
    c = table(spark, sf_dir, "customer").select(k.alias("doc"), F.col("c_name").alias("surface"), F.col("c_nationkey").alias("gid"), F.col("c_mktsegment").alias("category"), F.when(k % 3 == 0, "headword").otherwise("variant").alias("source"), rule.alias("rule"))
    shared = c.groupBy("gid").agg(F.countDistinct("category").alias("a"), F.count(F.lit(1)).alias("b")).where("a > 4 and b > 60").select("gid", F.lit(True).alias("shared"))
    c = c.join(shared, "gid", "left")
    features = {
        "variant_form_source": F.col("source") != "headword", "case_tolerant_rule": F.col("rule") == "case-tolerant", "single_token_surface": ~F.contains("surface", F.lit(" ")),
        "short_surface": F.length("surface") <= 12, "category_work": F.col("category") == "BUILDING", "shared_surname_gid": F.col("shared").isNotNull(),
    }
    anomalies = {"gid_not_listed": F.col("gid") >= 24, "suspect_rule_in_tier1": F.contains("rule", F.lit(":suspect"))}
    return E.risk_ranked(c, features, anomalies, ["doc"]).select("case_id", "doc", "score", "stratum", "features")


@query("WITH e AS (SELECT c_custkey AS gid, c_name AS name FROM customer UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier) SELECT lower(right(name, 3)) AS key, count(DISTINCT gid) AS bearers FROM e GROUP BY 1 HAVING count(DISTINCT gid) > 1")
def shared_surname_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gid"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey") + 1000000, "s_name").toDF("gid", "name")
    return E.shared_keys(c.unionByName(s), X.fold(F.right("name", F.lit(3))))


_FORMS = """f AS (SELECT DISTINCT gid, x.form AS form, x.rule AS rule, x.tier AS tier FROM (SELECT p_partkey AS gid, unnest([{'form': p_name, 'rule': 'headword', 'tier': 1}, {'form': upper(p_name), 'rule': 'caps-form', 'tier': 1},
  {'form': CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN array_to_string(list_reverse(string_split(p_name, ' ')), ' ') END, 'rule': 'natural-order', 'tier': 1},
  {'form': CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN left(p_name, 1) || '. ' || string_split(p_name, ' ')[-1] END, 'rule': 'initial-form', 'tier': 2},
  {'form': CASE WHEN len(string_split(p_name, ' ')) >= 3 THEN array_to_string(string_split(p_name, ' ')[1:2], ' ') END, 'rule': 'short-title', 'tier': 2}]) AS x FROM part) WHERE x.form IS NOT NULL) """


@query("WITH " + _FORMS + "SELECT * FROM f WHERE tier = 1 OR form NOT IN (SELECT form FROM f WHERE tier = 1)")
def lexicon_derived_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.derived_forms(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gid"), F.col("p_name").alias("label")))


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A curated list of passages as entities: each passage's first two words are its name, its words of nine letters and more its surnames."""
    words = F.filter(F.split("text", r"[^\p{L}]+"), lambda w: w != "")
    b = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("g"), F.col("item_id").cast("string")).alias("gid"), words.alias("w"))
    forms = b.where(F.size("w") > 1).select(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("form"), "gid", F.lit("person").alias("category"), F.lit("full-name").alias("rule"))
    long = b.select("gid", F.explode(F.array_distinct(F.filter("w", lambda w: F.length(w) >= 9))).alias("key"))
    return b.select("gid"), forms, long.select("key", "gid", F.lit(False).alias("released"))


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, forms, surnames = _lists(spark, sf_dir)
    return matcher.find(table(spark, sf_dir, "documents"), forms, surnames).withColumnRenamed("doc", "doc_id")


@query()
def mention_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every find of the list in every document (tests hold the rules against sentences worked out by hand and a plain scan)."""
    return _mentions(spark, sf_dir)


@query()
def mention_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _mentions(spark, sf_dir)
    return m.groupBy("rule", "tier", E.candidate_class(F.col("rule"), F.col("tier")).alias("class")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs"))


@query()
def mention_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.overview(_lists(spark, sf_dir)[0], _mentions(spark, sf_dir))


_SURFACES = r"s AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+(?: [A-Z][a-z]+)+|[A-Z][a-z]{7,}')) AS surface FROM documents) "


@query("WITH " + _SURFACES + "SELECT surface, count(*) AS n, count(DISTINCT doc_id) AS docs, array_to_string(list_sort(list(DISTINCT doc_id))[1:3], ',') AS first_docs FROM s GROUP BY surface HAVING count(*) >= CASE WHEN contains(surface, ' ') THEN 1 ELSE 2 END")
def unlisted_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised names outside the list: several words once, single words from two occurrences."""
    s = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+(?: [A-Z][a-z]+)+|[A-Z][a-z]{7,}"), F.lit(0))).alias("surface"))
    per = s.groupBy("surface", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    first = top_per_group(per, ["surface"], [F.col("doc_id")], 3).groupBy("surface").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("first_docs"))
    g = per.groupBy("surface").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("docs")).join(first, "surface")
    return g.where(F.col("n") >= F.when(F.contains("surface", F.lit(" ")), 1).otherwise(2))


_OUTCOMES = "o AS (SELECT lang, source, CASE WHEN quality = 1 AND n_chars > 600 THEN 'hit' WHEN quality = 1 THEN 'miss' WHEN quality = 0 AND n_chars > 600 THEN 'false_positive' ELSE 'worklist' END AS outcome FROM documents JOIN labels USING (doc_id)) "


@query("WITH " + _OUTCOMES + """, n AS (SELECT lang, count(*) FILTER (outcome = 'hit') AS h, count(*) FILTER (outcome = 'false_positive') AS f, count(*) FILTER (outcome IN ('hit', 'miss', 'worklist')) AS t, count(*) FILTER (outcome = 'worklist') AS w FROM o GROUP BY 1)
SELECT lang, CASE WHEN h + f > 0 THEN round(h / (h + f), 9) END AS precision, CASE WHEN t > 0 THEN round(h / t, 9) END AS recall, CASE WHEN t > 0 THEN round((h + w) / t, 9) END AS coverage FROM n""")
def precision_recall_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("quality"), F.col("n_chars")
    outcome = F.when((q == 1) & (n > 600), "hit").when(q == 1, "miss").when((q == 0) & (n > 600), "false_positive").otherwise("worklist")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return E.precision_recall(d.select("lang", outcome.alias("outcome")), ["lang"])


@query("""WITH m AS (SELECT o_custkey AS gid, o_orderkey AS doc_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS tier, CASE WHEN o_orderkey % 3 = 0 THEN [o_custkey + 1] ELSE [] END AS alt FROM orders),
a AS (SELECT alt AS gid, count(*) AS n FROM (SELECT unnest(alt) AS alt FROM m) GROUP BY 1), o AS (SELECT gid, count(*) FILTER (tier = 1) AS auto, count(*) FILTER (tier > 1) AS review, count(DISTINCT doc_id) AS docs FROM m GROUP BY 1)
SELECT c_custkey AS gid, coalesce(auto, 0) AS auto, coalesce(review, 0) AS review, coalesce(docs, 0) AS docs, coalesce(n, 0) AS alternative FROM customer LEFT JOIN o ON o.gid = c_custkey LEFT JOIN a ON a.gid = c_custkey""")  # fmt: skip
def entity_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    alt = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.col("o_custkey") + 1)).otherwise(F.array().cast("array<bigint>"))
    m = o.select(F.col("o_custkey").alias("gid"), F.col("o_orderkey").alias("doc_id"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("tier"), alt.alias("alternatives"))
    return E.overview(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("gid")), m)


@query("""WITH e AS (SELECT s_suppkey AS gid, s_name AS label, s_nationkey % 30 + CASE WHEN s_suppkey % 20 = 0 THEN 25 ELSE 0 END AS parent FROM supplier UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier WHERE s_suppkey % 25 = 0)
SELECT 'duplicate_id' AS kind, gid FROM e GROUP BY gid HAVING count(*) > 1 UNION ALL SELECT 'unresolved_parent', gid FROM e WHERE parent NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'bad_label', gid FROM e WHERE NOT regexp_matches(label, '^Supplier#[0-8]+$') UNION ALL SELECT DISTINCT 'collision', a.gid FROM e a JOIN e b ON right(a.label, 2) = right(b.label, 2) AND a.gid < b.gid""")  # fmt: skip
def entity_list_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate ids, dangling parents, malformed labels, form collisions."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    e = s.select(k.alias("gid"), F.col("s_name").alias("label"), (F.col("s_nationkey") % 30 + F.when(k % 20 == 0, 25).otherwise(0)).alias("parent"))
    e = e.unionByName(s.where(k % 25 == 0).select(k.alias("gid"), F.col("s_name").alias("label"), F.lit(1).alias("parent")))
    dup = e.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_id").alias("kind"), "gid")
    dangling = e.join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("parent")), "parent", "left_anti").select(F.lit("unresolved_parent").alias("kind"), "gid")
    bad = e.where(~F.col("label").rlike("^Supplier#[0-8]+$")).select(F.lit("bad_label").alias("kind"), "gid")
    # A collision needs a larger id with the same form: the largest per form tells, no self-join of a group.
    form = F.right("label", F.lit(2)).alias("form")
    most = e.groupBy(form).agg(F.max("gid").alias("most"))
    hit = e.select("gid", form).join(most, "form").where("gid < most").select(F.lit("collision").alias("kind"), "gid").distinct()
    return dup.unionByName(dangling).unionByName(bad).unionByName(hit)


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents), s AS (SELECT doc_id, w FROM l WHERE regexp_matches(w, '^[A-Z][a-z]{3,}$')), t AS (SELECT DISTINCT doc_id, w FROM l WHERE regexp_matches(w, '^[a-z]{4,}$'))
SELECT s.doc_id, count(*) AS capitalised, count(t.w) AS suspect FROM s LEFT JOIN t ON s.doc_id = t.doc_id AND lower(s.w) = t.w GROUP BY 1""")  # fmt: skip
def lowercase_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capitalised words whose lower-case twin stands in the same document: homograph suspicion."""
    words = F.split("text", " ")
    d = table(spark, sf_dir, "documents").select("doc_id", F.filter(words, lambda w: w.rlike("^[A-Z][a-z]{3,}$")).alias("c"), F.array_distinct(F.filter(words, lambda w: w.rlike("^[a-z]{4,}$"))).alias("t"))
    # Row-local: a set of the document's lower-case words, met by array operations on distinct words only.
    d = d.where(F.size("c") > 0)
    caps = d.select("doc_id", F.explode("c").alias("w")).groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    twins = d.select("doc_id", F.explode("t").alias("lower"))
    met = caps.join(twins, [caps["doc_id"] == twins["doc_id"], F.lower(caps["w"]) == twins["lower"]], "left").select(caps["doc_id"], "n", "lower")
    return met.groupBy("doc_id").agg(F.sum("n").alias("capitalised"), F.coalesce(F.sum(F.when(F.col("lower").isNotNull(), F.col("n"))), F.lit(0)).alias("suspect"))
