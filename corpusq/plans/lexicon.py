"""Queries over the building and checking of an entity list. Parts, suppliers and customers stand in for entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators import lexicon as L
from corpusq.plans.base import query
from corpusq.sources.tables import table

#: A person's label as a list gives it: surname, forename.
_NAMES = "n AS (SELECT p_partkey AS gid, upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) || ', ' || upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) AS name, p_type AS category FROM part) "


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = [F.initcap(F.split_part("p_name", F.lit(" "), F.lit(k))) for k in (2, 1)]
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gid"), F.concat_ws(", ", *words).alias("name"), F.col("p_type").alias("category"))


@query("WITH " + _NAMES + """, s AS (SELECT gid, name, split_part(name, ', ', 1) AS sur, split_part(name, ', ', 2) AS fore FROM n)
SELECT gid, unnest([name, fore || ' ' || sur, left(fore, 1) || '. ' || sur]) AS form, unnest(['variant-full-name', 'full-name', 'initial-surname']) AS rule FROM s UNION ALL SELECT gid, sur, 'surname' FROM s WHERE length(sur) >= 4""")
def person_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted and natural name, initial form, and the surname where it is distinctive."""
    return L.person_forms(_names(spark, sf_dir))


@query("WITH " + _NAMES + ", f AS (SELECT DISTINCT split_part(name, ', ', 2) || ' ' || split_part(name, ', ', 1) AS form FROM n) SELECT form, upper(form) AS caps FROM f WHERE length(upper(form)) = length(form) AND contains(form, ' ')")
def caps_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of two words and more in capitals, where capitals keep their length."""
    f = L.person_forms(_names(spark, sf_dir)).where("rule = 'full-name'").select("form").distinct()
    return L.caps(f)


@query("WITH k AS (SELECT p_brand AS gid, split_part(p_name, ' ', 1) AS name FROM part), g AS (SELECT gid, list_sort(list(DISTINCT name)) AS names FROM k GROUP BY gid), r AS (SELECT p_brand AS gid, min(p_name) AS label FROM part GROUP BY 1) SELECT gid, unnest(names) AS name, contains(label, unnest(names)) AS corroborated FROM g JOIN r USING (gid)")
def legacy_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old list by entity instead of by name, each name corroborated by the entity's label or demoted."""
    old = table(spark, sf_dir, "part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("name"), F.col("p_brand").alias("gid")).distinct()
    label = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("gid")).agg(F.min("p_name").alias("label"))
    return old.join(label, "gid").select("gid", "name", F.contains("label", F.col("name")).alias("corroborated"))


@query("WITH " + _NAMES + ", f AS (SELECT split_part(name, ', ', 2) || ' ' || split_part(name, ', ', 1) AS form FROM n), s AS (SELECT split_part(name, ', ', 1) AS form FROM n), d AS (SELECT DISTINCT unnest([split_part(p_name, ' ', 2), upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2)]) AS form FROM part) SELECT form FROM d WHERE form NOT IN (SELECT form FROM f) AND form NOT IN (SELECT form FROM s)")
def tier1_reach_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived forms that are neither a surname nor a form of the first tier."""
    first = L.person_forms(_names(spark, sf_dir)).where("rule = 'full-name'").select("form").unionByName(_names(spark, sf_dir).select(F.split_part("name", F.lit(", "), F.lit(1)).alias("form")))
    word = lambda k: F.split_part("p_name", F.lit(" "), F.lit(k))
    derived = table(spark, sf_dir, "part").select(F.explode(F.array(word(2), F.initcap(word(1)))).alias("form")).distinct()
    return derived.join(first, "form", "left_anti")


@query("SELECT p_partkey AS gid, p_name AS form, p_name = lower(p_name) AND label <> lower(label) AS lowered, p_name = lower(p_name) AND starts_with(label, upper(left(label, 1))) AS incipit FROM (SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN upper(left(p_name, 1)) || substr(p_name, 2) ELSE p_name END AS label FROM part)")
def case_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writings that only case parts from a form: all lower, or a work's lower incipit, are suspect."""
    label = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substr(p_name, 2)"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gid"), F.col("p_name").alias("form"), *[c.alias(k) for k, c in L.case_doubts(F.col("p_name"), label).items()])


@query("""WITH e AS (SELECT s_suppkey AS gid, s_name AS name FROM supplier), c AS (SELECT s_suppkey AS gid, CASE WHEN s_suppkey % 9 = 0 THEN 404 WHEN s_suppkey % 13 = 0 THEN 500 ELSE 200 END AS status, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name || CASE WHEN s_suppkey % 5 = 0 THEN 'x' ELSE '' END END AS preferred, s_nationkey AS kind FROM supplier WHERE s_suppkey % 17 > 0)
SELECT gid, CASE WHEN status IS NULL THEN 'not_cached' WHEN status = 404 THEN 'not_found' WHEN status <> 200 THEN 'other_status' WHEN preferred IS NULL THEN 'no_preferred_name' WHEN preferred <> name THEN 'name_differs' WHEN kind > 20 THEN 'wrong_type' END AS finding FROM e LEFT JOIN c USING (gid) WHERE finding IS NOT NULL""")
def cache_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities against the cached authority records; the first thing that is wrong."""
    e, c = _cached(spark, sf_dir)
    return L.cache_findings(e, c)


def _cached(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    status = F.when(k % 9 == 0, 404).when(k % 13 == 0, 500).otherwise(200)
    preferred = F.when(k % 7 != 0, F.concat("s_name", F.when(k % 5 == 0, "x").otherwise("")))
    cache = s.where("s_suppkey % 17 > 0").select(k.alias("gid"), status.alias("status"), preferred.alias("preferred"), (F.col("s_nationkey") <= 20).alias("typed"))
    return s.select(k.alias("gid"), F.col("s_name").alias("name")), cache


@query("SELECT CASE WHEN s_suppkey % 9 = 0 THEN 404 WHEN s_suppkey % 13 = 0 THEN 500 ELSE 200 END AS status, count(*) AS n FROM supplier WHERE s_suppkey % 17 > 0 GROUP BY 1")
def cache_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cached(spark, sf_dir)[1].groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_VARIANTS = "v AS (SELECT p_partkey AS gid, p_name AS label, unnest([p_name, lower(p_name), split_part(p_name, ' ', 2), split_part(p_name, ' ', 2)]) AS form FROM part) "


def _variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gid"), F.col("p_name").alias("label"), F.explode(F.array("p_name", F.lower("p_name"), second, second)).alias("form"))


@query("WITH " + _VARIANTS + "SELECT 'duplicate' AS finding, gid, form FROM v GROUP BY gid, form HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'redundant', gid, form FROM v WHERE form = label UNION ALL SELECT DISTINCT 'collision', gid, form FROM v WHERE form IN (SELECT form FROM v GROUP BY form HAVING count(DISTINCT gid) > 1)")
def variant_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants twice in an entry, equal to its label, or borne by several entries."""
    return L.variant_findings(_variants(spark, sf_dir))


@query("WITH " + _VARIANTS + ", d AS (SELECT DISTINCT gid, form FROM v) SELECT gid, form, CASE WHEN gid % 3 = 0 THEN 'keep' WHEN gid % 5 <> 1 THEN 'suspect' END AS status FROM d WHERE NOT (gid % 3 > 0 AND gid % 5 = 1)")
def variant_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of the cache after review: approved ones stay, rejected ones go, the others are suspect."""
    d = _variants(spark, sf_dir).select("gid", "form").distinct()
    decisions = d.select("gid", F.when(F.col("gid") % 3 == 0, "approve").when(F.col("gid") % 5 == 1, "reject").alias("decision")).where("decision is not null").distinct()
    return L.reviewed(d, decisions)


@query("WITH a AS (SELECT c_custkey AS gid, c_name AS label, 'person' AS category, 1 AS k FROM customer UNION ALL SELECT s_suppkey, s_name, 'org', 2 FROM supplier UNION ALL SELECT p_partkey, p_name, 'work', 3 FROM part) SELECT gid, label, category FROM a QUALIFY row_number() OVER (PARTITION BY gid ORDER BY k) = 1")
def listed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lists as one; of entries with one id the first list's stays."""
    one = lambda t, key, name, category: table(spark, sf_dir, t).select(F.col(key).cast("long").alias("gid"), F.col(name).alias("label"), F.lit(category).alias("category"))
    return L.listed([one("customer", "c_custkey", "c_name", "person"), one("supplier", "s_suppkey", "s_name", "org"), one("part", "p_partkey", "p_name", "work")])


@query("WITH c AS (SELECT s_suppkey AS gid, 'born ca. ' || (1800 + s_suppkey % 150) || ', Bern' AS born FROM supplier WHERE s_suppkey % 4 > 0) SELECT s_suppkey AS gid, s_name AS label, nullif(regexp_extract(born, '([0-9]{4})', 1), '')::INT AS year, 'https://example.org/' || s_suppkey AS link FROM supplier LEFT JOIN c ON c.gid = s_suppkey")
def lookup_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, year and link of every entity; the year from the cached record where there is one."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    born = F.concat(F.lit("born ca. "), (1800 + k % 150).cast("string"), F.lit(", Bern"))
    c = s.where("s_suppkey % 4 > 0").select(k.alias("gid"), F.nullif(F.regexp_extract(born, "([0-9]{4})", 1), F.lit("")).cast("int").alias("year"))
    return s.select(k.alias("gid"), F.col("s_name").alias("label")).join(c, "gid", "left").select("gid", "label", "year", F.concat(F.lit("https://example.org/"), F.col("gid").cast("string")).alias("link"))


@query("WITH " + _VARIANTS + ", q AS (SELECT DISTINCT gid, lower(form) AS surface FROM v), s AS (SELECT DISTINCT surface || CASE WHEN length(surface) % 2 = 0 THEN 's' ELSE '' END AS surface FROM q) SELECT s.surface, count(DISTINCT gid) AS n, min(gid) AS first FROM s JOIN q ON q.surface = s.surface OR q.surface || 's' = s.surface GROUP BY 1")
def alternatives_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities a surface may name, as it stands or without a genitive s."""
    q = _variants(spark, sf_dir).select("gid", F.lower("form").alias("surface")).distinct()
    s = q.select(F.concat("surface", F.when(F.length("surface") % 2 == 0, "s").otherwise("")).alias("surface")).distinct()
    return L.alternatives(s, q).groupBy("surface").agg(F.countDistinct("gid").alias("n"), F.min("gid").alias("first"))


@query("""WITH r AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey AS gid, lower(l_returnflag || l_linestatus) AS surface FROM lineitem WHERE l_quantity > 25), c AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey AS gid, l_returnflag AS surface FROM lineitem WHERE l_discount < 0.05)
SELECT r.doc, r.page, r.gid, r.surface, count(c.surface) > 0 AS met FROM r LEFT JOIN c ON r.doc = c.doc AND r.page = c.page AND r.gid = c.gid AND (contains(lower(r.surface), lower(c.surface)) OR contains(lower(c.surface), lower(r.surface))) GROUP BY ALL""")
def recall_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of a page met by finds of the same entity there, one surface within the other, case aside."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("gid"), "l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    r = li.where("l_quantity > 25").select("doc", "page", "gid", F.lower(F.concat("l_returnflag", "l_linestatus")).alias("surface")).distinct()
    c = li.where("l_discount < 0.05").select("doc", "page", "gid", F.col("l_returnflag").alias("surface"))
    return L.recall_met(r, c, ["doc", "page", "gid"])
