"""Queries over page and layout rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators import pages as P
from corpusq.plans.base import query
from corpusq.sources.tables import table


@query("SELECT doc_id, contains(text, 'the')::INT + contains(text, 'License')::INT + contains(text, 'rights')::INT + contains(text, '@')::INT >= 3 AS cover FROM documents")
def cover_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", P.is_cover(F.col("text"), ["the", "License", "rights", "@"]).alias("cover"))


@query("SELECT s_suppkey AS k, regexp_matches(s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '-X' WHEN s_suppkey % 7 = 0 THEN '-AB' ELSE '' END, '^[0-9]+-?[0-9X]$') AS known FROM supplier")
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    tag = F.when(k % 3 == 0, "-X").when(k % 7 == 0, "-AB").otherwise("")
    return table(spark, sf_dir, "supplier").select(k.alias("k"), P.known_id(F.concat(k.cast("string"), tag)).alias("known"))


@query("SELECT conv_id, list(n ORDER BY turn) = list_transform(range(1, count(*) + 1), lambda x : x::VARCHAR) AS sequence FROM (SELECT conv_id, turn, (turn + 1 + CASE WHEN conv_id % 4 = 0 AND turn > 2 THEN 1 ELSE 0 END)::VARCHAR AS n FROM conversations) GROUP BY 1")
def scan_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("turn") + 1 + F.when((F.col("conv_id") % 4 == 0) & (F.col("turn") > 2), 1).otherwise(0)).cast("string")
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", n.alias("n")))), lambda x: x["n"]).alias("l"))
    return lists.select("conv_id", P.is_scan_sequence(F.col("l")).alias("sequence"))


@query("""WITH r AS (SELECT l_orderkey AS page, (l_partkey % 50)::DOUBLE AS w, (l_suppkey % 40)::DOUBLE AS h FROM lineitem WHERE l_returnflag <> 'N'), g AS (SELECT page, count(*) AS n, sum(w * h / 100) AS c FROM r GROUP BY 1)
SELECT o_orderkey AS page, coalesce(n, 0) AS regions, CASE WHEN n IS NULL THEN 'empty' WHEN c < 15 THEN 'bad' WHEN c < 30 OR n <= 2 THEN 'warning' ELSE 'good' END AS class FROM orders LEFT JOIN g ON page = o_orderkey""")  # fmt: skip
def page_quality_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'")
    box = F.struct((F.col("l_partkey") % 50).cast("double").alias("w"), (F.col("l_suppkey") % 40).cast("double").alias("h"))
    r = li.groupBy(F.col("l_orderkey").alias("page")).agg(F.collect_list(box).alias("r"))
    p = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page")).join(r, "page", "left")
    regions = F.coalesce("r", F.array().cast("array<struct<w:double,h:double>>"))
    return p.select("page", F.size(regions).alias("regions"), P.layout_quality(regions).alias("class"))


@query("SELECT p_partkey, CASE WHEN p_brand IN ('Brand#11', 'Brand#22') THEN 'book' WHEN contains(lower(p_name || ' ' || p_type), 'brief') THEN 'letter' ELSE 'article' END AS genre FROM part")
def genre_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.when(F.col("p_brand").isin("Brand#11", "Brand#22"), "book")
    return table(spark, sf_dir, "part").select("p_partkey", P.genre(form, F.concat_ws(" ", "p_name", "p_type")).alias("genre"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(100, l_extendedprice * 100 / 40000), 6) AS pct, (least(100, l_extendedprice * 100 / 40000) * 1233 / 100)::DOUBLE::INT - CASE WHEN (least(100, l_extendedprice * 100 / 40000) * 1233 / 100)::INT > least(100, l_extendedprice * 100 / 40000) * 1233 / 100 THEN 1 ELSE 0 END AS px FROM lineitem")
def bbox_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    pct = P.to_percent(F.col("l_extendedprice"), F.lit(40000.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(pct, 6).alias("pct"), P.to_pixels(pct, F.lit(1233)).alias("px"))


@query(r"""WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN '[' || (turn * 7) || ']' WHEN turn % 3 = 2 THEN (turn * 5) || '.' ELSE text END AS text FROM conversations)
SELECT conv_id, arg_min(regexp_extract(text, '[0-9]+')::INT, turn) AS number FROM r WHERE regexp_matches(trim(text), '^[\[(]?[0-9]{1,4}[\])]?\.?$') GROUP BY 1""")  # fmt: skip
def page_number_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    text = F.when(t % 3 == 1, F.concat(F.lit("["), (t * 7).cast("string"), F.lit("]"))).when(t % 3 == 2, F.concat((t * 5).cast("string"), F.lit("."))).otherwise(F.col("text"))
    return P.page_number(table(spark, sf_dir, "conversations").select("conv_id", t.alias("idx"), text.alias("text")), ["conv_id"])


@query("SELECT event_id, coalesce(CASE WHEN event_id % 5 = 0 THEN 'x' || event_id END, CASE WHEN event_id % 3 = 0 THEN (user_id + 1)::VARCHAR END, CASE WHEN event_id % 2 = 0 THEN (event_id + 2)::VARCHAR END, CASE WHEN value > 50 THEN (user_id + 3)::VARCHAR END, '[' || user_id || ']') AS folio FROM events")
def folio_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    own = F.when(e % 5 == 0, F.concat(F.lit("x"), e.cast("string")))
    return table(spark, sf_dir, "events").select("event_id", P.folio(own, F.when(e % 3 == 0, u + 1), F.when(e % 2 == 0, e + 2), F.when(F.col("value") > 50, 3), u).alias("folio"))


@query("SELECT doc_id, round(0.5 * CASE WHEN starts_with(text, 'The') THEN 0 WHEN starts_with(text, 'T') THEN 0.35 ELSE 1 END + 0.3 * greatest(0, least(1, (n_chars - 400) / 1600)) + 0.2 * CASE WHEN doc_id % 9 / 9 < 1 / 3 THEN 1 WHEN doc_id % 9 / 9 < 2 / 3 THEN 0.5 ELSE 0 END, 9) AS score FROM documents")
def body_note_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    score = P.note_score(F.col("n_chars"), F.startswith(t, F.lit("The")), F.startswith(t, F.lit("T")), F.col("doc_id") % 9 / 9)
    return table(spark, sf_dir, "documents").select("doc_id", F.round(score, 9).alias("score"))


@query("""WITH s AS (SELECT doc_id, text, string_split(text, chr(10))[1] AS note FROM documents), p AS (SELECT doc_id, note, substr(text, length(note) + 1) AS body FROM s)
SELECT doc_id, CASE """ + " ".join(f"WHEN length(note) >= {w} AND len(list_filter(range(0, length(note) - {w} + 1, 20), lambda i : contains(body, substr(note, i + 1, {w})))) > 0 THEN {w}" for w in (300, 250, 200, 150)) + " ELSE 0 END AS run FROM p")
def reference_verified_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes that repeat the body (here: a text's whole first line against all that follows)."""
    note = F.element_at(F.split("text", "\n", 2), 1)
    d = table(spark, sf_dir, "documents").select("doc_id", note.alias("note"), F.expr("substr(text, length(split(text, '\n', 2)[0]) + 1)").alias("body"))
    return d.select("doc_id", P.verified_run(F.col("note"), F.col("body")).alias("run"))


@query("""WITH n AS (SELECT p_brand AS b, list(DISTINCT lower(p_name)) AS names FROM part GROUP BY 1), k AS (SELECT p_partkey, p_brand AS b, array_to_string(list_reverse(string_split(lower(p_name), ' '))[1:2], ' ') AS key FROM part)
SELECT p_partkey, len(list_filter(names, lambda x : contains(x, key) OR len(list_filter(string_split(key, ' '), lambda w : NOT list_contains(string_split(x, ' '), w))) = 0)) > 0 AS covered FROM k JOIN n USING (b)""")  # fmt: skip
def legacy_corroboration(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = p.groupBy("p_brand").agg(F.collect_set(F.lower("p_name")).alias("names"))  # a curated list's names
    key = F.array_join(F.slice(F.reverse(F.split(F.lower("p_name"), " ")), 1, 2), " ")
    return p.select("p_partkey", "p_brand", key.alias("key")).join(names, "p_brand").select("p_partkey", P.legacy_covered(F.col("key"), F.col("names")).alias("covered"))


@query("""WITH f AS (SELECT conv_id AS doc, turn + 1 AS page, CASE WHEN conv_id % 6 = 1 AND turn = 3 THEN NULL WHEN conv_id % 6 = 2 THEN turn + 3 WHEN conv_id % 6 = 3 AND turn = 2 THEN 1 ELSE turn + 1 END AS image, NOT (conv_id % 6 = 4 AND turn = 1) AS anchor FROM conversations),
s AS (SELECT *, lag(image) OVER (PARTITION BY doc ORDER BY page) AS b, count(*) OVER (PARTITION BY doc, image) AS n FROM f)
SELECT doc, array_to_string(list_filter([CASE WHEN min(image) FILTER (page = 1) > 1 THEN 'offset_start' END, CASE WHEN max(n) FILTER (image IS NOT NULL) > 1 THEN 'duplicate_scan' END, CASE WHEN bool_or(image < b) THEN 'out_of_order' END,
  CASE WHEN bool_or(image IS NULL) THEN 'unresolved_surface' END, CASE WHEN bool_or(NOT anchor) THEN 'missing_anchor' END], lambda x : x IS NOT NULL), ',') AS kinds FROM s GROUP BY doc""")  # fmt: skip
def facsimile_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = F.col("conv_id") % 6, F.col("turn")
    image = F.when((c == 1) & (t == 3), None).when(c == 2, t + 3).when((c == 3) & (t == 2), F.lit(1)).otherwise(t + 1)
    return P.facsimile_audit(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), (t + 1).alias("page"), image.alias("image"), (~((c == 4) & (t == 1))).alias("anchor")), "doc")


@query()
def content_page_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the same pages two numbers later (tests compare with a plain version)."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), "text")
    return P.match_drifting(c.withColumn("kind", F.lit("ref")).unionByName(c.withColumn("page", F.col("page") + 2).withColumn("kind", F.lit("hyp"))))


@query()
def gold_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference mentions (orders) to candidates (lines), one to one; tests compare with a plain version."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc"), (F.col("l_partkey") % 5).alias("gid"), (F.col("l_orderkey") % 997).alias("at"), F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("tier"), F.when(F.col("l_linestatus") == "O", "ref").otherwise("cand").alias("kind"))
    return P.greedy_match(li)


@query("SELECT page_id AS key, true AS done FROM pages WHERE html IS NOT NULL")
def balanced_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page fragments with their divisions balanced: as many closing as opening tags, never too early."""
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "(<article>)", "$1</div><div>").alias("h"))
    n = lambda x: F.regexp_count("text", F.lit(x))
    return P.balance(p, "page_id", "h").select("key", (n("<div") == n("</div>")).alias("done"))


@query("SELECT lang, md5(string_agg(source || '=' || n, ';' ORDER BY source)) AS fingerprint, sum(n)::BIGINT AS docs FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def canonical_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fingerprint of a nested record in canonical key order."""
    c = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "n"))), lambda x: F.concat_ws("=", x["source"], x["n"].cast("string"))), ";")
    return c.groupBy("lang").agg(F.md5(text).alias("fingerprint"), F.sum("n").alias("docs"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7|' || o_orderkey)) AS k FROM orders) WHERE k <= 10")
def recall_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages drawn uniformly within strata by a seeded hash."""
    from corpusq.operators.corpus import stratified_sample

    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return stratified_sample(o, ["o_orderpriority"], "o_orderkey", 10, 7).select("o_custkey", "o_orderkey")
