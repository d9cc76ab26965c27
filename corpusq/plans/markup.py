"""Queries over markup, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators import markup as M
from corpusq.plans.base import query
from corpusq.sources.tables import table


@query("WITH t AS (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) SELECT page_id, tag, count(*) AS n FROM t GROUP BY ALL")
def html_tag_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.tag_counts(table(spark, sf_dir, "pages"), "page_id", "html")


_RULES = """f AS (SELECT page_id, unnest(list_filter([CASE WHEN NOT contains(html, '<body') THEN 'R3' END, CASE WHEN NOT contains(html, '</body>') THEN 'R4' END, CASE WHEN contains(html, '<p></p>') THEN 'W4' END,
CASE WHEN NOT regexp_matches(html, '<html[^>]* lang=') THEN 'W1' END, CASE WHEN regexp_matches(html, '<title>.{0,20}</title>') THEN 'W2' END, CASE WHEN len(regexp_extract_all(html, '<p>')) < 3 THEN 'W5' END,
CASE WHEN len(regexp_extract_all(html, '<p>')) <> len(regexp_extract_all(html, '</p>')) THEN 'W6' END], lambda x : x IS NOT NULL)) AS rule FROM pages) """


def _findings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, h = table(spark, sf_dir, "pages"), F.col("html")
    n = lambda x: F.regexp_count(h, F.lit(x))
    rules = {
        "R3": ~F.contains(h, F.lit("<body")), "R4": ~F.contains(h, F.lit("</body>")), "W4": F.contains(h, F.lit("<p></p>")), "W1": ~h.rlike("<html[^>]* lang="),
        "W2": h.rlike("<title>.{0,20}</title>"), "W5": n("<p>") < 3, "W6": n("<p>") != n("</p>"),
    }
    return p, M.findings(p, "page_id", rules)


@query("WITH " + _RULES + "SELECT * FROM f")
def html_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(spark, sf_dir)[1]


@query("WITH " + _RULES + ", p AS (SELECT page_id, bool_or(starts_with(rule, 'R')) AS r, bool_or(starts_with(rule, 'W')) AS w FROM f GROUP BY 1) SELECT count(*) AS total, count(*) FILTER (NOT coalesce(r, false)) AS valid, count(*) FILTER (r) AS invalid, count(*) FILTER (w) AS with_warnings FROM pages LEFT JOIN p USING (page_id)")
def validation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, f = _findings(spark, sf_dir)
    return M.rollup(p, f, "page_id")


@query("SELECT conv_id AS doc, '<TEI><text><body><div>' || string_agg('<pb n=\"' || turn || '\"/><p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>', '' ORDER BY turn) || '</div></body></text></TEI>' AS xml FROM conversations GROUP BY 1")
def assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.page_xml(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), "text"))


@query(r"SELECT conv_id AS doc, (row_number() OVER (PARTITION BY conv_id ORDER BY turn))::INT AS page, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations")
def extract_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of assembled documents, read back from their markup."""
    return M.extract_pages(assemble_documents(spark, sf_dir), "doc", "xml")


@query("SELECT doc_id, md5(regexp_replace(replace(text, ' the ', '''the '), '([[:alpha:]À-ÿ])''([[:alpha:]À-ÿ])', '\\1’\\2', 'g')) AS digest FROM documents")
def apostrophe_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(M.apostrophes(F.expr("replace(text, ' the ', '\\'the ')"))).alias("digest"))


@query("SELECT event_id, json_extract_string(props, '$.' || k) AS value, k AS field FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def nested_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties as a map, tolerant of damage, one row per field."""
    m = F.from_json("props", "map<string,string>", {"mode": "PERMISSIVE"})
    return table(spark, sf_dir, "events").select("event_id", F.explode(m).alias("field", "value"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, TRY_CAST(regexp_extract(url, '/([0-9]+)(?:\\.html)?(?:#.*)?$', 1) AS INT) AS number FROM pages")
def keys_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys carried by names: host and page number."""
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)(?:\\\\.html)?(?:#.*)?$', 1) as int)")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), number.alias("number"))


@query("SELECT doc_id, CASE WHEN text IS NOT NULL THEN sha256(text) END AS digest FROM documents")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
