"""Queries over blanks, emphasis, page numbers, assets, languages and text helpers. Lines or turns stand in for pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.functions import text as X
from corpusq.operators.ordered import encode_pages
from corpusq.plans.base import query
from corpusq.plans.expected import folded
from corpusq.sources.tables import table

_PAGES = """p AS (SELECT conv_id AS doc, turn AS page, CASE WHEN turn = 1 THEN ' -- ' WHEN turn = 2 THEN 'Blank page' ELSE text END AS text FROM conversations),
b AS (SELECT *, CASE WHEN length(trim(text)) <= 5 THEN 'len<=5' WHEN NOT regexp_matches(trim(text), '[A-Za-zÀ-ÿ0-9]') THEN 'no-alnum' WHEN length(trim(text)) < 40 AND trim(regexp_replace(regexp_replace(lower(trim(text)), '[^a-z ]+', ' ', 'g'), ' +', ' ', 'g')) = 'blank page' THEN 'blank-marker' ELSE '' END AS reason FROM p),
r AS (SELECT conv_id AS doc, turn AS page, (conv_id + turn) % 4 AS regions FROM conversations WHERE turn < 6),
m AS (SELECT b.doc, b.page, text, reason, reason <> '' AS blank, coalesce(regions > 0, false) AS review, coalesce(regions, 0) AS regions FROM b LEFT JOIN r ON b.doc = r.doc AND b.page = r.page) """


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, page, text, reason, blank, review, regions: blank pages by their text; to review where a layout has regions on them."""
    c = table(spark, sf_dir, "conversations").withColumnsRenamed({"conv_id": "doc", "turn": "page"})
    text = F.when(F.col("page") == 1, " -- ").when(F.col("page") == 2, "Blank page").otherwise(F.col("text"))
    p = c.select("doc", "page", text.alias("text")).withColumn("reason", X.blank_reason(F.col("text")))
    r = c.where("page < 6").select("doc", "page", ((F.col("doc") + F.col("page")) % 4).alias("regions"))
    met = p.join(r, ["doc", "page"], "left")
    return met.select("doc", "page", "text", "reason", (F.col("reason") != "").alias("blank"), F.coalesce(F.col("regions") > 0, F.lit(False)).alias("review"), F.coalesce("regions", F.lit(0)).alias("regions"))


@query("WITH " + _PAGES + "SELECT doc, page, reason, review FROM m WHERE blank")
def blank_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).where("blank").select("doc", "page", "reason", "review")


@query("WITH " + _PAGES + "SELECT doc, page FROM m WHERE blank AND NOT review")
def certain_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir).where("blank AND NOT review").select("doc", "page")


@query("WITH " + _PAGES + "SELECT doc, page FROM r WHERE regions = 0")
def zero_region_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("turn < 6 AND (conv_id + turn) % 4 = 0")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"))


@query("WITH " + _PAGES + ", u AS (SELECT doc, page, text, CASE WHEN blank AND regions = 0 THEN 'both' WHEN blank THEN 'manifest' ELSE 'layout' END AS source FROM m WHERE blank OR (regions = 0 AND page < 6)) SELECT doc, source, count(*) AS pages, count(*) FILTER (length(trim(text)) <= 20) AS empty, count(*) FILTER (length(trim(text)) BETWEEN 21 AND 199) AS marginal, count(*) FILTER (length(trim(text)) >= 200) AS substantial FROM u GROUP BY ALL")
def blank_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that manifest or layout call blank, against how much text they hold."""
    n = F.length(F.trim("text"))
    u = _manifest(spark, sf_dir).where("blank OR (regions = 0 AND page < 6)")
    source = F.when(F.col("blank") & (F.col("regions") == 0), "both").when(F.col("blank"), "manifest").otherwise("layout")
    u = u.select("doc", source.alias("source"), X.volume_class(n).alias("k"))
    return u.groupBy("doc", "source").agg(F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("k") == k).alias(k) for k in ("empty", "marginal", "substantial")])


@query("WITH " + _PAGES + "SELECT doc, page, length(trim(text)) AS n FROM m WHERE regions = 0 AND page < 6 ORDER BY n DESC, doc, page LIMIT 20")
def top_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 longest texts on pages that a layout calls empty (a report's list)."""
    m = _manifest(spark, sf_dir).where("regions = 0 AND page < 6").select("doc", "page", F.length(F.trim("text")).alias("n"))
    return m.orderBy(F.col("n").desc(), "doc", "page").limit(20)


_EMPHASIS = "e AS (SELECT conv_id AS doc, turn AS page, CASE WHEN turn % 3 = 0 THEN replace(text, ' de ', ' *de* ') WHEN turn % 3 = 1 THEN replace(text, ' the ', ' _the_ ') ELSE replace(text, ' un ', ' * un * snake_case_name ') END AS text, turn % 4 > 0 AS hi FROM conversations) "


@query("WITH " + _EMPHASIS + r", f AS (SELECT *, regexp_matches(text, '\*+[^\s*](?:[^*\n]*[^\s*])?\*+') OR regexp_matches(text, '(?:^|[^\p{L}\p{N}_])_+[^\s_](?:[^_\n]*[^\s_])?_+(?:[^\p{L}\p{N}_]|$)') AS emphasis FROM e) SELECT doc, count(*) AS pages, count(*) FILTER (emphasis) AS emphasised, count(*) FILTER (emphasis AND NOT hi) AS lost FROM f GROUP BY doc")
def emphasis_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose text has emphasis, and those whose markup lost it."""
    text = F.expr("CASE WHEN turn % 3 = 0 THEN replace(text, ' de ', ' *de* ') WHEN turn % 3 = 1 THEN replace(text, ' the ', ' _the_ ') ELSE replace(text, ' un ', ' * un * snake_case_name ') END")
    e = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), X.has_emphasis(text).alias("emphasis"), (F.col("turn") % 4 > 0).alias("hi"))
    return e.groupBy("doc").agg(F.count(F.lit(1)).alias("pages"), F.count_if("emphasis").alias("emphasised"), F.count_if(F.col("emphasis") & ~F.col("hi")).alias("lost"))


_NUMBERED = "n AS (SELECT conv_id AS doc, turn + 1 AS page, CASE WHEN turn % 3 = 1 THEN '[' || (turn + 10) || ']' WHEN turn % 3 = 2 THEN (turn + 9)::VARCHAR ELSE text END AS text FROM conversations) "


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    text = F.when(t % 3 == 1, F.concat(F.lit("["), (t + 10).cast("string"), F.lit("]"))).when(t % 3 == 2, (t + 9).cast("string")).otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), (t + 1).alias("page"), text.alias("text"))


@query("WITH " + _NUMBERED + "SELECT doc, page, trim(text, '[]')::INT AS number FROM n WHERE regexp_matches(trim(text, '[]'), '^[0-9]+$')")
def digit_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that are a bare number once their brackets are off."""
    bare = F.regexp_replace("text", r"^[\[\]]+|[\[\]]+$", "")
    n = _numbered(spark, sf_dir).withColumn("bare", bare).where(F.col("bare").rlike("^[0-9]+$"))
    return n.select("doc", "page", F.col("bare").cast("int").alias("number"))


@query("WITH " + _NUMBERED + ", l AS (SELECT doc, page, page + 9 + doc % 2 AS layout FROM n), b AS (SELECT doc, page, trim(text, '[]')::INT AS number FROM n WHERE regexp_matches(trim(text, '[]'), '^[0-9]+$')) SELECT l.doc, l.page, layout, number FROM l JOIN b ON l.doc = b.doc AND l.page = b.page WHERE layout <> number")
def layout_against_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose number in the layout differs from the printed one."""
    layout = _numbered(spark, sf_dir).select("doc", "page", (F.col("page") + 9 + F.col("doc") % 2).alias("layout"))
    return layout.join(digit_paragraphs(spark, sf_dir), ["doc", "page"]).where("layout <> number")


@query("WITH p AS (SELECT conv_id AS doc, turn + 1 + CASE WHEN (turn + conv_id) % 7 > 4 THEN 1 ELSE 0 END AS page FROM conversations), k AS (SELECT DISTINCT doc, page FROM p), r AS (SELECT doc, page, row_number() OVER (PARTITION BY doc ORDER BY page) AS k FROM k) SELECT doc, count(*) FILTER (page = k) AS walked, max(page) AS last FROM r GROUP BY doc")
def printed_number_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages a walk from page 1 reaches before the first gap."""
    page = F.col("turn") + 1 + F.when((F.col("turn") + F.col("conv_id")) % 7 > 4, 1).otherwise(0)
    k = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), page.alias("page")).distinct()
    r = k.withColumn("k", F.row_number().over(Window.partitionBy("doc").orderBy("page")))
    return r.groupBy("doc").agg(F.count_if(F.col("page") == F.col("k")).alias("walked"), F.max("page").alias("last"))


@query("SELECT conv_id AS doc, turn AS page, CASE WHEN starts_with(f, '[') THEN regexp_extract(f, '\\[(.*)\\]', 1) ELSE f END AS bare, CASE WHEN starts_with(f, '[') THEN f ELSE '[' || f || ']' END AS bracketed FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '[' || (turn + 5) || ']' ELSE (turn + 5)::VARCHAR END AS f FROM conversations)")
def folio_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folio without and with brackets, however it came."""
    n = (F.col("turn") + 5).cast("string")
    f = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("["), n, F.lit("]"))).otherwise(n)
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), f.alias("f"))
    return c.select("doc", "page", X.unbracketed(F.col("f")).alias("bare"), X.bracketed(F.col("f")).alias("bracketed"))


_FILES = "f AS (SELECT conv_id AS doc, turn + 1 AS page, CASE turn % 3 WHEN 0 THEN 'img' WHEN 1 THEN 'txt' ELSE 'xml' END AS kind FROM conversations), g AS (SELECT conv_id || '_p' || (turn + 1) || '.' || CASE turn % 3 WHEN 0 THEN 'png' WHEN 1 THEN 'md' ELSE 'xml' END AS name FROM conversations) "


@query("WITH " + _FILES + """, t AS (SELECT doc, max(page) AS total FROM f GROUP BY 1), r AS (SELECT doc, kind, page, page - row_number() OVER (PARTITION BY doc, kind ORDER BY page) AS k FROM f), i AS (SELECT doc, kind, min(page) AS a, max(page) AS b FROM r GROUP BY doc, kind, k)
SELECT doc::VARCHAR AS doc, kind, CASE WHEN sum(b - a + 1) = max(total) THEN '*' ELSE string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) END AS pages FROM i JOIN t USING (doc) GROUP BY doc, kind""")
def mirror_asset_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by their names: the pages of each document that each kind covers."""
    t = F.col("turn")
    ending = F.when(t % 3 == 0, "png").when(t % 3 == 1, "md").otherwise("xml")
    names = table(spark, sf_dir, "conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit("_p"), (t + 1).cast("string"), F.lit("."), ending).alias("name"))
    parts = names.select(F.regexp_extract("name", r"^(.+)_p([0-9]+)\.(\w+)$", 1).alias("doc"), F.regexp_extract("name", r"_p([0-9]+)\.", 1).cast("int").alias("page"), F.regexp_extract("name", r"\.(\w+)$", 1).alias("ending"))
    kinds = parts.select("doc", "page", F.when(F.col("ending") == "png", "img").when(F.col("ending") == "md", "txt").otherwise("xml").alias("kind"))
    total = kinds.groupBy("doc").agg(F.max("page").alias("total"))
    return encode_pages(kinds.join(total, "doc"), ["doc", "kind"], "page", F.col("total"))


@query("WITH " + _FILES + "SELECT kind, count(*) AS files, count(DISTINCT doc) AS docs FROM f GROUP BY kind")
def pipeline_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and documents per kind of artifact."""
    t = F.col("turn")
    f = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.when(t % 3 == 0, "img").when(t % 3 == 1, "txt").otherwise("xml").alias("kind"))
    return f.groupBy("kind").agg(F.count(F.lit(1)).alias("files"), F.countDistinct("doc").alias("docs"))


@query("""WITH a AS (SELECT conv_id AS doc, turn + 1 AS page, CASE WHEN turn % 5 < 4 THEN 's' || (turn + conv_id % 2) END AS anchor FROM conversations), s AS (SELECT conv_id AS doc, 's' || turn AS id, conv_id || '/' || turn || '.jpg' AS image FROM conversations)
SELECT a.doc, string_agg(page || '=' || image, ';' ORDER BY page) AS facsimiles, count(*) AS resolved FROM a JOIN s ON a.doc = s.doc AND a.anchor = s.id GROUP BY a.doc""")
def facsimile_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's pages with the images their anchors resolve to; the others are left out."""
    c, t = table(spark, sf_dir, "conversations"), F.col("turn")
    doc = F.col("conv_id").alias("doc")
    a = c.select(doc, (t + 1).alias("page"), F.when(t % 5 < 4, F.concat(F.lit("s"), (t + F.col("conv_id") % 2).cast("string"))).alias("id"))
    s = c.select(doc, F.concat(F.lit("s"), t.cast("string")).alias("id"), F.concat_ws("", F.concat_ws("/", "conv_id", "turn"), F.lit(".jpg")).alias("image"))
    g = a.join(s, ["doc", "id"]).groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("page", "image")))).alias("m"))
    shown = F.array_join(F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"].cast("string"), x["value"])), ";")
    return g.select("doc", shown.alias("facsimiles"), F.size("m").cast("long").alias("resolved"))


@query("WITH k AS (SELECT user_id AS doc, event_id, CASE event_type WHEN 'error' THEN 'legacy' WHEN 'view' THEN 'own' ELSE event_type END AS kind FROM events) SELECT doc, string_agg(kind || ':' || event_id, ',' ORDER BY event_id) AS changes FROM (SELECT * FROM k WHERE kind NOT IN ('legacy', 'own') UNION ALL SELECT doc, max(event_id) + 1000000, 'history' FROM k WHERE kind = 'own' GROUP BY doc) GROUP BY doc")
def revision_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions without the legacy ones and one's own marks, which are built anew from the history."""
    kind = F.when(F.col("event_type") == "error", "legacy").when(F.col("event_type") == "view", "own").otherwise(F.col("event_type"))
    k = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), "event_id", kind.alias("kind"))
    own = k.where("kind = 'own'").groupBy("doc").agg((F.max("event_id") + 1000000).alias("event_id")).withColumn("kind", F.lit("history"))
    rows = k.where("kind NOT IN ('legacy', 'own')").unionByName(own).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("event_id", "kind"))).alias("x"))
    return rows.select("doc", F.array_join(F.transform("x", lambda x: F.concat_ws(":", x["kind"], x["event_id"].cast("string"))), ",").alias("changes"))


_LANGS = {
    "fr": ("fr", "FR", "fra"), "fra/deu": ("fra", "DE/FR", "fra,deu"), "DE": ("de", "DE", "deu"), "?": ("unknown", "OTHER", "und"), "": ("unknown", "OTHER", "und"),
    "fr, en": ("fr", "OTHER", "fra,eng"), "fra/deu/eng": ("fra", "MULTI", "fra,deu,eng"), "xx": ("xx", "OTHER", "und"), "ita": ("ita", "OTHER", "ita"),
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{a}', '{c}', {'true' if n else 'false'})" for (k, (a, _, c)), n in zip(_LANGS.items(), (1, 0, 0, 0, 0, 1, 0, 0, 1))) + ") t(raw, first, idents, single)")
def language_collapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three readings of a language field: its first language, its codes, and whether single capitalised words tell names."""
    raw = spark.createDataFrame([(k,) for k in _LANGS], "raw string")
    return raw.select("raw", X.first_language(F.col("raw")).alias("first"), X.language_idents(F.col("raw")).alias("idents"), X.single_words_allowed(F.col("raw")).alias("single"))


@query(r"SELECT doc_id, md5(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '""', '&quot;')) AS escaped, md5(regexp_replace(text, '[*_#]', '', 'g')) AS bare, md5(regexp_replace(" + folded("text") + r", '[^\x00-\x7F]', '?', 'g')) AS ascii FROM documents")
def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped for markup, without Markdown signs, and in ASCII."""
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.xml_escape(c)).alias("escaped"), F.md5(X.strip_markdown(c)).alias("bare"), F.md5(X.ascii_only(c)).alias("ascii"))


@query("SELECT doc_id, coalesce(nullif(instr(lower(regexp_replace(text, '[*_#]', '', 'g')), lower(w)), 0), 0) - 1 AS at FROM (SELECT doc_id, text, array_to_string(string_split(string_split(text, chr(10))[-1], ' ')[1:3], ' ') AS w FROM documents) WHERE w <> ''")
def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the first words of a text's last line first stand in it, case aside."""
    last = F.element_at(F.split("text", "\n", -1), -1)
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.array_join(F.slice(F.split(last, " ", -1), 1, 3), " ").alias("w")).where("w <> ''")
    return d.select("doc_id", X.find_phrase(F.col("text"), F.col("w")).alias("at"))


@query(r"SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN trim(regexp_extract(r, '(?s)<text>(.*?)</text>', 1)) ELSE trim(r) END AS reply FROM (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN 'Sure: <text>' || left(text, 200) || '</text> Done.' ELSE left(text, 200) END AS r FROM documents)")
def tagged_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged block of a model's reply, or all of it where it has none."""
    head = F.substring("text", 1, 200)
    r = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("Sure: <text>"), head, F.lit("</text> Done."))).otherwise(head)
    return table(spark, sf_dir, "documents").select("doc_id", X.tagged_block(r, "text").alias("reply"))


@query("""WITH r AS (SELECT l_orderkey AS page, l_linenumber AS k, CASE l_shipmode WHEN 'x' THEN 'x' ELSE CASE l_linenumber % 4 WHEN 0 THEN 'Page-header' WHEN 1 THEN 'Text' WHEN 2 THEN 'Picture' ELSE 'Title' END END AS label, l_quantity * 40 AS x, l_partkey % 1500 AS y FROM (SELECT *, 'a' AS l_shipmode FROM lineitem))
SELECT page, k, CASE label WHEN 'Text' THEN 'p' ELSE 'head' END AS tag, round(greatest(0, least(100, x * 100 / 1600)), 6) AS x_pct, round(greatest(0, least(100, y * 100 / 1200)), 6) AS y_pct FROM r WHERE label NOT IN ('Page-header', 'Picture')""")
def layout_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions of a layout with the tag of their label, chrome and pictures left out, boxes in percent."""
    from corpusq.operators.pages import to_percent

    k = F.col("l_linenumber")
    label = F.when(k % 4 == 0, "Page-header").when(k % 4 == 1, "Text").when(k % 4 == 2, "Picture").otherwise("Title")
    tags = F.create_map(F.lit("Text"), F.lit("p"), F.lit("Title"), F.lit("head"))
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), k.alias("k"), tags[label].alias("tag"), (F.col("l_quantity") * 40).alias("x"), (F.col("l_partkey") % 1500).alias("y"))
    return r.where("tag is not null").select("page", "k", "tag", F.round(to_percent(F.col("x"), F.lit(1600)), 6).alias("x_pct"), F.round(to_percent(F.col("y"), F.lit(1200)), 6).alias("y_pct"))


@query("SELECT lang, count(*) AS docs, count(*) FILTER (quality IS NULL) AS unrated, count(*) FILTER (coalesce(toxic, 0) = 1) AS flagged FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def metadata_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields with their defaults and three counters."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.count_if(F.col("quality").isNull()).alias("unrated"), F.count_if(F.coalesce("toxic", F.lit(0)) == 1).alias("flagged"))


@query("""WITH t AS (SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS p, len(regexp_extract_all(html, '<a[ >]')) AS a, len(regexp_extract_all(html, '<b[ >]')) AS b FROM pages), u AS (UNPIVOT t ON p, a, b INTO NAME tag VALUE n)
SELECT x.page_id, x.tag, x.n AS ours, y.n AS theirs, x.n - y.n AS delta FROM u x JOIN u y ON y.page_id = x.page_id + 1 AND x.tag = y.tag""")
def reference_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag counts of a page against those of its reference (here: the next page)."""
    n = lambda t: F.regexp_count("html", F.lit(f"<{t}[ >]")).alias(t)
    u = table(spark, sf_dir, "pages").select("page_id", n("p"), n("a"), n("b")).unpivot("page_id", ["p", "a", "b"], "tag", "n")
    ref = u.select((F.col("page_id") - 1).alias("page_id"), "tag", F.col("n").alias("theirs"))
    return u.join(ref, ["page_id", "tag"]).select("page_id", "tag", F.col("n").alias("ours"), "theirs", (F.col("n") - F.col("theirs")).alias("delta"))


@query("""WITH t AS (SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS p, len(regexp_extract_all(html, '</p>')) AS q, len(regexp_extract_all(html, '<b[ >]')) AS b, len(regexp_extract_all(html, '</b>')) AS c FROM pages), v AS (SELECT page_id, 'unclosed-p' AS rule, 'error' AS severity, p - q AS n FROM t UNION ALL SELECT page_id, 'unclosed-b', 'warning', b - c FROM t)
SELECT rule, severity, count(*) FILTER (n > 0) AS pages, sum(greatest(n, 0))::BIGINT AS findings FROM v GROUP BY ALL""")
def conformity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings and pages by rule and severity."""
    n = lambda x: F.regexp_count("html", F.lit(x))
    one = lambda rule, severity, c: F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), c.alias("n"))
    v = table(spark, sf_dir, "pages").select(F.inline(F.array(one("unclosed-p", "error", n("<p[ >]") - n("</p>")), one("unclosed-b", "warning", n("<b[ >]") - n("</b>")))))
    return v.groupBy("rule", "severity").agg(F.count_if(F.col("n") > 0).alias("pages"), F.sum(F.greatest("n", F.lit(0))).alias("findings"))


@query("""SELECT 'documents' AS tier, count(*) AS n, sum(n_chars)::BIGINT AS total FROM documents UNION ALL SELECT 'labels', count(*), sum(quality)::BIGINT FROM labels UNION ALL SELECT 'pages', count(*), sum(length(html))::BIGINT FROM pages UNION ALL SELECT 'conversations', count(*), sum(length(text))::BIGINT FROM conversations
UNION ALL SELECT 'unlabelled', count(*), NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tiers of a corpus side by side, with what falls between them."""
    one = lambda name, value: table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.lit(name).alias("tier"), "n", F.col("total").cast("long").alias("total"))
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    rest = d.agg(F.count(F.lit(1)).alias("n")).select(F.lit("unlabelled").alias("tier"), "n", F.lit(None).cast("long").alias("total"))
    return one("documents", F.col("n_chars")).unionByName(one("labels", F.col("quality"))).unionByName(one("pages", F.length("html"))).unionByName(one("conversations", F.length("text"))).unionByName(rest)


@query("WITH d AS (SELECT lang, text AS ref, replace(replace(text, 'é', 'e'), 'ü', 'u') AS hyp FROM documents) SELECT lang, sum(length(ref) - length(regexp_replace(ref, '[éüñ]', '', 'g')))::BIGINT AS expected, sum(length(hyp) - length(regexp_replace(hyp, '[éüñ]', '', 'g')))::BIGINT AS observed FROM d GROUP BY lang")
def diacritic_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special letters expected and still there, by language."""
    d = table(spark, sf_dir, "documents").select("lang", F.col("text").alias("ref"), F.expr("replace(replace(text, 'é', 'e'), 'ü', 'u')").alias("hyp"))
    return d.groupBy("lang").agg(F.sum(X.char_count(F.col("ref"), "[éüñ]")).alias("expected"), F.sum(X.char_count(F.col("hyp"), "[éüñ]")).alias("observed"))
