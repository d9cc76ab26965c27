"""Queries over positions, order and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.functions import text as X
from corpusq.operators import heads, ordered, spans
from corpusq.plans.base import query
from corpusq.plans.expected import folded
from corpusq.sources.tables import sized, table
from corpusq.storage import stored

_LINES = """l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS page, unnest(string_split(text, chr(10))) AS line FROM documents),
s AS (SELECT doc_id, page, line, (sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY page) - length(line) - 1)::BIGINT AS start FROM l) """


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's lines as its pages, with their start offsets."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line"))
    w = Window.partitionBy("doc_id").orderBy("page")
    return d.select("doc_id", (F.col("k") + 1).alias("page"), "line").withColumn("start", F.sum(F.length("line") + 1).over(w) - F.length("line") - 1)


@query("WITH " + _LINES + ", p AS (SELECT doc_id, unnest(range(0, n_chars, 997)) AS at FROM documents) SELECT p.doc_id, p.at, greatest(1, (SELECT max(page) FROM s WHERE s.doc_id = p.doc_id AND s.start <= p.at)) AS page FROM p")
def offset_to_page_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "documents").where("n_chars > 0").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chars") - 1, F.lit(997).cast("long"))).alias("at"))
    return spans.page_of(points, _lines(spark, sf_dir), ["doc_id"], "at")


_ZONES = _LINES + ", z AS (SELECT doc_id, page, start, start + length(line) AS \"end\" FROM s WHERE page % 3 = 1), p AS (SELECT doc_id, unnest(range(0, n_chars, 499)) AS at FROM documents) "


def _zones(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    points = table(spark, sf_dir, "documents").where("n_chars > 0").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chars") - 1, F.lit(499).cast("long"))).alias("at"))
    return points, _lines(spark, sf_dir).where("page % 3 = 1").select("doc_id", "page", "start", (F.col("start") + F.length("line")).alias("end"))


@query("WITH " + _ZONES + 'SELECT p.doc_id, p.at, z.page FROM p JOIN z ON p.doc_id = z.doc_id AND p.at >= z.start AND p.at < z."end"')
def offset_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, zones = _zones(spark, sf_dir)
    return spans.in_zone(points, zones, ["doc_id"], "at").select("doc_id", "at", "page")


@query("WITH " + _ZONES + 'SELECT p.doc_id, count(*) AS outside FROM p WHERE NOT EXISTS (SELECT 1 FROM z WHERE p.doc_id = z.doc_id AND p.at >= z.start AND p.at < z."end") GROUP BY 1')
def outside_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, zones = _zones(spark, sf_dir)
    return spans.in_zone(points, zones, ["doc_id"], "at", "left_anti").groupBy("doc_id").agg(F.count(F.lit(1)).alias("outside"))


_MARKS = """m AS (SELECT l_orderkey AS doc, l_partkey % 50 AS gid, (l_linenumber * 100 + l_suppkey % 90)::BIGINT AS start, (l_linenumber * 100 + l_suppkey % 90 + l_quantity::INT)::BIGINT AS "end" FROM lineitem),
c AS (SELECT l_orderkey AS doc, l_partkey % 50 AS gid, (l_linenumber * 100 + l_suppkey % 90 + CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_suppkey % 40 END)::BIGINT AS start, (l_linenumber * 100 + l_suppkey % 90 + CASE WHEN l_linestatus = 'O' THEN 0 ELSE l_suppkey % 40 END + l_quantity::INT)::BIGINT AS "end", CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS tier FROM lineitem) """


def _marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf_dir, "lineitem")
    base = (F.col("l_linenumber") * 100 + F.col("l_suppkey") % 90).cast("long")
    shift = F.when(F.col("l_linestatus") == "O", 0).otherwise(F.col("l_suppkey") % 40)
    size = F.col("l_quantity").cast("int")
    key = [F.col("l_orderkey").alias("doc"), (F.col("l_partkey") % 50).alias("gid")]
    marks = li.select(*key, base.alias("start"), (base + size).alias("end"))
    found = li.select(*key, (base + shift).alias("start"), (base + shift + size).alias("end"), F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("tier"))
    return marks, found


@query("WITH " + _MARKS + 'SELECT m.doc, m.gid, m.start, m."end", c.tier, c.start AS found FROM (SELECT DISTINCT * FROM m) m LEFT JOIN c ON m.doc = c.doc AND m.gid = c.gid AND c.start < m."end" AND m.start < c."end" QUALIFY row_number() OVER (PARTITION BY m.doc, m.gid, m.start, m."end" ORDER BY c.tier NULLS LAST, c.start) = 1')
def span_overlap_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks, found = _marks(spark, sf_dir)
    met = spans.overlap_pick(marks.distinct(), found, ["doc", "gid"], ["doc", "gid", "start", "end"], [F.col("r_tier").asc_nulls_last(), F.col("r_start")])
    return met.select("doc", "gid", "start", "end", F.col("r_tier").alias("tier"), F.col("r_start").alias("found"))


@query("WITH " + _MARKS + """, d AS (SELECT DISTINCT * FROM m), f AS (SELECT doc, gid, start, "end", min(tier) AS tier FROM c GROUP BY ALL),
e AS (SELECT d.*, x.tier AS t, x.tier IS NOT NULL AS exact FROM d LEFT JOIN f x ON d.doc = x.doc AND d.gid = x.gid AND d.start = x.start AND d."end" = x."end"),
o AS (SELECT e.*, y.tier AS ot FROM e LEFT JOIN f y ON NOT exact AND e.doc = y.doc AND e.gid = y.gid AND y.start < e."end" AND e.start < y."end" QUALIFY row_number() OVER (PARTITION BY e.doc, e.gid, e.start, e."end" ORDER BY y.tier NULLS LAST, y.start) = 1)
SELECT CASE WHEN exact THEN 'kept_tier' || t WHEN ot IS NULL THEN 'gone' ELSE 'moved_tier' || ot END AS class, count(*) AS n FROM o GROUP BY 1""")
def verdict_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks, found = _marks(spark, sf_dir)
    found = found.groupBy("doc", "gid", "start", "end").agg(F.min("tier").alias("tier"))
    return spans.classify_marks(marks.distinct(), found, ["doc", "gid"]).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query("WITH " + _MARKS + """, r AS (SELECT doc, start, "end", max("end") OVER (PARTITION BY doc ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM c),
g AS (SELECT *, sum(CASE WHEN b IS NULL OR start > b THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY start, "end") AS run FROM r) SELECT doc, min(start) AS start, max("end") AS "end" FROM g GROUP BY doc, run""")
def span_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.merge_spans(sized(_marks(spark, sf_dir)[1].select("doc", "start", "end"), "doc"), ["doc"])


@query("WITH " + _LINES + """, t AS (SELECT doc_id, n_chars FROM documents) SELECT s.doc_id, page, start, coalesce(lead(start) OVER (PARTITION BY s.doc_id ORDER BY start), n_chars) AS "end" FROM s JOIN t USING (doc_id)""")
def next_boundary_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return ordered.next_bound(_lines(spark, sf_dir).join(d, "doc_id"), ["doc_id"], "start", F.col("n_chars")).select("doc_id", "page", "start", "end")


_NUMBERS = "n AS (SELECT user_id AS doc, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS page, CASE WHEN event_id % 3 > 0 THEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) + CASE WHEN value > 60 THEN user_id % 4 ELSE 2 END END AS num FROM events) "


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a document with a printed number on some."""
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    e = table(spark, sf_dir, "events").withColumn("page", at)
    num = F.when(F.col("event_id") % 3 > 0, F.col("page") + F.when(F.col("value") > 60, F.col("user_id") % 4).otherwise(2))
    return e.select(F.col("user_id").alias("doc"), "page", num.alias("num"))


@query("WITH " + _NUMBERS + """, o AS (SELECT *, num - page AS d FROM n), w AS (SELECT *, last_value(d IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, first_value(d IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM o)
SELECT doc, page, num, coalesce(num, CASE WHEN l IS NOT NULL AND (r IS NULL OR l = r) THEN l + page END) AS filled FROM w""")
def gap_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.interpolate(_numbers(spark, sf_dir), ["doc"], "page", "num")


@query("WITH " + _NUMBERS + """, c AS (SELECT doc, num - page AS "offset", count(*) AS n, min(page) AS first FROM n WHERE num IS NOT NULL GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY doc) AS total FROM c)
SELECT doc, "offset", n, total::BIGINT AS total, total >= 3 AND n / total >= 0.9 AS stable FROM t QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n DESC, first) = 1""")
def mode_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.mode_offset(_numbers(spark, sf_dir), ["doc"], "page", "num")


@query("WITH " + _NUMBERS + """, a AS (SELECT doc, avg((num > b)::INT) AS ascending FROM (SELECT doc, num, lag(num) OVER (PARTITION BY doc ORDER BY page) AS b FROM n WHERE num IS NOT NULL) WHERE b IS NOT NULL GROUP BY 1),
g AS (SELECT doc, count(*) AS pages, count(num) AS numbered, count(*) FILTER (num = page) AS in_sequence, count(*) FILTER (abs(num - page) > 50) AS wild FROM n GROUP BY 1)
SELECT g.doc, pages, numbered, round(ascending, 6) AS ascending, CASE WHEN numbered = 0 THEN 'undetermined' WHEN in_sequence = pages THEN 'scan_sequence' WHEN ascending >= 0.9 AND wild * 2 <= numbered THEN 'printed_folio' WHEN numbered < 3 THEN 'undetermined' ELSE 'mixed' END AS class FROM g LEFT JOIN a USING (doc)""")
def pagination_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = ordered.pagination_class(_numbers(spark, sf_dir), ["doc"], "page", "num")
    return p.select("doc", "pages", "numbered", F.round("ascending", 6).alias("ascending"), "class")


@query("""WITH p AS (SELECT DISTINCT conv_id, turn + 1 AS page FROM conversations WHERE (turn + conv_id) % 4 > 0 OR conv_id % 5 = 0), t AS (SELECT conv_id, count(*) AS total FROM conversations GROUP BY 1),
r AS (SELECT conv_id, page, page - row_number() OVER (PARTITION BY conv_id ORDER BY page) AS k FROM p), g AS (SELECT conv_id, min(page) AS a, max(page) AS b FROM r GROUP BY conv_id, k)
SELECT conv_id, CASE WHEN sum(b - a + 1) = max(total) THEN '*' ELSE string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a || '-' || b END, ',' ORDER BY a) END AS pages FROM g JOIN t USING (conv_id) GROUP BY 1""")  # fmt: skip
def page_list_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    total = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    there = c.where("(turn + conv_id) % 4 > 0 OR conv_id % 5 = 0").select("conv_id", (F.col("turn") + 1).alias("page")).join(total, "conv_id")
    return ordered.encode_pages(there, ["conv_id"], "page", F.col("total"))


_BOXES = "b AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS idx, (l_partkey % 60)::DOUBLE AS x, (l_suppkey % 95)::DOUBLE AS y, (CASE WHEN l_quantity > 40 THEN 80 ELSE 10 + l_quantity END)::DOUBLE AS w FROM lineitem) "


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    idx = F.row_number().over(Window.partitionBy("page").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    return sized(li, "page").select(
        "page", idx.alias("idx"), (F.col("l_partkey") % 60).cast("double").alias("x"), (F.col("l_suppkey") % 95).cast("double").alias("y"),
        F.when(F.col("l_quantity") > 40, 80).otherwise(10 + F.col("l_quantity")).cast("double").alias("w"),
    )


@query("WITH " + _BOXES + """, k AS (SELECT *, x + w / 2 AS mid, w >= 60 AS wide FROM b),
n AS (SELECT *, CASE WHEN wide THEN row_number() OVER (PARTITION BY page, wide ORDER BY y, idx) - 1 ELSE (SELECT count(*) FROM k j WHERE j.page = k.page AND j.wide AND j.y <= k.y) END AS band FROM k),
c AS (SELECT *, CASE WHEN mid - lag(mid) OVER (PARTITION BY page, band, wide ORDER BY mid, idx) > 12 THEN 1 ELSE 0 END AS jump FROM n), d AS (SELECT *, sum(jump) OVER (PARTITION BY page, band, wide ORDER BY mid, idx) AS col FROM c)
SELECT page, idx, row_number() OVER (PARTITION BY page ORDER BY band, wide, col, y, idx) AS place FROM d""")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.reading_order(_boxes(spark, sf_dir), ["page"]).select("page", "idx", "place")


_VARIANTS = [(a, b) for a in (55, 60, 65) for b in (10, 12, 14)]


@query("WITH " + _BOXES + ", v AS (SELECT * FROM (VALUES " + ", ".join(f"({a}, {b})" for a, b in _VARIANTS) + """) t(wide_at, gap_at)), k AS (SELECT b.*, wide_at, gap_at, x + w / 2 AS mid, w >= wide_at AS wide FROM b, v),
n AS (SELECT *, CASE WHEN wide THEN row_number() OVER (PARTITION BY page, wide_at, gap_at, wide ORDER BY y, idx) - 1 ELSE coalesce(sum(wide::INT) OVER (PARTITION BY page, wide_at, gap_at ORDER BY y RANGE UNBOUNDED PRECEDING), 0) END AS band FROM k),
c AS (SELECT *, CASE WHEN mid - lag(mid) OVER (PARTITION BY page, wide_at, gap_at, band, wide ORDER BY mid, idx) > gap_at THEN 1 ELSE 0 END AS jump FROM n), d AS (SELECT *, sum(jump) OVER (PARTITION BY page, wide_at, gap_at, band, wide ORDER BY mid, idx) AS col FROM c),
e AS (SELECT page, wide_at, gap_at, idx, row_number() OVER (PARTITION BY page, wide_at, gap_at ORDER BY band, wide, col, y, idx) AS place FROM d), o AS (SELECT page, wide_at, gap_at, list(idx ORDER BY place) AS o FROM e GROUP BY ALL)
SELECT page, CASE WHEN NOT bool_or(o <> list_sort(o)) THEN 'none' WHEN count(DISTINCT o) = 1 THEN 'robust' ELSE 'fragile' END AS class FROM o GROUP BY page""")
def reading_order_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose order is not the input's: robust if nine threshold variants agree, else fragile."""
    return ordered.order_stability(_boxes(spark, sf_dir), ["page"], [55.0, 60.0, 65.0], [10.0, 12.0, 14.0])


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as documents, their texts as pages in the order of ids, every line that has a letter; a first line without a full stop is a title."""
    d = table(spark, sf_dir, "documents")
    page = ordered.ranked(d.select("source", "doc_id"), ["source"], ["doc_id"], "page").select("doc_id", F.col("source").alias("doc"), "page")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line"))
    lines = lines.select("doc_id", "k", heads.head_form(X.fold(F.col("line"))).alias("form"), ((F.col("k") == 0) & ~F.endswith("line", F.lit("."))).alias("in_head")).where("form <> ''")
    idx = F.row_number().over(Window.partitionBy("doc_id").orderBy("k")) - 1
    # The operators read the segments six times.
    return stored(lines.withColumn("idx", idx).join(page, "doc_id").select("doc", "page", "idx", "form", "in_head"), "segments")


_SEGMENTS = f"""g AS (SELECT source AS doc, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page, string_split(text, chr(10)) AS ls FROM documents),
f AS (SELECT doc, page, generate_subscripts(ls, 1) AS k, unnest(ls) AS line FROM g), h AS (SELECT *, regexp_replace(regexp_replace(lower({folded('line')}), '^[^\\p{{L}}]+|[^\\p{{L}}]+$', '', 'g'), '\\s+', ' ', 'g') AS form FROM f),
s AS (SELECT doc, page, row_number() OVER (PARTITION BY doc, page ORDER BY k) - 1 AS idx, form, k = 1 AND NOT ends_with(line, '.') AS in_head FROM h WHERE form <> ''),
n AS (SELECT doc, count(DISTINCT page) AS pages FROM s GROUP BY 1), k AS (SELECT * FROM s WHERE length(form) BETWEEN 2 AND 80),
o AS (SELECT doc, form, page FROM k GROUP BY ALL HAVING count(*) = 1), c AS (SELECT doc, form, pages, count(*) AS n, min(page % 2) AS lo, max(page % 2) AS hi FROM o JOIN n USING (doc) GROUP BY ALL),
p1 AS (SELECT doc, form, 'primary' AS kind, n FROM c WHERE n >= greatest(3, ceil(pages * 0.05))) """


@query("WITH " + _SEGMENTS + "SELECT doc, form, n FROM p1")
def running_head_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The primary forms and the pages that carry them once."""
    segments = _segments(spark, sf_dir)
    lines = segments.where(heads.is_short(F.col("form")))
    solo = lines.groupBy("doc", "form", "page").agg(F.count(F.lit(1)).alias("k")).where("k = 1").groupBy("doc", "form").agg(F.count(F.lit(1)).alias("n"))
    pages = segments.groupBy("doc").agg(F.countDistinct("page").alias("pages"))
    return heads.accepted_forms(lines, pages).where("kind = 'primary'").join(solo, ["doc", "form"]).select("doc", "form", "n")


@query("WITH " + _SEGMENTS + r""", a AS (SELECT DISTINCT v.doc, v.form, 'alternating' AS kind FROM c v JOIN c w ON v.doc = w.doc AND v.lo = v.hi AND w.lo = w.hi AND v.lo <> w.lo AND v.n >= 2 AND w.n >= 2 AND v.n + w.n >= v.pages * 0.5 WHERE v.doc NOT IN (SELECT doc FROM p1)),
b AS (SELECT doc, form, kind FROM p1 UNION ALL SELECT * FROM a), r AS (SELECT DISTINCT doc, form FROM k WHERE (doc, form) NOT IN (SELECT (doc, form) FROM b)),
v AS (SELECT DISTINCT r.doc, r.form, 'contains' AS kind FROM r JOIN b ON r.doc = b.doc AND length(r.form) <= 2 * length(b.form) AND contains(' ' || regexp_replace(r.form, '[^\p{L}\p{N}_]', ' ', 'g') || ' ', ' ' || regexp_replace(b.form, '[^\p{L}\p{N}_]', ' ', 'g') || ' ') AND contains(r.form, b.form)),
u AS (SELECT * FROM b UNION ALL SELECT * FROM v),
h1 AS (SELECT k.doc, page, idx, k.form, kind, coalesce(lag(idx) OVER w = idx - 1 AND lag(CASE WHEN kind IS NOT NULL THEN k.form END) OVER w <> k.form, false) AS follows FROM k LEFT JOIN u ON k.doc = u.doc AND k.form = u.form WINDOW w AS (PARTITION BY k.doc, page ORDER BY idx)),
h2 AS (SELECT *, count(*) OVER q AS n, bool_or(follows) OVER q AS pf FROM h1 WHERE kind IS NOT NULL WINDOW q AS (PARTITION BY doc, form, page)),
z AS (SELECT doc, form, count(DISTINCT CASE WHEN n = 1 THEN page END) AS solo, count(DISTINCT CASE WHEN pf THEN page END) AS followed FROM h2 GROUP BY ALL),
e AS (SELECT doc, page, coalesce(min(idx) FILTER (length(form) NOT BETWEEN 2 AND 80), count(*)) AS en, min(idx) FILTER (in_head) AS ti FROM s WHERE idx < 4 GROUP BY ALL)
SELECT h2.doc, h2.page, idx, h2.form, kind, CASE WHEN n > 1 THEN 'repeated-on-page' WHEN ti < en AND idx < en THEN 'title-block' WHEN pf AND followed * 2 < solo THEN 'off-slot' WHEN kind = 'contains' AND idx >= 3 THEN 'inner-variant' END AS reason
FROM h2 JOIN z ON h2.doc = z.doc AND h2.form = z.form LEFT JOIN e ON h2.doc = e.doc AND h2.page = e.page""")
def running_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones and exemptions of every accepted form."""
    return heads.detect(_segments(spark, sf_dir))


@query("""WITH e AS (SELECT conv_id, turn, role, text, lag(ends_with(trim(text), '?')) OVER (PARTITION BY conv_id ORDER BY turn) AS asked FROM (SELECT conv_id, turn, role, CASE WHEN role = 'user' AND turn % 4 = 0 THEN text || '?' ELSE text END AS text FROM conversations))
SELECT conv_id, turn, CASE WHEN ends_with(trim(text), '?') THEN 'question' WHEN coalesce(asked, false) THEN 'answer' ELSE 'paragraph' END AS kind FROM e""")  # fmt: skip
def interview_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when((F.col("role") == "user") & (F.col("turn") % 4 == 0), F.concat("text", F.lit("?"))).otherwise(F.col("text"))
    asks = F.endswith(F.trim(text), F.lit("?"))
    asked = F.lag(asks).over(Window.partitionBy("conv_id").orderBy("turn"))
    kind = F.when(asks, "question").when(F.coalesce(asked, F.lit(False)), "answer").otherwise("paragraph")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", kind.alias("kind"))


@query("""WITH p AS (SELECT conv_id, turn AS ordinal, length(text) AS chars FROM conversations), r AS (SELECT conv_id, turn AS ordinal, 'r' || turn AS region FROM conversations WHERE turn < 1 + conv_id % 6)
SELECT coalesce(p.conv_id, r.conv_id) AS conv_id, coalesce(p.ordinal, r.ordinal) AS ordinal, chars, region FROM p FULL JOIN r ON p.conv_id = r.conv_id AND p.ordinal = r.ordinal""")  # fmt: skip
def paragraph_region_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").withColumnRenamed("turn", "ordinal")
    regions = c.where("ordinal < 1 + conv_id % 6").select("conv_id", "ordinal", F.concat(F.lit("r"), "ordinal").alias("region"))
    return spans.zip_ordinals(c.select("conv_id", "ordinal", F.length("text").alias("chars")), regions, ["conv_id"])


@query("""WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS k, list_distinct(list_filter(string_split_regex(lower(unnest(string_split(text, chr(10)))), '[^a-zà-ÿß]+'), lambda w : w <> '')) AS w FROM documents),
f AS (SELECT doc_id, w AS fw FROM l WHERE k = 1) SELECT l.doc_id, k FROM l JOIN f USING (doc_id) WHERE k > 1 AND len(w) > 0 AND len(list_intersect(w, fw)) / len(w) >= 0.8""")  # fmt: skip
def filter_echo_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that merely echo the words of the first one."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line"))
    words = F.array_distinct(F.filter(F.split(F.lower("line"), "[^a-zà-ÿß]+"), lambda w: w != ""))
    d = d.select("doc_id", (F.col("k") + 1).alias("k"), words.alias("w"))
    first = d.where("k = 1").select("doc_id", F.col("w").alias("fw"))
    return d.where((F.col("k") > 1) & (F.size("w") > 0)).join(first, "doc_id").where(F.size(F.array_intersect("w", "fw")) / F.size("w") >= 0.8).select("doc_id", "k")


_LINKS = "k AS (SELECT conv_id AS doc, 'n' || turn AS id, CASE WHEN turn < 6 THEN 'n' || (turn + 1) END AS next, CASE WHEN turn > 0 THEN 'n' || (turn - 1 - (conv_id + turn) % 7 // 6) END AS prev FROM conversations) "


@query("WITH " + _LINKS + "SELECT a.doc, a.id, a.next, CASE WHEN b.id IS NULL THEN 'missing_target' ELSE 'not_reciprocated' END AS problem FROM k a LEFT JOIN k b ON a.doc = b.doc AND a.next = b.id WHERE a.next IS NOT NULL AND (b.id IS NULL OR b.prev IS DISTINCT FROM a.id)")
def relation_reciprocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    name = lambda x: F.concat(F.lit("n"), x.cast("string"))
    c = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc"), name(t).alias("id"), F.when(t < 6, name(t + 1)).alias("next"),
        F.when(t > 0, name(t - 1 - F.floor((F.col("conv_id") + t) % 7 / 6))).alias("prev"),
    )
    return spans.reciprocity(c, "doc")


@query("WITH a AS (SELECT DISTINCT user_id AS doc, 'a' || (event_id % 40) AS name FROM events WHERE event_type = 'view'), b AS (SELECT DISTINCT user_id AS doc, 'a' || (event_id % 40) AS name FROM events WHERE event_type = 'click') SELECT coalesce(a.doc, b.doc) AS doc, coalesce(a.name, b.name) AS name, CASE WHEN a.doc IS NULL THEN 'no_start' ELSE 'no_end' END AS problem FROM a FULL JOIN b ON a.doc = b.doc AND a.name = b.name WHERE a.doc IS NULL OR b.doc IS NULL")
def anchor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(F.col("event_type") == "view", "start").when(F.col("event_type") == "click", "end")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.concat(F.lit("a"), (F.col("event_id") % 40).cast("string")).alias("name"), side.alias("side"))
    return spans.unpaired_anchors(e, "doc")


@query("SELECT o_custkey AS doc, o_orderpriority AS surface, o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS occurrence FROM orders")
def occurrence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderpriority").alias("surface"), "o_orderkey")
    return ordered.occurrence_index(o, ["doc", "surface"], "o_orderkey")


@query("""WITH f AS (SELECT conv_id, turn, role, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM (SELECT conv_id, turn, CASE WHEN turn IN (2, 3) THEN 'user' ELSE role END AS role FROM conversations)),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM f) SELECT conv_id, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM g GROUP BY conv_id, role, run""")  # fmt: skip
def continuation_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn").isin(2, 3), "user").otherwise(F.col("role")).alias("role"))
    return ordered.islands(c, ["conv_id"], "turn", "role")
