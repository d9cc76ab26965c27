"""Running heads: short lines that recur at the pages of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lengths of a line that may be a head, recurrence, and the leading lines of a page.
LEAST_CHARS, MOST_CHARS = 2, 80
MIN_RECURRENCE, SHARE, COVERAGE, MIN_ALTERNATION, LENGTH_FACTOR, EDGE, TITLE_BLOCK = 3, 0.05, 0.5, 2, 2, 3, 4


def parity(low: str = "lo", high: str = "hi"):  # noqa: ANN201
    """Of pages' least and greatest remainder by two."""
    return F.when(F.col(low).isNull(), "none").when(F.col(low) != F.col(high), "mixed").when(F.col(low) == 1, "odd").otherwise("even")


def head_form(folded: Column) -> Column:
    """The key by which heads recur, of a folded line: from its first to its last letter, white space collapsed."""
    return F.regexp_replace(F.regexp_replace(folded, r"^[^\p{L}]+|[^\p{L}]+$", ""), r"\s+", " ")


def is_short(form: Column) -> Column:
    return F.length(form).between(LEAST_CHARS, MOST_CHARS)


def accepted_forms(lines: DataFrame, pages: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, form, kind) of recurring forms; ``lines``: doc, page, idx, form of the short lines, ``pages``: doc, pages.

    primary: alone on at least max(3, 5 %) of the pages. Only where a document has none: alternating,
    two forms of opposite page parity that cover half of its pages. Then contains: longer variants,
    at most twice as long, that hold an accepted form between word boundaries.
    """
    solo = lines.groupBy(doc, "form", "page").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    forms = solo.groupBy(doc, "form").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("page") % 2).alias("lo"), F.max(F.col("page") % 2).alias("hi")).join(pages, doc)
    need = F.greatest(F.lit(MIN_RECURRENCE), F.ceil(F.col("pages") * SHARE))
    primary = forms.where(F.col("n") >= need).select(doc, "form", F.lit("primary").alias("kind"))
    sides = forms.where((F.col("n") >= MIN_ALTERNATION) & (F.col("lo") == F.col("hi"))).join(primary.select(doc).distinct(), doc, "left_anti")
    # Opposite parities share no page, so the pages covered are the sum: a form has a partner if the
    # other side's commonest form is common enough.
    best = sides.groupBy(doc, F.col("lo").alias("side")).agg(F.max("n").alias("most"))
    other = best.select(doc, (1 - F.col("side")).alias("lo"), "most")
    paired = sides.join(other, [doc, "lo"]).where(F.col("n") + F.col("most") >= F.col("pages") * COVERAGE)
    base = primary.unionByName(paired.select(doc, "form", F.lit("alternating").alias("kind")))
    # A line that holds a form holds the form's first word: lines meet forms by it.
    rest = lines.select(doc, "form").distinct().join(base, [doc, "form"], "left_anti")
    rest = rest.select(doc, "form", F.explode(F.array_distinct(F.regexp_extract_all("form", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))).alias("word")).alias("r")
    b = base.select(doc, F.col("form").alias("base"), F.regexp_extract("form", r"[\p{L}\p{N}_]+", 0).alias("word")).alias("b")
    inside = F.expr("r.form rlike concat('(?:^|[^\\\\p{L}\\\\p{N}_])\\\\Q', b.base, '\\\\E(?:[^\\\\p{L}\\\\p{N}_]|$)')")
    more = rest.join(b, [doc, "word"]).where(F.contains(F.col("form"), F.col("base")) & (F.length("form") <= LENGTH_FACTOR * F.length("base")) & inside)
    return base.unionByName(more.select(doc, "form").distinct().withColumn("kind", F.lit("contains")))


def title_blocks(segments: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, page, block): how many leading short segments a page has, at most four, if one of them is a title; else 0.

    ``segments``: doc, page, idx, form, in_head, of all lines that are not empty, numbered from 0.
    """
    short = is_short(F.col("form"))
    lead = segments.where(F.col("idx") < TITLE_BLOCK)
    ends = lead.groupBy(doc, "page").agg(F.coalesce(F.min(F.when(~short, F.col("idx"))), F.count(F.lit(1))).alias("end"), F.min(F.when(F.col("in_head"), F.col("idx"))).alias("title"))
    return ends.select(doc, "page", F.when(F.col("title") < F.col("end"), F.col("end")).otherwise(0).alias("block"))


def detect(segments: DataFrame, pages: DataFrame | None = None, doc: str = "doc") -> DataFrame:
    """Every occurrence of an accepted form with the reason why it is exempt (null: a zone).

    ``segments`` as in :func:`title_blocks`; ``pages``: doc, pages, by default the pages that have
    segments. repeated-on-page; title-block on a page that opens a division; off-slot where it follows
    another accepted form on fewer than half of its solo pages; inner-variant for a contains form
    behind the page's first three lines.
    """
    lines = segments.where(is_short(F.col("form"))).select(doc, "page", "idx", "form")
    pages = segments.groupBy(doc).agg(F.countDistinct("page").alias("pages")) if pages is None else pages
    forms = accepted_forms(lines, pages, doc)
    page = Window.partitionBy(doc, "page").orderBy("idx")
    hits = lines.join(forms, [doc, "form"], "left")
    before = F.lag(F.when(F.col("kind").isNotNull(), F.col("form"))).over(page)
    behind = F.lag("idx").over(page) == F.col("idx") - 1
    hits = hits.withColumn("_follows", F.coalesce(behind & before.isNotNull() & (before != F.col("form")), F.lit(False))).where("kind is not null")
    per_page = Window.partitionBy(doc, "form", "page")
    hits = hits.withColumn("_n", F.count(F.lit(1)).over(per_page)).withColumn("_page_follows", F.max("_follows").over(per_page))
    by_page = hits.groupBy(doc, "form", "page").agg(F.count(F.lit(1)).alias("n"), F.max("_follows").alias("f"))
    counts = by_page.groupBy(doc, "form").agg(F.count_if(F.col("n") == 1).alias("_solo"), F.count_if("f").alias("_followed"))
    hits = hits.join(counts, [doc, "form"]).join(title_blocks(segments, doc), [doc, "page"], "left")
    reason = (
        F.when(F.col("_n") > 1, "repeated-on-page")
        .when(F.col("idx") < F.col("block"), "title-block")
        .when(F.col("_page_follows") & (F.col("_followed") * 2 < F.col("_solo")), "off-slot")
        .when((F.col("kind") == "contains") & (F.col("idx") >= EDGE), "inner-variant")
    )
    return hits.withColumn("reason", reason).select(doc, "page", "idx", "form", "kind", "reason")
