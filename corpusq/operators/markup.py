"""Markup documents as tables: tags, rules, body and page text, idempotent rewrites."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Opening tags per document and name."""
    tags = df.select(doc, F.explode(F.regexp_extract_all(text, F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))).alias("tag"))
    return tags.groupBy(doc, F.lower("tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"))


def findings(df: DataFrame, doc: str, rules: dict[str, Column]) -> DataFrame:
    """One row per document and broken rule: all rules in one scan."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))
    return df.select(doc, F.explode(broken).alias("rule"))


def rollup(df: DataFrame, found: DataFrame, doc: str) -> DataFrame:
    """Documents in all, valid, invalid (an R rule) and with warnings (a W rule)."""
    per = found.groupBy(doc).agg(F.max(F.startswith("rule", F.lit("R"))).alias("r"), F.max(F.startswith("rule", F.lit("W"))).alias("w"))
    d = df.select(doc).join(per, doc, "left")
    return d.agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.coalesce("r", F.lit(False))).alias("valid"), F.count_if("r").alias("invalid"), F.count_if("w").alias("with_warnings"))


def _local(tag: object) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def body_pages(xml: str, footnotes: bool = False) -> list[tuple[int, str]]:
    """(page, text) of a document's body.

    Corrections win over errors in a choice; foot notes are left out unless asked for; a line break is a
    space unless it says that it breaks no word; pages follow the page breaks. Text that does not
    parse gives one page with its tags stripped.
    """
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return [(1, " ".join(unescape(re.sub(r"<[^>]*>", " ", xml)).split()))]
    body = next((e for e in root.iter() if _local(e.tag) == "body"), None)
    pages: list[list[str]] = [[]]
    if body is None:
        return []
    todo: list[tuple[ET.Element, bool]] = [(body, False)]
    while todo:
        e, leave = todo.pop()
        if leave:
            pages[-1].append(e.tail or "")
            continue
        name = _local(e.tag)
        if name == "pb":
            pages.append([])
        elif name == "lb" and e.get("break") != "no":
            pages[-1].append(" ")
        if e is not body:
            todo.append((e, True))
        if name == "note" and e.get("place") == "foot" and not footnotes:
            continue
        kids = list(e)
        if name == "choice":
            fixed = [k for k in kids if _local(k.tag) in ("corr", "reg", "expan")] or kids[:1]
            kids = fixed[:1]
        pages[-1].append(e.text or "")
        todo += [(k, False) for k in reversed(kids)]
    texts = [" ".join("".join(p).split()) for p in pages]
    first = 0 if texts[0] or len(texts) == 1 else 1
    return [(k + 1, t) for k, t in enumerate(texts[first:])]


def extract_pages(df: DataFrame, doc: str, xml: str, footnotes: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, p, t) for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if x for p, t in body_pages(x, footnotes)]
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.string()))], ["doc", "page", "text"])

    return df.select(F.col(doc).cast("long").alias("doc"), F.col(xml).alias("x")).mapInArrow(run, "doc long, page int, text string")


def page_xml(pages: DataFrame, doc: str = "doc") -> DataFrame:
    """Assembles a document from page fragments in page order, escaped."""
    esc = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    frag = F.concat(F.lit('<pb n="'), F.col("page").cast("string"), F.lit('"/><p>'), esc, F.lit("</p>"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", frag.alias("f")))), lambda x: x["f"])
    return pages.groupBy(doc).agg(F.concat(F.lit("<TEI><text><body><div>"), F.array_join(ordered, ""), F.lit("</div></body></text></TEI>")).alias("xml"))


def bracketed(n: Column) -> Column:
    """A number that is not printed stands in brackets; done once only."""
    return F.when(n.rlike(r"^\[.*\]$"), n).otherwise(F.concat(F.lit("["), n, F.lit("]")))


def apostrophes(c: Column) -> Column:
    """Straight apostrophes between letters to typographic ones, outside tags; idempotent."""
    return F.regexp_replace(c, r"(?<=\p{L})'(?=\p{L})(?![^<>]*>)", "’")
