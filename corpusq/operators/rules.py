"""The audit rules of an edition over a table of elements: one predicate a rule, all in one table of findings.

:func:`elements` makes a row of each element; every rule is then a DataFrame predicate on rows or on
counts per document. Documents that do not parse have the finding ``XML``.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.functions.text import normalize_lang_code

#: What the rules accept.
BACK_TYPES, RENDITIONS = ["translation", "reprint", "otherEdition"], ["#b", "#i", "#u", "#g", "#sup", "#sub", "#k"]
FOREIGN_AUTHORITIES, NO_URL = ["GeoNames", "Wikidata"], ["", "unknown"]
FOOTNOTE_ID, AUTHORITY_REF = r"^fn\d+[a-z]?-\d+$", r"^GND:[0-9A-Za-z\-]+$"
THIN_PAGE, TOP_DIVS = 50, 3
_ROW = "doc long, i int, parent int, name string, path array<string>, attrs map<string,string>, text string, own string, kids int"


def _local(tag: object) -> str:
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def elements(df: DataFrame, doc: str, xml: str) -> DataFrame:
    """doc, i (document order from 0), parent (-1: none), name, path, attrs (by local name), text (of all of it, trimmed), own (leading text, trimmed), kids.

    ``path`` holds an entry ``name`` or ``name[type]`` for every element from the root down. A document that
    does not parse has one row without a name.
    """

    def rows(d: int, x: str | None) -> Iterator[tuple]:
        try:
            root = ET.fromstring(x or "")
        except ET.ParseError:
            yield d, 0, -1, None, [], {}, None, None, 0
            return
        n, todo = 0, [(root, -1, [])]
        while todo:
            e, parent, above = todo.pop()
            kids = [k for k in e if isinstance(k.tag, str)]
            attrs = {_local(k): v for k, v in e.attrib.items()}
            path = [*above, _local(e.tag) + (f"[{attrs['type']}]" if attrs.get("type") else "")]
            yield d, n, parent, _local(e.tag), path, attrs, "".join(e.itertext()).strip(), (e.text or "").strip(), len(kids)
            todo += [(k, n, path) for k in reversed(kids)]
            n += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _ROW.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.string()), pa.string(), pa.string(), pa.int32()]
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                cols = list(zip(*rows(d, x)))
                cols[5] = [list(a.items()) for a in cols[5]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return df.select(F.col(doc).cast("long"), xml).mapInArrow(run, _ROW)


def _attr(name: str) -> Column:
    return F.try_element_at(F.col("attrs"), F.lit(name))


def row_rules(div_types: list[str], root_type: str) -> dict[str, Column]:
    """Rules about one element."""
    name, kind, n = F.col("name"), _attr("type"), _attr("n")
    is_, ref = lambda *x: name.isin(*x), _attr("ref")
    foot = is_("note") & (_attr("place") == "foot")
    typed = F.coalesce(kind, F.lit("")) != ""
    within = lambda pattern: F.exists(F.slice("path", 1, F.size("path") - 1), lambda p: p.rlike(pattern))
    above = F.coalesce(F.get("path", F.size("path") - 2), F.lit(""))
    lang = _attr("lang")
    return {
        "R1": (F.col("i") == 0) & name.isNotNull() & ~kind.eqNullSafe(F.lit(root_type)),
        "R5": is_("div") & ((typed & ~kind.isin(*div_types)) | (~typed & (F.coalesce(n, F.lit("")) == ""))),
        "R6": is_("note") & (F.coalesce(_attr("place"), F.lit("")) == ""),
        "R7": is_("figure") & above.rlike(r"^p(\[|$)"),
        "W1": is_("language") & (_attr("ident") == "und"),
        "W4": is_("div") & (F.col("text") == ""),
        "W7": is_("graphic") & F.coalesce(_attr("url"), F.lit("")).isin(*NO_URL),
        "W12": foot & (F.coalesce(n, F.lit("")) == ""),
        "W13": foot & (F.coalesce(_attr("id"), F.lit("")) != "") & ~_attr("id").rlike(FOOTNOTE_ID),
        "W14": is_("div") & above.rlike(r"^back(\[|$)") & typed & ~kind.isin(*BACK_TYPES),
        "W15": is_("div") & typed & n.isNotNull(),
        "W16": is_("figure") & (F.coalesce(_attr("id"), F.lit("")) == ""),
        "W17": is_("speaker") & above.rlike(r"^sp(\[|$)") & (F.col("own") == "") & (F.col("kids") == 0),
        "W18": is_("foreign") & (F.coalesce(lang, F.lit("")) != "") & (normalize_lang_code(lang) != lang),
        "Z1": ref.isNotNull() & ~ref.rlike(AUTHORITY_REF) & (is_("persName", "orgName") | (is_("bibl") & ~within(r"^div\[bibliography\]$"))),
        "Z2": is_("idno") & kind.isin(*FOREIGN_AUTHORITIES),
        "Z3": is_("placeName", "event"),
        "Z4": is_("standOff") | (is_("name") & (F.coalesce(ref, F.lit("")) != "")),
        "Z5": is_("hi") & _attr("rendition").isNotNull() & ~_attr("rendition").isin(*RENDITIONS),
        "Z6": is_("pb") & (_attr("facs").isNull() | n.isNull()),
        "Z8": is_("persName", "orgName") & ref.isNull(),
        "XML": name.isNull(),
    }


def document_findings(e: DataFrame) -> DataFrame:
    """doc, rule of what a document as a whole lacks or has too much of."""
    at = lambda pattern: F.exists("path", lambda p: p.rlike(pattern))
    name, in_body, in_header = F.col("name"), at(r"^body(\[|$)"), at(r"^teiHeader(\[|$)")
    count = lambda c: F.count_if(c)
    full = lambda x: F.max(F.when((name == x) & in_header, F.struct(-F.col("i"), F.col("text") != ""))).getField("col2")
    one = e.where("name is not null").groupBy("doc").agg(
        count(name == "teiHeader").alias("headers"), count(name == "body").alias("bodies"), count(name == "div").alias("divs"), count(name == "surface").alias("surfaces"), count(name == "pb").alias("pbs"),
        count((name == "lb") & in_body).alias("lbs"), F.max(F.when(name == "body", F.length("text"))).alias("chars"), F.coalesce(full("title"), F.lit(False)).alias("title"), F.coalesce(full("author"), F.lit(False)).alias("author"),
    )
    rules = {
        "R2": F.col("headers") == 0, "R3": F.col("bodies") == 0, "R4": F.col("divs") == 0, "W2": (F.col("headers") > 0) & (~F.col("title") | ~F.col("author")),
        "W3": (F.col("surfaces") > 0) & (F.col("pbs") > 0) & (F.col("surfaces") != F.col("pbs")), "W5": (F.col("bodies") > 0) & (F.col("pbs") > 0) & (F.col("chars") < THIN_PAGE * F.col("pbs")),
        "W6": (F.col("bodies") > 0) & (F.col("pbs") > 0) & (F.col("lbs") == 0),
    }
    found = one.select("doc", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).alias("rule"))
    top = e.where((name == "div") & F.get("path", F.size("path") - 2).rlike(r"^body(\[|$)")).groupBy("doc", F.coalesce(_attr("n"), F.lit("")).alias("n")).agg(F.count(F.lit(1)).alias("k"))
    return found.unionByName(top.where(F.col("k") > TOP_DIVS).select("doc", F.lit("W11").alias("rule")).distinct())


def findings(e: DataFrame, div_types: list[str], root_type: str) -> DataFrame:
    """doc, rule, n: how often each rule is broken in each document."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in row_rules(div_types, root_type).items()]))
    rows = e.select("doc", F.explode(broken).alias("rule"))
    return reduce(DataFrame.unionByName, [rows, document_findings(e)]).groupBy("doc", "rule").agg(F.count(F.lit(1)).alias("n"))
