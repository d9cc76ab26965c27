"""Sources and sinks besides tables: page texts, layouts, markup, bibliographies, images, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.operators.ordered import pick

#: Competing page texts, best first.
TEXT_SOURCES = ["curated", "gemini-b", "gemini-a", "llm-c", "mistral"]
LAYOUT = "doc_id string, page int, image_width int, image_height int, num_regions int, regions array<struct<label:string,{tag}:string,text:string,bbox:struct<x_pct:double,y_pct:double,w_pct:double,h_pct:double>>>"
MASTERFILE = "ID string, PublForm string, Jahr string, `Anzahl Seiten` string, Sprache string, digitalisiert string"


def _name() -> Column:
    return F.col("_metadata.file_name")


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``<source>/<doc>_p<N>.md`` files: doc, page, source, text."""
    raw = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*_p*.md")
    path = F.col("_metadata.file_path")
    return raw.select(
        F.regexp_extract(_name(), r"^(.+)_p\d+\.md$", 1).alias("doc"), F.regexp_extract(_name(), r"_p(\d+)", 1).cast("int").alias("page"),
        F.element_at(F.split(path, "/"), -2).alias("source"), F.col("value").alias("text"),
    )


def best_texts(texts: DataFrame, sources: list[str] = TEXT_SOURCES) -> DataFrame:
    """The text of the best source per page, with its source; unknown sources are ignored."""
    rank = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    return pick(texts.withColumn("_rank", rank).where("_rank > 0"), ["doc", "page"], [F.col("_rank")]).drop("_rank")


def skip_cover(pages: DataFrame, meta: DataFrame) -> DataFrame:
    """Without page 1 of documents that have a cover sheet (``meta``: doc, has_cover)."""
    flagged = meta.where("has_cover").select("doc", F.lit(1).alias("page"))
    return pages.join(flagged, ["doc", "page"], "left_anti")


def layouts(spark: SparkSession, folder: str, strict: bool = False, tag: str = "tag") -> DataFrame:
    """Layout files; damaged ones fail a strict read and are left out of a tolerant one. ``tag``: the field with the edition's own tag."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(LAYOUT.format(tag=tag)).option("multiLine", True).option("mode", mode).option("recursiveFileLookup", True).json(folder)


def regions(pages: DataFrame) -> DataFrame:
    """One row per region, boxes clipped to the page."""
    r = pages.select("doc_id", "page", F.posexplode("regions").alias("idx", "r"))
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col(f"r.bbox.{c}")))
    return r.select("doc_id", "page", "idx", "r.label", "r.text", *[clip(c).alias(c[0]) for c in ("x_pct", "y_pct", "w_pct", "h_pct")])


def fill_sizes(best: DataFrame, fallback: DataFrame) -> DataFrame:
    """Image sizes from the fallback where the better layout has none."""
    f = fallback.select("doc_id", "page", F.col("image_width").alias("_w"), F.col("image_height").alias("_h"))
    sized = best.join(f, ["doc_id", "page"], "left")
    return sized.withColumn("image_width", F.coalesce(F.nullif("image_width", F.lit(0)), "_w")).withColumn("image_height", F.coalesce(F.nullif("image_height", F.lit(0)), "_h")).drop("_w", "_h")


def markup_files(spark: SparkSession, folder: str, suffix: str = "_final.xml") -> DataFrame:
    """doc and xml of every finished markup file."""
    raw = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
    return raw.select(F.replace(_name(), F.lit(suffix), F.lit("")).alias("doc"), F.col("value").alias("xml"))


def masterfile(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The bibliography: rows with an id, '10.0' read as '10', the first year, pages, language, digitised flag."""
    m = spark.read.csv(path, schema=MASTERFILE, header=True, sep=sep).where("trim(ID) <> ''")
    number = F.expr("try_cast(try_cast(trim(ID) as double) as bigint)")
    return m.select(
        F.coalesce(number.cast("string"), F.trim("ID")).alias("doc"), F.col("PublForm").alias("form"), F.regexp_extract("Jahr", r"((?:19|20)\d\d)", 1).alias("year"),
        F.expr("try_cast(`Anzahl Seiten` as int)").alias("pages"), F.col("Sprache").alias("language"), (F.lower(F.trim("digitalisiert")).isin("x", "ja", "1", "true")).alias("digitised"),
    )


def png_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Width and height from the header of PNG files; null where the signature is another one."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").option("recursiveFileLookup", True).load(folder)
    head = F.hex(F.substring("content", 1, 24))
    number = lambda at: F.conv(F.substring(head, at, 8), 16, 10).cast("int")
    is_png = F.startswith(head, F.lit("89504E470D0A1A0A"))
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.when(is_png, number(33)).alias("width"), F.when(is_png, number(41)).alias("height"))


def page_name(doc: Column, page: Column, kind: str) -> Column:
    """File names of a page: texts unpadded, images and layouts padded to three digits."""
    pattern = {"text": "%s_p%d.md", "image": "%s_p%03d.png", "layout": "%s_p%03d_layout.json"}[kind]
    return F.format_string(pattern, doc, page)


def write_report(df: DataFrame, path: str) -> None:
    """JSON lines in key order; the columns' order is the fields' order."""
    df.write.mode("overwrite").json(path)


def write_worklist(df: DataFrame, path: str) -> None:
    """Semicolon-separated with a header; the first column's name carries the byte order mark spreadsheets look for."""
    first, *rest = df.columns
    df.select(F.col(first).alias("﻿" + first), *rest).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)
