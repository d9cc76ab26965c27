"""Exact deduplication by a log-structured merge index, DataFrame operations only.

* Every input task is a memtable: it hashes its texts and flushes one run, a Parquet file of
  (digest, id) sorted by digest with a Bloom filter and min/max statistics on the digest, so that
  a later lookup of single digests skips runs.
* Compaction merges the runs; of equal digests the smallest identifier survives.
* Hits (digests with two or more rows) receive byte verification: their normalised texts are read
  again and the smallest and largest text of each digest are compared. Where they differ, the
  rows of that digest are grouped anew by the text itself.

Texts are equal when identical after each run of ASCII white space is replaced by one space (no
trimming). Null text counts as empty. Of equal texts the smallest id stays; null ids lose against
others; of rows that repeat both id and text exactly one stays. Extra columns are ignored by
:func:`exact_groups` and carried along by :func:`drop_copies`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.llm.common import SPACE, salt, salted_groups, sized, stored


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _digests(docs: DataFrame, id_col: str, text_col: str, digest_bytes: int, *more: Column) -> DataFrame:
    """id, sha (of the whole normalised text), digest (its first bytes), salt and ``more``."""
    sha = F.unhex(F.sha2(normalised(F.col(text_col)), 256))
    return docs.select(F.col(id_col).alias("_id"), sha.alias("_sha"), *more).select(
        "*", F.substring("_sha", 1, digest_bytes).alias("_digest"), salt("_id").alias("_salt")
    )


def flush_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """Level 0: one sorted run with filters per input task; no shuffle."""
    rows = _digests(docs, id_col, text_col, digest_bytes).sortWithinPartitions("_digest")
    return stored(rows, "lsm-run", **{"parquet__bloom__filter__enabled#_digest": "true", "parquet__bloom__filter__expected__ndv#_digest": "200000"})


def compact(runs: DataFrame) -> DataFrame:
    """Level 1: (digest, salt) to the smallest id and the number of rows of the digest."""
    return stored(
        sized(salted_groups(runs, ["_digest"], "_id"), runs.count()).sortWithinPartitions("_digest"),
        "lsm-level",
        **{"parquet__bloom__filter__enabled#_digest": "true", "parquet__bloom__filter__expected__ndv#_digest": "200000"},
    )


def unverified(docs: DataFrame, level: DataFrame, id_col: str, text_col: str, digest_bytes: int) -> DataFrame:
    """Digests whose rows do not all hold the same bytes."""
    texts = _digests(docs, id_col, text_col, digest_bytes, normalised(F.col(text_col)).alias("_text"))
    hits = level.where("group_size > 1").select("_digest", "_salt")
    return (
        texts.join(hits, ["_digest", "_salt"], "left_semi")
        .groupBy("_digest")
        .agg(F.min("_text").alias("lo"), F.max("_text").alias("hi"))
        .where("lo <> hi")
        .select("_digest")
    )


def _labelled(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group; of the rows with the kept id and the same text one is kept."""
    first = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(F.col("_id").asc_nulls_last())) == 1
    return rows.join(groups, [*keys, "_salt"]).withColumn("kept", first & F.col("_id").eqNullSafe(F.col("keep_id")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    runs = flush_runs(docs, id_col, text_col, digest_bytes)
    level = compact(runs)
    bad = stored(unverified(docs, level, id_col, text_col, digest_bytes), "lsm-unverified")
    found = _labelled(runs, level, ["_digest"])
    if not bad.isEmpty():
        texts = _digests(docs, id_col, text_col, digest_bytes, normalised(F.col(text_col)).alias("_text"))
        again = texts.join(bad, "_digest", "left_semi")
        again = _labelled(again, salted_groups(again, ["_text"], "_id"), ["_text"]).drop("_text")
        found = found.join(bad, "_digest", "left_anti").unionByName(again)
    return found.select(
        F.col("_id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.lower(F.hex("_sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without copies, all its columns: the row with the smallest id of each text stays."""
    runs = flush_runs(docs, id_col, text_col)
    level = compact(runs)
    if not unverified(docs, level, id_col, text_col, 32).isEmpty():
        keep = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_digest")).withColumn("_salt", salt("_id"))
    else:
        keep = level.select("_digest", "_salt", F.col("keep_id").alias("_id"))
    rows = _digests(docs, id_col, text_col, 32, F.struct("*").alias("_row"))
    same = [rows["_digest"] == keep["_digest"], rows["_salt"] == keep["_salt"], rows["_id"].eqNullSafe(keep["_id"])]
    one = Window.partitionBy("_digest", "_salt", "_id").orderBy(F.lit(1))
    return rows.join(keep, same, "left_semi").withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*")
