"""SimHash near-duplicates by deletion-variant signatures.

A document's fingerprint: A-Z lower-cased, words of non-white-space, shingles of ``width`` words
with repeats (fewer words: the whole sequence; none: fingerprint zero), XXH64 with seed 42 of each;
a bit is 1 if it is set in over half of the hashes. Fingerprints link at ``MAX_BITS`` or fewer
differing bits.

With three bits and only two segments of 32 bits, one segment differs by at most one bit. So each
distinct fingerprint is indexed under either whole segment and under either segment with one bit
blotted out, 2 * 33 keys. Rows meet by key equality: under a whole segment all of them, under a
blotted one those that differ in that bit; every candidate pair is verified on all 64 bits. Copies
were folded into one fingerprint before.

A key with more than ``HOT`` fingerprints is not paired: its rows are indexed again by the other
segment, cut in two in the same way, and what is still hot then is probed: at most 18 bits are free
there, so each fingerprint looks up its neighbours within three of these bits. Every step is
linear in the number of fingerprints, and no link is lost.

Components: labels sink along links with pointer jumping, each round written to the shared folder.

Null text counts as empty. All documents without words are linked. Null ids lose against others as
component ids; repeated rows each get their row. Texts of any length count whole. Extra columns are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import salt, sized, spread, stored

SEED, MAX_BITS, WIDTH, HOT = 42, 3, 3, 256
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_STEP = 1 << 16


def shingles(text: str | None, width: int) -> np.ndarray:
    """The hashes (uint64) of a text's shingles, repeats included; fewer words: one of the whole sequence; none: none."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hash64(line, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[: len(words) - width + 1].tolist(), end[width - 1 :].tolist()
    return np.fromiter((hash64(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; they are counted in steps, so memory stays bounded."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _STEP):
        ones += np.unpackbits(hashes[k : k + _STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The unsigned fingerprint of one text."""
    return majority(shingles(text, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """_id, _fp (the fingerprint's bits as a signed long) and _salt per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["_id", "_fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return rows.mapInArrow(run, "_id long, _fp long").withColumn("_salt", salt("_id"))


def _variants(value: Column, bits: int, tag: int) -> list[Column]:
    """(key, side) of a segment: the whole of it (side null), and with each bit blotted out (side: that bit)."""
    key = lambda p, v: v + F.lit((tag * 64 + p) << bits).cast("long")
    whole = F.struct(key(0, value).alias("key"), F.lit(None).cast("int").alias("side"))
    return [whole] + [
        F.struct(key(p + 1, value.bitwiseAND(F.lit(~(1 << p) & ((1 << bits) - 1)))).alias("key"), F.shiftright(value, p).bitwiseAND(F.lit(1)).cast("int").alias("side"))
        for p in range(bits)
    ]


def _bits(at: int, n: int) -> Column:
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1))


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of keys with two or more of them, and their number n.

    The rows were multiplied, which their size as guessed from files does not show: they are never broadcast.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.hint("merge").join(counts, keys)


def _pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Verified links (a, b), a < b, of the rows that share a key and differ in its blotted bit, if it has one."""
    a = rows.select(*keys, F.col("fp").alias("a"), F.col("side").alias("sa"))
    b = rows.select(*keys, F.col("fp").alias("b"), F.col("side").alias("sb"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    whole = F.col("sa").isNull() & (F.col("a") < F.col("b"))
    apart = (F.col("sa") == 0) & (F.col("sb") == 1)
    met = a.join(b, keys).where((whole | apart) & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _masks(free: list[int]) -> list[int]:
    """Every mask of one to three of the free bits, as signed longs."""
    found = []
    for i, x in enumerate(free):
        found.append(1 << x)
        for j in range(i):
            found.append(1 << x | 1 << free[j])
            found += [1 << x | 1 << free[j] | 1 << free[k] for k in range(j)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _probe(hot: DataFrame, distinct: DataFrame) -> DataFrame:
    """Links of fingerprints within three bits of the 16 that a hot second-level key leaves free, or its two blotted ones."""
    # One list of masks for each free 16-bit piece and pair of blotted bits; the blotted bits are found from the keys.
    quarter = F.when(F.col("seg") == 0, F.when(F.col("piece") == 0, 1).otherwise(0)).otherwise(F.when(F.col("piece") == 0, 3).otherwise(2))
    blots = F.array_compact(F.array(F.when(F.col("p1") >= 0, F.col("p1")), F.when(F.col("p2") >= 0, F.col("p2"))))
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x)
    inner = F.array(*[F.lit(m).cast("long") for m in [0, *_masks(list(range(16)))]])
    base = F.transform(inner, lambda m: F.call_function("shiftleft", m, (quarter * 16).cast("int")))
    some = F.array(F.lit(0).cast("long"), F.coalesce(one(F.get(blots, F.lit(0)).cast("int")), F.lit(0).cast("long")), F.coalesce(one(F.get(blots, F.lit(1)).cast("int")), F.lit(0).cast("long")))
    both = F.array_distinct(F.concat(some, F.array(some[1].bitwiseOR(some[2]))))
    probes = hot.select("fp", F.explode(F.array_distinct(F.flatten(F.transform(both, lambda s: F.transform(base, lambda m: m.bitwiseOR(s)))))).alias("m"))
    probes = probes.where((F.col("m") != 0) & (F.bit_count("m") <= MAX_BITS)).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("other")).where("fp < other")
    return probes.join(distinct.select(F.col("fp").alias("other")), "other", "left_semi").select(F.col("fp").alias("a"), F.col("other").alias("b"))


def links(distinct: DataFrame, hot: int = HOT) -> DataFrame:
    """Every pair (a, b) of distinct fingerprints (column fp) at most three bits apart, a < b, each once."""
    first = distinct.select("fp", F.explode(F.array(*_variants(_bits(0, 32), 32, 0), *_variants(_bits(32, 32), 32, 1))).alias("v")).select("fp", "v.*")
    met = stored(_counted(first, ["key"]), "simhash-keys")
    found = _pairs(met.where(F.col("n") <= hot), ["key"])
    again = met.where(F.col("n") > hot)
    if not again.isEmpty():
        seg = F.shiftright("key", 38).cast("int")
        p1 = F.shiftright("key", 32).bitwiseAND(F.lit(63)).cast("int") - 1
        again = again.select("fp", F.col("key").alias("key1"), F.col("side").alias("side1"), seg.alias("seg"), F.when(p1 >= 0, p1 + seg * 32).otherwise(-1).alias("p1"))
        low = F.when(F.col("seg") == 0, _bits(32, 16)).otherwise(_bits(0, 16))
        high = F.when(F.col("seg") == 0, _bits(48, 16)).otherwise(_bits(16, 16))
        second = again.select("*", F.explode(F.array(*_variants(low, 16, 0), *_variants(high, 16, 1))).alias("v")).select("fp", "key1", "side1", "seg", "p1", "v.*")
        met2 = stored(_counted(second, ["key1", "key"]), "simhash-keys2")
        # Both blots must hold: the pairing on the inner side is enough, as verification sees all bits.
        found = found.unionByName(_pairs(met2.where(F.col("n") <= hot), ["key1", "key"]))
        still = met2.where(F.col("n") > hot)
        if not still.isEmpty():
            piece = F.shiftright("key", 22).cast("int")
            p2 = F.shiftright("key", 16).bitwiseAND(F.lit(63)).cast("int") - 1
            # The other segment starts at bit 32 for segment 0 and at bit 0 for segment 1.
            at = F.when(F.col("seg") == 0, 32).otherwise(0) + piece * 16
            rows = still.select("fp", (1 - F.col("seg")).alias("seg"), piece.alias("piece"), "p1", F.when(p2 >= 0, p2 + at).otherwise(-1).alias("p2")).distinct()
            found = found.unionByName(_probe(rows, distinct))
    return found.distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, lab) for every linked fingerprint: lab is the least (no id, id, fp) reachable.

    ``nodes``: fp, rep (the least id with it); ``edges``: a, b.
    """
    n = nodes.count()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumn("_salt", salt("b"))
    both = stored(sized(both, n), "simhash-edges")
    own = F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("rep"), F.col("fp").alias("fp"))
    labels = nodes.join(both.select(F.col("a").alias("fp")).distinct(), "fp").select("fp", own.alias("lab"))
    labels = stored(sized(labels, n), "simhash-labels")
    done = labels.isEmpty()
    while not done:
        heard = spread(both, labels.withColumnRenamed("fp", "a"), ["a"]).groupBy(F.col("b").alias("fp")).agg(F.min("lab").alias("heard"))
        sunk = labels.join(heard, "fp").select("fp", F.col("lab").alias("old"), F.least("lab", "heard").alias("lab"))
        sunk = stored(sized(sunk, n), "simhash-sunk")
        jump = sunk.select(F.col("fp").alias("to"), F.col("lab").alias("far"))
        # All of a component point to a few nodes: such a key is dealt out by salt.
        rows = sunk.select("fp", "old", "lab", F.col("lab.fp").alias("to"), salt("fp").alias("_salt"))
        new = spread(rows, jump, ["to"]).select("fp", "old", F.least("lab", "far").alias("lab"))
        new = stored(sized(new, n), "simhash-labels")
        done = new.where(~F.col("old").eqNullSafe(F.col("lab"))).isEmpty()
        labels = new.select("fp", "lab")
    return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    rows = stored(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    parts = rows.groupBy("_fp", "_salt").agg(F.min("_id").alias("least"))
    # Tasks of few rows: each becomes 66 index rows.
    nodes = stored(sized(parts.groupBy(F.col("_fp").alias("fp")).agg(F.min("least").alias("rep")), rows.count(), 10_000), "simhash-nodes")
    labels = components(nodes, links(nodes.select("fp"), hot))
    whole = nodes.join(labels, "fp", "left").select(F.col("fp").alias("_fp"), F.when(F.col("lab").isNull(), F.col("rep")).otherwise(F.col("lab.rep")).alias("component_id"))
    known = parts.select("_fp", "_salt").join(whole, "_fp")
    return rows.join(known, ["_fp", "_salt"]).select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")
