"""Near copies by word shingles, on top of operator 8: the pipeline's stage.

Two texts are near copies if the sets of their shingles of ``WIDTH`` words (A-Z lower-cased; fewer words:
the whole sequence; none: the empty set, equal to itself) have a Jaccard similarity of ``SIMILARITY`` or
more. Fingerprints of 64 bits three bits apart find about a quarter of such pairs, and any
number of bits has the same trouble: at a similarity of 0.8 a seventh of them differ, so segments
that differ in one bit at most must be short, and short keys meet by chance. So candidates come from
two indexes:

* operator 8: SimHash fingerprints of the shingles linked at three bits by deletion variants;
* ``BANDS`` keys of ``ROWS`` least hashes each: a pair at the threshold shares one with a
  probability of 0.99, a pair of 0.5 with 0.22.

Every candidate is then verified on the shingle sets themselves. Equal sets are one node from the
start. A bucket is a key with two nodes or more. Each node meets one node first: of its buckets' least
nodes the one it shares most of them with, of equals that of the largest bucket. So families around one
text become one component for one pair a node. What is not yet linked meets within the buckets that have several components: short ones
(``REACH`` nodes, at most ``MEMBERS`` of one component) compare all nodes of different components; the
nodes of all others are joined exactly by their rarest shingles (:func:`unmet`), which loses no pair,
after the largest component of each shingle has met the others by ``MEMBERS`` of its nodes.
Before a pair is verified its two nodes' ``PARITY`` longs of parity bits (each shingle flips one bit) tell
most pairs that cannot be similar: sets differ in at least as many shingles as their bits.

A component's smallest id stands for it. Null ids lose against others; rows that repeat both id and
text stay or go as one id. Null text counts as empty. Very long texts are read whole, in steps. Extra
columns are carried along, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.llm import simhash
from corpusq.llm.common import salt, sized, spread, stored

WIDTH, SIMILARITY, BANDS, ROWS, REACH, MEMBERS, PARITY = 5, 0.8, 16, 6, 32, 8, 8
#: At most so many nodes (40 bytes each) are broadcast to the texts; more are merged with them.
FEW = 200_000
_STEP = 1 << 12
_RNG = np.random.default_rng(simhash.SEED)
_FLIP = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64, endpoint=False)
_ODD = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64, endpoint=False) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray) -> list[int]:
    """The band keys of a set of shingle hashes (uint64); the band's number is part of its key."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), _STEP):
        part = hashes[k : k + _STEP]
        np.minimum(least, ((part[None] ^ _FLIP[:, None]) * _ODD[:, None]).min(1), out=least)
    raw = least.astype("<u8").tobytes()
    size = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[k * size : (k + 1) * size], k) for k in range(BANDS)]


def parity(hashes: np.ndarray) -> list[int]:
    """``PARITY`` signed longs of bits, one for each remainder of the hashes: set if an odd number of them has it."""
    odd = np.bincount((hashes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """_id, _text (a hash of the text), _key (of the shingle set), _fp (SimHash), _n (different shingles), _bands, _odd (parity bits), _salt per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, fps, sizes, found, odd = [], [], [], [], []
            for t in b.column(2):
                hashes = simhash.shingles(t.as_py(), width)
                own = np.unique(hashes)
                keys.append(xxhash.xxh3_128_digest(own.astype("<u8").tobytes()))
                fps.append(simhash.majority(hashes))
                sizes.append(len(own))
                found.append(np.array(bands(own), np.uint64).view(np.int64).tolist())
                odd.append(parity(own))
            fps = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(fps, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(x, pa.list_(pa.int64())) for x in (found, odd)]], ["_id", "_text", "_key", "_fp", "_n", "_bands", "_odd"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "_id long, _text long, _key binary, _fp long, _n long, _bands array<long>, _odd array<long>").withColumn("_salt", salt("_id"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    return rows.select("_id", F.xxhash64("_t").alias("_text"), "_t")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """fp (the node) and its shingle hashes, for the nodes of ``wanted`` (fp, rep and text: the row to read)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                own = np.unique(simhash.shingles(t.as_py(), width))
                found.append((key, own.view(np.int64)))
            cols = [pa.array([k for k, _ in found], pa.binary()), pa.array([h for _, h in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["fp", "hashes"])

    # The texts' size is guessed from compressed files: they must never be the side that is broadcast.
    texts = _rows(docs, id_col, text_col).hint("merge")
    if wanted.limit(FEW + 1).count() <= FEW:
        texts, wanted = _rows(docs, id_col, text_col), F.broadcast(wanted)
    met = texts.join(wanted, texts["_id"].eqNullSafe(wanted["rep"]) & (texts["_text"] == wanted["text"])).select("fp", "_t")
    return met.mapInArrow(run, "fp binary, hashes array<long>").dropDuplicates(["fp"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    rows = pairs.select("a", "b", salt("b").alias("_salt"))
    rows = spread(rows, sets.select(F.col("fp").alias("a"), F.col("hashes").alias("x")), ["a"], True).withColumn("_salt", salt("a"))
    rows = spread(rows.hint("merge"), sets.select(F.col("fp").alias("b"), F.col("hashes").alias("y")), ["b"], True)
    both = F.size(F.array_intersect("x", "y"))
    return rows.where(both >= similarity * (F.size("x") + F.size("y") - both)).select("a", "b")


def _paired(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _close(similarity: float) -> Column:
    """Whether two sets (xn, xo and yn, yo: size and parity bits) can be similar enough. True for all that are."""
    apart = reduce(add, [F.bit_count(F.col("xo")[k].bitwiseXOR(F.col("yo")[k])) for k in range(PARITY)])
    return (F.least("xn", "yn") >= similarity * F.greatest("xn", "yn") - 1e-6) & (apart <= (1 - similarity) / (1 + similarity) * (F.col("xn") + F.col("yn")) + 1e-6)


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """The nodes of one side of a pair: its name, and component, size and parity bits behind it."""
    return rows.select(*more, F.col("fp").alias(name), F.col("to").alias(f"{name}c"), F.col("n").alias(f"{name}n"), F.col("odd").alias(f"{name}o"))


def rarest(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The nodes (fp, n, odd) with their rarest shingles h and the place of each (at): of n, those that may be missing and one more."""
    rows = sets.join(nodes.select("fp"), "fp").select("fp", F.explode("hashes").alias("h")).withColumn("_salt", salt("fp"))
    rows = stored(rows, "near-shingles")
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("many"))
    found = spread(rows, counts, ["h"], True).groupBy("fp").agg(F.array_sort(F.collect_list(F.struct("many", "h"))).alias("x")).join(nodes, "fp")
    need = (F.col("n") - F.ceil(similarity * F.col("n") - 1e-6) + 1).cast("int")
    found = found.select("fp", "n", "odd", F.posexplode(F.slice("x", F.lit(1), F.greatest(need, F.lit(1)))["h"]).alias("at", "h"))
    return stored(found.withColumn("_salt", salt("fp")), "near-rarest")


def unmet(rows: DataFrame, own: DataFrame, similarity: float, members: int | None = None) -> DataFrame:
    """All pairs (a, b) of nodes of different components that can be similar enough; rows: :func:`rarest`, own: fp and its component, to.

    Similar sets share one of their rarest shingles. The first that they share tells, by its place in both,
    how many they can share at most. Of a shingle's nodes all but its largest component's meet the others, so
    a component's own pairs are never made. With ``members`` they meet so many of the largest component's only.
    """
    rows = rows.join(own, "fp")
    most = rows.groupBy("h", "to").agg(F.count(F.lit(1)).alias("many")).groupBy("h")
    most = most.agg(F.max_by("to", F.struct("many", "to")).alias("most"), F.count(F.lit(1)).alias("several")).where("several > 1")
    rows = stored(spread(rows, most.drop("several"), ["h"], True), "near-shared")
    x = _side(rows.where(F.col("to") != F.col("most")).withColumn("xat", F.col("at")), "x", "h", "most", "xat")
    y = rows.withColumn("yat", F.col("at"))
    if members:
        y = y.where(F.col("to") == F.col("most")).withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy("fp"))).where(F.col("k") <= members)
    once = (F.col("xc") != F.col("yc")) & ((F.col("yc") == F.col("most")) | (F.col("x") < F.col("y")))
    shared = F.least(F.col("xn") - F.col("xat"), F.col("yn") - F.col("yat")) >= similarity / (1 + similarity) * (F.col("xn") + F.col("yn")) - 1e-6
    return x.hint("merge").join(_side(y, "y", "h", "yat"), "h").where(once & shared & _close(similarity)).select(*_paired("x", "y")).distinct()


def merged(nodes: DataFrame, labels: DataFrame, new: DataFrame) -> DataFrame:
    """The labels after new links (a, b): only the components that these join are gone through."""
    ends = new.select(F.col("a").alias("fp")).unionByName(new.select(F.col("b").alias("fp"))).distinct()
    lone = F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("rep"), F.col("fp").alias("fp"))
    ends = stored(nodes.select("fp", "rep").join(ends, "fp").join(labels, "fp", "left").select("fp", F.coalesce("lab", lone).alias("lab")), "near-ends")
    edges = new.join(ends.select(F.col("fp").alias("a"), F.col("lab.fp").alias("x")), "a").join(ends.select(F.col("fp").alias("b"), F.col("lab.fp").alias("y")), "b")
    sunk = simhash.components(ends.select("lab.fp", "lab.rep").distinct(), edges.select(*_paired("x", "y")).distinct())
    whole = labels.unionByName(ends.join(labels, "fp", "left_anti")).select("fp", "lab", F.col("lab.fp").alias("to")).withColumn("_salt", salt("fp"))
    sunk = sunk.select(F.col("fp").alias("to"), F.col("lab").alias("new"))
    # Most of a component's nodes may point to one label: such a key is dealt out by salt.
    keys = whole.select("to", "_salt").distinct().join(sunk, "to", "left")
    return stored(whole.join(keys, ["to", "_salt"]).select("fp", F.coalesce("new", "lab").alias("lab")), "near-labels")


def similar_links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """The labels (:func:`simhash.components`) of the nodes' (fp, rep, text, simhash, n, bands, odd) verified links."""
    n_nodes = nodes.count()
    rows = nodes.select("fp", F.explode("bands").alias("band")).withColumn("_salt", salt("fp"))
    full = rows.groupBy("band").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = stored(spread(rows, full, ["band"], True).select("fp", "band", "least", "size", "_salt"), "near-buckets")
    # SimHash: nodes of one fingerprint meet its least node, linked fingerprints by their least nodes.
    first = stored(sized(nodes.groupBy("simhash").agg(F.min("fp").alias("least")), n_nodes, 10_000), "near-first")
    same = spread(nodes.select("simhash", "fp").withColumn("_salt", salt("fp")), first, ["simhash"]).where("fp <> least").select("least", "fp")
    linked = simhash.links(first.select(F.col("simhash").alias("fp")))
    far = linked.join(first.select(F.col("simhash").alias("a"), F.col("least").alias("x")), "a").join(first.select(F.col("simhash").alias("b"), F.col("least").alias("y")), "b")
    far = stored(far.select("x", "y"), "near-far")
    shares = rows.where("fp <> least").groupBy("fp", "least").agg(F.count(F.lit(1)).alias("many"), F.max("size").alias("size"))
    nearest = shares.groupBy("fp").agg(F.max_by("least", F.struct("many", "size", "least")).alias("least"))
    pairs = stored(nearest.select(*_paired("least", "fp")).unionByName(same.select(*_paired("least", "fp"))).distinct(), "near-pairs")
    # Only rows in a bucket or a pair are read again.
    wanted = rows.select("fp").unionByName(same.select("fp")).unionByName(same.select(F.col("least").alias("fp")))
    wanted = wanted.unionByName(far.select(F.col("x").alias("fp"))).unionByName(far.select(F.col("y").alias("fp"))).distinct()
    wanted = stored(sized(nodes.join(wanted, "fp").select("fp", "rep", "text", "n", "odd"), n_nodes), "near-wanted")
    sets = stored(shingle_sets(docs, wanted.select("fp", "rep", "text"), id_col, text_col, width), "near-sets")
    labels = simhash.components(nodes, stored(verified(pairs, sets, similarity), "near-links"))

    def known() -> DataFrame:
        """fp, to (its component), n and odd of the nodes that are still of interest."""
        own = labels.select("fp", F.col("lab.fp").alias("to"))
        return stored(sized(wanted.select("fp", "n", "odd").join(own, "fp", "left").withColumn("to", F.coalesce("to", "fp")), n_nodes), "near-known")

    def linked_by(more: DataFrame) -> DataFrame:
        new = stored(verified(stored(more, "near-pairs"), sets, similarity), "near-links")
        return labels if new.isEmpty() else merged(nodes, labels, new)

    nodes_now = known()
    listed = rows.select("band", "fp", "_salt").join(nodes_now, "fp")
    sizes = listed.groupBy("band", "to").agg(F.count(F.lit(1)).alias("many")).groupBy("band")
    sizes = sizes.agg((F.count(F.lit(1)) > 1).alias("open"), ((F.sum("many") <= REACH) & (F.max("many") <= MEMBERS)).alias("short"))
    listed = stored(spread(listed, sizes.where("open").drop("open"), ["band"], True), "near-lists")
    short = listed.where("short")
    apart = (F.col("x") < F.col("y")) & (F.col("xc") != F.col("yc")) & _close(similarity)
    met = _side(short, "x", "band").hint("merge").join(_side(short, "y", "band"), "band").where(apart).select(*_paired("x", "y"))
    met_far = far.join(_side(nodes_now, "x"), "x").join(_side(nodes_now, "y"), "y").where((F.col("xc") != F.col("yc")) & _close(similarity)).select(*_paired("x", "y"))
    labels = linked_by(met.unionByName(met_far).distinct())
    long = listed.where("not short").select("band", "fp", "_salt")
    if not long.isEmpty():
        nodes_now = known()
        long = stored(long.join(nodes_now.select("fp", "to"), "fp"), "near-long")
        still = long.groupBy("band").agg((F.min("to") != F.max("to")).alias("open")).where("open").select("band")
        still = spread(long, still, ["band"]).select("fp").distinct()
        several = rarest(stored(nodes_now.drop("to").join(still, "fp"), "near-open"), sets, similarity)
        # Large components first meet by a few nodes: where they hang together, their other pairs need not be made.
        labels = linked_by(unmet(several, nodes_now.select("fp", "to"), similarity, MEMBERS))
        labels = linked_by(unmet(several, known().select("fp", "to"), similarity))
    return labels


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: id, component_id."""
    rows = stored(sketches(docs, id_col, text_col, width), "near-sketches")
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("rep"), F.col("_text").alias("text"))
    parts = rows.groupBy("_key", "_salt").agg(F.min(first).alias("row"), F.min("_fp").alias("simhash"), F.min("_n").alias("n"), F.min("_bands").alias("bands"), F.min("_odd").alias("odd"))
    nodes = parts.groupBy(F.col("_key").alias("fp")).agg(*[F.min(c).alias(c) for c in ("row", "simhash", "n", "bands", "odd")])
    nodes = nodes.select("fp", "row.rep", "row.text", "simhash", "n", "bands", "odd")
    nodes = stored(sized(nodes, rows.count(), 10_000), "near-nodes")
    labels = similar_links(docs, nodes, id_col, text_col, width, similarity)
    least = nodes.join(labels, "fp", "left").select(F.col("fp").alias("_key"), F.when(F.col("lab").isNull(), F.col("rep")).otherwise(F.col("lab.rep")).alias("component_id"))
    return spread(rows.select("_id", "_key", "_salt"), least, ["_key"]).select(F.col("_id").alias(id_col), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """``docs``, all columns, with the smallest id of each component; null ids stay only where all of its ids are null."""
    found = near_groups(docs, id_col, text_col, width, similarity)
    keep = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_keep")).distinct()
    rows = docs.select(F.col(id_col).alias("_id"), F.struct("*").alias("_row"))
    return rows.join(keep, rows["_id"].eqNullSafe(keep["_keep"]), "left_semi").select("_row.*")
