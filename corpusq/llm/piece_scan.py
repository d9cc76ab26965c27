"""SentencePiece encoding and decoding as a max-plus parallel scan.

A piece model's encoding is the best path over piece edges. For a unigram model an edge weighs its
score; for a merge (BPE) model, such as the public file, an encoding is exactly the path on which
every two neighbouring pieces encode to themselves when joined, so an edge weighs 0 after a piece
it may follow and minus infinity otherwise. Both are paths in the max-plus semiring with the last
piece as state.

* A document over ``CHUNK`` characters is split into chunks at fixed places, whatever stands there.
  A boundary's state is the piece that starts before it and ends at or behind it. Each chunk
  yields, on its own, the transfer matrix from the states of its left boundary to those of its right
  one.
* The matrices of a document are combined in a tree: the product is associative, so each level
  multiplies up to ``FAN`` neighbours in a task, halves first, until one matrix is left. Its best
  entry fixes the first and last state; on the way down each node's states fix those of its parts.
* Each chunk is then backtraced on its own between its two states.

Within a chunk the paths run word by word: no piece holds a space behind another character, so every
word start is an edge of every path, and a worker remembers words. Characters without a piece are
single edges and become byte pieces. Decoding joins the pieces and takes the dummy space off.

The scan equals the library's ``encode`` (tests compare them). Null text counts as empty: no pieces.
``▁`` in a text encodes as a space, so ``round_trip`` is false there. Repeated rows each get their
row; null ids are kept; extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm import ragged
from corpusq.llm.common import stored

SPACE = "▁"
CHUNK, CACHE, FAN = 65_536, 500_000, 32
_START = re.compile(f"[^{SPACE}](?={SPACE})")
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]*")
#: A state: (start, end, piece) of an edge, counted from the document's start.
State = tuple[int, int, int]
LOW = float("-inf")


class Pieces:
    """The vocabulary and the edge weights of a model file. One per worker."""

    def __init__(self, path: str, unigram: bool = False):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.text = [lib.id_to_piece(i) for i in range(n)]
        self.score = [lib.get_score(i) for i in range(n)]
        self.bytes_at = next(i for i in range(n) if lib.is_byte(i))
        self.width = max(map(len, self.ids))
        self.unigram = unigram
        # Two neighbours that no piece holds are an edge of every path: full stops behind most letters.
        self.joins = {t[k : k + 2] for t in self.ids for k in range(len(t) - 1)}
        byte = [bytes([i - self.bytes_at]) if 0 <= i - self.bytes_at < 256 else t.replace(SPACE, " ").encode() for i, t in enumerate(self.text)]
        self.table = ragged.runs(byte, "u1")
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merges of a short text: the best-scored joinable pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = LOW, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and self.score[i] > best:
                    best, at = self.score[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: str, right: str) -> bool:
        """Weight 0 rather than minus infinity: the two pieces stay as they are when joined."""
        if right[0] == SPACE and left[-1] != SPACE:
            return len(right) == 1 or self.self_made(right)
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= CACHE // 8:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return found

    def self_made(self, piece: str) -> bool:
        found = self.pairs.get((piece, ""))
        if found is None:
            found = self.pairs[piece, ""] = self.merged(piece) == [piece]
        return found

    def edges(self, text: str, at: int) -> Iterator[str]:
        """Pieces of ``text`` that end at ``at``, longest first; a lone character always is one."""
        for k in range(max(0, at - self.width), at - 1):
            if text[k:at] in self.ids:
                yield text[k:at]
        yield text[at - 1]

    def weight(self, left: str | None, right: str) -> float:
        if self.unigram:
            i = self.ids.get(right)
            return -1e6 if i is None else self.score[i]
        return 0.0 if (self.self_made(right) if left is None else self.follows(left, right)) else LOW

    def paths(self, text: str, first: int, left: str | None, last: int) -> list[dict[str, tuple[float, str | None]]]:
        """best[p - first][piece]: the best weight of a path from ``first`` (after ``left``) whose last piece ends at p, and the piece before it."""
        best: list[dict[str, tuple[float, str | None]]] = [{} for _ in range(last - first + 1)]
        best[0][left or ""] = (0.0, None)
        for p in range(first + 1, last + 1):
            here = best[p - first]
            for piece in self.edges(text, p):
                q = p - len(piece) - first
                if q < 0:
                    continue
                for before, (w, _) in best[q].items():
                    v = w + self.weight(before or None, piece)
                    if v > LOW and v > here.get(piece, (LOW,))[0]:
                        here[piece] = (v, before)
                if here and not self.unigram:
                    break  # only one piece can end here on a path without a forbidden edge
        return best

    def back(self, best: list[dict[str, tuple[float, str | None]]], piece: str) -> list[str]:
        """The pieces of the best path that ends in ``piece`` at the last place, in order."""
        found, p = [], len(best) - 1
        while p:
            found.append(piece)
            before = best[p][piece][1]
            p -= len(piece)
            piece = before
        return found[::-1]

    def coded(self, pieces: list[str]) -> bytes:
        ids: list[int] = []
        for x in pieces:
            i = self.ids.get(x)
            ids += [i] if i is not None else [self.bytes_at + b for b in x.encode()]
        return np.array(ids, "<u4").tobytes()

    def word(self, text: str) -> bytes:
        """Ids of a word (spaces, then other characters), by the scan; words are remembered."""
        found = self.words.get(text)
        if found is None:
            found = self.old.get(text)
            if found is None:
                parts = self.apart(text)
                if len(parts) > 1:
                    found = b"".join(map(self.word, parts))
                elif self.unigram:
                    best = self.paths(text, 0, None, len(text))
                    found = self.coded(self.back(best, max(best[-1], key=lambda x: best[-1][x][0])))
                else:
                    found = self.coded(self.only_path(text))
            if len(text) <= 64:
                if len(self.words) >= CACHE:
                    self.old, self.words = self.words, {}
                self.words[text] = found
        return found

    def apart(self, text: str) -> list[str]:
        """The text cut between all neighbours that no piece holds; no part can be cut again."""
        joins, cuts = self.joins, [0]
        cuts += [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in joins]
        return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]

    def only_path(self, text: str) -> list[str]:
        """:meth:`paths` of a merge model from a text's start: at most one piece ends each place."""
        ids, width, known = self.ids, self.width, self.known
        n = len(text)
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for p in range(1, n + 1):
            for q in range(p - width if p > width else 0, p):
                before = last[q]
                if before < 0 and q:
                    continue
                i = ids.get(text[q:p])
                if i is None:
                    if p - q > 1:
                        continue
                    i = (1 << 21) + ord(text[q])  # a character without a piece
                key = before << 22 | i if q else i
                ok = known.get(key)
                if ok is None:
                    if len(known) >= CACHE:
                        known.clear()
                    ok = known[key] = self.follows(text[start[q] : q], text[q:p]) if q else self.self_made(text[q:p])
                if ok:
                    last[p], start[p] = i, q
                    break
        found, p = [], n
        while p:
            found.append(text[start[p] : p])
            p = start[p]
        return found[::-1]

    def encode(self, text: str) -> bytes:
        """A text that is one chunk."""
        return b"".join(map(self.word, self.split(SPACE + text.replace(" ", SPACE)))) if text else b""

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Texts that are one chunk each; the distinct words of a step are scanned once."""
        found: list[bytes] = []
        for step in ragged.steps(texts):
            plain = [bool(t) and t[0] != " " and t[-1] != " " and "  " not in t and SPACE not in t for t in step]
            solve = lambda words: [self.word(SPACE + w) for w in words]
            ids = iter(ragged.by_words([t for t, p in zip(step, plain) if p], solve, solve))
            found += [next(ids) if p else self.encode(t) for t, p in zip(step, plain)]
        return found

    @staticmethod
    def split(text: str) -> list[str]:
        """Words: each starts at a space behind a non-space."""
        if SPACE * 2 not in text and text[0] == SPACE and text[-1] != SPACE:
            return [SPACE + w for w in text[1:].split(SPACE)]
        return [w for w in _WORDS.findall(text) if w]

    def decode(self, ids: bytes) -> str:
        return self.decoded(ids).decode("utf-8", "replace").removeprefix(" ")

    def decoded(self, ids: bytes) -> bytes:
        """The pieces' bytes end to end, with the dummy space."""
        return ragged.take(*self.table, np.frombuffer(ids, "<u4"))[0].tobytes()

    # One chunk of a longer text: ``text`` is the stretch from ``at``, with ``width`` characters before and behind.

    def states(self, text: str, at: int, boundary: int) -> list[State]:
        """Pieces that start before the boundary and end at or behind it."""
        b, found = boundary - at, []
        for s in range(max(0, b - self.width), b):
            for e in range(b, min(len(text), s + self.width) + 1):
                if (e - s == 1) or text[s:e] in self.ids:
                    found.append((s + at, e + at, self.ids.get(text[s:e], -1)))
        return found

    def _middle(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """The first and last word start in [low, high], places that every path passes."""
        found = [m.start() for m in _START.finditer(text, max(low - 1, 0), high + 1)]
        found = [x + 1 for x in found if low <= x + 1 <= high]
        return (found[0], found[-1]) if found else None

    def _best(self, best: dict[str, tuple[float, str | None]]) -> tuple[float, str] | None:
        return max(((v[0], k) for k, v in best.items()), default=None)

    def _leaving(self, best: list[dict], first: int, s: int, piece: str) -> tuple[float, str] | None:
        """Weight and piece before it of the best path from ``first`` on whose last piece starts at s."""
        if s < first:
            return None
        found = [(v, before) for before, (w, _) in best[s - first].items() if (v := w + self.weight(before or None, piece)) > LOW]
        return max(found, default=None)

    def transfer(self, text: str, at: int, start: int, end: int, n: int) -> Matrix:
        """The finite entries of the matrix of the chunk [start, end) of a text of n characters.

        Where the chunk has word starts clear of both boundaries, it is a column times a row: only
        the stretches before the first and behind the last of them depend on the states. Else (one
        long word) each entering state gets a path run of its own.
        """
        enters: list[State | None] = self.states(text, at, start) if start else [None]
        leaves = [x for x in self.states(text, at, end) if end < n or x[1] == n]
        stops = [(j, j[0] - at, text[j[0] - at : j[1] - at]) for j in leaves]
        last = max(s for _, s, _ in stops)
        cut = self._middle(text, start - at + self.width, end - at - self.width)
        found = []
        if cut:
            inner = sum(self.best_weight(w) for w in self.split(text[cut[0] : cut[1]])) if self.unigram and cut[0] < cut[1] else 0.0
            tail = self.paths(text, cut[1], None, last)
            row = [(j, x[0]) for j, s, piece in stops if (x := self._leaving(tail, cut[1], s, piece))]
            for i in enters:
                first = i[1] - at if i else 0
                head = self._best(self.paths(text, first, text[i[0] - at : first] if i else None, cut[0])[-1])
                if head:
                    found += [(i, j, head[0] + inner + w) for j, w in row]
            return found
        for i in enters:
            first = i[1] - at if i else 0
            best = self.paths(text, first, text[i[0] - at : first] if i else None, max(first, last))
            for j, s, piece in stops:
                if i and i == j:
                    found.append((i, j, 0.0))
                elif x := self._leaving(best, first, s, piece):
                    found.append((i, j, x[0]))
        return found

    def best_weight(self, word: str) -> float:
        return self._best(self.paths(word, 0, None, len(word))[-1])[0]

    def trace(self, text: str, at: int, start: int, end: int, enter: State | None, leave: State) -> bytes:
        """Ids of the pieces behind ``enter`` up to and with ``leave`` on the best path of the chunk."""
        if enter == leave:
            return b""
        first, (s, e) = enter[1] - at if enter else 0, (leave[0] - at, leave[1] - at)
        left, piece = text[enter[0] - at : first] if enter else None, text[s:e]
        cut, done = self._middle(text, start - at + self.width, end - at - self.width), b""
        if cut:
            head = self.paths(text, first, left, cut[0])
            done = self.coded(self.back(head, self._best(head[-1])[1])) if cut[0] > first else b""
            if cut[0] < cut[1]:
                done += b"".join(map(self.word, self.split(text[cut[0] : cut[1]])))
            first, left = cut[1], None
        best = self.paths(text, first, left, s)
        before = self._leaving(best, first, s, piece)[1]
        return done + self.coded((self.back(best, before) if s > first else []) + [piece])


_MODELS: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


#: The finite entries of a transfer matrix.
Matrix = list[tuple[State | None, State, float]]


def product(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product: the best way through both, by the first's entering and the second's leaving state."""
    rows: dict[State | None, list[tuple[State, float]]] = {}
    for j, k, w in b:
        rows.setdefault(j, []).append((k, w))
    best: dict[tuple[State | None, State], float] = {}
    for i, j, w in a:
        for k, v in rows.get(j, ()):
            if w + v > best.get((i, k), LOW):
                best[i, k] = w + v
    return [(i, k, w) for (i, k), w in best.items()]


def whole(matrices: list[Matrix]) -> Matrix:
    """The product of matrices in order, halves first."""
    if len(matrices) == 1:
        return matrices[0]
    half = len(matrices) // 2
    return product(whole(matrices[:half]), whole(matrices[half:]))


def ends(m: Matrix) -> tuple[State | None, State]:
    """The states of a document's best path, from the matrix of all of it."""
    _, leave = max((w, j) for i, j, w in m if i is None)
    return None, leave


def within(matrices: list[Matrix], enter: State | None, leave: State) -> list[tuple[State | None, State]]:
    """The (entering, leaving) state of each of the matrices on the best path between two states."""
    if len(matrices) == 1:
        return [(enter, leave)]
    half = len(matrices) // 2
    first, second = matrices[:half], matrices[half:]
    to = {j: w for i, j, w in whole(first) if i == enter}
    _, mid = max((to[j] + w, j) for j, k, w in whole(second) if k == leave and j in to)
    return within(first, enter, mid) + within(second, mid, leave)


def combine(matrices: list[Matrix]) -> list[tuple[State | None, State]]:
    """The best (entering, leaving) state of every chunk of a document."""
    return within(matrices, *ends(whole(matrices)))


def _flat(m: Matrix) -> list[float]:
    return [x for i, j, w in m for x in (*(i or (-1, -1, -1)), *j, w)]


def _matrix(flat: object) -> Matrix:
    rows = np.asarray(flat, np.float64).reshape(-1, 7).tolist()
    return [(None if r[0] < 0 else (int(r[0]), int(r[1]), int(r[2])), (int(r[3]), int(r[4]), int(r[5])), r[6]) for r in rows]


_NODE = "_id long, _sha string, _k int, m array<double>"


def scanned(chunks: DataFrame) -> DataFrame:
    """_id, _sha, _k and the states s of every chunk, from the chunks' matrices m (columns _NODE)."""

    def up(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_k")
        one = _flat(whole([_matrix(m) for m in g["m"]]))
        return pd.DataFrame({"_id": g["_id"].array[:1], "_sha": g["_sha"].array[:1], "_k": g["_k"].array[:1] // FAN, "m": [one]})

    def down(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_k")
        s = [int(x) for x in g["s"].iloc[0]]
        found = within([_matrix(m) for m in g["m"]], None if s[0] < 0 else tuple(s[:3]), tuple(s[3:]))
        flat = [[*(i or (-1, -1, -1)), *j] for i, j in found]
        return pd.DataFrame({"_id": g["_id"].array, "_sha": g["_sha"].array, "_k": g["_k"].array, "s": flat})

    def root(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            flat = [[-1, -1, -1, *ends(_matrix(m))[1]] for m in g["m"]]
            yield pd.DataFrame({"_id": g["_id"].array, "_sha": g["_sha"].array, "_k": g["_k"].array, "s": flat})

    levels = [chunks]
    while (levels[-1].agg(F.max("_k")).first()[0] or 0) > 0:
        node = F.floor(F.col("_k") / FAN).cast("int").alias("_up")
        levels.append(stored(levels[-1].groupBy("_sha", "_id", node).applyInPandas(up, _NODE), "scan-level"))
    kind = "_id long, _sha string, _k int, s array<long>"
    states = levels.pop().mapInPandas(root, kind)
    for level in reversed(levels):
        above = states.select(F.col("_sha").alias("_s"), F.col("_id").alias("_i"), F.col("_k").alias("_up"), "s")
        part = level.withColumn("_up", F.floor(F.col("_k") / FAN).cast("int")).alias("c").join(
            above.alias("a"), (F.col("c._sha") == F.col("a._s")) & F.col("c._id").eqNullSafe(F.col("a._i")) & (F.col("c._up") == F.col("a._up"))
        )
        part = part.select("_id", "_sha", "_k", "m", F.col("c._up").alias("_up"), "s")
        states = part.groupBy("_sha", "_id", "_up").applyInPandas(down, kind)
    return states


def encode(docs: DataFrame, path: str, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_pieces, ids_crc32, n_chunks, round_trip."""
    out = "_id long, n_pieces long, ids_crc32 long, n_chunks long, round_trip boolean"
    names = ["_id", "n_pieces", "ids_crc32", "n_chunks", "round_trip"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            texts, found = b.column(1).to_pylist(), []
            for d, text, ids in zip(b.column(0).to_pylist(), texts, m.encode_many(texts)):
                back = m.decoded(ids) == (" " + text).encode() if text else not ids
                found.append((d, len(ids) // 4, zlib.crc32(ids), 1, back))
            cols = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    short = rows.where(F.length("_t") < chunk).mapInArrow(whole, out)
    width = 16 * 4
    # Longer documents: one row per chunk with its surroundings; equal rows go as one and are counted.
    long = rows.where(F.length("_t") >= chunk).groupBy("_id", "_t").agg(F.count(F.lit(1)).alias("_copies"))
    text = F.concat(F.lit(SPACE), F.translate("_t", " ", SPACE))
    long = long.select("_id", "_copies", F.sha2("_t", 256).alias("_sha"), text.alias("_t"), F.length(text).alias("_n"))
    long = long.select("*", F.explode(F.sequence(F.lit(0), F.ceil((F.col("_n") / chunk)).cast("int") - 1)).alias("_k"))
    at = F.greatest(F.lit(0), F.col("_k") * chunk - width)
    parts = long.select("_id", "_sha", "_copies", "_n", "_k", at.alias("_at"), F.substring("_t", at + 1, F.least((F.col("_k") + 1) * chunk + width, F.col("_n")) - at).alias("_part"))
    parts = stored(parts.repartition("_sha", "_k"), "scan-chunks")
    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            found = []
            for r in b.to_pylist():
                t = m.transfer(r["_part"], r["_at"], r["_k"] * chunk, min(r["_n"], (r["_k"] + 1) * chunk), r["_n"])
                found.append((r["_id"], r["_sha"], r["_k"], _flat(t)))
            cols = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64())))], ["_id", "_sha", "_k", "m"])

    matrices = parts.select("_id", "_sha", "_k", "_n", "_at", "_part").mapInArrow(transfers, _NODE)
    states = stored(scanned(stored(matrices, "scan-matrices")), "scan-states")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            found = []
            for r in b.to_pylist():
                s = r["s"]
                start, end = r["_k"] * chunk, min(r["_n"], (r["_k"] + 1) * chunk)
                ids = m.trace(r["_part"], r["_at"], start, end, None if s[0] < 0 else tuple(s[:3]), tuple(s[3:]))
                found.append((r["_id"], r["_sha"], r["_copies"], r["_k"], ids))
            cols = list(zip(*found)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["_id", "_sha", "_copies", "_k", "ids"])

    same = [F.col("p._sha") == F.col("s._sha"), F.col("p._id").eqNullSafe(F.col("s._id")), F.col("p._k") == F.col("s._k")]
    met = parts.alias("p").join(states.alias("s"), same).select("p.*", "s.s")
    traces = met.mapInArrow(traced, "_id long, _sha string, _copies long, _k int, ids binary")

    def joined(g: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        g = g.sort_values("_k")
        ids, copies = b"".join(map(bytes, g["ids"])), int(g["_copies"].iloc[0])
        back = hashlib.sha256(model(path).decode(ids).encode()).hexdigest() == g["_sha"].iloc[0]
        one = {"_id": g["_id"].iloc[:1].array.repeat(copies), "n_pieces": len(ids) // 4, "ids_crc32": zlib.crc32(ids), "n_chunks": len(g), "round_trip": back}
        return pd.DataFrame(one)

    giant = traces.groupBy("_sha", "_id").applyInPandas(joined, out)
    return short.unionByName(giant).withColumnRenamed("_id", id_col)
