"""Array operations on ragged data: many short runs end to end in one array."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in steps of so many characters at most (or one text), so memory stays bounded.
STEP_CHARS = 8_000_000


def take(table: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``codes`` of ``table`` end to end, and the end of each run in the result."""
    n = sizes[codes]
    ends = np.cumsum(n)
    at = np.repeat(starts[codes] - ends + n, n)
    at += np.arange(len(at))
    return table[at], ends


def runs(parts: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table, starts, sizes) of byte strings that hold items of ``dtype``."""
    table = np.frombuffer(b"".join(parts), dtype)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // table.itemsize
    return table, np.cumsum(sizes) - sizes, sizes


def steps(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t or "") > STEP_CHARS:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def by_words(texts: list[str] | pa.Array, words: Callable[[list[str]], list[bytes]], first: Callable[[list[str]], list[bytes]] | None = None) -> list[bytes]:
    """Each text's 32-bit ids: those of its space-separated words end to end.

    ``words`` gives the ids of each distinct word, ``first`` those of the words that start a text. Without
    ``first`` all words are alike, and cut at any ASCII white space.
    """
    if not len(texts):
        return []
    whole = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
    split = pc.split_pattern(whole, " ") if first else pc.ascii_split_whitespace(whole)
    bounds = split.offsets.to_numpy()
    coded = split.values.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    known = words(distinct)
    if first:
        known += first([t.partition(" ")[0] for t in texts])
        codes[bounds[:-1]] = len(distinct) + np.arange(len(texts))
    table, starts, sizes = runs(known, "<u4")
    ids, ends = take(table, starts, sizes, codes)
    buf, cut = ids.tobytes(), (4 * np.r_[0, ends][bounds]).tolist()
    return [buf[a:b] for a, b in zip(cut, cut[1:])]
