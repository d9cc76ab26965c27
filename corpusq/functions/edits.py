"""Edit scripts, their split into real errors and extra text, and the categories of differences.

An edit script is one minimal alignment: common ends are taken off, the rest is aligned by Hirschberg's
halving over the rows of the table, kept as bit vectors; ties go to substitution, then deletion.
Counts per script do not depend on the tie: fidelity + scope equals the Levenshtein distance as long
as scope counts the insertions of long inserted runs and fidelity everything else.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

SCOPE_RUN = 50
Op = tuple[str, int, int, int, int]


def _places(s: str) -> dict[str, int]:
    """For each character the set of its places in ``s``, as bits."""
    found: dict[str, int] = {}
    for i, c in enumerate(s):
        found[c] = found.get(c, 0) | 1 << i
    return found


def _common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


def distance(a: str, b: str) -> int:
    """Levenshtein distance by Myers' bit vectors: a column of the table is one integer."""
    n = _common(a, b)
    a, b = a[n:], b[n:]
    n = _common(a[::-1], b[::-1])
    a, b = (a[: len(a) - n], b[: len(b) - n]) if len(a) < len(b) else (b[: len(b) - n], a[: len(a) - n])
    if not a:
        return len(b)
    places, d = _places(a).get, len(a)
    every, last = (1 << d) - 1, 1 << d - 1
    up, down = every, 0
    for c in b:
        same = places(c, 0) | down
        kept = ((up + (same & up)) ^ up) | same
        less, more = up & kept, down | every & ~(up | kept)
        d += bool(more & last) - bool(less & last)
        more = more << 1 | 1
        up, down = every & (less << 1 | ~(more | kept)), more & kept
    return d


def _last_row(a: str, b: str) -> np.ndarray:
    """Distances of the whole of ``a`` to every prefix of ``b``, by the same bit vectors."""
    places, every = _places(b).get, (1 << len(b)) - 1
    up, down = every, 0
    for c in a:
        same = places(c, 0) | down
        kept = ((up + (same & up)) ^ up) | same
        less, more = up & kept, (down | every & ~(up | kept)) << 1 | 1
        up, down = every & (less << 1 | ~(more | kept)), more & kept
    bits = [np.unpackbits(np.frombuffer(x.to_bytes((len(b) + 7) // 8, "little"), np.uint8), count=len(b), bitorder="little").astype(np.int64) for x in (up, down)]
    return np.concatenate([[len(a)], len(a) + np.cumsum(bits[0] - bits[1])])


def _align(a: str, b: str) -> list[tuple[str, int, int, int]]:
    """Runs (tag, i, j, length) of aligned characters; explicit stack instead of recursion."""
    out: list[tuple[str, int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if head := _common(a[a0:a1], b[b0:b1]):
            out.append(("equal", a0, b0, head))
            a0, b0 = a0 + head, b0 + head
        if tail := _common(a[a0:a1][::-1], b[b0:b1][::-1]):
            a1, b1 = a1 - tail, b1 - tail
            todo.append((a1, a1 + tail, b1, b1 + tail))
        if a0 == a1:
            out += [("insert", a0, b0, b1 - b0)] if b0 < b1 else []
        elif b0 == b1:
            out.append(("delete", a0, b0, a1 - a0))
        elif a1 - a0 == 1:
            at = b.find(a[a0], b0, b1)
            m = max(at, b0)
            out += [("insert", a0, b0, m - b0)] if b0 < m else []
            out.append(("equal" if at >= 0 else "replace", a0, m, 1))
            out += [("insert", a1, m + 1, b1 - m - 1)] if m + 1 < b1 else []
        else:
            mid = (a0 + a1) // 2
            cost = _last_row(a[a0:mid], b[b0:b1]) + _last_row(a[mid:a1][::-1], b[b0:b1][::-1])[::-1]
            cut = b0 + int(np.argmin(cost))
            todo += [(mid, a1, cut, b1), (a0, mid, b0, cut)]
    return out


def opcodes(ref: str, hyp: str) -> list[Op]:
    """(tag, i1, i2, j1, j2) runs that turn ``ref`` into ``hyp``."""
    found: list[Op] = []
    for tag, i, j, n in _align(ref, hyp):
        i2, j2 = i + n * (tag != "insert"), j + n * (tag != "delete")
        if found and found[-1][0] == tag and found[-1][2] == i and found[-1][4] == j:
            found[-1] = (tag, found[-1][1], i2, found[-1][3], j2)
        else:
            found.append((tag, i, i2, j, j2))
    return found


def decompose(ref: str, hyp: str, scope_run: int = SCOPE_RUN) -> tuple[int, int, int]:
    """(fidelity, scope, distance): inserted runs of at least ``scope_run`` characters are scope."""
    fidelity = scope = 0
    for tag, i1, i2, j1, j2 in opcodes(ref, hyp):
        if tag == "insert" and j2 - j1 >= scope_run:
            scope += j2 - j1
        elif tag != "equal":
            fidelity += max(i2 - i1, j2 - j1)
    return fidelity, scope, fidelity + scope


def _bare(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def category(ref: str, hyp: str) -> str:
    """The first rule that fits a difference."""
    both = ref + hyp
    if not both.strip():
        return "whitespace"
    if ref and hyp and _bare(ref) == _bare(hyp):
        return "diacritic"
    if all(unicodedata.category(c)[0] in "PS" or c.isspace() for c in both):
        return "punctuation"
    if len(both) < 5 and any(c in both for c in "-¬­") and re.fullmatch(r"[-¬­\s\w]*", both):
        return "hyphenation"
    longer = max(ref, hyp, key=len)
    if len(longer) > 50 and any(longer.count(longer[k : k + 3]) >= 3 for k in range(len(longer) - 2)):
        return "artifact"
    if len(ref) > 80 or len(hyp) > 80 or abs(len(ref) - len(hyp)) > 40:
        return "layout"
    return "other"


def words_as_chars(a: str, b: str) -> tuple[str, str]:
    """Both texts with each distinct word as one private-use character: word distance is then character distance."""
    known: dict[str, str] = {}

    def code(w: str) -> str:
        k = len(known)
        return known.setdefault(w, chr(0xE000 + k) if k < 6400 else chr(0xF0000 + k - 6400))

    return "".join(map(code, a.split())), "".join(map(code, b.split()))
