"""Whole-text encoding with the public tokenizers, by distinct words.

A text is cut where no token can span: before a space that follows a non-space and precedes a
non-space. Both tokenizer files split there before they merge, so the ids of the words, joined,
are the ids of the text (tests compare them). The distinct words of a step are looked up in the ids
a worker remembers (``CACHE`` words and the generation before them); the others are encoded by the
library, with a full stop or comma behind a letter as a word of its own. Words that start with a space
go in one call: with the byte-level file, the tokens that start with a space tell where each begins.
Texts with a special token's string or any other white space are encoded as a whole.

The word file drops white space and never lets a token span it, so its texts are cut at all ASCII white
space, and words of ASCII and Latin-1 letters also where the file's pattern cuts them: into runs of
letters, single digits and runs of signs (:func:`cut`). The file's normalizer leaves a run of lower-case Latin-1
letters as it is and its pattern takes it whole, so it goes straight to the library's model. Other runs of
letters have exactly one token that ends a word, so many are encoded in one call and counted. Other words,
and those with an apostrophe or what may begin a special token, go to the whole library uncut.
"""

from __future__ import annotations

import os
import string
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from corpusq.llm import ragged

CACHE = 250_000
#: Where one of these occurs, words might not be independent or a special token might hide.
_ODD = ["  ", " \n", "\n ", "<|", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]

#: Runs of letters encoded in one call, so many words at most.
_CALL = 2000
_SIGNS = string.punctuation
#: What a byte of UTF-8 is: 0 white space, 1 of a letter, 2 sign, 3 digit, 4 what makes a word uncut. All Latin-1 letters begin with C3.
_KIND = np.full(256, 4, np.uint8)
_KIND[[*b" \t\n\v\f\r"]] = 0
_KIND[[*string.ascii_letters.encode(), 0xC3, *range(0x80, 0xC0)]] = 1
_KIND[[*_SIGNS.encode()]] = 2
_KIND[[*string.digits.encode()]] = 3
_KIND[[0x97, 0xB7, ord("'")]] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[[*string.ascii_uppercase.encode(), *range(0x80, 0x97), *range(0x98, 0x9F)]] += 32
_ODD_ASCII = [x for x in _ODD if x.isascii()]


def plain(text: str) -> bool:
    """The text has no white space but line ends and single spaces between words."""
    return text[0] != " " and text[-1] != " " and not any(x in text for x in (_ODD_ASCII if text.isascii() else _ODD))


def _stopped(word: str) -> bool:
    return len(word) > 2 and word[-1] in ".," and word[-2].isalpha()

#: The byte-level alphabet of the library's files, for texts read as Latin-1.
_BYTES = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}


def cut(texts: list[str | None]) -> pa.Array:
    """The texts with A-Z in lower case and a space wherever the word file's pattern cuts a word.

    Words with any other byte are left as they are. A sign mark beside a letter or digit beyond Latin-1
    might combine with it or belong to its run, so such words stay whole.
    """
    whole = pa.array([t or "" for t in texts], pa.large_string())
    offsets, data = np.frombuffer(whole.buffers()[1], np.int64)[: len(texts) + 1], whole.buffers()[2]
    old = np.frombuffer(data, np.uint8)[: offsets[-1]] if data else np.zeros(0, np.uint8)
    if not len(old):
        return whole
    kind = _KIND[old]
    apart = kind[1:] != kind[:-1]
    apart |= kind[1:] == 3
    apart &= kind[1:] != 0
    apart &= kind[:-1] != 0
    lower = _LOWER[old]
    odd = kind == 4
    odd[:-1] |= (old[:-1] == ord("<")) & (old[1:] == ord("|"))
    if odd.any():
        begins = kind == 0
        begins[offsets[:-1][offsets[:-1] < len(old)]] = True
        word = np.cumsum(begins, dtype=np.int32)
        left = np.zeros(int(word[-1]) + 1, bool)
        left[word[odd]] = True
        left = left[word]
        lower[left] = old[left]
        apart &= ~left[1:]
    at = np.flatnonzero(apart) + 1
    made, kept = np.full(len(old) + len(at), 32, np.uint8), np.ones(len(old) + len(at), bool)
    kept[at + np.arange(len(at))] = False
    made[kept] = lower
    moved = offsets + np.searchsorted(at, offsets)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved), pa.py_buffer(made))


def _parts(word: str) -> list[str]:
    """A word of letters, also once normalized, with signs behind them, as two."""
    stem = word.rstrip(_SIGNS.replace("'", ""))
    return [stem, word[len(stem) :]] if unicodedata.normalize("NFC", stem).lower().isalpha() and len(stem) < len(word) else [word]


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids. One per worker; not for pickling."""

    def __init__(self, path: str, keep_space: bool, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._lib, self._cache = Tokenizer.from_file(path), cache
        self._space = " " if keep_space else ""
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        if keep_space:
            self._starts = np.zeros(self._lib.get_vocab_size(), bool)
            self._starts[[i for t, i in self._lib.get_vocab().items() if t.startswith("Ġ")]] = True
        else:
            self._model = self._lib.model
            self._ends = np.zeros(self._lib.get_vocab_size(), bool)
            self._ends[[i for t, i in self._lib.get_vocab().items() if t.endswith("</w>")]] = True

    def whole(self, text: str) -> bytes:
        return np.array(self._lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words, each of which gets a space in front if the file keeps spaces."""
        if words:
            ids = np.array(self._lib.encode_batch_fast([self._space + " ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self._starts[ids]) if self._space else np.r_[0, np.flatnonzero(self._ends[ids]) + 1][:-1]
            if len(at) == len(words) and at[0] == 0:
                buf, cut = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
                return [buf[a:b] for a, b in zip(cut, cut[1:])]
        return [self.whole(self._space + w) for w in words]

    def _straight(self, words: list[str]) -> list[bytes]:
        """Ids of runs of lower-case Latin-1 letters, by the model alone."""
        tokenize = self._model.tokenize
        made = [[t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTES))] for w in words]
        ends = np.cumsum(np.fromiter(map(len, made), np.int64, len(made)))
        buf = np.fromiter(chain.from_iterable(made), "<u4", int(ends[-1]) if made else 0).tobytes()
        at = [0, *(4 * ends).tolist()]
        return [buf[a:b] for a, b in zip(at, at[1:])]

    def _apart(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of words of the word file."""
        letters = [w for w in missing if w.isalpha()]
        latin = [w for w in letters if w.isascii() or max(w) <= "\xff"]
        latin = [w for w in latin if w.islower() and w == w.lower()]
        made = dict(zip(latin, self._straight(latin)))
        if len(latin) < len(letters):
            rest = [w for w in letters if w not in made]
            for k in range(0, len(rest), _CALL):
                some = rest[k : k + _CALL]
                made.update(zip(some, self._together(some)))
        if len(letters) < len(missing):
            other = [(w, _parts(w)) for w in missing if not w.isalpha()]
            ends = {x: self.whole(x) for x in {p[1] for _, p in other if len(p) > 1}}
            made.update((w, (made.get(p[0]) or self.whole(p[0])) + ends[p[1]] if len(p) > 1 else self.whole(w) if w else b"") for w, p in other)
        return made

    def _stems(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of words of the byte-level file, and of those without the full stop or comma behind them."""
        new, old = self._new, self._old
        stems = list({w[:-1] if _stopped(w) else w for w in missing})
        stems = [w for w in stems if w not in new and w not in old]
        made = dict(zip(stems, self._together(stems)))
        ends = {c: self.whole(c) for c in ".,"}
        for w in missing:
            if _stopped(w):
                stem = w[:-1]
                made[w] = (made if stem in made else new if stem in new else old)[stem] + ends[w[-1]]
        return made

    def _words(self, words: list[str]) -> list[bytes]:
        new, old = self._new, self._old
        get, get_old = new.get, old.get
        found = [x if (x := get(w)) is not None else get_old(w) for w in words]
        missing = [w for w, x in zip(words, found) if x is None]
        if not missing:
            return found
        made = self._stems(missing) if self._space else self._apart(missing)
        found = [made[w] if x is None else x for w, x in zip(words, found)]
        if len(new) + len(made) > self._cache:
            self._old, self._new = new, made
        else:
            new.update(made)
        return found

    def _heads(self, words: list[str]) -> list[bytes]:
        return [self.whole(w) for w in words]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        found: list[bytes] = []
        for step in ragged.steps(texts):
            if not self._space:
                found += ragged.by_words(cut(step), self._words)
                continue
            is_plain = [bool(t) and plain(t) for t in step]
            ids = iter(ragged.by_words([t for t, p in zip(step, is_plain) if p], self._words, self._heads))
            found += [next(ids) if p else self.whole(t) if t else b"" for t, p in zip(step, is_plain)]
        return found

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keep_space: bool) -> Encoder:
    """The worker's encoder for a file; a reused Python worker keeps its words."""
    if (path, keep_space) not in _ENCODERS:
        _ENCODERS[path, keep_space] = Encoder(path, keep_space)
    return _ENCODERS[path, keep_space]
