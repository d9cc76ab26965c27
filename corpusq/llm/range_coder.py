"""Token ids on disk by an adaptive context-mixing range coder.

Ids are cut into blocks of ``BLOCK`` (only the last of a group is shorter). Each block starts from the
same model state and a fresh coder and carries a CRC-32, so blocks are decoded independently and
damage is found. The blocks of a group are coded side by side, one lane each: step t codes the
t-th id of every lane with array operations. All arithmetic is in integers, so files decode on any machine.

Every id is coded whole, by three predictions:

* order 2: the id that followed the last two ids before in this block, with a confidence;
* order 1: the counted followers of the last id;
* order 0: the counted ids.

The share of the range each order gets is learned as the block is coded: for order 2, and for order 1
against order 0, two adaptive estimates in different contexts (confidence; confidence with what
order 1 knows of the last id; that alone; that with the orders that were right before) are mixed
with a weight that follows its gradient. The id then takes the part of the share that its count has in
the highest order that predicts it. No bits are stored beside the range coder's.

The counts of orders 0 and 1 are those of the group (at most ``BLOCK * LANES`` ids); its header holds them,
compressed, and every block starts from them. A follower is listed where it saves more bits than
its entry takes, which every group decides from its own counts. Shares of a list are counted in few bits
more than its length has, so that a table tells at once which follower a code falls on.

File: groups one after another. Group: magic, sizes, header, document table (id, has id, tokens), block
table (tokens, coded bytes, CRC-32), coded streams.

Null text counts as empty; it has the end id only. Null ids come first; rows that repeat an id come in
order of their text. An empty table gives no rows. Texts of any length are coded whole, across
blocks. Extra columns are ignored, whatever their names. Ids are unsigned 32-bit; a group may hold
at most 2**17 different ones.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm import sharedfs
from corpusq.llm.common import work_path
from corpusq.llm.tokens import encoder

BLOCK, LANES, _SLICE = 4096, 2048, 256
MAGIC = b"CXM3"
#: Slots of a lane's order-2 table, and the classes of what order 1 knows of an id.
SLOTS, KNOWN = 4096, 16
#: Bits, at least, that counts are scaled to; the bits a listed follower has to save.
BITS, ENTRY = 14, 22
#: Bits a list's shares are counted in: those of its length and FINE more, LEAST_BITS to BITS.
FINE, LEAST_BITS = 4, 8
#: The range a block starts with, the least one after an id, and the bits of its codes.
_START, _TOP, _CODE = 1 << 48, 1 << 44, (1 << 60) - 1


def _scaled(n: np.ndarray, group: np.ndarray, groups: int, bits: int | np.ndarray) -> np.ndarray:
    """Counts scaled so that each group's sum is 2**bits (one for all groups or one each), every count at least 1."""
    total = np.bincount(group, n, groups)
    size = np.bincount(group, minlength=groups)
    room = (1 << bits) - size  # one for each entry, the rest by count
    share = n * room[group] // np.maximum(total[group].astype(np.int64), 1)
    left = room - np.bincount(group, share, groups).astype(np.int64)
    # What rounding leaves goes to the first of the largest counts.
    order = np.lexsort((np.arange(len(n)), -n, group))
    first = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]]) if len(n) else order
    share[order[first]] += left[group[order[first]]]
    return share + 1


def _packed(*parts: np.ndarray) -> bytes:
    """Arrays of small unsigned integers, low and high bytes apart, deflated."""
    planes = [p.astype("<u4").view(np.uint8).reshape(-1, 4)[:, k].tobytes() for p in parts for k in range(4)]
    return struct.pack(f"<{len(parts)}I", *map(len, parts)) + zlib.compress(b"".join(planes), 6)


def _unpacked(data: bytes, n: int) -> list[np.ndarray]:
    sizes, body, at, found = struct.unpack_from(f"<{n}I", data), np.frombuffer(zlib.decompress(data[4 * n :]), np.uint8), 0, []
    for size in sizes:
        planes = body[at : at + 4 * size].reshape(4, size)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64) if size else np.zeros(0, np.int64))
        at += 4 * size
    return found


class Counts:
    """Counts of orders 0 and 1 of a group. Symbols are the places of the group's ids in ascending order, plus one.

    ``pairs``: last symbol << 17 | symbol of the listed followers, ascending. Symbol 0 stands before
    a block's start and has no followers.
    """

    def __init__(self, ids: np.ndarray, n0: np.ndarray, pairs: np.ndarray, n1: np.ndarray, known: np.ndarray):
        self.ids, self.pairs, self.known = ids, pairs, known
        bits = max(BITS, len(ids).bit_length() + 2)
        self.kept = (n0, n1)
        freq0 = np.r_[0, _scaled(n0, np.zeros(len(ids), np.int64), 1, bits)]
        last = pairs >> 17
        size = np.bincount(last, minlength=len(ids) + 1)
        scale = np.minimum(np.maximum(np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64) + FINE, LEAST_BITS), BITS)
        freq1 = _scaled(n1, last, len(ids) + 1, scale)
        run = np.cumsum(freq1) - freq1
        cum1 = run - run[np.searchsorted(last, last)] if len(run) else run
        # One table of parts: the listed followers, then the symbols of order 0, then the whole share of order 2;
        # each has its symbol, where its share begins, the share and the bits that shares are counted in.
        sym = np.r_[pairs & 0x1FFFF, np.arange(len(freq0)), 0]
        cum, freq = np.r_[cum1, np.cumsum(freq0) - freq0, 0], np.r_[freq1, freq0, 1]
        self.parts = sym << 46 | cum << 26 | freq << 5 | np.r_[scale[last], np.full(len(freq0), bits), 0]
        self.order0, self.order2 = len(pairs), len(freq) - 1
        # The part that each unit of a share belongs to: order 0, then the lists, then one that only damaged blocks ask
        # for, where a list is empty. Where a symbol's list begins, its bits, what is known.
        units = np.r_[freq0, freq1, 1 << LEAST_BITS]
        self.slots = np.repeat(np.r_[self.order0 : self.order2, : self.order0, self.order2].astype(np.int32), units)
        whole = np.where(size > 0, 1 << scale, 0)
        begin = np.where(size > 0, (1 << bits) + np.cumsum(whole) - whole, len(self.slots) - units[-1])
        self.lists = begin << 10 | scale << 5 | known
        self.bits = bits

    @classmethod
    def of(cls, ids: np.ndarray, n0: np.ndarray, grid: np.ndarray) -> tuple[Counts, np.ndarray]:
        """The counts of a grid of symbols (steps by lanes, 0 where a lane has ended), and the part of each place."""
        before = np.zeros_like(grid)
        before[1:] = grid[:-1]
        # Sorted slice by slice, so that temporary arrays stay small.
        slices = []
        for lane in range(0, grid.shape[1], _SLICE):
            some = grid[:, lane : lane + _SLICE]
            at = np.flatnonzero(some)
            packed = np.zeros(some.shape, np.int64)
            packed[1:] = some[:-1]
            packed <<= 17
            packed |= some
            packed = packed.reshape(-1)[at] << 27
            packed |= at
            packed.sort()
            key = packed >> 27
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            slices.append((key[first], np.diff(np.r_[first, len(key)]), (packed & ((1 << 27) - 1)).astype(np.int32)))
        pair, which = np.unique(np.concatenate([x[0] for x in slices]), return_inverse=True)
        n = np.bincount(which, np.concatenate([x[1] for x in slices])).astype(np.int64)
        last, sym = pair >> 17, (pair & 0x1FFFF) - 1
        n_last = np.bincount(last, n, len(ids) + 1)
        gain = n * np.log2(n * float(n0.sum()) / np.maximum(n_last[last] * n0[sym], 1))
        listed = (gain > ENTRY) & (last > 0)
        # No list may be longer than its scale has room for.
        rank = np.lexsort((-n, last))
        place = np.empty(len(rank), np.int64)
        run = last[rank]
        place[rank] = np.arange(len(rank)) - np.searchsorted(run, run)
        listed &= place < 1 << (BITS - 1)
        part = np.where(listed, np.cumsum(listed) - 1, int(listed.sum()) + 1 + sym)
        parts, seen = np.zeros(grid.shape, np.int32), 0
        for lane, (key, each, at) in zip(range(0, grid.shape[1], _SLICE), slices):
            some = np.zeros(parts[:, lane : lane + _SLICE].size, np.int32)
            some[at] = np.repeat(part[which[seen : seen + len(key)]], each)
            parts[:, lane : lane + _SLICE] = some.reshape(len(grid), -1)
            seen += len(key)
        share = np.bincount(last, n * listed, len(ids) + 1) / np.maximum(n_last, 1)
        known = np.minimum((share * KNOWN).astype(np.int64), KNOWN - 1)
        return cls(ids, n0, pair[listed], n[listed], known), parts

    def dump(self) -> bytes:
        n0, n1 = self.kept
        last = self.pairs >> 17
        per = np.bincount(last, minlength=len(self.ids) + 1)
        sym = self.pairs & 0x1FFFF
        step = np.diff(np.r_[0, sym])
        new = np.r_[True, last[1:] != last[:-1]] if len(last) else np.zeros(0, bool)
        step[new] = sym[new]
        return _packed(np.diff(np.r_[0, self.ids]), n0, per, step, n1, self.known)

    @classmethod
    def load(cls, data: bytes) -> Counts:
        gap, n0, per, step, n1, known = _unpacked(data, 6)
        last = np.repeat(np.arange(len(per)), per)
        run = np.cumsum(step)
        first = np.cumsum(per) - per
        base = np.r_[0, run][first]
        return cls(np.cumsum(gap), n0, last << 17 | (run - base[last] if len(run) else run), n1, known)


class _Coder:
    """Range coder over lanes: ranges of 2**44 to 2**60, output in 16-bit words, carries settled at the end."""

    def __init__(self, lanes: int, coded: list[bytes] | None = None):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _START, np.int64)
        self.decoding = coded is not None
        if coded is None:
            self.lanes: list[np.ndarray] = []
            self.digits: list[np.ndarray] = []
        else:
            # Behind its words a block is read as zeros. ``low`` is the code less the low end of the range.
            sizes = np.array([len(c) // 2 + 4 for c in coded], np.int64)
            self.words = np.frombuffer(b"".join(c[: len(c) // 2 * 2] + bytes(8) for c in coded), "<u2").astype(np.int64)
            self.at = np.cumsum(sizes) - sizes
            for _ in range(3):
                self.low = self.low << 16 | self.words[self.at]
                self.at += 1
            # Damaged blocks may ask for more words than there are.
            self.last = len(self.words) - 1

    def settle(self, live: int) -> None:
        """Moves words out of or into the first ``live`` lanes; ranges are 2**44 at least after it."""
        lane = (self.range[:live] < _TOP).nonzero()[0]
        while len(lane):
            low, width = self.low.take(lane), self.range.take(lane)
            width <<= 16
            if self.decoding:
                at = self.at.take(lane)
                low <<= 16
                low |= self.words.take(np.minimum(at, self.last))
                low &= _CODE
                at += 1
                self.at[lane] = at
            else:
                self.lanes.append(lane)
                self.digits.append((low >> 32).astype(np.int32))
                low &= 0xFFFFFFFF
                low <<= 16
            self.low[lane], self.range[lane] = low, width
            lane = lane[width < _TOP]

    def finish(self) -> list[bytes]:
        """The words of each lane: the last is the shortest number within the range, zeros behind it left out."""
        lanes = len(self.low)
        lane = np.concatenate([*self.lanes, np.arange(lanes)]).astype(np.uint16 if lanes < 1 << 16 else np.int64)
        digits = np.concatenate([*self.digits, ((self.low + _TOP - 1) >> 44 << 12).astype(np.int32)])[np.argsort(lane, kind="stable")]
        while len(over := np.flatnonzero(digits > 0xFFFF)):
            carry = digits[over] >> 16
            digits[over] &= 0xFFFF
            digits[over - 1] += carry
        cut = [0, *(2 * np.cumsum(np.bincount(lane, minlength=lanes))).tolist()]
        buf = digits.astype("<u2").tobytes()
        return [buf[a:b] for a, b in zip(cut, cut[1:])]


#: What an order-2 entry's confidence becomes after a miss and after a hit, as differences, and whether the entry stays.
_STEP = np.array([*((k >> 1) - k for k in range(8)), 1, 1, 1, 1, 1, 1, 1, 0], np.int32)
_STAYS = np.array([*(k > 1 for k in range(8)), *[True] * 8])
#: The bounds of an estimate, and the estimates every block starts with: order 2 by confidence, order 1 by the share it knows.
_LEAST, _MOST, _HISTORY = 64, 64512, 9
#: So far apart are the contexts of what order 1 knows, in the second estimate of either mix.
_WIDE = np.array([[8], [_HISTORY]])
_START2 = np.array([512, 12000, 28000, 40000, 48000, 52000, 56000, 60000], np.int32)
_START1 = np.array([(2 * k + 1) * 65536 // (2 * KNOWN) for k in range(KNOWN)], np.int32)


class _Mixes:
    """For each lane two mixes (order 2; order 1), each of two adaptive 16-bit estimates and a weight that learns which is nearer."""

    def __init__(self, lanes: int):
        starts = [_START2, np.tile(_START2, KNOWN), _START1, np.repeat(_START1, _HISTORY)]
        self.table = np.concatenate([np.tile(x, lanes) for x in starts])
        each = np.arange(lanes, dtype=np.int64)
        #: Where the estimates of a lane begin, by their contexts.
        self.bases = np.stack([lanes * sum(map(len, starts[:k])) + each * len(x) for k, x in enumerate(starts)])
        self.weight = np.full((2, lanes), 1 << 14, np.int32)

    def only(self, live: int) -> None:
        self.bases, self.weight = (np.ascontiguousarray(x[:, :live]) for x in (self.bases, self.weight))

    def estimate(self, at: np.ndarray) -> np.ndarray:
        """The two mixed estimates, from the four that stand at ``at``."""
        self.at = at.reshape(-1)
        self.old = self.table.take(self.at).reshape(2, 2, -1)
        self.apart = self.old[:, 1] - self.old[:, 0]
        p = self.apart * self.weight
        p >>= 15
        p += self.old[:, 0]
        return p

    def learn(self, one: np.ndarray, held: np.ndarray) -> None:
        """``one``: the two outcomes; where ``held`` is 0 rather than -1 the mix of order 1 learns nothing."""
        goal = one * np.int32(_MOST - _LEAST)
        goal += _LEAST
        step = ((self.apart > 0) == one).astype(np.int32)
        step <<= 15
        step -= self.weight
        step >>= 7
        new = goal[:, None] - self.old
        new >>= 5
        new[1] &= held
        new += self.old
        self.table[self.at] = new.reshape(-1)
        step[1] &= held
        self.weight += step


class _Lanes:
    """Coder and model of a group of blocks; ``sizes`` must not grow from lane to lane."""

    def __init__(self, sizes: list[int], counts: Counts, coded: list[bytes] | None = None):
        n = len(sizes)
        self.sizes, self.counts, self.coder = np.array(sizes, np.int64), counts, _Coder(n, coded)
        self.table = np.zeros(n * SLOTS, np.int32)
        self.mixes = _Mixes(n)

    def run(self, grid: np.ndarray | None, parts: np.ndarray | None) -> np.ndarray:
        """Codes the symbols (steps by lanes) with their parts of orders 0 and 1, or decodes them."""
        c, coder, table = self.counts, self.coder, self.table
        n, steps, bits = len(self.sizes), int(self.sizes.max(initial=0)), c.bits
        out = np.zeros((steps, n), np.int32) if grid is None else grid
        lists, slots = c.lists, c.slots
        base, mixes = np.arange(n, dtype=np.int64) * SLOTS, self.mixes
        a, past, mark = (np.zeros(n, np.int64) for _ in range(3))
        kind = np.zeros(n, np.int8)
        live = n
        for t in range(steps):
            if self.sizes[live - 1] <= t:
                live = int(np.searchsorted(-self.sizes, -t, side="left"))
                a, past, kind, mark, base = (x[:live] for x in (a, past, kind, mark, base))
                mixes.only(live)
            at = a * 5003
            at += mark
            at &= SLOTS - 1
            at += base
            entry = table.take(at)
            guess, sure = entry >> 3, entry & 7
            # The share of order 2, then what is left between orders 1 and 0.
            list_of = lists.take(a)
            know = list_of & 31
            contexts = mixes.bases.copy()
            contexts[:2] += sure
            contexts[2] += know
            contexts[3] += past
            contexts[1::2] += know * _WIDE
            p, q = mixes.estimate(contexts)
            rest = (65536 - p).astype(np.int64)
            q = q * rest
            q >>= 16
            low, r = coder.low[:live], coder.range[:live]
            r >>= 16
            one, two = q * r, rest * r
            if grid is None:
                hit, more = low >= two, low >= one
            else:
                sym, part = grid[t, :live], parts[t, :live]
                hit = guess == sym
                more = part >= c.order0
                more |= hit
            before, kind = kind, more.view(np.int8) + hit.view(np.int8)
            # Where the id's order begins and ends.
            start = np.where(hit, two, one)
            start *= more
            r <<= 16
            width = np.where(hit, r, np.where(more, two, one))
            width -= start
            if grid is None:
                low -= start
                list_of >>= 5
                shift = np.where(more, bits, list_of & 31)
                shift[hit] = 0
                width >>= shift
                v = (low.view(np.uint64) // width.view(np.uint64)).view(np.int64)
                np.minimum(v, (1 << shift) - 1, out=v)
                list_of >>= 5
                list_of[more] = 0
                v += list_of
                part = slots.take(v)
                part[hit] = c.order2
                each = c.parts.take(part)
                sym = (each >> 46).astype(np.int32)
                sym = np.where(hit, guess, sym)
            else:
                low += start
                each = c.parts.take(np.where(hit, c.order2, part))
                width >>= each & 31
            off = each >> 26
            off &= (1 << 20) - 1
            off *= width
            each >>= 5
            each &= (1 << 21) - 1
            if grid is None:
                low -= off
                out[t, :live] = sym
            else:
                low += off
            np.multiply(width, each, out=r)
            coder.settle(live)
            # Learning; order 1 learns where order 2 missed.
            one = np.empty((2, live), np.int32)
            state = one[0]
            state[:] = hit
            np.equal(kind, 0, out=one[1], casting="unsafe")
            mixes.learn(one, state - 1)
            state <<= 3
            state += sure
            entry += _STEP.take(state)
            fresh = sym << 3
            fresh += 1
            table[at] = np.where(_STAYS.take(state), entry, fresh)
            mark = a * 1031
            a, past = sym.astype(np.int64), before * np.int64(3)
            past += kind
        return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, list[tuple[int, bytes, int]]]:
    """The header of a group and (tokens, coded, crc32) of each of its blocks."""
    if not len(ids):
        return b"", []
    if int(ids.max()) < 1 << 20:
        count = np.bincount(ids)
        distinct = np.flatnonzero(count)
        n0, place = count[distinct], np.cumsum(count > 0)
        sym = place[ids]
    else:
        distinct, sym, n0 = np.unique(ids, return_inverse=True, return_counts=True)
        sym = sym + 1
    if len(distinct) >= 1 << 17:
        raise ValueError(f"a group has {len(distinct)} different ids, at most {(1 << 17) - 1} are possible")
    n = -(-len(ids) // block)
    grid = np.zeros(n * block, np.int32)
    grid[: len(ids)] = sym
    grid = np.ascontiguousarray(grid.reshape(n, block)[:, : min(block, len(ids))].T)
    sizes = [min(block, len(ids) - k) for k in range(0, len(ids), block)]
    counts, parts = Counts.of(distinct.astype(np.int64), n0, grid)
    lanes = _Lanes(sizes, counts)
    lanes.run(grid, parts)
    raw = ids.astype("<u4").tobytes()
    crcs = [zlib.crc32(raw[4 * k : 4 * (k + block)]) for k in range(0, len(ids), block)]
    return counts.dump(), list(zip(sizes, lanes.coder.finish(), crcs))


def decode_blocks(header: bytes, blocks: list[tuple[int, bytes, int]]) -> np.ndarray:
    """The ids of some blocks of a group, largest first; a block whose CRC differs raises ValueError."""
    if not blocks:
        return np.zeros(0, np.int64)
    counts = Counts.load(header)
    out = _Lanes([b[0] for b in blocks], counts, [b[1] for b in blocks]).run(None, None)
    found = np.r_[0, counts.ids].take(out, mode="clip")
    parts = [found[: b[0], i].astype("<u4") for i, b in enumerate(blocks)]
    for i, (p, b) in enumerate(zip(parts, blocks)):
        if zlib.crc32(p.tobytes()) != b[2]:
            raise ValueError(f"block {i}: checksum differs")
    return np.concatenate(parts).astype(np.int64)


def write_group(f: BinaryIO, docs: list[tuple[int | None, bytes]]) -> int:
    """Appends a group of (doc id, ids as little-endian 32-bit); returns its bytes."""
    header, blocks = encode_blocks(np.frombuffer(b"".join(x for _, x in docs), "<u4"))
    table = np.array([(d or 0, d is not None, len(x) // 4) for d, x in docs], "<i8").tobytes()
    index = np.array([(n, len(c), crc) for n, c, crc in blocks], "<u4").tobytes()
    head = MAGIC + struct.pack("<QQQ", len(docs), len(blocks), len(header))
    whole = b"".join([head, header, table, index, *(b[1] for b in blocks)])
    f.write(whole)
    return len(whole)


def read_groups(f: BinaryIO) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc id, ids) of every document of a file, group by group."""
    while head := f.read(28):
        if head[:4] != MAGIC:
            raise ValueError("not a token file")
        n_docs, n_blocks, n_header = struct.unpack("<QQQ", head[4:])
        header = f.read(n_header)
        table = np.frombuffer(f.read(24 * n_docs), "<i8").reshape(-1, 3)
        index = np.frombuffer(f.read(12 * n_blocks), "<u4").reshape(-1, 3).tolist()
        ids = decode_blocks(header, [(n, f.read(size), crc) for n, size, crc in index])
        at = 0
        for d, there, n in table.tolist():
            yield (d if there else None), ids[at : at + n]
            at += n


def write_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes one file per range of ids; returns (part, path, docs, tokens, bytes), parts in ascending id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, end = encoder(tokenizer, False), np.array([end_id], "<u4").tobytes()
        path, n_docs, n_tokens, size, held, group = sharedfs.own_name(folder, f"part-{part:06d}", ".cxr"), 0, 0, 0, 0, []
        with sharedfs.written(path) as f:
            for b in batches:
                for d, x in zip(b.column(0).to_pylist(), enc.encode_many(b.column(1).to_pylist())):
                    group.append((d, x + end))
                    held += len(group[-1][1]) // 4
                    n_docs, n_tokens = n_docs + 1, n_tokens + len(group[-1][1]) // 4
                    if held >= BLOCK * LANES:
                        size += write_group(f, group)
                        group, held = [], 0
            if group:
                size += write_group(f, group)
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "docs": [n_docs], "tokens": [n_tokens], "bytes": [size]})

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    rows = rows.repartitionByRange("_id").sortWithinPartitions("_id", "_t")
    made = rows.mapInArrow(run, "part long, path string, docs long, tokens long, bytes long").collect()
    return docs.sparkSession.createDataFrame(made, "part long, path string, docs long, tokens long, bytes long")


def read_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, start, n_tokens, ids_crc32, read back from the files."""
    spark = manifest.sparkSession
    parts = sorted(manifest.collect(), key=lambda r: r.part)
    base, rows = 0, []
    for r in parts:
        rows.append((r.path, base))
        base += r.tokens
    files = spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with sharedfs.opened(path) as f:
                    found: list[tuple] = []
                    for d, ids in read_groups(f):
                        found.append((d, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(found) >= 10_000:
                            yield _batch(found)
                            found = []
                    yield _batch(found)

    def _batch(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "_id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("_id", id_col)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    folder = work_path(docs.sparkSession, "tokens")
    return read_files(write_files(docs, tokenizer, end_id, folder, id_col, text_col), id_col)
