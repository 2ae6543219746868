"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text, A-Z lower-cased, is a sequence of bytes and an end. A byte is coded by binary
decisions down a Huffman tree that belongs to the two or three bytes before it. Bytes and trees
come from counts of n-grams over all learned documents; only bytes that none of these has go
through an escape and eight even decisions.

Six predictors judge every decision: the counts of its tree (the last two or three bytes), the
counts of zeros and ones after hashed contexts (the last 4, 5 and 6 bytes, and the word so far
with its tree) over all learned documents, and a match model of what followed the same six bytes
earlier in the text. Their log odds are mixed by weights; which set of weights, depends on what
the contexts have seen; where all sets are alike they are worked out as one. Counts are frozen
for scoring. The weights are learned from every decision of all learned documents: these are in
two halves by a hash of their text, and a document is judged by the counts of the half that it is
not in, as its own counts would always be right. They are the same at the start of every text; while it is read, what its own weights differ by is refined from every
decision, after stretches of at most `STRETCH` bytes: a decision is always coded with weights
from before it. The sum of the code lengths is the text's log probability. Nothing is taken from
a sample: bytes, trees, tables and their sizes come from all learned documents.

Four passes over the learned documents or all of them, each a map over whole texts: n-grams
and words; counts by context and half; weights; scores. Each task adds its own documents up before anything is
shuffled. The counts of a task are sparse blocks of slots, added up a few at a time. A table has
a slot for every decision learned from (for four bytes: for 16 times the different n-grams), up
to 2^MOST_BITS, the bound of what is broadcast (a byte a slot); beyond it contexts share slots. A context's decisions lie in 16 slots next to one another.

Beside it stands a unigram model of words, with exact counts: the most frequent ones (at most
`COMMON_WORDS`) are broadcast, the rest is joined.

Defined results: null text counts as empty, which is the end alone; ties and repeated rows
make no difference to how a row is scored; without learned documents every decision is
even and base counts are zero; a null id is learned from; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import pickle
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, map_arrow, quiet_threads, staged

#: Hashed contexts by their number of bytes, and 0 for the word so far; the least and the most slots of a table as powers of two.
ORDERS = (4, 5, 6, 0)
LEAST_BITS, MOST_BITS = 16, 24
#: Contexts of two and of three bytes that have trees of their own at most, the most frequent, and how often each must be seen.
TREE_SIZES = ((2, 8, 4096), (3, 40, 8192))
#: Different n-grams and words that a task holds before it hands them on; keys of contexts likewise, and those it collects before it counts them.
GRAMS_HELD, WORDS_HELD, KEYS_HELD, WAITING = 2_000_000, 400_000, 6_000_000, 250_000
MATCH = 6
#: Slots of a block, and tables that are added up at once.
BLOCK, FAN_IN = 1 << 17, 32
COMMON_WORDS = 400_000
#: Bytes of a text that are worked on at once, and of several short ones, few enough for their arrays to stay in a core's cache.
CHUNK, GROUP = 1 << 18, 3 << 14
#: Bytes after which the weights are refined, at the start of a text and at most.
FIRST_STRETCH, STRETCH = 64, 1024
#: Log odds are stored in steps of a tenth.
SCALE = 10.0
LOG10_2 = float(np.log10(2))
#: Bytes are numbers from 1 on; 0 is the end, or what is before a text.
SPACE = np.zeros(257, bool)
SPACE[[0, 33, 10, 11, 12, 13, 14]] = True
GRAM = 9
_rng = np.random.default_rng(20250311)
_M = [np.uint32(x) for x in _rng.integers(1, 1 << 31, MATCH, dtype=np.int64) * 2 + 1]
_M64 = [np.uint64(x) for x in _rng.integers(1, 1 << 62, MATCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
_MIX, _MIX64 = np.uint32(0x9E3779B1), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x4F6CDD1D


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^32."""
    steps = np.full((2, CHUNK + 2 * GROUP + 64), np.array([[_BASE], [pow(_BASE, -1, 1 << 32)]], np.uint32))
    steps[:, 0] = 1
    return tuple(np.cumprod(steps, axis=1, dtype=np.uint32))


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def pick(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """values[at] for places that are known to exist, which saves the test of bounds."""
    return values.take(at, mode="clip")


# Sorted keys with counts


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, sorted, and how often each occurs. keys is sorted in place."""
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.diff(first, append=len(keys))


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(runs) == 1:
        return runs[0]
    keys = np.concatenate([k for k, _ in runs])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    n = np.concatenate([n for _, n in runs])[order]
    return keys[first], np.add.reduceat(n, first) if len(first) else n


class Tally:
    """Counts of keys of at most 48 bits: collected, sorted, and merged when several runs have come together.

    A run is an array of keys with their counts in the 16 bits below; larger counts are kept apart.
    """

    BITS = np.uint64(16)
    MOST = (1 << 16) - 1

    def __init__(self):
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.runs: list[np.ndarray] = []
        self.large: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.held += len(keys)
        if self.held > WAITING:
            self._count()

    def _count(self) -> None:
        if self.waiting:
            self._keep(*counted(np.concatenate(self.waiting)))
            self.waiting, self.held = [], 0
            if len(self.runs) >= 8:
                self.merge()

    def _keep(self, keys: np.ndarray, n: np.ndarray) -> None:
        if n.max(initial=0) > self.MOST:
            fits = n <= self.MOST
            self.large.append((keys[~fits], n[~fits]))
            keys, n = keys[fits], n[fits]
        self.runs.append(keys << self.BITS | n.astype(np.uint64))

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        run = self.runs[0] if len(self.runs) == 1 else np.concatenate(self.runs)
        one, self.runs = len(self.runs) == 1, []
        if not one:
            run.sort(kind="stable")  # which makes use of the runs
        keys = run >> self.BITS
        run &= np.uint64(self.MOST)
        if one:
            return keys, run.view(np.int64)
        last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
        return keys[last], np.diff(np.cumsum(run, out=run)[last].view(np.int64), prepend=0)

    def merge(self) -> None:
        if len(self.runs) > 1:
            self._keep(*self._merged())
        if len(self.large) > 1:
            self.large = [merged(self.large)]

    def size(self) -> int:
        return sum(map(len, self.runs)) + sum(len(k) for k, _ in self.large)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._count()
        found, self.large = self.large + ([self._merged()] if self.runs else []), []
        return merged(found) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


# Texts laid out


@dataclass
class Carry:
    """What a piece of a long text takes over from those before it."""

    tail: np.ndarray  # the last bytes
    word: np.uint32  # sum and power of the word so far
    power: np.uint32
    keys: np.ndarray  # the different runs of MATCH bytes so far, sorted, and the numbers of the bytes that last followed them
    followed: np.ndarray
    right: bool = False  # whether the match model was right about the last byte


@dataclass
class Laid:
    """Pieces of texts one after another, each after MATCH empty places and before one for its end."""

    u: np.ndarray  # numbers of the bytes
    begin: np.ndarray  # of each piece
    size: np.ndarray  # bytes of each piece, and its end if it has it
    carry: Carry | None

    def real(self) -> np.ndarray:
        out = np.zeros(len(self.u) + 1, np.int8)
        out[self.begin] = 1
        out[self.begin + self.size] -= 1
        return np.cumsum(out, dtype=np.int8)[:-1].view(bool)


def lay_out(pieces: list[tuple[bytes, bool]], carry: Carry | None = None) -> Laid:
    """carry is for the first piece, if it goes on with a text."""
    before = bytes(MATCH)
    raw = np.frombuffer(b"".join([x for data, _ in pieces for x in (before, data, b"\0")]), np.uint8)
    length = np.array([len(data) for data, _ in pieces])
    begin = np.cumsum(length + MATCH + 1) - length - 1
    u = raw.astype(np.uint32)
    u += np.uint32(1)
    u[(begin[:, None] + np.arange(-MATCH, 0)).ravel()] = 0
    u[begin + length] = 0
    if carry is not None and len(carry.tail):
        u[MATCH - len(carry.tail) : MATCH] = carry.tail.astype(np.uint32) + np.uint32(1)
    return Laid(u, begin, length + np.array([last for _, last in pieces]), carry)


def pieces_of(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """Long texts are worked on in pieces, of which only the last has the end; what a piece needs of those before it is carried."""
    for start in range(0, max(1, len(data)), CHUNK):
        yield data[start : start + CHUNK], start + CHUNK >= len(data)


def groups(texts: list[bytes]) -> Iterator[tuple[list[int], list[tuple[bytes, bool]], Carry | None, Carry | None]]:
    """Numbers of texts and their pieces that are worked on together, those of like length, with what is carried in and out."""
    numbers, held = [], 0
    for k in sorted(range(len(texts)), key=lambda k: len(texts[k])):
        if len(texts[k]) > CHUNK:
            carry = None
            for piece in pieces_of(texts[k]):
                out = None if piece[1] else carried_on(piece[0], carry)
                yield [k], [piece], carry, out
                carry = out
            continue
        if numbers and held + len(texts[k]) > GROUP:
            yield numbers, [(texts[i], True) for i in numbers], None, None
            numbers, held = [], 0
        numbers.append(k)
        held += len(texts[k]) + MATCH + 1
    if numbers:
        yield numbers, [(texts[i], True) for i in numbers], None, None


def _word_sums(u: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(u) + 1, np.uint32)
    np.cumsum((u * np.uint32(0x6659FD93) ^ np.uint32(0xA5A5A5A5)) * _powers()[0][: len(u)], dtype=np.uint32, out=sums[1:])
    return sums


def word_so_far(laid: Laid) -> np.ndarray:
    """Hash of the bytes since the last gap, before each place."""
    u, n = laid.u, len(laid.u)
    sums = _word_sums(u)
    gap = pick(SPACE, u)
    if laid.carry is not None:
        gap[:MATCH] = True
    start = np.zeros(n, np.int64)
    start[1:] = np.where(gap[:-1], np.arange(1, n), 0)
    np.maximum.accumulate(start, out=start)
    key = (sums[:-1] - pick(sums, start)) * pick(_powers()[1], start)
    if laid.carry is not None:
        going_on = start == MATCH
        key[going_on] = key[going_on] * laid.carry.power + laid.carry.word
    return key


def carried_on(data: bytes, before: Carry | None) -> Carry:
    """What a piece hands on to the next one, but for its runs of bytes."""
    raw = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero(SPACE[1:][raw])
    word = raw[gaps[-1] + 1 :] if len(gaps) else raw
    with np.errstate(over="ignore"):
        key, power = _word_sums(word.astype(np.uint32) + np.uint32(1))[-1], np.uint32(pow(_BASE, len(word), 1 << 32))
        if before is not None and not len(gaps):
            key, power = key * before.power + before.word, power * before.power
    tail = raw if before is None else np.concatenate([before.tail, raw])
    return Carry(tail[-MATCH:], key, power, before.keys if before else np.zeros(0, np.uint64), before.followed if before else np.zeros(0, np.uint32))


def context_sums(laid: Laid) -> list[np.ndarray]:
    """For each of ORDERS a 32-bit hash of the context before each place."""
    u, n = laid.u, len(laid.u)
    out, key = [], np.zeros(n, np.uint32)
    for back in range(1, MATCH + 1):
        key[back:] += u[: n - back] * _M[back - 1]
        if back in ORDERS:
            out.append(key.copy() if back < MATCH else key)
    out.append(word_so_far(laid))
    return out


# The first pass: n-grams and words


def grams(laid: Laid, real: np.ndarray) -> np.ndarray:
    """The n-grams of four places that end in a byte or the end of a text."""
    u = laid.u.astype(np.uint64)
    key = u.copy()
    for back in range(1, 4):
        key[back:] += u[:-back] << np.uint64(GRAM * back)
    return key[real]


# Codes


def huffman(weights: list[float]) -> list[list[int]]:
    """For each symbol its path: node * 2 + bit from the root. Ties go to the earlier symbol."""
    heap = [(w, k) for k, w in enumerate(weights)]
    heapq.heapify(heap)
    n = new = len(weights)
    parent = [0] * (2 * n)
    while len(heap) > 1:
        a = heapq.heappop(heap)
        b = heap[0]
        parent[a[1]], parent[b[1]] = new * 2, new * 2 + 1
        heapq.heapreplace(heap, (a[0] + b[0], new))
        new += 1
    root, paths = new - 1, []
    for k in range(n):
        path = []
        while k != root:
            up = parent[k]
            k = up >> 1
            path.append((root - k) * 2 + (up & 1))  # the root is node 0
        paths.append(path[::-1])
    return paths


@dataclass
class Coding:
    """Symbols are 0 for the end, 1 for the escape and then bytes. A code is tree * n + symbol."""

    symbol: np.ndarray  # number of a byte -> symbol
    n: int
    row: np.ndarray  # the last two symbols -> row of trees
    trees: np.ndarray  # (row, the symbol before them) -> tree
    start: np.ndarray  # code -> place of its path among the entries
    length: np.ndarray  # code -> depth
    entry: np.ndarray  # (tree * n + node) * 32 + place among 16 slots * 2 + bit
    odds: np.ndarray  # tree * n + node -> log odds by the tree's own counts

    def codes(self, laid: Laid) -> tuple[np.ndarray, np.ndarray]:
        """Tree and code at each place."""
        s = pick(self.symbol, laid.u)
        at = np.zeros(len(s), np.int64)
        at[2:] = s[:-2]
        at *= self.n
        at[1:] += s[:-1]
        at = pick(self.row, at)
        at *= self.n
        at[3:] += s[:-3]
        tree = pick(self.trees, at)
        return tree, tree * self.n + s

    def lengths(self, gram: np.ndarray) -> np.ndarray:
        """How many decisions the last place of each of `grams` takes."""
        s = [pick(self.symbol, gram >> GRAM * back & (1 << GRAM) - 1) for back in range(4)]
        tree = pick(self.trees, pick(self.row, s[2] * self.n + s[1]) * self.n + s[3])
        return pick(self.length, tree * self.n + s[0])


def coding_of(last: tuple[np.ndarray, np.ndarray], tables: list[tuple[np.ndarray, np.ndarray]]) -> Coding:
    """From counts of the last places, and of n-grams of three and of four places for the contexts that get trees."""
    used = np.zeros(257, np.int64)
    used[last[0].astype(np.int64)] = last[1]
    kept = np.argsort(-used[1:], kind="stable")[: int((used[1:] > 0).sum())]
    n = len(kept) + 2
    symbol = np.ones(257, np.int64)
    symbol[0] = 0
    symbol[1 + kept] = np.arange(2, n)
    overall = np.zeros(n) + 0.5
    overall[0] += used[0]
    overall[2:] += used[1:][kept]
    trees, of, row, rows = [overall], {}, np.zeros(n * n, np.int64), [np.zeros(n, np.int64)]
    for (size, _, _), (key, number) in zip(TREE_SIZES, tables):
        order = np.argsort(key, kind="stable")
        key, number = key[order].astype(np.int64), number[order]
        context, start = np.unique(key >> GRAM, return_index=True)
        ends = np.append(start[1:], len(key))
        last_place = symbol[key & ((1 << GRAM) - 1)]
        for k, c in enumerate(context.tolist()):
            some = slice(start[k], ends[k])
            pair = c & ((1 << 2 * GRAM) - 1)
            at = int(symbol[pair >> GRAM] * n + symbol[pair & ((1 << GRAM) - 1)])
            below = trees[of.get(pair, 0)] if size == 3 else overall
            own = np.bincount(last_place[some], weights=number[some], minlength=n)
            if not row[at]:
                row[at] = len(rows)
                rows.append(np.zeros(n, np.int64))
            if size == 2:
                of[pair] = len(trees)
                rows[row[at]][:] = len(trees)
            else:
                rows[row[at]][symbol[c >> 2 * GRAM]] = len(trees)
            trees.append(own + below / below.sum())
    length, entry, odds = np.zeros(len(trees) * n, np.int64), [], np.zeros(len(trees) * n, np.float32)
    for t, weights in enumerate(trees):
        paths = huffman(weights.tolist())
        lengths = np.array([len(p) for p in paths])
        length[t * n : (t + 1) * n] = lengths
        steps = np.array([s for p in paths for s in p], np.int64)
        heap = np.array([h for p in paths for h in heap_places(p)], np.int64)
        by = np.bincount(steps, weights=np.repeat(weights, lengths), minlength=2 * n).reshape(n, 2)
        odds[t * n : (t + 1) * n] = np.log((by[:, 1] + 0.02) / (by[:, 0] + 0.02))
        entry.append(((t * n + (steps >> 1)) << 5 | heap << 1 | steps & 1).astype(np.uint32))
    return Coding(symbol, n, row, np.concatenate(rows), np.cumsum(length) - length, length, np.concatenate(entry), odds)


def heap_places(path: list[int]) -> Iterator[int]:
    """For each node of a path its place among 16: the first four levels have one each, deeper nodes share."""
    at = 1
    for depth, step in enumerate(path):
        yield at if depth < 4 else (step >> 1) * 7 & 15
        at = at * 2 + (step & 1)


def make_coding(texts: list[bytes]) -> Coding:
    """From texts at hand."""
    tally = Tally()
    for _, pieces, carry, _ in groups(texts):
        laid = lay_out(pieces, carry)
        tally.add(grams(laid, laid.real()))
    gram, count = tally.take()

    def summed(size: int) -> tuple[np.ndarray, np.ndarray]:
        known, of = np.unique(gram & np.uint64((1 << GRAM * size) - 1), return_inverse=True)
        return known.astype(np.int64), np.bincount(of, weights=count, minlength=len(known)).astype(np.int64)

    tables = []
    for size, least, most in TREE_SIZES:
        key, number = summed(size + 1)
        known, of = np.unique(key >> GRAM, return_inverse=True)
        total = np.bincount(of, weights=number, minlength=len(known))
        best = np.argsort(-total, kind="stable")[:most]
        chosen = np.isin(of, best[total[best] >= least])
        tables.append((key[chosen], number[chosen]))
    return coding_of(summed(1), tables)


def bits_for(most: list[int], decisions_a_byte: float) -> tuple[int, ...]:
    """Table sizes with a slot for every decision of so many contexts with a next byte, up to the bound."""
    return tuple(min(MOST_BITS, max(LEAST_BITS, int(np.ceil(np.log2(max(1.0, n * decisions_a_byte)))))) for n in most)


def lines(laid: Laid, tree: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each order the slot that a context's places are counted from, as an exclusive or."""
    out = []
    for order, key, bits in zip(ORDERS, context_sums(laid), sizes):
        if order == 0:  # a place in the tree means something else in another tree
            key = key * _MIX ^ tree.astype(np.uint32) * np.uint32(0xC2B2AE35)
        key *= _MIX
        key >>= np.uint32(32 - bits)
        out.append(key)
    return out


# The second pass: counts by slot


def squeezed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, most of them small, by byte planes and compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").ravel().view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Counts:
    """Zeros and ones by slot, for one task. CODE bits of a key are its code, the upper ones the line."""

    CODE = np.uint64(24)

    def __init__(self, coding: Coding, sizes: tuple[int, ...], share: int = 1):
        """share: how many of these a task has, which hold KEYS_HELD together."""
        self.coding, self.sizes, self.share = coding, sizes, share
        self.tallies = [Tally() for _ in ORDERS]

    def add(self, texts: list[bytes]) -> None:
        for _, pieces, carry, _ in groups(texts):
            laid = lay_out(pieces, carry)
            tree, code = self.coding.codes(laid)
            real = np.flatnonzero(laid.real())
            code = pick(code, real).astype(np.uint64)
            for tally, line in zip(self.tallies, lines(laid, tree, self.sizes)):
                key = pick(line, real).astype(np.uint64)
                key <<= self.CODE
                key |= code
                tally.add(key)

    def full(self) -> bool:
        """Whether too many different keys are held; those that several runs have are merged first."""
        if self._size() <= KEYS_HELD // self.share:
            return False
        for tally in self.tallies:
            tally.merge()
        return self._size() > KEYS_HELD // self.share * 3 // 4

    def _size(self) -> int:
        return sum(t.size() for t in self.tallies)

    def rows(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(block, number, places as distances, counts), as of `sparse`; they are then forgotten."""
        c, first = self.coding, 0
        for tally, bits in zip(self.tallies, self.sizes):
            keys, n = tally.take()
            block = min(BLOCK, 1 << bits)
            edges = np.searchsorted(keys, np.arange(0, (1 << bits) + block, block, dtype=np.uint64) << self.CODE)
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    line = (keys[a:b] >> self.CODE).astype(np.int64) - k * block
                    code = (keys[a:b] & np.uint64((1 << 24) - 1)).astype(np.int64)
                    lengths = pick(c.length, code)
                    owner, at = spread(lengths, pick(c.start, code))
                    entry = pick(c.entry, at)
                    slot = pick(line, owner) ^ (entry >> np.uint32(1) & np.uint32(15)).astype(np.int64)
                    slot *= 2
                    slot += entry & np.uint32(1)
                    yield first + k, *sparse(np.bincount(slot, weights=pick(n[a:b], owner)))
            first += (1 << bits) // block


def sparse(flat: np.ndarray) -> tuple[int, bytes, bytes]:
    """How many of a block's counts are not zero, their places as distances, and they."""
    used = np.flatnonzero(flat != 0)
    return len(used), squeezed(np.diff(used, prepend=0)), squeezed(np.minimum(flat[used], 0xFFFFFFFF))


def spread(lengths: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner of every one of sum(lengths) decisions, and its place, counted on from its owner's start. Every owner has one at least."""
    end = np.cumsum(lengths)
    owner = np.zeros(end[-1] if len(end) else 0, np.int64)
    owner[end[:-1]] = 1
    np.cumsum(owner, out=owner)
    at = pick(start - end + lengths, owner)
    at += np.arange(len(owner))
    return owner, at


def ranges(lengths: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The places of `spread` alone, for long stretches."""
    out = np.ones(int(lengths.sum()), np.int64)
    out[0] = start[0]
    out[np.cumsum(lengths[:-1])] = start[1:] - start[:-1] - lengths[:-1] + 1
    return np.cumsum(out, out=out)


def added(rows: list[tuple[int, bytes, bytes]], total: np.ndarray | None = None) -> np.ndarray:
    """rows as of `sparse`, added up: counts of zeros and ones by slot of a block, flat."""
    total = np.zeros(2 * BLOCK, np.int64) if total is None else total
    for n, at, counts in rows:
        total[np.cumsum(unsqueezed(at, n), dtype=np.int64)] += unsqueezed(counts, n)
    return total


def odds_of(total: np.ndarray) -> np.ndarray:
    """Log odds in tenths, 0 where nothing was seen."""
    zeros, ones = total[::2], total[1::2]
    odds = np.clip(np.rint(SCALE * np.log((ones + 0.4) / (zeros + 0.4))), -127, 127).astype(np.int8)
    odds[odds == 0] = 1
    return np.where(zeros + ones > 0, odds, 0).astype(np.int8)


class Packed:
    """An object whose arrays are compressed for a broadcast; a worker opens it once."""

    _open: dict[str, object] = {}

    def __init__(self, value: object):
        buffers: list[pickle.PickleBuffer] = []
        self.key, self.head = uuid.uuid4().hex, pickle.dumps(value, 5, buffer_callback=buffers.append)
        self.parts = [(raw.nbytes, pa.compress(pa.py_buffer(raw), codec="zstd", asbytes=True)) for raw in (b.raw() for b in buffers)]

    def get(self):
        if self.key not in self._open:
            self._open.clear()
            self._open[self.key] = pickle.loads(self.head, buffers=[pa.decompress(data, decompressed_size=n, codec="zstd", asbytes=True) if n else b"" for n, data in self.parts])
        return self._open[self.key]


BLOCK_ROW = "half int, block int, lane long, number int, slots binary, counts binary"
ODDS = ("odds", "odds_0", "odds_1")


def add_up(rows: DataFrame, n: int) -> DataFrame:
    """rows of `n` tasks -> (block, odds, odds_0, odds_1): each block's log odds, by all counts and by those of each half."""

    def total_of(table: pa.Table) -> np.ndarray:
        return added(list(zip(*(table.column(c).to_pylist() for c in ("number", "slots", "counts")))))

    def add(table: pa.Table) -> pa.Table:
        row = (*(table.column(c)[0].as_py() for c in ("half", "block", "lane")), *sparse(total_of(table)))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array([c], k) for c, k in zip(row, kinds)], names=["half", "block", "lane", "number", "slots", "counts"])

    def finish(table: pa.Table) -> pa.Table:
        half = table.column("half").to_numpy()
        halves = [total_of(table.filter(pa.array(half == h))) for h in (0, 1)]
        odds = [pa.compress(odds_of(total).tobytes(), codec="zstd", asbytes=True) for total in (halves[0] + halves[1], *halves)]
        return pa.table([pa.array([table.column("block")[0].as_py()], pa.int32()), *[pa.array([x], pa.binary()) for x in odds]], names=["block", *ODDS])

    while n > FAN_IN:
        rows = rows.withColumn("lane", F.floor(F.col("lane") / FAN_IN)).groupBy("half", "block", "lane").applyInArrow(add, BLOCK_ROW)
        n = -(-n // FAN_IN)
    return rows.groupBy("block").applyInArrow(finish, "block int, " + ", ".join(f"{c} binary" for c in ODDS))


def tables_of(sizes: tuple[int, ...]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Empty tables, and their blocks as views of them."""
    tables = [np.zeros(1 << bits, np.int8) for bits in sizes]
    return tables, [t[k : k + BLOCK] for t in tables for k in range(0, len(t), BLOCK)]


def filled(blocks: dict[int, np.ndarray], sizes: tuple[int, ...]) -> list[np.ndarray]:
    tables, views = tables_of(sizes)
    for k, odds in blocks.items():
        views[k][:] = odds[: len(views[k])]
    return tables


# Mixing


INPUTS, GATES = len(ORDERS) + 3, 12
LEARNING, RATE, STEADY = 0.2, 0.8, 30.0
#: What learning starts from: what a tree's counts, a hashed context and an expected bit weigh, and mean squares of log odds, expected bits and the constant input. All count as STEADY decisions.
FIRST_WEIGHTS, SQUARES = (0.3, 0.2, 2.0), (2.0, 1 / 16, 1 / 16)


#: Decisions after which a task's weights have settled, and how often the forms of those before are worked out.
SETTLED, ROUNDS = 2_000_000, 4

#: Hashed contexts' log odds are taken as they are stored.
UNITS = np.array([1.0] + [1 / SCALE] * len(ORDERS) + [1.0, 1.0])


@dataclass
class Model:
    coding: Coding
    odds: list[np.ndarray]  # for each order: slot -> log odds in tenths, 0 if unseen
    weights: np.ndarray  # (input, gate)
    power: np.ndarray  # mean square of each input
    gain: dict[bytes, float] | None = None  # what a common word adds to the base score

    def one_set(self) -> np.ndarray | None:
        """The weights, if all sets have the same."""
        return self.weights[:, 0] if self.weights is not None and (self.weights == self.weights[:, :1]).all() else None


@dataclass
class Inputs:
    raw: np.ndarray  # (input, decision): log odds of a one, in UNITS
    sign: np.ndarray  # 1 for a one, -1 for a zero
    gate: np.ndarray | None  # the set of weights of every decision, where sets differ
    first: np.ndarray  # each byte's first decision, and their number
    escapes: np.ndarray  # whether each byte is one that was never learned

    @property
    def x(self) -> np.ndarray:
        """(input, decision): log odds of what came."""
        return self.raw * self.sign * UNITS[:, None].astype(np.float32)


def _earlier(key: np.ndarray) -> np.ndarray:
    """For each place the last earlier one with the same key, or -1."""
    mixed = (key * _MIX64 >> np.uint64(20)) << np.uint64(20) | np.arange(len(key), dtype=np.uint64)
    mixed.sort()
    at = (mixed & np.uint64((1 << 20) - 1)).astype(np.int64)
    mixed >>= np.uint64(20)
    same = np.flatnonzero(mixed[1:] == mixed[:-1])
    out = np.full(len(key), -1, np.int64)
    out[at[same + 1]] = at[same]
    return out


def matches(laid: Laid, real: np.ndarray, out: Carry | None) -> tuple[np.ndarray, np.ndarray]:
    """At each real place what the match model expects, as a byte's number or -1, and whether it was right one place before.

    The runs of bytes that a text has had are taken from laid.carry and put into out, if it goes on.
    """
    u, n = laid.u, len(laid.u)
    key = np.zeros(n, np.uint64)
    for back in range(1, MATCH + 1):
        key[back:] += u[: n - back] * _M64[back - 1]
    sizes = laid.size
    key = pick(key, real)
    own = key + np.repeat(np.arange(len(sizes), dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), sizes)
    before = _earlier(own)
    here = pick(u, real).astype(np.int64)
    expected = np.where(before >= 0, pick(here, before), -1)
    carry = laid.carry
    if carry is not None and len(carry.keys):
        new = np.flatnonzero(before < 0)
        place = np.minimum(np.searchsorted(carry.keys, key[new]), len(carry.keys) - 1)
        known = carry.keys[place] == key[new]
        expected[new[known]] = carry.followed[place[known]]
    right = np.zeros(len(key) + 1, bool)
    right[0] = carry is not None and carry.right
    np.equal(expected, here, out=right[1:])
    if out is not None:
        # Of equal keys the last counts; np.unique gives the first, so they are turned round.
        out.keys, at = np.unique(np.concatenate([key[::-1], out.keys]), return_index=True)
        out.followed = np.concatenate([here[::-1].astype(np.uint32), out.followed])[at]
        out.right = bool(right[-1])
    right = right[:-1]
    right[np.cumsum(sizes)[:-1]] = False  # a text's first byte has none before it
    return expected, right


def inputs(laid: Laid, model: Model, out: Carry | None = None, order: np.ndarray | None = None) -> Inputs:
    """order: an order of the real places to go through them in, else as they are."""
    c = model.coding
    tree, code = c.codes(laid)
    real = np.flatnonzero(laid.real())
    expected, right = matches(laid, real, out)
    if order is not None:
        real, expected, right = pick(real, order), pick(expected, order), pick(right, order)
    code = pick(code, real)
    lengths = pick(c.length, code)
    first = np.zeros(len(code) + 1, np.int64)
    np.cumsum(lengths, out=first[1:])
    owner, at = spread(lengths, pick(c.start, code))
    entry = pick(c.entry, at)
    sign = (entry & np.uint32(1)).astype(np.float32)
    sign *= 2
    sign -= 1
    place = (entry >> np.uint32(1) & np.uint32(15)).astype(np.int64)
    node = (entry >> np.uint32(5)).astype(np.int64)
    x = np.empty((INPUTS, len(sign)), np.float32)
    x[0] = pick(c.odds, node)
    gate = None if model.one_set() is not None else np.zeros(len(sign), np.int64)
    for k, line in enumerate(lines(laid, tree, tuple(len(t).bit_length() - 1 for t in model.odds))):
        slot = pick(pick(line, real).astype(np.int64), owner)
        slot ^= place
        odds = pick(model.odds[k], slot)
        x[1 + k] = odds
        if gate is not None and k == len(ORDERS) - 1:
            gate[odds != 0] = 2  # the word so far is known
    if gate is not None:
        gate[first[:-1]] += 1
    x[-1], x[-2] = 0.25, 0
    # The decisions of matched bytes, and where the expected byte's path is at the same depth.
    matched = np.flatnonzero(expected >= 0)
    tree = tree.take(pick(real, matched))
    other = tree * c.n + c.symbol.take(pick(expected, matched))
    both = np.minimum(pick(lengths, matched), pick(c.length, other))
    of, theirs = spread(both, pick(c.start, other))
    mine = theirs + (pick(first, matched) - pick(c.start, other)).take(of)
    theirs = pick(c.entry, theirs)
    hit = np.flatnonzero(theirs >> np.uint32(5) == pick(node, mine))
    mine, theirs = mine[hit], theirs[hit]
    x[-2, mine] = (theirs & np.uint32(1)).astype(np.float32) * 2 - 1
    if gate is not None:
        gate[mine] += 4 + 4 * pick(right, matched).take(of[hit])
    return Inputs(x, sign, gate, first, c.symbol.take(pick(laid.u, real)) == 1)


def stretches(n: int) -> list[int]:
    """Bytes after which the weights are refined, from 0 to n."""
    out, size = [0], FIRST_STRETCH
    while out[-1] < n:
        out.append(min(n, out[-1] + size))
        size = min(2 * size, STRETCH)
    return out


def _in_rounds(sizes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """An order of the bytes of several texts by stretches, and for each stretch the texts that have it and where each begins in the order."""
    edges, starts = stretches(int(sizes.max(initial=0))), np.cumsum(sizes) - sizes
    order, rounds, at = [], [], 0
    for a, b in zip(edges[:-1], edges[1:]):
        lanes = np.flatnonzero(sizes > a)
        length = np.minimum(sizes[lanes], b) - a
        order.append(ranges(length, starts[lanes] + a))
        rounds.append((lanes, at + np.cumsum(length) - length))
        at += len(order[-1])
    return np.concatenate(order) if order else np.zeros(0, np.int64), rounds


def code_lengths(pieces: list[tuple[bytes, bool]], model: Model, carry: Carry | None, out: Carry | None, change: np.ndarray) -> np.ndarray:
    """Bits of each piece. change (input, piece): what a text's weights differ by; it is refined."""
    laid = lay_out(pieces, carry)
    order, rounds = _in_rounds(laid.size)
    i = inputs(laid, model, out, order)
    likely, power, units, one, fixed = np.empty(i.raw.shape[1], np.float32), model.power[:, None], UNITS[:, None], model.one_set(), None
    if one is None:
        fixed = sum(pick(w, i.gate) * x for w, x in zip((model.weights * UNITS[:, None]).astype(np.float32), i.raw))
    lane_of, starts = [], []
    for k, (lanes, byte_starts) in enumerate(rounds):
        begins = i.first[byte_starts]
        lane_of.append(lanes), starts.append(begins)
        end = int(i.first[rounds[k + 1][1][0]]) if k + 1 < len(rounds) else len(likely)
        d = slice(int(begins[0]), end)
        weights = np.ascontiguousarray(((change[:, lanes] + (0 if one is None else one[:, None])) * units).T, np.float32)
        spans = [(slice(a, b), i.raw[:, a:b]) for a, b in pairwise([*begins.tolist(), end])]
        for w, (span, x) in zip(weights, spans):
            np.dot(w, x, out=likely[span])
        p = likely[d]
        if fixed is not None:
            p += fixed[d]
        p *= i.sign[d]
        np.minimum(p, 16, out=p)
        np.maximum(p, -16, out=p)
        np.exp(p, out=p)
        miss = p + 1
        np.divide(1, miss, out=miss)
        p *= miss
        wrong, gain = miss * i.sign[d], np.empty((len(lanes), INPUTS), np.float32)
        for g, (span, x) in zip(gain, spans):
            np.dot(x, wrong[span.start - d.start : span.stop - d.start], out=g)
        miss *= p
        change[:, lanes] += RATE * (gain.T * units) / (np.add.reduceat(miss, begins - d.start) * power + STEADY)
    nats = np.log(likely, out=likely)
    total = np.zeros(len(pieces))
    if rounds:
        np.subtract.at(total, np.concatenate(lane_of), np.add.reduceat(nats, np.concatenate(starts), dtype=np.float64) / np.log(2))
    if i.escapes.any():
        of = np.repeat(np.arange(len(pieces)), laid.size).take(order)
        total += 8.0 * np.bincount(of[i.escapes], minlength=len(pieces))
    return total


def all_bits(texts: list[bytes], model: Model) -> np.ndarray:
    """The code length of each text in bits."""
    total, change = np.zeros(len(texts)), np.zeros((INPUTS, 0))
    for numbers, pieces, carry, out in groups(texts):
        if carry is None:
            change = np.zeros((INPUTS, len(pieces)))
        total[numbers] += code_lengths(pieces, model, carry, out, change)
    return total


def first_weights() -> np.ndarray:
    """The weights (gate, input) that every text starts with."""
    w = np.zeros((GATES, INPUTS), np.float32)
    w[:, 0], w[:, 1 : 1 + len(ORDERS)], w[:, -2] = FIRST_WEIGHTS
    return w


def learn_weights(model: Model, texts: list[bytes], rounds: int = 3, step: int = 4096) -> None:
    """Sets the model's weights by online learning over texts at hand; the more a set of weights is used, the nearer to a Newton step.

    Texts are mixed, and the weights averaged over the last round, so that none weighs more for coming last.
    The jobs below learn them by `WeightSums`, of all documents.
    """
    w = first_weights()
    squares, seen, averaged, steps = np.zeros(INPUTS), 0, np.zeros_like(w, np.float64), 0
    texts = sorted(texts, key=lambda t: (zlib.crc32(t), t))
    for number in range(rounds):
        for first in range(0, len(texts), 32):
            for _, pieces, carry, out in groups(texts[first : first + 32]):
                laid = lay_out(pieces, carry)
                i = inputs(laid, model, out, _in_rounds(laid.size)[0])
                signed = i.x
                if not number:
                    squares += (signed.astype(float) ** 2).sum(axis=1)
                    seen += signed.shape[1]
                for start in range(0, signed.shape[1], step):
                    x, gate = signed[:, start : start + step], i.gate[start : start + step]
                    dots = (w.take(gate, axis=0) * x.T).sum(axis=1)
                    miss = 1 / (1 + np.exp(np.clip(dots, -16, 16)))
                    used = np.zeros((GATES, len(gate)), np.float32)
                    used[gate, np.arange(len(gate))] = miss
                    up = used @ x.T
                    used *= 1 - miss
                    w += LEARNING * up / (used @ (x * x).T + STEADY)
                    if number == rounds - 1:
                        averaged += w
                        steps += 1
    model.weights, model.power = np.ascontiguousarray((averaged / steps if steps else w).T, np.float32), squares / max(1, seen)


class WeightSums:
    """What a task learns of the weights: for every set the sum of the second-order forms of its decisions' code lengths, each taken
    at the weights that the sums so far give, and of their slopes. Sums of several tasks are added, and then solved once. So
    weights depend a little on which documents a task has, but every decision counts once."""

    def __init__(self):
        self.curve, self.pull = np.zeros((GATES, INPUTS, INPUTS)), np.zeros((GATES, INPUTS))
        self.squares, self.seen = np.zeros(INPUTS), 0.0

    def weights(self) -> np.ndarray:
        """The weights (gate, input) that are best by the sums, and the first ones, which count as STEADY decisions."""
        return np.linalg.solve(self.curve + STEADY * np.eye(INPUTS), (self.pull + STEADY * first_weights())[:, :, None])[:, :, 0]

    def power(self) -> np.ndarray:
        """The mean square of each input."""
        first = np.array([SQUARES[0]] * (1 + len(ORDERS)) + list(SQUARES[1:]))
        return (self.squares + STEADY * first) / (self.seen + STEADY)

    def add(self, texts: list[bytes], model: Model) -> None:
        """model: with no weights, and with counts that do not hold these texts."""
        for _, pieces, carry, out in groups(texts):
            i = inputs(lay_out(pieces, carry), model, out)
            self.squares += np.array([np.dot(x, x) for x in i.raw]) * UNITS**2
            self.seen += i.raw.shape[1]
            order = np.argsort(i.gate.astype(np.uint8), kind="stable")
            raw, sign = i.raw.take(order, axis=1, mode="clip"), pick(i.sign, order)
            edges = np.append(0, np.cumsum(np.bincount(i.gate, minlength=GATES))).tolist()
            before = self.curve.copy(), self.pull.copy()
            for _ in range(ROUNDS if self.seen < SETTLED else 1):  # the first ones are taken once more where they themselves lead
                now = self.weights()
                self.curve, self.pull = before[0].copy(), before[1].copy()
                for g, (a, b) in enumerate(pairwise(edges)):
                    if a < b:
                        curve, slope = self._form(raw[:, a:b], sign[a:b], now[g])
                        self.curve[g] += curve
                        self.pull[g] += curve @ now[g] + slope

    def _form(self, x: np.ndarray, sign: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Second and first derivatives (the latter with its sign turned) of the code length, in nats, of decisions."""
        miss = np.dot((w * UNITS).astype(np.float32), x)
        miss *= sign
        np.clip(miss, -16, 16, out=miss)
        np.exp(miss, out=miss)
        miss += 1
        np.divide(1, miss, out=miss)
        slope = (x @ (miss * sign)) * UNITS
        miss *= 1 - miss
        steep = x * miss
        return np.array([steep @ row for row in x]) * UNITS[:, None] * UNITS, slope  # faster than as one product, which has few rows

    def packed(self) -> bytes:
        return np.concatenate([self.curve.ravel(), self.pull.ravel(), self.squares, [self.seen]]).tobytes()

    def unpack(self, data: bytes) -> WeightSums:
        """Adds what another one has packed."""
        values = np.frombuffer(data)
        curve, pull, squares, seen = np.split(values, np.cumsum([self.curve.size, self.pull.size, INPUTS]))
        self.curve += curve.reshape(self.curve.shape)
        self.pull += pull.reshape(self.pull.shape)
        self.squares += squares
        self.seen += seen[0]
        return self


# The jobs


def first_pass(rows: DataFrame) -> DataFrame:
    """(key, word, n) over rows (text, ...): counts of n-grams by key, and of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grams_out() -> Iterator[pa.RecordBatch]:
            keys, n = tally.take()
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.nulls(len(keys), pa.binary()), pa.array(n.astype(np.int64))], ["key", "word", "n"])

        def words_out() -> pa.RecordBatch:
            m = len(words)
            batch = pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())], ["key", "word", "n"])
            words.clear()
            return batch

        tally, words = Tally(), Counter()
        for batch in batches:
            texts = [lowered(value.as_py()) for value in batch.column(0)]
            for data in texts:
                words.update(data.split())
                if len(words) > WORDS_HELD:
                    yield words_out()
            for _, pieces, carry, _ in groups(texts):
                laid = lay_out(pieces, carry)
                tally.add(grams(laid, laid.real()))
            if tally.size() > GRAMS_HELD:
                yield from grams_out()
        yield from grams_out()
        if words:
            yield words_out()

    return map_arrow(rows, count, "key long, word binary, n long").groupBy("key", "word").agg(F.sum("n").alias("n"))


def learn_coding(statistics: DataFrame) -> tuple[Coding, tuple[int, ...]]:
    """The coding, and the sizes of the tables of contexts."""
    found = statistics.where("key IS NOT NULL").select("key", "n")
    different, bytes_learned = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def numbers(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        t = df.toArrow()
        return t.column("key").to_numpy(), t.column("n").to_numpy()

    def by_last(size: int) -> DataFrame:
        return found.groupBy(F.col("key").bitwiseAND((1 << GRAM * size) - 1).alias("key")).agg(F.sum("n").alias("n"))

    tables = []
    for size, least, most in TREE_SIZES:
        each = by_last(size + 1).withColumn("context", F.shiftright("key", GRAM))
        best = each.groupBy("context").agg(F.sum("n").alias("total")).where(F.col("total") >= least).orderBy(F.desc("total"), "context").limit(most)
        tables.append(numbers(each.join(F.broadcast(best.select("context")), "context").select("key", "n")))
    coding = coding_of(numbers(by_last(1)), tables)
    shared = statistics.sparkSession.sparkContext.broadcast(Packed(coding))

    def decisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            made += int(shared.value.get().lengths(batch.column(0).to_numpy()) @ batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], ["made"])

    made = map_arrow(found, decisions, "made long").agg(F.coalesce(F.sum("made"), F.lit(0))).first()[0]
    shared.unpersist()
    return coding, bits_for([16 * different] + [bytes_learned] * (len(ORDERS) - 1), made / bytes_learned if bytes_learned else 1.0)


def table_counts(rows: DataFrame, coding: Coding, sizes: tuple[int, ...]) -> DataFrame:
    """rows (text, half) -> (block, odds, odds_0, odds_1), stored."""
    shared = rows.sparkSession.sparkContext.broadcast(Packed((coding, sizes)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lane, halves = TaskContext.get().partitionId(), [Counts(*shared.value.get(), share=2) for _ in range(2)]

        def counts_out(half: int) -> Iterator[pa.RecordBatch]:
            for block, number, at, counts in halves[half].rows():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([half], pa.int32()), pa.array([block], pa.int32()), pa.array([lane], pa.int64()), pa.array([number], pa.int32()), pa.array([at], pa.binary()), pa.array([counts], pa.binary())],
                    ["half", "block", "lane", "number", "slots", "counts"],
                )

        for batch in batches:
            of = batch.column(1).to_numpy()
            for half, held in enumerate(halves):
                held.add([lowered(value.as_py()) for value in batch.column(0).filter(pa.array(of == half))])
                if held.full():
                    yield from counts_out(half)
        for half in range(2):
            yield from counts_out(half)

    stored = staged(add_up(map_arrow(rows, count, BLOCK_ROW), rows.rdd.getNumPartitions()), "tables")
    shared.unpersist()
    return stored


def read_tables(blocks: DataFrame, column: str, sizes: tuple[int, ...]) -> list[np.ndarray]:
    found = blocks.select("block", column).toArrow()
    tables, views = tables_of(sizes)
    for block, data in zip(found.column("block").to_pylist(), found.column(column)):
        views[block][:] = np.frombuffer(pa.decompress(data.as_buffer(), decompressed_size=BLOCK, codec="zstd"), np.int8)[: len(views[block])]
    return tables


def weight_sums(rows: DataFrame, blocks: DataFrame, coding: Coding, sizes: tuple[int, ...]) -> WeightSums:
    """From every row (text, half), judged by the counts of the half that it is not in."""
    total = WeightSums()
    for half in (0, 1):
        shared = rows.sparkSession.sparkContext.broadcast(Packed(Model(coding, read_tables(blocks, ODDS[2 - half], sizes), None, None)))

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            quiet_threads()
            held = WeightSums()
            for batch in batches:
                held.add([lowered(value.as_py()) for value in batch.column(0)], shared.value.get())
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([held.packed()], pa.binary())], ["lane", "sums"])

        found = map_arrow(rows.where(F.col("half") == half).select("text"), sums, "lane long, sums binary").collect()
        for r in sorted(found, key=lambda r: r.lane):
            total.unpack(r.sums)
        shared.unpersist()
    return total


def learn(docs: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame, int, int]:
    """docs to learn from -> the model, word counts (word, c), N and V."""
    n = docs.count()
    text = F.col(text_col).cast("string")
    # Copies of a text are in one half, so that none is judged by another's counts.
    rows = docs.select(text.alias("text"), (F.crc32(F.coalesce(text, F.lit(""))) % 2).cast("int").alias("half"))
    statistics = staged(first_pass(rows.select("text")), "statistics")
    words = statistics.where("word IS NOT NULL").select("word", F.col("n").alias("c"))
    coding, sizes = learn_coding(statistics)
    blocks = table_counts(rows, coding, sizes)
    sums = weight_sums(rows, blocks, coding, sizes)
    # To four places, as the last digits of sums are left to chance.
    weights = np.ascontiguousarray(np.round(sums.weights(), 4).T, np.float32)
    model = Model(coding, read_tables(blocks, "odds", sizes), weights, np.round(sums.power(), 4))
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    return model, words, total[0] + n, total[1] + (n > 0)


def common_words(words: DataFrame) -> dict[bytes, int]:
    """The most frequent words, at most COMMON_WORDS: all above a count that a histogram of counts gives."""
    level = F.floor(F.log2("c") * 16).cast("int")
    least, held = None, 0
    for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("k"), F.min("c").alias("c")).orderBy(F.desc("level")).collect():
        held += r["k"]
        if held > COMMON_WORDS:
            break
        least = r["c"]
    if least is None:
        return {}
    found = words.where(F.col("c") >= least).toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("c").to_pylist()))


def scored(batch: pa.RecordBatch, m: Model) -> pa.RecordBatch:
    """Scores of (id, text, row); words that are not in m.gain are handed on with their counts."""
    gain = m.gain
    texts = [lowered(x.as_py()) for x in batch.column(1)]
    tokens, known, base, rare, tf, ends = [], [], [], [], [], [0]
    for data in texts:
        words = data.split()
        found = list(map(gain.get, words))
        missing = found.count(None)
        if missing:
            counts = Counter(w for w, g in zip(words, found) if g is None)
            rare += counts.keys()
            tf += counts.values()
            found = [g for g in found if g is not None]
        ends.append(len(rare))
        tokens.append(len(words) + 1)
        known.append(len(found))
        base.append(sum(found))
    pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(tf, pa.int32())], ["word", "tf"])
    columns = [batch.column(0), batch.column(2), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(-LOG10_2 * all_bits(texts, m)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)]
    return pa.RecordBatch.from_arrays(columns, ["id", "row", "n_bytes", "n_tokens", "known", "base", "score", "rare"])


def score(docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of docs."""
    spark = docs.sparkSession
    ends = learned.count()
    model, words, total, distinct = learn(learned, text_col)
    model.gain = {w: float(np.log10(c + 0.5)) for w, c in common_words(words).items()}
    shared = spark.sparkContext.broadcast(Packed(model))
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    end_part = float(np.log10(ends + 0.5))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quiet_threads()
        m = shared.value.get()
        for batch in batches:
            if batch.num_rows:
                yield scored(batch, m)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    read = staged(map_arrow(rows, make, "id long, row long, n_bytes long, n_tokens long, known long, base double, score double, rare array<struct<word:binary,tf:int>>"), "scored")
    # None of these words has more than a part in COMMON_WORDS of the corpus, so none is a hot key.
    rare = read.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
    rest = rare.join(words, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("more_known"), F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("more_base"))
    out = read.drop("rare").join(rest, "row", "left")
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) + F.lit(end_part) - F.col("n_tokens") * F.lit(norm)
    known_tokens = F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(ends > 0))
    rate = -F.col("score") / F.lit(LOG10_2) / F.greatest("n_bytes", F.lit(1))
    return out.select(F.col("id").alias(id_col), "n_tokens", known_tokens.alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score", rate.alias("bits_per_byte"))


def assess(docs: DataFrame, modulus: int = 5, held_out: int = 1) -> DataFrame:
    """Scores of all rows, learned from the folds that are not held out."""
    fold = id_remainder(F.col("doc_id"), modulus)
    scored_rows = score(docs, docs.where(fold != held_out))
    return scored_rows.select("doc_id", (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
