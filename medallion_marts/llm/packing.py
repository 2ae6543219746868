"""Packing tokenised documents into windows by the sum-of-squares rule.

A document's full windows stand alone; its rest is placed, as it arrives, at the fill level
(of an open window in which it fits, or of a new one) for which the sum over fill levels of
the squared number of open windows becomes least. The numbers are kept in an array by level.
A window is done when a rest fills it exactly.

Each task packs the documents of its partition. The pieces in windows still open at its end go
to a second step, where one task packs those of `TASKS_TOGETHER` tasks by the same rule, the longest
first, and what stays open once more. Then the emptiest window is dissolved, again and again, and its
pieces are placed by the rule without new windows; a piece that fits none is cut and fills the level
(or the two levels exactly) whose loss lowers the sum most. One window is left; it is cut into lengths
that are powers of two, which need no padding.

About a thousand windows stay open, whatever the number of documents: the rule keeps levels even.
`MAX_OPEN` bounds a task's memory for lengths on which it does not; beyond it rests are cut as well.

Ids are those of the `tokenizers` library. Where its file is a byte-level BPE with merges in
order of ids, as the given one, the same ranks are merged by `tiktoken`, which is faster;
other files, texts with special strings and letters beyond U+024F (whose classes depend on a
library's Unicode version) go through `tokenizers` itself.

Defined results: a null or empty text is the end id alone; ties go to the fullest level;
repeated rows are packed like any others; an empty table gives an empty result; other
columns are not looked at. The sequence id holds the step and the partition's number in its upper bits.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, quiet_threads, staged

WINDOW = 1024
END_ID = 0
#: Windows that a task holds open at most (32 MB of ids); beyond that documents are cut, so nothing is dropped.
MAX_OPEN = 8192
#: Tasks whose open windows are packed together in the second step.
TASKS_TOGETHER = 32
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window)]
        self.n_open = 0

    def choose(self, size: int, may_open: bool = True) -> int | None:
        """The level, 0 for a new window, whose use makes the sum of squared counts least; None if it fits nowhere."""
        last = self.window - size
        gain = 1 - 2 * self.count[: last + 1]  # one window leaves this level
        gain[self.count[: last + 1] == 0] = 1 << 40
        gain[0] = 0 if may_open else 1 << 40
        after = 2 * self.count[size:] + 1  # and one comes to that
        after[last] = 0  # a full window counts no more
        gain += after
        best = last - int(np.argmin(gain[::-1]))
        return best if gain[best] < 1 << 39 else None

    def to_fill(self, size: int) -> int:
        """The level to fill with the beginning of a piece that fits nowhere whole.

        What is left of the piece then fills another level exactly, if there is such a pair: the one whose
        loss lowers the sum most; ties to the fullest.
        """
        levels = np.flatnonzero(self.count[1 : self.window]) + 1
        other = 2 * self.window - size - levels
        gain = 2 * self.count[levels] - 1
        there = self.count[np.clip(other, 1, self.window - 1)] - (other == levels)
        gain += np.where((other < self.window) & (there > 0), 2 * there - 1, 0)
        return int(levels[len(levels) - 1 - np.argmax(gain[::-1])])

    def take(self, level: int) -> list:
        self.count[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def put(self, level: int, pieces: list) -> None:
        self.open[level].append(pieces)
        self.count[level] += 1
        self.n_open += 1


class Packer:
    """Packs (doc_id, packed ids) of one task. Pieces are (doc_id, start, length, bytes, doc_tokens)."""

    def __init__(self, first_sequence: int, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.levels = Levels(window)
        self.window, self.max_open, self.sequence = window, max_open, first_sequence
        self.rows: list[tuple] = []
        #: Windows of rests that were filled by the rule and by a cut, cuts in all, and tokens of the last window.
        self.by_rule = self.by_cut = self.cuts = self.last = 0

    def add(self, doc_id, ids: bytes) -> None:
        total = len(ids) // 4
        for start in range(0, total - self.window + 1, self.window):
            self._close([(doc_id, start, self.window, ids[4 * start : 4 * (start + self.window)], total)])
        if rest := total % self.window:
            self.place((doc_id, total - rest, rest, ids[4 * (total - rest) :], total), self.max_open)

    def place(self, piece: tuple, max_open: int) -> None:
        """Puts a piece into windows by the rule."""
        levels = self.levels
        while True:
            size = piece[2]
            level = levels.choose(size, levels.n_open < max_open)
            whole = level is not None
            if not whole:
                level = levels.to_fill(size)
                self.cuts += 1
            pieces = levels.take(level) if level else []
            doc_id, start, _, ids, total = piece
            n = size if whole else self.window - level
            pieces.append((doc_id, start, n, ids[: 4 * n], total))
            if level + n == self.window:
                self._close(pieces)
                self.by_rule += whole
                self.by_cut += not whole
            else:
                levels.put(level + n, pieces)
            if whole:
                return
            piece = (doc_id, start + n, size - n, ids[4 * n :], total)

    def again(self) -> None:
        """Packs what is in open windows once more, the longest pieces first."""
        pieces = sorted((x[:5] for x in self.leave()), key=lambda x: -x[2])
        self.levels = Levels(self.window)
        for piece in pieces:
            self.place(piece, self.max_open)

    def finish(self) -> None:
        """Dissolves the emptiest windows until one is left, and cuts that one into powers of two."""
        levels = self.levels
        while levels.n_open > 1:
            for piece in levels.take(int(np.flatnonzero(levels.count)[0])):
                self.place(piece, max(1, levels.n_open))
        if levels.n_open:
            level = int(np.flatnonzero(levels.count)[0])
            self.last = level
            pieces = levels.take(level)
            while level:
                room = 1 << (level.bit_length() - 1)
                level -= room
                current = []
                while room:
                    doc_id, start, length, ids, total = pieces[0]
                    n = min(room, length)
                    current.append((doc_id, start, n, ids[: 4 * n], total))
                    room -= n
                    pieces[:1] = [(doc_id, start + n, length - n, ids[4 * n :], total)] if n < length else []
                self._close(current)

    def leave(self) -> list[tuple]:
        """The pieces in windows still open, with a number for the window and their place in it."""
        out = []
        for windows in self.levels.open:
            for pieces in windows:
                at = 0
                for piece in pieces:
                    out.append((*piece, self.sequence, at))
                    at += piece[2]
                self.sequence += 1
        return out

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, length, ids, total in pieces:
            self.rows.append((doc_id, start, length, zlib.crc32(ids), total, self.sequence, at))
            at += length
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        self.rows = []
        return out


#: Letters whose classes are the same in every Unicode version.
_PLAIN = "[^\\x00-\\u024f]"


def byte_ranks(file: dict) -> dict[bytes, int] | None:
    """Token bytes to ids of a tokenizer file, if it is a plain byte-level BPE whose merges are in order of their ids."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or file.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
        return None
    # The printable bytes stand for themselves, the others for the characters from 256 on.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    special = {x["content"] for x in file.get("added_tokens", [])}
    vocabulary = model["vocab"]
    made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in made or made != sorted(made) or any(not set(t) <= byte_of.keys() for t in vocabulary if t not in special):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}


class Ids:
    """Packed ids of texts."""

    def __init__(self, path: str):
        quiet_threads()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.special = [x["content"] for x in file.get("added_tokens", [])]
        self.odd = regex.compile(_PLAIN).search
        self.merge = None
        if ranks := byte_ranks(file):
            import public_tokenizers
            import tiktoken

            self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def of(self, text: str) -> bytes:
        if self.merge and (text.isascii() or not self.odd(text)) and not any(s in text for s in self.special):
            try:
                return self.merge(text, disallowed_special=()).tobytes()
            except ValueError:  # a run too long for its regular expressions
                pass
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    return Ids(path)


LEFT = SCHEMA + ", ids binary, together int"


def _left_batch(left: list[tuple], together: int) -> pa.RecordBatch:
    doc, start, length, ids, total, window, at = zip(*left)
    numbers = [pa.array(c, pa.int64()) for c in (doc, start, length, [0] * len(left), total, window, at)]
    return pa.RecordBatch.from_arrays([*numbers, pa.array(ids, pa.binary()), pa.array([together] * len(left), pa.int32())], [x.split()[0] for x in LEFT.split(", ")])


def _closed(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())], [x.split()[0] for x in LEFT.split(", ")])


def pack(docs: DataFrame, path: str, window: int = WINDOW, max_open: int = MAX_OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document in a sequence. Only pieces left in open windows are shuffled."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        packer = Packer(task << 40, window, max_open)
        ids, end = ids_of(path), array("I", [END_ID]).tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc_id, ids.of(text.as_py() or "") + end)
                if len(packer.rows) >= 20_000:
                    yield _closed(packer.batch())
        if packer.rows:
            yield _closed(packer.batch())
        left = packer.leave()
        for at in range(0, len(left), 1000):
            yield _left_batch(left[at : at + 1000], task // TASKS_TOGETHER)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer((1 << 62) + (TaskContext.get().partitionId() << 40), window, max_open)
        for batch in batches:
            doc, start, length, _, total, _, _, ids, _ = (c.to_pylist() for c in batch.columns)
            for piece in zip(doc, start, length, ids, total):
                packer.place(piece, max_open)
            if len(packer.rows) >= 20_000:
                yield packer.batch()
        packer.again()
        packer.finish()
        if packer.rows:
            yield packer.batch()

    # Written once: both halves must come of the same run of a task.
    packed = staged(map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), first, LEFT), "packed")
    left = packed.where("ids IS NOT NULL").repartition("together").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    return packed.where("ids IS NULL").drop("ids", "together").unionByName(map_arrow(left, second, SCHEMA))
