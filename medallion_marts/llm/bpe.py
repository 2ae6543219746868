"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

Bytes are mapped to Latin-1 characters so that one Aho-Corasick automaton finds, in one
pass, the longest vocabulary entry at every position. The encoder takes longest matches
from the left; two neighbours must be compatible (merging their bytes by rank would yield
just these two), else it shortens the match or steps back. Positions that were found to be
dead are remembered, so the work is linear in the text. Compatibility is memoised.

Defined results: null text is empty and gives no ids; rows are independent, so ties,
repeated rows and other columns make no difference; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Entries after which a worker's memory of words or token pairs starts anew.
MEMO_ENTRIES = 400_000
#: Beyond every rank.
NEVER = 1 << 60


class Encoder:
    """Encodes one pre-split piece; `ranks` maps token bytes to ids in merge order."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        top = max(ranks.values(), default=-1) + 1
        self.token = [b""] * top
        self.size = [0] * top
        for b, i in ranks.items():
            self.token[i], self.size[i] = b, len(b)
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.shorter = {}
        for b, i in ranks.items():
            self.shorter[i] = next((ranks[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in ranks), None)
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        for i in sorted(ranks.values()):
            self._split(i)
        self.memo.clear()

    def _split(self, i: int) -> None:
        """Finds the two tokens whose merge makes token i."""
        b, left = self.token[i], self.shorter[i]
        while left is not None:
            right = self.ranks.get(b[self.size[left] :])
            if right is not None and left < i and right < i and self._pair(left, right):
                self.halves[i] = (left, right)
                self.merged[left, right] = i
                return
            left = self.shorter[left]

    def _edge(self, i: int, side: int) -> list[int]:
        """The tokens that token i has at its left (0) or right (1) end as it is merged together, from a byte up to itself."""
        out = [i]
        while out[-1] in self.halves:
            out.append(self.halves[out[-1]][side])
        return out[::-1]

    def _pair(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b by rank leaves just these two.

        Ranks pass from low to high; at any time one token of a's right edge and one of b's left edge
        meet at the border. A merge across it happens if its rank comes before the next merge on
        either side. At equal rank the one further left is first.
        """
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        while True:
            next_left = left[i + 1] if i + 1 < len(left) else NEVER
            next_right = right[j + 1] if j + 1 < len(right) else NEVER
            across = self.merged.get((left[i], right[j]), NEVER)
            if across < next_left and across <= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        found = self.memo.get((a, b))
        if found is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            found = self.memo[a, b] = self._pair(a, b)
        return found

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if not n:
            return []
        longest: list[int | None] = [None] * n
        for end, (i, size) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size + 1] = i
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else None
            while token is not None:
                end = at + self.size[token]
                if alive[end] and (last is None or self.compatible(last, token)):
                    break
                token = self.shorter[token]
            if token is None:
                if last is None:
                    raise ValueError("the vocabulary lacks a byte of the text")
                alive[at] = 0
                out.pop()
                at -= self.size[last]
                token = self.shorter[last]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Pieces(dict):
    """Piece of text to packed ids, filled as pieces are met."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.encoder.encode(piece.encode("utf-8"))).tobytes()
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = packed
        return packed


@lru_cache(maxsize=2)
def load(path: str, pattern: str):
    """(split function, packed ids of pieces, encoder) of a rank file."""
    import regex

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    encoder = Encoder(ranks)
    return regex.compile(pattern).findall, _Pieces(encoder), encoder


def encode_and_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) for every row, and the ids themselves if asked."""

    def make():
        split, pieces, encoder = load(path, pattern)
        packed_of = pieces.__getitem__

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, ids_hash, text_hash, all_ids = [], [], [], []
            for text in batch.column(1):
                packed = b"".join(map(packed_of, split(text.as_py() or "")))
                ids = array("I", packed)
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                text_hash.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids.tolist())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)

        return one

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col))
    return map_batches(rows, make, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
