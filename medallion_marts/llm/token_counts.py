"""Token counts of whole texts, the huge ones by overlapping chunks that are spliced where both agree.

A text up to `CHUNK` characters is encoded at once. A longer one is encoded in chunks that overlap,
with offsets, so that the tokenizer never holds more than a chunk. Two neighbours are spliced at a
common token: one with the same id over the same characters in both, whole characters only.

Why that is exact for a byte-level BPE that splits by its usual pattern: the pattern looks ahead (by
less than four characters) but not back, and added tokens are cut out first. So the first chunk's pieces
begin where the whole text's do, unless they begin within the longest added token and four characters of
its end, where common tokens don't count; and the later chunk's pieces end where the whole text's do,
except for its last one. A sequence of tokens is the encoding of a piece exactly if every two neighbours
are compatible. Up to the common token all pairs are the first chunk's, from it on the later chunk's, so
all are compatible, and the spliced sequence is the encoding. Without a common token the overlap is
doubled, in the end to the whole text, so the count is always that of the whole text.

Files that are not such a BPE (other models, normalizers, word ends; `.model` files) are outside the
argument and are encoded whole.

Defined results: a null text is empty and has no tokens; rows are independent, so ties, repeated rows
and null ids make no difference; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quiet_threads

#: Characters of a chunk, and of the overlap that is tried first.
CHUNK, OVERLAP = 65_536, 256
LIMIT = 1024
#: Characters of short texts that are handed to the tokenizer together.
TOGETHER = 1 << 20


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def _plain_byte_bpe(file: dict) -> bool:
    """Whether the splice is proven for a tokenizer file."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or file.get("normalizer"):
        return False
    if split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space"):
        return False
    return not any(t.get(flag) for t in file.get("added_tokens", []) for flag in ("lstrip", "rstrip", "single_word"))


class Counter:
    """Counts the tokens of texts by a tokenizer file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        quiet_threads()
        self.widened = 0
        if path.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
            self.chunk = None
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.counts = lambda texts: [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        longest = max((len(t["content"]) for t in file.get("added_tokens", [])), default=0)
        self.guard = longest + 4
        self.overlap = max(overlap, 2 * self.guard)
        self.chunk = max(chunk, 4 * self.overlap) if _plain_byte_bpe(file) else None
        self.byte_of = _byte_of()

    def of(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        out, short, size = [0] * len(texts), [], 0

        def flush() -> None:
            for k, n in zip(short, self.counts([texts[k] for k in short])):
                out[k] = n
            short.clear()

        for k, text in enumerate(texts):
            if self.chunk and len(text) > self.chunk:
                out[k] = self.huge(text)
            elif text:
                short.append(k)
                size += len(text)
                if size > TOGETHER:
                    flush()
                    size = 0
        flush()
        return out

    def huge(self, text: str) -> int:
        """The number of tokens of a text longer than a chunk."""
        encode = lambda a, b: self.tokenizer.encode(text[a:b], add_special_tokens=False)
        total, begin, end = 0, 0, self.chunk
        left, first = encode(begin, end), 0  # tokens of left from first on are not counted yet
        while end < len(text):
            overlap = self.overlap
            while True:
                start = max(begin, end - overlap)
                stop = min(len(text), start + max(self.chunk, 2 * overlap))
                right = encode(start, stop)
                met = self._common(text, left, begin, first, end - self.guard, right, start)
                if met:
                    break
                if start == begin:  # nothing in common over a whole chunk
                    return len(encode(0, len(text)))
                self.widened += 1
                overlap *= 2
            total += met[0] - first
            left, begin, end, first = right, start, stop, met[1]
        return total + len(left) - first

    def _common(self, text: str, left, left_at: int, first: int, last_at: int, right, right_at: int) -> tuple[int, int] | None:
        """How many tokens of left and of right there are up to a common token of whole characters: the latest that begins by last_at."""
        spans = {}
        ids, offsets = right.ids, right.offsets
        for k in range(len(ids)):
            a, b = offsets[k]
            spans[a + right_at, b + right_at, ids[k]] = k
        ids, offsets = left.ids, left.offsets
        for k in range(len(ids) - 2, first - 1, -1):
            a, b = offsets[k]
            if a + left_at < right_at:
                return None
            at = spans.get((a + left_at, b + left_at, ids[k]))
            if at is not None and a < b and a + left_at <= last_at and self._whole(left.tokens[k], text[a + left_at : b + left_at]):
                return k + 1, at + 1
        return None

    def _whole(self, token: str, of: str) -> bool:
        """Whether a token stands for just these characters, with white space before them perhaps (which offsets may leave out)."""
        if any(c not in self.byte_of for c in token):
            return False
        token, of = bytes(self.byte_of[c] for c in token), of.encode()
        return token.endswith(of) and not token[: len(token) - len(of)].strip()


@lru_cache(maxsize=2)
def counter_of(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row; no shuffle."""

    def make():
        counter = counter_of(path)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = counter.of([t or "" for t in batch.column(1).to_pylist()])
            columns = [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, [id_col, "n_bytes", "n_tokens", "over_limit"])

        return one

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text.alias(text_col), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return map_batches(rows, make, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean")
