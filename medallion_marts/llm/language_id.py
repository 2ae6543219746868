"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree of order 0 to 3 is counted from a bounded sample of
labelled documents. With these counts frozen, the code length of a byte is that of the
longest known context in which the byte has been seen, plus the escapes from the longer
ones (method C: as many escapes as distinct successors). As a sum over a text, code lengths
are linear in how often each string of 1 to 4 bytes occurs: as a context a string adds its
escape, as context and byte it takes back the escape and what shorter contexts would cost.
Trees are stored so, sparsely: a string has weights only for the languages that know it. All
byte values, contexts and languages are kept; a text is looked up once, however many languages
there are.

Defined results: `und` with score 0 for a null text or one without a letter, and for every
text if nothing was learned; equal code lengths go to the alphabetically first language;
repeated rows are scored alike; a null id is never held out; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, id_remainder, keep_rows, map_batches

ORDER = 3
#: About so many documents of each language are learned from, chosen by a hash of their id, and so
#: many in all: with more than 40 languages each has fewer. This bounds the model.
SAMPLE_PER_LANGUAGE = 1500
SAMPLE = 60_000
#: Bytes of a text whose strings are held at once.
SLAB = 1 << 20
UNDETERMINED = "und"


class Strings:
    """Numbers of byte strings of one length, by open addressing; -1 for others.

    A string is a number whose highest byte is its last, so that sorted strings have their endings sorted, too.
    """

    def __init__(self, values: np.ndarray):
        self.shift = np.uint32(32 - max(4, int(2 * len(values)).bit_length()))
        self.value, self.number = (np.zeros(1 << (32 - int(self.shift)), t) for t in (np.uint32, np.int32))
        self.number.fill(-1)
        values = values.astype(np.uint32)
        left, slot = np.arange(len(values)), self._slot(values)
        while len(left):
            free = self.number[slot] < 0
            self.number[slot[free]] = left[free]  # of several the last stays
            placed = self.number[slot] == left
            self.value[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & (len(self.number) - 1)

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return ((values * np.uint32(2654435761)) >> self.shift).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        slot = self._slot(values)
        found = self.number[slot]
        left = np.flatnonzero((found >= 0) & (self.value[slot] != values))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.number) - 1)
            found[left] = self.number[slot]
            on = (found[left] >= 0) & (self.value[slot] != values[left])
            left, slot = left[on], slot[on]
        return found


@dataclass
class Trees:
    """Weights of the strings of one length: those of string k are entries starts[k] to starts[k + 1]."""

    strings: Strings
    starts: np.ndarray
    language: np.ndarray
    as_context: np.ndarray  # bits of the escape
    in_text: np.ndarray  # those, and the bits by which context and byte differ from escape and shorter context

    def add(self, total: np.ndarray, values: np.ndarray, times: np.ndarray, weights: np.ndarray) -> None:
        found = self.strings.find(values)
        known = found >= 0
        found, times = found[known], times[known]
        first, n = self.starts[found], self.starts[found + 1] - self.starts[found]
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        total += np.bincount(self.language[at], weights=weights[at] * np.repeat(times, n), minlength=len(total))


@dataclass
class Model:
    languages: list[str]
    escape: np.ndarray  # language -> bits of the escape from the empty context
    trees: list[Trees]  # for strings of 1 to ORDER + 1 bytes

    def bits(self, text: bytes) -> np.ndarray:
        padded = np.zeros(len(text) + ORDER, np.uint32)
        padded[ORDER:] = np.frombuffer(text, np.uint8)
        total = (8 + self.escape) * len(text)
        for start in range(0, len(text), SLAB):
            part = padded[start : start + SLAB + ORDER]
            grams = part[:-ORDER].copy()
            for k in range(1, ORDER + 1):
                grams |= part[k : k - ORDER or None] << np.uint32(8 * k)
            grams, times = np.unique(grams, return_counts=True)
            for tree in reversed(self.trees):
                tree.add(total, grams, times, tree.in_text)
                grams = grams >> np.uint32(8)
                first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
                grams, times = grams[first], np.add.reduceat(times, first)
        if text:  # the last string is no context, and the padding is one
            last = int.from_bytes((b"\0" * ORDER + text)[-ORDER:], "little")
            for length, tree in enumerate(self.trees[:-1], 1):
                ends = np.array([0, last >> 8 * (ORDER - length)], np.uint32)
                tree.add(total, ends, np.array([1.0, -1.0]), tree.as_context)
        return total


def build(grams: np.ndarray, language: np.ndarray, counts: np.ndarray, languages: list[str]) -> Model:
    """grams: (n, ORDER + 1) bytes, of which the last follows the others."""
    whole = np.zeros(len(grams), np.int64)
    for k in range(ORDER + 1):
        whole |= grams[:, k].astype(np.int64) << 8 * k
    of = language.astype(np.int64) << 32
    escape, trees = np.zeros(len(languages)), []
    shorter, shorter_bits = np.arange(len(languages)) << 32, np.full(len(languages), 8.0)
    for length in range(1, ORDER + 2):
        # A key is a language and a string; contexts are the strings without their last byte.
        keys, at = np.unique(of | whole >> 8 * (ORDER + 1 - length), return_inverse=True)
        n = np.bincount(at, weights=counts, minlength=len(keys))
        tongue, string = keys >> 32, keys & ((1 << 32) - 1)
        contexts, context = np.unique(tongue << 32 | string & ((1 << 8 * (length - 1)) - 1), return_inverse=True)
        total = np.bincount(context, weights=n, minlength=len(contexts))
        distinct = np.bincount(context, minlength=len(contexts))
        escapes = np.log2(total + distinct) - np.log2(distinct)
        bits = np.log2(total + distinct)[context] - np.log2(n)
        lower = tongue << 32 | string >> 8
        as_byte = bits - escapes[context] - shorter_bits[np.searchsorted(shorter, lower)]
        if length == 1:
            escape[contexts >> 32] = escapes
        else:
            trees.append(_tree(shorter, shorter_as_byte, contexts, escapes))
        shorter, shorter_bits, shorter_as_byte = keys, bits, as_byte
    trees.append(_tree(shorter, shorter_as_byte, np.zeros(0, np.int64), np.zeros(0)))
    return Model(languages, escape, trees)


def _tree(seen: np.ndarray, as_byte: np.ndarray, contexts: np.ndarray, escapes: np.ndarray) -> Trees:
    keys = np.union1d(seen, contexts)
    as_context, in_text = np.zeros(len(keys)), np.zeros(len(keys))
    as_context[np.searchsorted(keys, contexts)] = escapes
    in_text[np.searchsorted(keys, seen)] = as_byte
    in_text += as_context
    order = np.argsort(keys & ((1 << 32) - 1), kind="stable")
    strings, n = np.unique(keys & ((1 << 32) - 1), return_counts=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    return Trees(Strings(strings), starts, (keys >> 32)[order].astype(np.int32), as_context[order], in_text[order])


def learn(docs: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the labelled rows of docs; None if there are none."""
    labelled = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).where("_text IS NOT NULL AND _lang IS NOT NULL")
    sizes = labelled.groupBy("_lang").count().collect()
    if not sizes:
        return None
    sample_per_language = min(sample_per_language, SAMPLE / len(sizes))
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["_lang"], min(1.0, sample_per_language / r["count"]))])
    langs = sorted(r["_lang"] for r in sizes)
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(langs) for x in (lang, k)])
    chosen = labelled.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < F.coalesce(share[F.col("_lang")], F.lit(0.0)) * (1 << 20))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            by_lang: dict[int, list[np.ndarray]] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                b = np.frombuffer(b"\0" * ORDER + text.as_py().encode("utf-8"), np.uint8).astype(np.uint32)
                key = b[:-ORDER].copy()
                for k in range(1, ORDER + 1):
                    key = key << np.uint32(8) | b[k : len(b) - ORDER + k]
                by_lang.setdefault(lang, []).append(key)
            langs, keys, counts = [], [], []
            for lang, parts in by_lang.items():
                key, n = np.unique(np.concatenate(parts), return_counts=True)
                langs += [lang] * len(key)
                keys.append(key.astype(np.int64))
                counts.append(n)
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.int32()), pa.array(np.concatenate(keys)), pa.array(np.concatenate(counts).astype(np.int64))], ["lang", "gram", "n"])

        return one

    counted = map_batches(chosen.select("_text", number[F.col("_lang")].alias("_lang")), make, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    if not found.num_rows:
        return None
    language, gram, n = (found.column(c).to_numpy() for c in ("lang", "gram", "n"))
    order = np.lexsort((gram, language))
    grams = np.stack([((gram[order] >> (8 * (ORDER - k))) & 255).astype(np.uint8) for k in range(ORDER + 1)], axis=1)
    model = build(grams, language[order], n[order].astype(np.float64), langs)
    del found, language, gram, n, grams
    give_back()
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, bits_per_byte) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import regex

        letter, m = regex.compile(r"\p{L}").search, shared.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            langs, scores, rates = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                if m is None or text is None or not letter(text):
                    langs.append(UNDETERMINED), scores.append(0.0), rates.append(0.0)
                    continue
                data = text.encode("utf-8", "replace")
                bits = m.bits(data)
                best = int(np.argmin(bits))
                langs.append(m.languages[best])
                scores.append(float(1 / np.exp2(-np.minimum(bits - bits[best], 1000)).sum()))
                rates.append(float(bits[best] / len(data)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())], [id_col, "lang_pred", "score", "bits_per_byte"])

        return one

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string"))
    return map_batches(rows, make, f"`{id_col}` long, lang_pred string, score double, bits_per_byte double")


def identify(docs: DataFrame, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Predictions for all rows, learned from the folds that are not held out."""
    fold = id_remainder(F.col("doc_id"), modulus)
    model = learn(docs.where(fold != held_out))
    return predict(docs, model).select("doc_id", (fold == held_out).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def keep_identified(docs: DataFrame, model: Model | None, min_score: float = 0.5) -> DataFrame:
    """The rows of docs, with docs' own columns, whose language is told with `min_score` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import regex

        letter, m = regex.compile(r"\p{L}").search, shared.value

        def told(text: str | None) -> bool:
            if text is None or not letter(text):
                return False
            if m is None:
                return True
            bits = m.bits(text.encode("utf-8", "replace"))
            return bool(1 / np.exp2(-np.minimum(bits - bits.min(), 1000)).sum() >= min_score)

        return lambda texts: [told(x.as_py()) for x in texts]

    return keep_rows(docs, make)
