"""Phrase collocations by partitioned mining: shards first, then exact counts of what some shard found.

Documents are dealt to `SHARDS` shards by a hash of their id. A phrase with `least` occurrences in a
language has, in one shard at least, its share of them: `least` times the shard's part of the
language's words, rounded up. So every shard is mined completely at that local support, two words
first and then three words whose two halves are frequent in the shard; the union of what shards found
contains every frequent phrase. All phrases of the union are then counted over all documents as words,
not hashes, and those below `least` go.

Tasks cut texts into words on whole buffers, count hashes and send one row for each distinct one;
Spark sums them. What shards found goes back to the tasks as a bitmap of hashed phrases, of
`FILTER_BYTES` at most: a phrase that is there by chance is counted too, and found too rare in the
end, so results are exact at any size; only the work grows if a bitmap fills up.

The words of a phrase's parts are counted exactly as well. The score is worked out in decimals of 38
digits. A part may belong to very many phrases: Spark splits such keys of the sort-merge joins.

Defined results: a null text is empty; a null lang is `und`; repeated rows and rows without id count
as they come; ties in score and count go to the phrase's byte order; an empty table gives an empty
result; other columns are not looked at. A slice of text takes about 60 times its size in memory;
slices are cut between words, so only a single word longer than `SLICE` makes one longer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_arrow, staged, staged_with

SHARDS = 4
LEAST, TOP, SWALLOWED = 10, 2000, 50
#: A bitmap's size at most, and its positions for each phrase.
FILTER_BYTES, POSITIONS = 32 << 20, 16
#: Bytes of text worked on at once; phrases that a task collects before it counts them and sends them on.
SLICE, PENDING = 1 << 20, 1_500_000
#: Languages times shards that are broadcast with their local support; with more, the local support is 1.
MAX_SHARES = 200_000
#: Fixed characters of the definition: those that end a piece, and the blanks between words.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


class Words:
    """The words of one slice: places in `data`, hashes, pieces, and the document of each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: np.ndarray, doc: np.ndarray, old: int):
        self.data, self.starts, self.ends, self.doc, self.old = data, starts, ends, doc, old
        #: Whether word k and the next one (the next two) are in one piece, and were not all in the slice before.
        self.two = piece[:-1] == piece[1:]
        self.two[: max(0, old - 1)] = False
        self.three = (piece[:-2] == piece[2:]) if len(piece) > 2 else np.zeros(0, bool)

    def hashes(self, seed: np.ndarray) -> np.ndarray:
        """A hash of each word and its seed."""
        at, n = self.starts[0] if len(self.starts) else 0, (self.ends[-1] - self.starts[0]) if len(self.starts) else 0
        part = self.data[at : at + n].astype(_U) + _U(1)
        sums = np.zeros(n + 1, _U)
        np.cumsum(part * np.cumprod(np.full(n, _STEP, _U)), out=sums[1:])
        back = np.cumprod(np.concatenate([np.ones(1, _U), np.full(max(0, n - 1), _BACK, _U)])) if n else np.ones(0, _U)
        a, b = self.starts - at, self.ends - at
        return _mixed((sums[b] - sums[a]) * back[a] + seed)


def slices(texts: pa.Array, size: int) -> Iterator[Words]:
    """The words of a column of texts, A-Z lower-cased, slice by slice; a slice repeats the last two words before it."""
    texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    if body is None or offsets[-1] == offsets[0]:
        return
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    data = lower[np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside, ends_piece = np.ones(256, bool), np.zeros(256, bool)
    inside[list(BLANKS + PIECE_ENDS)] = False
    ends_piece[list(PIECE_ENDS)] = True
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    begin, end, old = 0, 0, 0
    while end < len(data):
        end = min(len(data), max(end, begin) + size)
        while end < len(data) and inside[data[end]] and not begins[end]:  # a word is not cut
            step = np.flatnonzero(~inside[data[end : end + size]] | begins[end : min(len(data), end + size)])
            end = end + int(step[0]) if len(step) else min(len(data), end + size)
        here = inside[data[begin:end]]
        fresh = begins[begin:end]
        starts = np.flatnonzero(here & (~np.concatenate([[False], here[:-1]]) | fresh))
        ends = np.flatnonzero(here & (~np.concatenate([here[1:], [False]]) | np.concatenate([fresh[1:], [True]]))) + 1
        piece = np.cumsum(ends_piece[data[begin:end]] | fresh)[starts]
        starts, ends = starts + begin, ends + begin
        if len(starts) > old:
            yield Words(data, starts, ends, piece, np.searchsorted(offsets, starts, "right") - 1, old)
        old = min(2, len(starts))
        begin = int(starts[-old]) if old else end


def _codes(langs: pa.Array) -> np.ndarray:
    return np.asarray(langs).view(_U)


def _keys(words: Words, lang: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the phrases of two and of three words that begin at each word: 56 bits of hash, 8 of shard."""
    h = words.hashes(lang[words.doc])
    turn = lambda x: (x << _U(21)) | (x >> _U(43))
    two = _mixed(turn(h[:-1]) + h[1:])
    three = _mixed(turn(two[:-1]) + h[2:] + _U(1)) if len(h) > 2 else np.zeros(0, _U)
    s = shard[words.doc].astype(_U)
    return (two >> _U(8) << _U(8)) | s[: len(two)], (three >> _U(8) << _U(8)) | s[: len(three)]


def _position(key: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """A key's position in a bitmap; with shards, another one in each of them."""
    at = (key >> _U(8)) & _U(bits - 1)
    return (at ^ ((key & _U(255)) * _U(bits // shards)) if shards else at).astype(np.int64)


def _position_column(key: Column, bits: int, shards: int) -> Column:
    at = F.shiftrightunsigned(key, 8).bitwiseAND(F.lit(bits - 1))
    return at.bitwiseXOR(key.bitwiseAND(F.lit(255)) * F.lit(bits // shards)) if shards else at


def _bitmap(keys: DataFrame, rows: int, shards: int) -> np.ndarray:
    """A bitmap of keys: FILTER_BYTES at most, whatever their number."""
    bits = min(8 * FILTER_BYTES, 1 << max(15, math.ceil(math.log2(max(1, rows) * POSITIONS))))
    at = _position_column(F.col("key"), bits, shards) + 1  # Spark's buckets begin at 1
    parts = keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, part in parts.collect():
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part, np.uint8)
    return out


def _is_set(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _mined(docs: DataFrame, pairs, shards: int, size: int) -> DataFrame:
    """(key) of the phrases that reach the local support of a shard: of two words, or of three with both halves in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = pairs.value if pairs is not None else None
        keys, needs, n = [], [], 0

        def out() -> pa.RecordBatch:
            found, first, counts = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.concatenate(needs)[first].astype(np.int64)), pa.array(counts, pa.int64())], ["key", "need", "n"])

        for batch in batches:
            lang, shard, need = _codes(batch.column(1)), np.asarray(batch.column(2)), np.asarray(batch.column(3)).astype(np.int32)
            for words in slices(batch.column(0), size):
                two, three = _keys(words, lang, shard)
                if bitmap is None:
                    at = np.flatnonzero(words.two)
                    keys.append(two[at])
                else:
                    known = _is_set(bitmap, _position(two, 8 * len(bitmap), shards))
                    at = np.flatnonzero(words.three & known[:-1] & known[1:])
                    keys.append(three[at])
                needs.append(need[words.doc[at]])
                n += len(at)
                if n > PENDING:
                    yield out()
                    keys, needs, n = [], [], 0
        if n:
            yield out()

    rows = map_arrow(docs.select("text", "lang_key", "shard", "need"), run, "key long, need long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n"), F.max("need").alias("need")).where("n >= need").select("key")


class _Exact:
    """Counts of (language, number of words, phrase) of a slice; no text becomes a Python object."""

    NAMES = ["lang", "k", "phrase", "n"]

    def __init__(self, bitmap: np.ndarray):
        self.bitmap = bitmap

    def of(self, words: Words, lang: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
        code = {}
        of_doc = np.array([code.setdefault(x, len(code)) for x in names], np.int64)
        ids, first = self._ids(words, of_doc)
        size = words.ends[first] - words.starts[first]
        ends = np.cumsum(size)
        body = words.data[np.repeat(words.starts[first] - ends + size, size) + np.arange(ends[-1])]
        text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(np.concatenate([[0], ends])), pa.py_buffer(body)).cast(pa.string())
        name = pa.array(list(code), pa.string()).take(pa.array(of_doc[words.doc[first]]))
        counts = np.bincount(ids[words.old :], minlength=len(first))
        new = np.flatnonzero(counts)
        yield self._batch(1, name, [text], [new], counts[new])
        two, three = _keys(words, lang, np.zeros(len(lang), np.uint8))
        bits = 8 * len(self.bitmap)
        at = np.flatnonzero(words.two & _is_set(self.bitmap, _position(two, bits, 0)))
        pairs, counts = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)
        yield self._batch(2, name, [text] * 2, [pairs >> 32, pairs & 0xFFFFFFFF], counts)
        if len(three):
            at = np.flatnonzero(words.three & _is_set(self.bitmap, _position(three, bits, 0)))
            pairs, inverse = np.unique(ids[at] << 32 | ids[at + 1], return_inverse=True)
            threes, counts = np.unique(inverse.astype(np.int64) << 32 | ids[at + 2], return_counts=True)
            of = pairs[threes >> 32]
            yield self._batch(3, name, [text] * 3, [of >> 32, of & 0xFFFFFFFF, threes & 0xFFFFFFFF], counts)

    def _batch(self, k: int, name: pa.Array, texts: list[pa.Array], ids: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        parts = [t.take(pa.array(i)) for t, i in zip(texts, ids)]
        phrase = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
        return pa.RecordBatch.from_arrays([name.take(pa.array(ids[0])), pa.array(np.full(len(counts), k, np.int32)), phrase, pa.array(counts.astype(np.int64))], self.NAMES)

    @staticmethod
    def _ids(words: Words, of_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A number for each different word of a language, and where each is first. Hashes sort the words; bytes decide."""
        lang = of_doc[words.doc]
        _, first, ids = np.unique(words.hashes(lang.astype(_U) << _U(40)), return_index=True, return_inverse=True)
        size, same = words.ends - words.starts, first[ids]
        equal = (size == size[same]) & (lang == lang[same])
        if equal.all():
            shift = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            equal = words.data[np.repeat(words.starts, size) + shift] == words.data[np.repeat(words.starts[same], size) + shift]
        if not equal.all():  # two words of one hash
            seen: dict[tuple, int] = {}
            ids = np.array([seen.setdefault((g, words.data[a:b].tobytes()), len(seen)) for g, a, b in zip(lang, words.starts, words.ends)])
            _, first = np.unique(ids, return_index=True)
        return ids.astype(np.int64), first


def _exact(docs: DataFrame, union, least: int, size: int) -> DataFrame:
    """(lang, k, phrase, f) of the words, and of the phrases in the bitmap, with `least` occurrences or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = _Exact(union.value)
        for batch in batches:
            lang, names = _codes(batch.column(1)), batch.column(2).to_pylist()
            for words in slices(batch.column(0), size):
                yield from exact.of(words, lang, names)

    rows = map_arrow(docs.select("text", "lang_key", "lang"), run, "lang string, k int, phrase string, n long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def _scored(counts: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of the phrases of two words or more, by their lowest cut."""
    part = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    candidates = counts.where("k > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.select("lang", "k", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"), F.array_join(F.slice("words", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("rest"))
    cut = cut.join(part.toDF("lang", "first", "l"), ["lang", "first"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    cut = cut.withColumns({"top": F.lit(1_000_000).cast("decimal(7,0)") * (whole("a") * whole("a")), "below": whole("l") * whole("r")})
    best = cut.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct(F.expr("top div below").alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "k", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, swallowed: int = SWALLOWED, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two and three words.

    A phrase is left out if a longer candidate that contains it has `swallowed` % of its occurrences.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_key"), F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(shards)).cast("int").alias("shard"))
    # A word of these tables is a run of other characters than the blanks and the ends of pieces.
    of_word = F.regexp_count("text", F.lit(r"[^ \t.,;:!?\n\x0B\f\r]+"))
    shares, seen = staged_with(rows.groupBy("lang", "lang_key", "shard").agg(F.coalesce(F.sum(of_word.cast("long")), F.lit(0)).alias("words")), "shares")
    totals = shares.groupBy("lang").agg(F.sum("words").alias("n"))
    needs = shares.join(totals, "lang").select("lang", "shard", F.greatest(F.lit(1), F.expr(f"({least} * words + n - 1) div greatest(n, 1)")).alias("need"))
    dealt = rows.join(F.broadcast(needs), ["lang", "shard"]) if seen["rows"] <= MAX_SHARES else rows.withColumn("need", F.lit(1).cast("long"))

    two, seen_two = staged_with(_mined(dealt, None, shards, SLICE), "two")
    local = spark.sparkContext.broadcast(_bitmap(two, seen_two["rows"], shards))
    three, seen_three = staged_with(_mined(dealt, local, shards, SLICE), "three")
    union = spark.sparkContext.broadcast(_bitmap(two.unionByName(three), seen_two["rows"] + seen_three["rows"], 0))
    counts = staged(_exact(rows, union, least, SLICE), "counts")

    scored = _scored(counts)
    inside = counts.where("k = 3").select("lang", F.split("phrase", " ").alias("w"), "f")
    inside = inside.select("lang", "f", F.explode(F.array(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < swallowed * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SPLIT = r"regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"
ORACLE_SQL = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest({_SPLIT}) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x != '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1),
occurrences AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM occurrences GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS p, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(p[cut + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase FROM counts WHERE k = 3) GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.f IS NULL OR 100 * g.f < {SWALLOWED} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= {TOP}
"""
