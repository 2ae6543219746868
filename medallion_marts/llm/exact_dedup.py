"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions only.

Pass 1 counts how many rows set each filter position and keeps, as bitmaps of 32,768
positions, those set by two rows or more. Pass 2 looks every digest up: one with a position
that no other row has set is surely unique and passes straight through; only the rest is
shuffled and grouped. False positives merely take the long way, so the result is exact.

The filter has 16 positions a row up to `FILTER_BYTES`, so that it can always be broadcast; with
more rows more of the unique digests take the long way. Texts are never moved to find copies:
digests are. To drop copies, a second filter, of the digests that do repeat, tells which rows
may have to go; only these are shuffled with their texts.

Defined results: null text counts as empty; a null id never wins against a number; rows
that repeat an id and a text share one verdict in `find_copies` and leave one row in
`drop_copies`; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged_with

#: Filter positions for each row. Two positions a row: about 1.5 % of unique rows take the long way.
POSITIONS_PER_ROW = 16
#: The filter's size at most.
FILTER_BYTES = 32 << 20
#: Groups of a thousandth of all rows or more (and of so many rows at least) are large: there are at most a thousand.
LARGE_GROUPS, LARGE_AT_LEAST = 1000, 20


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _positions(digest: Column, size: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(seed)), F.lit(size)) for seed in (1, 2)]


def _filter(digests: DataFrame, rows: int, least: int) -> tuple[DataFrame, int]:
    """Bitmaps of the positions that `least` rows or more set, and the number of positions."""
    size = min(8 * FILTER_BYTES, 1 << max(15, math.ceil(math.log2(max(1, rows) * POSITIONS_PER_ROW))))
    pos = digests.select(F.explode(F.array_distinct(F.array(*_positions(F.col("_digest"), size)))).alias("pos"))
    if least > 1:
        pos = pos.groupBy("pos").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    bitmaps = pos.groupBy(F.bitmap_bucket_number("pos").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("_bits"))
    return staged_with(bitmaps, "filter")[0], size


def _is_set(bits: Column, pos: Column) -> Column:
    at = F.bitmap_bit_position(pos)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1, F.lit(False))


def _flag(rows: DataFrame, bitmaps: DataFrame, size: int) -> DataFrame:
    """rows with `_maybe`: whether both positions of their digest are in the filter."""
    out = rows.withColumn("_maybe", F.lit(True))
    for pos in _positions(F.col("_digest"), size):
        out = out.withColumn("_bucket", F.bitmap_bucket_number(pos)).join(F.broadcast(bitmaps), "_bucket", "left")
        out = out.withColumn("_maybe", F.col("_maybe") & _is_set(F.col("_bits"), pos)).drop("_bucket", "_bits")
    return out


def _groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int, int]:
    """(rows (_id, _digest, _maybe), groups of those that may be repeated (_digest, keep_id, group_size), numbers of rows and of such groups)."""
    digests, seen = staged_with(docs.select(F.col(id_col).alias("_id"), _digest(text_col).alias("_digest")), "digests")
    flagged = _flag(digests, *_filter(digests, seen["rows"], 2))
    groups, found = staged_with(flagged.where("_maybe").groupBy("_digest").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    return flagged, groups, seen["rows"], found["rows"]


def _with_groups(maybe: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """maybe (with _digest) and what its group has. Large groups are few, so they are broadcast; a join by digest would put each into one task."""
    large = F.col("group_size") >= max(LARGE_AT_LEAST, n_rows // LARGE_GROUPS)
    at_once = maybe.join(F.broadcast(groups.where(large)), "_digest", "left")
    rest = at_once.where("group_size IS NULL").select(*maybe.columns).join(groups.where(~large), "_digest")
    return at_once.where("group_size IS NOT NULL").unionByName(rest)


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row; of equal texts the largest id stays."""
    flagged, groups, n_rows, _ = _groups(docs, id_col, text_col)
    grouped = _with_groups(flagged.where("_maybe").select("_id", "_digest"), groups, n_rows).select("_id", "keep_id", "group_size", "_digest")
    single = flagged.where(~F.col("_maybe")).select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "_digest")
    return single.unionByName(grouped).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with docs' own columns; unique texts are not shuffled."""
    flagged, groups, n_rows, n_groups = _groups(docs, id_col, text_col)
    repeated = groups.where("group_size > 1")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = _flag(docs.select(row, F.col(id_col).alias("_id"), _digest(text_col).alias("_digest")), *_filter(repeated, n_groups, 1))
    candidates = flagged.where("_maybe").select("_id", "_digest")
    grouped = candidates.join(F.broadcast(repeated), "_digest") if n_groups * 64 <= FILTER_BYTES else _with_groups(candidates, repeated, n_rows)
    # (digest, id) is spread evenly even where one digest has a third of the rows.
    losers = grouped.where(~F.col("_id").eqNullSafe(F.col("keep_id"))).select("_digest", "_id")
    maybe = rows.where("_maybe").alias("r").join(losers.alias("k"), (F.col("r._digest") == F.col("k._digest")) & F.col("r._id").eqNullSafe(F.col("k._id")), "left_anti")
    maybe = maybe.dropDuplicates(["_digest", "_id"])
    return rows.where(~F.col("_maybe")).select("_row").unionByName(maybe.select("_row")).select("_row.*")


ORACLE_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS keep_id,
       count(*) OVER (PARTITION BY sha256(coalesce(text, ''))) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY sha256(coalesce(text, ''))) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
