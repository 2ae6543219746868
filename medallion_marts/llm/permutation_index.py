"""Approximate nearest neighbours by inner product, from a permutation index.

A vector is represented by its `NEAREST` nearest pivots in order. Pivots are a bounded
sample of the vectors and their opposites, so far ones count as well. For inner products of
unequal lengths the vectors get one coordinate more, which makes all of them equally long.
The index is made of blocks; each holds its vectors and, for every pivot, an inverted file of
the vectors that have it among their nearest, with its place in their order. A query goes
through the files of its own nearest pivots; what the entries add up to is the footrule
distance (a pivot that a vector lacks stands at place `NEAREST`). The nearest `SHARE` of a
block by footrule, ties included, and all that are very near by it (`SURE`) are ranked anew by
exact inner products in double precision.

Every row is indexed; queries are a stated set that meets the index in blocks of both.

Defined results: vectors that are null, zero, hold null or non-finite components, or have not
the commonest number of dimensions take no part; rows that repeat an id count once, with
the least vector; equal scores go to the smaller id; an empty table gives an empty result;
null ids take no part; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

PIVOTS = 256
NEAREST = 64
#: Pivots are chosen from so many vectors, those with the least hashed ids.
SAMPLE = 4096
#: A vector this close to a pivot (as a cosine, of either sign) does not become one too.
APART = 0.8
SHARE = 0.2
#: A block offers this many candidates at least.
LEAST = 128
#: Vectors that save so much of the largest footrule distance are all candidates, however many
#: they are: in a crowd of almost equal vectors the order of pivots no longer tells them apart.
SURE = 0.6
BLOCK, QUERY_BLOCK = 16_384, 2048


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): one valid vector of doubles for each id."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).where("id IS NOT NULL AND x IS NOT NULL").where(fine)
    return rows.groupBy("id").agg(F.min("x").alias("x"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def orders(x: np.ndarray, pivots: np.ndarray, nearest: int, longest: float = 0.0) -> np.ndarray:
    """The numbers of the nearest pivots, nearest first. longest: of all vectors, 0 for queries."""
    rest = np.sqrt(np.maximum(0, longest**2 - (x * x).sum(axis=1))) if longest else np.zeros(len(x))
    near = np.concatenate([x, rest[:, None]], axis=1) @ pivots.T
    near = np.concatenate([near, -near], axis=1)
    nearest = min(nearest, near.shape[1])
    top = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, axis=1), axis=1, kind="stable"), axis=1)


def choose_pivots(sample: np.ndarray, longest: float) -> np.ndarray:
    """Directions of sampled vectors, none of them close to another, so that no crowd takes many."""
    x = np.concatenate([sample, np.sqrt(np.maximum(0, longest**2 - (sample * sample).sum(axis=1)))[:, None]], axis=1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    chosen = np.empty((0, x.shape[1]))
    for v in x:
        if len(chosen) < PIVOTS and (not len(chosen) or np.abs(chosen @ v).max() < APART):
            chosen = np.concatenate([chosen, v[None]])
    return chosen


class Block:
    """Inverted files of one block, rebuilt from its stored arrays."""

    def __init__(self, ids: bytes, vectors: bytes, entries: bytes, places: bytes, starts: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.x = np.frombuffer(vectors, np.float64).reshape(len(self.ids), -1)
        self.entries, self.places = np.frombuffer(entries, np.uint16), np.frombuffer(places, np.uint8)
        self.starts = np.frombuffer(starts, np.int64)

    @staticmethod
    def pack(ids: np.ndarray, x: np.ndarray, order: np.ndarray, n_pivots: int) -> tuple:
        rows, places = np.repeat(np.arange(len(ids)), order.shape[1]), np.tile(np.arange(order.shape[1]), len(ids))
        by_pivot = np.argsort(order.ravel(), kind="stable")
        starts = np.zeros(n_pivots + 1, np.int64)
        np.cumsum(np.bincount(order.ravel(), minlength=n_pivots), out=starts[1:])
        return ids.tobytes(), x.tobytes(), rows[by_pivot].astype(np.uint16).tobytes(), places[by_pivot].astype(np.uint8).tobytes(), starts.tobytes()

    def near(self, order: np.ndarray, want: int) -> np.ndarray:
        """Rows of the block that are nearest to a query's order by footrule, ties at the end included."""
        if want >= len(self.ids):
            return np.arange(len(self.ids))
        k = len(order)
        files = [slice(self.starts[p], self.starts[p + 1]) for p in order]
        rows = np.concatenate([self.entries[f] for f in files])
        # Footrule = a constant less twice the sum over common pivots of k - max(place, other place).
        saved = np.concatenate([np.maximum(self.places[f], np.uint8(j)) for j, f in enumerate(files)])
        gain = np.bincount(rows, weights=k - saved.astype(np.int32), minlength=len(self.ids))
        edge = np.partition(gain, len(gain) - want)[len(gain) - want]
        return np.flatnonzero(gain >= min(edge, SURE * k * (k + 1) / 2))

    def best(self, query_id: int, query: np.ndarray, rows: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        rows = rows[self.ids[rows] != query_id]
        rough = self.x[rows] @ query
        if len(rows) > top:
            edge = np.partition(rough, len(rough) - top)[len(rough) - top]
            rows = rows[rough >= edge - 1e-9 * (1 + abs(edge))]
        score = (self.x[rows] * query).sum(axis=1)
        first = np.lexsort((self.ids[rows], -score))[:top]
        return self.ids[rows][first], score[first]


def search(vectors: DataFrame, every: int = 20, top: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", share: float = SHARE, least: int = LEAST, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id, score) of the rows whose id is divisible by `every`, against all others."""
    spark = vectors.sparkSession
    schema = f"query_id long, rank int, `{id_col}` long, score double"
    rows = clean(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n"), F.max(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)).alias("longest"))
    common = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == common["dims"])
    longest = float(np.sqrt(common["longest"]))
    chosen = rows.select(F.xxhash64("id").alias("h"), "id", "x").orderBy("h", "id").limit(SAMPLE).toArrow()
    shared = spark.sparkContext.broadcast(choose_pivots(_matrix(chosen.column("x")), longest))
    n_blocks = -(-common["n"] // block)
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int")

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        by_id = np.argsort(ids, kind="stable")
        x = _matrix(table.column("x"))[by_id]
        packed = []
        # A hashed block may be somewhat larger than planned; entries hold 16 bits.
        for start in range(0, len(ids), 60_000):
            some = slice(start, start + 60_000)
            packed.append(Block.pack(ids[by_id][some], x[some], orders(x[some], shared.value, NEAREST, longest), 2 * len(shared.value)))
        number = table.column("part")[0].as_py()
        names = ["ids", "vectors", "entries", "places", "starts"]
        return pa.table([pa.array([number] * len(packed), pa.int32())] + [pa.array(c, pa.binary()) for c in zip(*packed)], names=["part", *names])

    index = staged(rows.select(part.alias("part"), "id", "x").groupBy("part").applyInArrow(build, "part int, ids binary, vectors binary, entries binary, places binary, starts binary"), "index")
    queries = staged(rows.where(F.col("id") % every == 0), "queries")
    n_query_blocks = max(1, -(-queries.count() // query_block))
    asked = queries.withColumn("asked", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_query_blocks)).cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<int>")))
    indexed = index.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1)).cast("array<int>")))

    def answer(stored: pa.Table, table: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if table.num_rows and stored.num_rows:
            ids, x = table.column("id").to_numpy(), _matrix(table.column("x"))
            order = orders(x, shared.value, NEAREST)
            for row in range(stored.num_rows):
                b = Block(*(stored.column(c)[row].as_py() for c in ("ids", "vectors", "entries", "places", "starts")))
                want = max(least, int(np.ceil(share * len(b.ids))))
                for q in range(len(ids)):
                    found, score = b.best(ids[q], x[q], b.near(order[q], want), top)
                    out[0].append(np.full(len(found), ids[q])), out[1].append(found), out[2].append(score)
        join = lambda c, kind: pa.array(np.concatenate(c) if c else np.zeros(0), kind)
        return pa.table([join(out[0], pa.int64()), join(out[1], pa.int64()), join(out[2], pa.float64())], names=["query_id", "id", "score"])

    near = indexed.groupBy("part", "asked").cogroup(asked.groupBy("part", "asked")).applyInArrow(answer, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias(id_col), "score")
