"""Near-duplicates by an LSH forest over MinHash signatures.

1. Each document becomes a set of word shingles (64-bit hashes), a digest of the set and a
   MinHash signature of one byte a place. Documents with equal sets are one from here on.
2. The forest: signatures are sorted in several orders, each beginning at another place. In
   every order a document's candidates are its next neighbours, as far as they share a prefix
   of at least `MIN_DEPTH` places and most of the places in view. Neighbours share the longest
   prefixes, so the depth at which candidates are found adapts to how crowded a region is.
3. Candidates are confirmed on the full sets: first the most similar ones of each document;
   then those that would join two components.
4. Where a region (a common prefix of `CROWD_DEPTH` places in one order) holds more documents
   than the neighbourhood reaches and they are still in several components, those outside its
   largest one are compared with the region: by signature, and where that agrees on the full
   sets. A region of over `CELL` documents is split by a longer prefix first, the longest that
   linked documents still share in some order but for a thousandth of them (`deepest`); what is
   still larger, in documents or in bytes, is compared in blocks. Of the links found in a block
   only those that join components leave it. So neither the reach nor a region's size is a cap.

Only components matter to the result: links inside one need not all be confirmed.

Defined results: documents without words are linked with nothing; rows with the same id are
one node; a null id gets the smallest id of the documents with an equal set, or null, and
without any id at all stays; an empty table gives an empty result; other columns are not
looked at. Texts are used whole, however long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, map_batches, sized, staged, staged_with
from .graph import components

SHINGLE = 5
PLACES = 128
#: Orders, places from the beginning of one to that of the next, and places of each that the sort has in view.
TREES, STRIDE, DEPTH = 25, 5, 40
#: Places that candidates share at the beginning; and those of a crowded region.
MIN_DEPTH, CROWD_DEPTH = 4, 6
#: Neighbours looked at after each document in each order.
REACH = 6
#: Most similar candidates before each document (by id) that are confirmed first.
FIRST = 2
#: Standard deviations below the threshold at which signatures still count as agreeing, and at which places in view do.
SLACK, VIEW_SLACK = 4.2, 2.5
#: Rows of a region that are compared at once, on either side, and bytes of their sets.
CELL, CELL_BYTES = 1024, 8 << 20
#: Ids are broadcast up to this number, else joined by a shuffle.
BROADCAST_IDS = 4_000_000

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_MULT = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _rng.integers(1, 1 << 31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint64).astype(np.uint32)
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SEGMENT = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased; a word's hash doesn't depend on its place."""
    raw = np.frombuffer(data, np.uint8)
    out, start, n = [], 0, len(raw)
    while start < n:
        end = min(n, start + _SEGMENT)
        if end < n:  # cut at white space, so that no word is split
            gaps = np.flatnonzero(_SPACE[raw[start:end]])
            while not len(gaps) and end < n:
                ahead = np.flatnonzero(_SPACE[raw[end : end + _SEGMENT]])
                gaps, end = (ahead + (end - start), end) if len(ahead) else (gaps, min(n, end + _SEGMENT))
            if len(gaps):
                end = start + int(gaps[-1]) + 1
        part = raw[start:end]
        power, inverse = _power_tables(max(len(part), 1 << 14))
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[part], [True]]).astype(np.int8)))
        first, after = edge[::2], edge[1::2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        out.append(_mix((sums[after] - sums[first]) * inverse[first]))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; of a shorter text its whole sequence; of none, nothing."""
    words = word_hashes((text or "").encode("utf-8", "replace"))
    n = len(words)
    if not n:
        return words
    if n < SHINGLE:
        return _mix((words * _MULT[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = words[: n - SHINGLE + 1] * _MULT[0]
    for k in range(1, SHINGLE):
        total = total + words[k : n - SHINGLE + 1 + k] * _MULT[k]
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> bytes:
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(PLACES, 0xFFFFFFFF, np.uint32)
    half = PLACES // 2
    for start in range(0, len(shingles), 2048):
        for part, h in ((slice(0, half), low), (slice(half, PLACES), high)):
            hashed = np.multiply.outer(_A[part], h[start : start + 2048])
            hashed += _B[part, None]
            np.minimum(best[part], hashed.min(axis=1), out=best[part])
    return ((best * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, digest, signature) for every row; digest and signature are null without words."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py())
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signatures.append(signature(s) if len(s) else None)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())], ["id", "n_shingles", "digest", "signature"])

        return one

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, make, "id long, n_shingles long, digest binary, signature binary")


def _forest(nodes: DataFrame) -> DataFrame:
    """(tree, label, id): the signature from the place where the tree's order begins."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows = nodes.select("id", F.concat("signature", "signature").alias("twice"), tree)
    return rows.select("tree", F.expr(f"substring(twice, tree * {STRIDE} + 1, {DEPTH})").alias("label"), "id")


def deepest(percent: int) -> int:
    """The longest prefix that a pair at the threshold shares in one of the orders but for one time in a thousand."""
    return max([CROWD_DEPTH, *(d for d in range(CROWD_DEPTH, DEPTH) if (1 - (percent / 100) ** d) ** TREES <= 1e-3)])


def _descend(forest: DataFrame, least: float) -> DataFrame:
    """From the sorted orders (a, b, agree, tree, label): candidate pairs a < b, and, with null a, places b in crowded regions.

    A pair on either side of a border between partitions is missed in that one order only. A
    partition's first and last regions may go on beyond its border, so they count as crowded.
    """
    names = ["a", "b", "agree", "tree", "label"]

    def rows_of(a, b, agree, tree, label) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip((a, b, agree, tree, label), kinds)], names)

    def crowd(tree: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        n = len(ids)
        return rows_of(pa.nulls(n, pa.int64()), ids, pa.nulls(n, pa.int32()), tree.astype(np.int32), pa.array([x.tobytes() for x in labels[:, :16]], pa.binary()))

    def run(batches):
        kept, region, border = None, None, True  # the rows of the region that is still open
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column(0).to_numpy()
            labels = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, DEPTH)
            ids = batch.column(2).to_numpy()
            old = 0
            if kept is not None:
                old = len(kept[2])
                tree, labels, ids = (np.concatenate([x, y]) for x, y in zip(kept, (tree, labels, ids)))
            key = tree.astype(np.int64) << 32 | np.ascontiguousarray(labels[:, :MIN_DEPTH]).view(">u4").ravel().astype(np.int64)
            a, b, agree = [], [], []
            for k in range(1, min(REACH, len(key) - 1) + 1):
                later = np.arange(max(k, old), len(key))
                later = later[(key[later] == key[later - k]) & (ids[later] != ids[later - k])]
                same = (labels[later] == labels[later - k]).sum(axis=1)
                later, same = later[same >= least], same[same >= least]
                a.append(np.minimum(ids[later], ids[later - k])), b.append(np.maximum(ids[later], ids[later - k])), agree.append(same)
            if a and sum(map(len, a)):
                a, b, agree = np.concatenate(a), np.concatenate(b), np.concatenate(agree)
                yield rows_of(a, b, agree, pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary()))
            # Regions that end in this batch are crowded if they have more rows than the neighbourhood reaches.
            tree, labels, ids = tree[old:], labels[old:], ids[old:]
            key = tree.astype(np.int64) << 48
            for k in range(CROWD_DEPTH):
                key |= labels[:, k].astype(np.int64) << (8 * k)
            edges = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for start, end in zip(edges, np.append(edges[1:], len(key))):
                if region is not None and region[0] != key[start]:
                    if border or region[1] > REACH + 1:
                        for part in region[2]:
                            yield crowd(*part)
                    region, border = None, False
                if region is None:
                    region = [key[start], 0, []]
                region[1] += end - start
                region[2].append((tree[start:end], labels[start:end], ids[start:end]))
                if region[1] > REACH + 1 and len(region[2]) > 4:  # crowded already
                    for part in region[2]:
                        yield crowd(*part)
                    region[2] = []
            kept = tree[-REACH:], labels[-REACH:], ids[-REACH:]
        if region is not None:
            for part in region[2]:
                yield crowd(*part)

    parts = max(forest.sparkSession.sparkContext.defaultParallelism, int(forest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = forest.repartitionByRange(parts, "tree", "label", "id").sortWithinPartitions("tree", "label", "id")
    return map_arrow(ordered, run, "a long, b long, agree int, tree int, label binary")


def only_ids(docs: DataFrame, ids: DataFrame, n_ids: int, how: str = "left_semi") -> DataFrame:
    """docs whose `id` is (or is not) among ids; few enough ids are broadcast, else both sides shuffle."""
    return docs.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, "id", how)


def _confirmed(pairs: DataFrame, n_pairs: int, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets satisfy 100 * intersection >= percent * union.

    Texts become sets where they lie, and a pair's two sets meet by one shuffle.
    """
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id"))
    asked = docs.join(F.broadcast(sides) if 2 * n_pairs <= BROADCAST_IDS else sides, "id").select("id", "a", "b", "text")

    def sets():
        last: list = [None, None, b""]

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(3)):
                value = text.as_py()
                if key != last[0] or value != last[1]:
                    last[:] = key, value, shingle_set(value).tobytes()
                out.append(last[2])
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.binary())], ["id", "a", "b", "shingles"])

        return one

    def compare():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) if z.is_valid else np.zeros(0, np.uint64) for z in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return one

    drawn = map_batches(asked, sets, "id long, a long, b long, shingles binary")
    side = lambda x: F.max(F.when(F.col("id") == F.col(x), F.col("shingles")))
    return map_batches(drawn.groupBy("a", "b").agg(side("a").alias("x"), side("b").alias("y")), compare, "a long, b long")


def _sets_of(docs: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """(id, shingles): the full sets of some documents, as packed hashes."""

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], ["id", "shingles"])

        return one

    return map_batches(only_ids(docs, ids, n_ids).select("id", "text"), make, "id long, shingles binary").dropDuplicates(["id"])


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of x with every one of y."""
    nx, ny = np.repeat(np.arange(len(x)), list(map(len, x))), np.repeat(np.arange(len(y)), list(map(len, y)))
    vx, vy = np.concatenate(x), np.concatenate(y)
    shared = np.intersect1d(vx, vy)
    out = np.zeros((len(x), len(y)), np.float32)
    for start in range(0, len(shared), 4096):  # dense products over some of the shared shingles
        some = shared[start : start + 4096]
        dense = []
        for rows, values, n in ((nx, vx, len(x)), (ny, vy, len(y))):
            at = np.minimum(np.searchsorted(some, values), len(some) - 1)
            hit = some[at] == values
            m = np.zeros((n, len(some)), np.float32)
            m[rows[hit], at[hit]] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def joining_links(ids: np.ndarray, comp: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], few: np.ndarray, least: float, percent: int) -> list[tuple[int, int]]:
    """Links of rows marked few with the others that join different components, as few as do."""
    xs, ys = np.flatnonzero(few), np.flatnonzero(~few)
    candidate = np.zeros((len(xs), len(ys)), bool)
    for k, i in enumerate(xs):
        candidate[k] = ((signatures[ys] == signatures[i]).mean(axis=1) >= least) & (comp[ys] != comp[i])
    xs, candidate = xs[candidate.any(axis=1)], candidate[candidate.any(axis=1)]
    ys, candidate = ys[candidate.any(axis=0)], candidate[:, candidate.any(axis=0)]
    if not candidate.size:
        return []
    both = common_counts([sets[i] for i in xs], [sets[i] for i in ys])
    size = np.array(list(map(len, sets)))
    linked = candidate & (100 * both >= percent * (size[xs][:, None] + size[ys][None, :] - both))
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    out = []
    for k, j in np.argwhere(linked):
        a, b = root(int(comp[xs[k]])), root(int(comp[ys[j]]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(ids[xs[k]]), int(ids[ys[j]])))
    return out


def _crowded(places: DataFrame, n_places: int, nodes: DataFrame, comps: DataFrame, n_comps: int, docs: DataFrame, least: float, percent: int) -> DataFrame:
    """Confirmed links (a, b) between components in regions beyond the neighbourhood's reach. places: (tree, label, id)."""
    of = comps.select(F.col("node").alias("id"), "component")
    placed = sized(places, n_places).join(F.broadcast(of) if n_comps <= BROADCAST_IDS else of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = placed.withColumn("prefix", F.substring("label", 1, CROWD_DEPTH))
    # There are at most places / CELL regions to split.
    large = placed.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > CELL).select("tree", "prefix", F.lit(True).alias("large"))
    large = F.broadcast(large) if n_places / CELL <= BROADCAST_IDS else large
    longer = F.substring("label", 1, min(16, deepest(percent)))
    placed = placed.join(large, ["tree", "prefix"], "left").withColumn("prefix", F.when(F.col("large"), longer).otherwise(F.col("prefix"))).drop("large", "label")
    parts = placed.groupBy("tree", "prefix", "component").agg(F.count("*").alias("n"))
    regions = parts.groupBy("tree", "prefix").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("component", "n").alias("main"))
    regions = regions.where(f"n > {REACH + 1} AND n > most")
    rows, seen = staged_with(placed.join(regions, ["tree", "prefix"]), "crowded")
    rows = sized(rows, seen["rows"])
    ids, n_ids = staged_with(rows.select("id").distinct(), "ids")
    sets = staged(_sets_of(docs, ids, n_ids["rows"]), "sets")
    bytes_of = rows.select("tree", "prefix", "id").join(sets.select("id", F.length("shingles").alias("size")), "id").groupBy("tree", "prefix").agg(F.sum("size").alias("bytes"))
    # There are fewer regions than rows, and with them broadcast no region's sets meet in one task but in its blocks.
    rows = rows.join(F.broadcast(bytes_of) if seen["rows"] <= BROADCAST_IDS else bytes_of, ["tree", "prefix"]).join(nodes.select("id", "signature").join(sets, "id"), "id")
    # A large set counts for several rows, so that a block is bounded in bytes but for one set.
    blocks = lambda n: F.greatest(F.ceil(n / CELL), F.ceil(F.col("bytes") / CELL_BYTES)).cast("int")
    n_all, n_few = blocks(F.col("n")), F.least(blocks(F.col("n") - F.col("most")), F.greatest(F.lit(1), (F.col("n") - F.col("most")).cast("int")))
    hashed = F.xxhash64("id")
    columns = ["tree", "prefix", "id", "component", "signature", "shingles"]
    # A row of the region is in one block of all; one outside the main component also in one block of the few.
    everyone = rows.select(*columns, F.lit(False).alias("few"), F.pmod(hashed, n_all).cast("int").alias("x"), F.explode(F.sequence(F.lit(0), n_few - 1)).alias("y"))
    others = rows.where("component != main").select(*columns, F.lit(True).alias("few"), F.explode(F.sequence(F.lit(0), n_all - 1)).alias("x"), F.pmod(hashed, n_few).cast("int").alias("y"))

    def compare(table: pa.Table) -> pa.Table:
        signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, PLACES)
        full = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        few = table.column("few").to_numpy(zero_copy_only=False).astype(bool)
        links = joining_links(table.column("id").to_numpy(), table.column("component").to_numpy(), signatures, full, few, least, percent)
        return pa.table([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], names=["a", "b"])

    return everyone.unionByName(others).groupBy("tree", "prefix", "x", "y").applyInArrow(compare, "a long, b long").distinct()


def near_copies(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs."""
    share, deviation = percent / 100, (percent / 100 * (1 - percent / 100)) ** 0.5
    least = share - SLACK * deviation / PLACES**0.5
    in_view = DEPTH * share - VIEW_SLACK * deviation * DEPTH**0.5
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    drawn = staged(sketch(docs, id_col, text_col), "sketch")
    sets = drawn.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep"), F.first("signature").alias("signature"))
    sets = staged(sets, "sets")
    nodes = sets.where("rep IS NOT NULL").select(F.col("rep").alias("id"), "signature")
    found = staged(_descend(_forest(nodes), in_view), "forest")
    pairs, seen = staged_with(found.where("a IS NOT NULL").groupBy("a", "b").agg(F.max("agree").alias("agree")), "pairs")
    pairs = sized(pairs, seen["rows"])
    places, n_places = staged_with(found.where("a IS NULL").select("tree", "label", F.col("b").alias("id")), "places")

    nearest = pairs.withColumn("k", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("agree"), "a"))).where(f"k <= {FIRST}")
    first, n_first = staged_with(nearest.select("a", "b"), "first")
    first = sized(first, n_first["rows"])
    links, n_links = staged_with(_confirmed(first, n_first["rows"], rows, percent), "links")
    links = sized(links, n_links["rows"])

    def joined(some: DataFrame) -> tuple[DataFrame, int]:
        comps, n_comps = staged_with(components(some), "components")
        return sized(comps, n_comps["rows"]), n_comps["rows"]

    comps, n_comps = joined(links)

    def between(candidates: DataFrame) -> DataFrame:
        """Those of different components."""
        of = lambda x: comps.select(F.col("node").alias(x), F.col("component").alias("c" + x))
        few = lambda df: F.broadcast(df) if n_comps <= BROADCAST_IDS else df
        both = candidates.select("a", "b").join(few(of("a")), "a", "left").join(few(of("b")), "b", "left")
        return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    stars = lambda: comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    second, n_second = staged_with(between(pairs).join(first, ["a", "b"], "left_anti"), "second")
    if n_second["rows"]:
        links, n_links = staged_with(_confirmed(sized(second, n_second["rows"]), n_second["rows"], rows, percent), "links")
        if n_links["rows"]:
            comps, n_comps = joined(stars().unionByName(sized(links, n_links["rows"])))
    if n_places["rows"]:
        third, n_third = staged_with(_crowded(places, n_places["rows"], nodes, comps, n_comps, rows, least, percent), "links")
        if n_third["rows"]:
            comps, n_comps = joined(stars().unionByName(sized(third, n_third["rows"])))

    rep = comps.withColumnRenamed("node", "rep")
    of_set = sets.join(F.broadcast(rep) if n_comps <= BROADCAST_IDS else rep, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = drawn.select("id", "n_shingles", "digest").join(of_set, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs, with docs' own columns, that are the first of their component, and those without an id."""
    gone, seen = staged_with(near_copies(docs, percent).where("NOT kept").select(F.col("doc_id").alias("id")).distinct(), "gone")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return only_ids(docs.select(row, F.col("doc_id").cast("long").alias("id")), gone, seen["rows"], "left_anti").select("_row.*")


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""
