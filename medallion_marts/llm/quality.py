"""Text quality by a byte-level convolutional network in numpy.

Filters of `WIDTH` bytes slide over the whole document; each is a learned table of weights
by byte value and place, with one more for the share of bytes that repeat what stood up to
`LAGS` bytes before. Rectified responses are max-pooled over chunks of 2 * `BLOCK` bytes that
overlap by half and together cover the document. The largest and the mean pooled response
of each filter over the chunks are combined by a logistic into one probability.

The network is trained by Adam on a bounded sample of labelled documents. For scoring, the
tables of neighbouring places are added up to tables by byte pair, and a response takes
three look-ups.

Defined results: a null text is scored like the empty one, which is one chunk of padding;
without labels every score is 0.5; ties, repeated rows and several labels of a document
are not special; a null id is never held out; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, map_batches

WIDTH, FILTERS, BLOCK, LAGS = 6, 16, 128, 24
#: About so many documents of each label are learned from, chosen by a hash of their id.
SAMPLE_PER_LABEL = 1200
#: Of longer documents a passage of so many characters is learned from, at a place chosen by a hash of
#: the id (they are scored whole); this bounds the sample in bytes.
MAX_LEARNED_CHARS = 20_000
EPOCHS, BATCH, RATE = 6, 32, 0.01
#: Bytes whose responses are held at once.
SLAB = 1 << 16


def repeats(text: np.ndarray) -> np.ndarray:
    """For each byte whether the 8 bytes from there also start 1 to LAGS bytes earlier."""
    n = len(text)
    out = np.zeros(n, bool)
    if n <= 8:
        return out
    key = np.lib.stride_tricks.sliding_window_view(text, 8)
    key = np.ascontiguousarray(key).view(np.uint64).ravel()
    for lag in range(1, min(LAGS, len(key) - 1) + 1):
        out[lag : len(key)] |= key[lag:] == key[:-lag]
    return out


@dataclass
class Model:
    taps: np.ndarray  # (WIDTH, 256, FILTERS)
    repeat: np.ndarray  # FILTERS
    bias: np.ndarray  # FILTERS
    head: np.ndarray  # 2 * FILTERS + 2: largest, mean, share of repeats, constant

    def pairs(self) -> list[np.ndarray]:
        both = [(self.taps[k][:, None, :] + self.taps[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]
        both[0] += self.bias
        return [b.astype(np.float32) for b in both]


def padded(text: bytes) -> np.ndarray:
    """At least one block, and WIDTH - 1 bytes after the last start, both of zeros."""
    n = max(1, -(-len(text) // BLOCK)) * BLOCK
    out = np.zeros(n + WIDTH - 1, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out


def block_maxima(text: np.ndarray, again: np.ndarray, pairs: list[np.ndarray], repeat: np.ndarray) -> np.ndarray:
    """(blocks, FILTERS): the largest response that starts in each block of BLOCK bytes."""
    n = len(text) - WIDTH + 1
    pair = text[:-1].astype(np.int32) << 8
    pair |= text[1:]
    out = np.empty((n // BLOCK, len(repeat)), np.float32)
    for start in range(0, n, SLAB):
        end = min(n, start + SLAB)
        response = pairs[0].take(pair[start:end], axis=0)
        for k in range(1, len(pairs)):
            response += pairs[k].take(pair[start + 2 * k : end + 2 * k], axis=0)
        response[again[start:end]] += repeat
        out[start // BLOCK : end // BLOCK] = response.reshape(-1, BLOCK, len(repeat)).max(axis=1)
    return np.maximum(out, 0)


def pooled(blocks: np.ndarray) -> np.ndarray:
    """Chunks are two neighbouring blocks; a single block is a chunk."""
    return np.maximum(blocks[1:], blocks[:-1]) if len(blocks) > 1 else blocks


class Scorer:
    def __init__(self, model: Model | None):
        self.model = model
        self.pairs = model.pairs() if model else None
        self.repeat = model.repeat.astype(np.float32) if model else None

    def __call__(self, text: str | None) -> float:
        if self.model is None:
            return 0.5
        b = padded((text or "").encode("utf-8", "replace"))
        n = len(b) - WIDTH + 1
        again = repeats(b[:n])
        chunks = pooled(block_maxima(b, again, self.pairs, self.repeat))
        x = np.concatenate([chunks.max(axis=0), chunks.mean(axis=0), [again.mean(), 1.0]])
        return float(1 / (1 + np.exp(-np.clip(x @ self.model.head, -30, 30))))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(seed)
    params = {
        "taps": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)),
        "repeat": rng.normal(0, 0.3, FILTERS),
        "bias": np.zeros(FILTERS),
        "head": np.concatenate([rng.normal(0, 0.1, 2 * FILTERS), [0.0, 0.0]]),
    }
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    data = [padded(t) for t in texts]
    again = [repeats(d[: len(d) - WIDTH + 1]) for d in data]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            grad = _gradient(params, [data[i] for i in chosen], [again[i] for i in chosen], labels[chosen])
            step += 1
            for k, g in grad.items():
                m, v = moment[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                params[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(**params)


def _gradient(params: dict, data: list, again: list, labels: np.ndarray) -> dict:
    """Of the mean log loss; a max passes its gradient to the place it came from."""
    taps, head = params["taps"].astype(np.float32), params["head"]
    f = taps.shape[2]
    columns = np.arange(f)
    grad = {k: np.zeros_like(v) for k, v in params.items()}
    flat = grad["taps"].reshape(-1)
    bytes_at, weight_at = [], []
    for text, rep, y in zip(data, again, labels):
        n = len(text) - WIDTH + 1
        response = np.tile(params["bias"].astype(np.float32), (n, 1))
        for k in range(WIDTH):
            response += taps[k].take(text[k : n + k], axis=0)
        response[rep] += params["repeat"].astype(np.float32)
        cut = response.reshape(-1, BLOCK, f)
        arg = cut.argmax(axis=1)  # (blocks, filters)
        best = np.take_along_axis(cut, arg[:, None, :], axis=1)[:, 0]
        place = arg + (np.arange(len(arg)) * BLOCK)[:, None]
        if len(best) > 1:
            left = best[:-1] >= best[1:]
            chunk, place = np.where(left, best[:-1], best[1:]), np.where(left, place[:-1], place[1:])
        else:
            chunk = best
        on = chunk > 0
        chunk = np.where(on, chunk, 0)
        top = chunk.argmax(axis=0)
        x = np.concatenate([chunk[top, columns], chunk.mean(axis=0), [rep.mean(), 1.0]])
        p = 1 / (1 + np.exp(-np.clip(x @ head, -30, 30)))
        d = (p - y) / len(data)
        grad["head"] += d * x
        g = np.tile(d * head[f : 2 * f] / len(chunk), (len(chunk), 1))
        g[top, columns] += d * head[:f]
        g *= on
        grad["bias"] += g.sum(axis=0)
        grad["repeat"] += (g * rep[place]).sum(axis=0)
        for k in range(WIDTH):
            bytes_at.append(((k * 256 + text[place + k].astype(np.int64)) * f + columns).ravel())
            weight_at.append(g.ravel())
    flat += np.bincount(np.concatenate(bytes_at), weights=np.concatenate(weight_at), minlength=len(flat))
    for k in ("taps", "repeat", "head"):
        grad[k] += 1e-4 * params[k]
    return grad


def learn(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """docs (doc_id, text), labels (doc_id, quality); None without labels."""
    given = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1) AND doc_id IS NOT NULL")
    sizes = {r["quality"]: r["count"] for r in given.groupBy("quality").count().collect()}
    if not sizes:
        return None
    share = F.when(F.col("quality") == 1, min(1.0, sample_per_label / sizes.get(1, 1))).otherwise(min(1.0, sample_per_label / sizes.get(0, 1)))
    chosen = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    places = F.greatest(F.length("text") - MAX_LEARNED_CHARS, F.lit(0)) + 1
    passage = F.substring("text", F.pmod(F.xxhash64("doc_id", F.lit("place")), places).cast("int") + 1, F.lit(MAX_LEARNED_CHARS))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", passage.alias("text")).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["text"] or ""))
    if not rows:
        return None
    model = train([(r["text"] or "").encode("utf-8", "replace") for r in rows], np.array([r["quality"] for r in rows], float))
    # The sample has as many of either label; the odds of all labelled rows come back in.
    drawn = {y: sum(r["quality"] == y for r in rows) for y in (0, 1)}
    if all(drawn.values()) and len(sizes) == 2:
        model.head[-1] += np.log(sizes[1] / drawn[1]) - np.log(sizes[0] / drawn[0])
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        of = Scorer(shared.value)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array([of(x.as_py()) for x in batch.column(1)], pa.float64())], [id_col, "score"])

        return one

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string"))
    return map_batches(rows, make, f"`{id_col}` long, score double")


def assess(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """Scores of all rows, learned from the labels of the folds that are not held out."""
    model = learn(docs, labels.where(id_remainder(F.col("doc_id"), modulus) != held_out))
    return score(docs, model).select("doc_id", (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
