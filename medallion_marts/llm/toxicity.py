"""Toxic spans by a linear-chain conditional random field (CRF).

Tags are 0 (fine) and 1 (toxic). Features of a token are its word, the word's first four, five
and six letters, and the words before and after it, each as far as it is surely likelier in
toxic labelled documents than in clean ones (copies count once); other tokens are plain. Labels
are those of documents: in a clean one every tag is 0, in a toxic one at least one is 1, which
one is hidden. The CRF maximises the likelihood of that by its exact gradient: forward-backward
with and without the condition. A document is scored over its whole chain: between tokens with
features the transfer matrix is raised to the number of plain tokens between them, so nothing is
cut off. The marginals of its tokens give the document's score through a logistic of their
largest, their sum and their density, and the offsets of tokens whose marginal is a half or more.

Defined results: a null text counts as empty, and an empty one is scored like one without
features, with the least score; without labels of both kinds every score is 0; ties and repeated
rows are scored alike; documents with several labels count once for each; a null id is
never held out; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, id_remainder, keep_rows, map_batches, staged

#: About so many documents of each label are learned from, chosen by a hash of their id.
SAMPLE_PER_LABEL = 4000
#: Features kept, those in most toxic documents first.
MAX_FEATURES = 5000
#: A feature is taken if it is in so many toxic documents at least and so many times likelier there, at the ends of
#: both rates' one-sided 90 % intervals that speak against it.
MIN_TOXIC, MIN_RATIO, Z = 3, 4.0, 1.28
#: Tokens on either side of one with features that go into a training window, and tokens of a window at most.
CONTEXT, LONGEST = 3, 8
WORD = r"[^\W\d_]+"
MEMO_ENTRIES = 200_000


def features(word: str) -> list[str]:
    """Of the word itself; "<" and ">" before it are features of the tokens after and before it."""
    return ["=" + word] + [word[:n] for n in (4, 5, 6) if len(word) > n]


def of_tokens(found: list[tuple | None]) -> dict[int, list]:
    """Place -> what it has, from (own, for the token after, for the token before) of each word or None."""
    out: dict[int, list] = {}
    for k, f in enumerate(found):
        if f is not None:
            for place, some in ((k, f[0]), (k + 1, f[1]), (k - 1, f[2])):
                if some and 0 <= place < len(found):
                    out.setdefault(place, []).extend(some)
    return out


@dataclass
class Model:
    weight: dict[str, float]
    bias: float
    transition: np.ndarray  # [from, to]
    logistic: np.ndarray  # for 1, largest marginal, log of 1 + sum, density

    def __post_init__(self):
        step = np.exp(self.transition) * np.array([1.0, np.exp(self.bias)])
        self.step = step / step.max()
        powers = [np.eye(2)]
        for _ in range(256):
            m = powers[-1] @ self.step
            powers.append(m / m.max())
        self.powers = np.array(powers)

    def parts(self, word: str) -> tuple | None:
        """Weights of the word's own features, and of those of the tokens after and before it."""
        w = self.weight
        out = [w[f] for f in features(word) if f in w], [w["<" + word]] if "<" + word in w else [], [w[">" + word]] if ">" + word in w else []
        return out if any(out) else None

    def power(self, n: int) -> np.ndarray:
        """The step matrix to the n, up to a factor: beyond 256 by squaring."""
        if n <= 256:
            return self.powers[n]
        half = self.power(n // 2)
        out = half @ half
        if n % 2:
            out = out @ self.step
        return out / out.max()

    def marginals(self, at: list[int], emission: list[float], length: int) -> np.ndarray:
        """P(tag 1) of the tokens at the given places, whose emissions exceed plain ones."""
        k = len(at)
        factor = np.ones((k, 2))
        factor[:, 1] = np.exp(np.clip(emission, -30, 30))
        forward, state, last = np.empty((k, 2)), np.array([1.0, 0.0]), -1
        for j, place in enumerate(at):  # the chain starts from tag 0 before the first token
            state = (state @ self.power(place - last)) * factor[j]
            state /= state.sum()
            forward[j], last = state, place
        backward = np.empty((k, 2))
        state, nxt = np.ones(2), length - 1
        for j in range(k - 1, -1, -1):
            state = self.power(nxt - at[j]) @ state
            state /= state.sum()
            backward[j] = state
            state, nxt = state * factor[j], at[j]
        both = forward * backward
        return both[:, 1] / both.sum(axis=1)

    def score(self, marginals: np.ndarray, length: int) -> float:
        total = marginals.sum()
        x = np.array([1.0, marginals.max() if len(marginals) else 0.0, np.log1p(total), total / max(1, length)])
        return float(1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30))))


def chain_likelihood(theta: np.ndarray, index: np.ndarray, mask: np.ndarray, doc: np.ndarray, toxic: np.ndarray, n_features: int, l2: float) -> tuple[float, np.ndarray]:
    """The log likelihood of the documents' labels, penalised, and its gradient.

    theta: weights, bias, transitions. index: (windows, tokens, slots) feature numbers, n_features
    for none; mask: (windows, tokens); doc: document of each window; toxic: label of each document.
    """
    n, length = mask.shape
    weights, bias, trans = np.append(theta[:n_features], 0.0), theta[n_features], theta[n_features + 1 :].reshape(2, 2)
    e = np.ones((n, length, 2))
    e[:, :, 1] = np.exp(np.clip(weights[index].sum(axis=2) + bias, -30, 30))
    e = np.where(mask[:, :, None], e, 1.0)
    step = np.exp(trans)
    alpha, before, state, log_z = np.empty((n, length, 2)), [], np.tile([1.0, 0.0], (n, 1)), np.zeros(n)
    for t in range(length):
        before.append(state)
        new = (state @ step) * e[:, t]
        total = new.sum(axis=1)
        log_z += np.where(mask[:, t], np.log(total), 0)
        state = np.where(mask[:, t, None], new / total[:, None], state)
        alpha[:, t] = state
    none = np.bincount(doc, weights=mask.sum(axis=1) * trans[0, 0] - log_z, minlength=len(toxic))  # log P(all tags are 0)
    none = np.minimum(none, -1e-9)
    some = -np.expm1(none)
    value = float(np.where(toxic, np.log(some), none).sum() - l2 / 2 * (theta**2).sum())
    # Given that a document is toxic its marginals are 1 / P(some) times as large; given that it is clean they are 0.
    scale, p_none = (1 / some)[doc], np.exp(none)[doc]
    of_toxic = toxic[doc].astype(bool)
    beta, marginal, g_trans = np.ones((n, 2)), np.zeros((n, length)), np.zeros((2, 2))
    zero = np.array([[1.0, 0.0], [0.0, 0.0]])
    for t in range(length - 1, -1, -1):
        both = alpha[:, t] * beta
        marginal[:, t] = both[:, 1] / both.sum(axis=1)
        pair = before[t][:, :, None] * step[None] * (e[:, t] * beta)[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        given = np.where(of_toxic[:, None, None], (pair - p_none[:, None, None] * zero) * scale[:, None, None], zero)
        g_trans += ((given - pair) * mask[:, t, None, None]).sum(axis=0)
        new = (e[:, t] * beta) @ step.T
        new /= new.sum(axis=1, keepdims=True)
        beta = np.where(mask[:, t, None], new, beta)
    rest = (np.where(of_toxic[:, None], marginal * scale[:, None], 0.0) - marginal) * mask
    grad = np.zeros_like(theta)
    grad[:n_features] = np.bincount(index.ravel(), weights=np.repeat(rest.ravel(), index.shape[2]), minlength=n_features + 1)[:n_features]
    grad[n_features] = rest.sum()
    grad[n_features + 1 :] = g_trans.ravel()
    return value, grad - l2 * theta


def fit_chain(index: np.ndarray, mask: np.ndarray, doc: np.ndarray, toxic: np.ndarray, start: np.ndarray, rounds: int = 100, l2: float = 0.5) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood by gradient steps with Adam, from `start` weights."""
    n_features = len(start)
    theta = np.concatenate([start, [-3.0], np.zeros(4)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        grad = chain_likelihood(theta, index, mask, doc, toxic, n_features, l2)[1]
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        theta = theta + 0.1 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return theta[:n_features], float(theta[n_features]), theta[n_features + 1 :].reshape(2, 2)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.05) -> np.ndarray:
    """Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - l2 * w)
    return w


def learn(docs: DataFrame, labels: DataFrame, sample_per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """docs (doc_id, text), labels (doc_id, toxic); None if either label is absent."""
    given = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    sizes = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, sample_per_label / sizes[1])).otherwise(min(1.0, sample_per_label / sizes[0]))
    chosen = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    sample = staged(sample.dropDuplicates(), "sample")  # a copied document's own words are no sign

    def count():
        import re

        words = re.compile(WORD).findall

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = (Counter(), Counter())
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                n[toxic].update({f for w in set(words(text.as_py().lower())) for f in features(w)})
                n[toxic][""] += 1
            names = [f for f in n[1]]  # a feature of no toxic document here may be one of another batch
            names += [f for f in n[0] if f not in n[1]]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[1][f] for f in names], pa.int64()), pa.array([n[0][f] for f in names], pa.int64())], ["feature", "toxic", "clean"])

        return one

    counted = map_batches(sample, count, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"toxic >= {MIN_TOXIC} OR feature = ''")
    whole = counted.where("feature = ''").first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return None
    sure = lambda c, sign: F.greatest(F.lit(0.0), F.col(c) + sign * Z * F.sqrt(c))
    ratio = sure("toxic", -1) / F.lit(whole["toxic"]) / ((sure("clean", 1) + 1) / F.lit(whole["clean"]))
    strong = counted.where("feature != ''").where(ratio >= MIN_RATIO).orderBy(F.desc("toxic"), "feature").limit(MAX_FEATURES)
    names = [r["feature"] for r in strong.select("feature").collect()]
    names += [side + f[1:] for f in names if f[0] == "=" for side in "<>"]
    number = {f: k for k, f in enumerate(names)}

    def compress():
        import re

        words = re.compile(WORD).findall

        def parts(w: str) -> tuple | None:
            out = [number[f] for f in features(w) if f in number], [number["<" + w]] if "<" + w in number else [], [number[">" + w]] if ">" + w in number else []
            return out if any(out) else None

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, found, length = [], [], []
            for text in batch.column(0):
                tokens = words(text.as_py().lower())
                hits = sorted(of_tokens(list(map(parts, tokens))).items())
                at.append([h[0] for h in hits]), found.append([h[1] for h in hits]), length.append(len(tokens))
            return pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.list_(pa.int32()))), pa.array(length, pa.int32()), batch.column(1)], ["at", "found", "length", "toxic"])

        return one

    rows = map_batches(sample, compress, "at array<int>, found array<array<int>>, length int, toxic int").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["toxic"], r["length"], r["at"], r["found"]))
    model = fit(names, rows)
    del rows
    give_back()
    return model


def windows(at: list[int], length: int) -> list[range]:
    """Stretches of at most LONGEST tokens that hold every token with features and those around it; without any, one in the middle."""
    out: list[list[int]] = []
    for c in at or ([length // 2] if length else []):
        a, b = max(0, c - CONTEXT), min(length, c + CONTEXT + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [range(k, min(b, k + LONGEST)) for a, b in out for k in range(a, b, LONGEST)]


def fit(names: list[str], rows: list[dict]) -> Model:
    """rows: places and feature numbers of the tokens with features, number of tokens, label."""
    slots = 8
    index, mask, doc = [], [], []
    for k, r in enumerate(rows):
        hits = dict(zip(r["at"], r["found"]))
        for span in windows(r["at"], r["length"]):
            empty = LONGEST - len(span)
            index.append([(hits.get(p, []) + [len(names)] * slots)[:slots] for p in span] + [[len(names)] * slots] * empty)
            mask.append([True] * len(span) + [False] * empty)
            doc.append(k)
    if not index:
        index, mask, doc = [[[len(names)] * slots] * LONGEST], [[False] * LONGEST], [0]
    toxic = np.array([r["toxic"] for r in rows])
    start = np.array([0.0 if f[0] in "<>" else 2.0 for f in names])
    has_window = np.bincount(doc, minlength=len(rows)) > 0
    number = np.cumsum(has_window) - 1  # documents without a token say nothing about the chain
    weights, bias, transition = fit_chain(np.array(index), np.array(mask), number[doc], toxic[has_window] if has_window.any() else toxic[:1], start)
    model = Model(dict(zip(names, weights.tolist())), bias, transition, np.zeros(4))
    x = []
    for r in rows:
        emission = [sum(weights[f] for f in found) for found in r["found"]]
        m = model.marginals(r["at"], emission, r["length"])
        x.append([1.0, m.max() if len(m) else 0.0, np.log1p(m.sum()), m.sum() / max(1, r["length"])])
    model.logistic = fit_logistic(np.array(x), toxic.astype(float))
    return model


class _Emissions(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> tuple | None:
        value = self.model.parts(word)
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def scorer(model: Model | None):
    """text -> (score, marginals of the tokens with features, their places among the tokens)."""
    import re

    words = re.compile(WORD).findall
    emissions = _Emissions(model) if model else None

    def score(text: str | None):
        if model is None:
            return 0.0, (), ()
        found = list(map(emissions.__getitem__, words((text or "").lower())))
        hits = of_tokens(found) if found.count(None) < len(found) else {}
        at = sorted(hits)
        m = model.marginals(at, [sum(hits[k]) for k in at], len(found)) if at else np.zeros(0)
        return model.score(m, len(found)), m, at

    return score


def tag(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_toxic, spans) for every row; spans are character offsets with their marginals."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        import re

        score, token = scorer(shared.value), re.compile(WORD).finditer

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, spans = [], []
            for value in batch.column(1):
                text = value.as_py()
                s, marginals, at = score(text)
                scores.append(s)
                bad = {k: float(m) for k, m in zip(at, marginals) if m >= 0.5}
                # Lower-casing may change a text's length; offsets are those in the text as given.
                spans.append([{"start": x.start(), "end": x.end(), "marginal": bad[k]} for k, x in enumerate(token(text or "")) if k in bad] if bad else [])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([len(x) for x in spans], pa.int32()), pa.array(spans, kind)], [id_col, "score", "n_toxic", "spans"])

        return one

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string"))
    return map_batches(rows, make, f"`{id_col}` long, score double, n_toxic int, spans array<struct<start:int,end:int,marginal:double>>")


def assess(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """Scores of all rows, learned from the labels of the folds that are not held out."""
    model = learn(docs, labels.where(id_remainder(F.col("doc_id"), modulus) != held_out))
    return tag(docs, model).select("doc_id", (id_remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_toxic", "spans")


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, with docs' own columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = scorer(shared.value)
        return lambda texts: [score(x.as_py())[0] < threshold for x in texts]

    return keep_rows(docs, make)
