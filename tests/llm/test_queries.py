"""The registered queries at the smallest scale against brute force over the whole tables."""

import hashlib
import math
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from compare import same  # noqa: E402

from medallion_marts.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def documents(spark, small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, small, name):
    same(QUERIES[name](spark, small), ORACLE_SQL[name], small)


def test_op1(spark, small, fold):
    small = small.replace("sf0.001", "sf0.01")  # 200 documents are too few to learn a language model from
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    counts = Counter()
    for i, text in documents:
        if fold(i, 5) != 1:
            counts.update([*(text or "").encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in QUERIES["op1_lm_score"](spark, small).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(i, 5) == 1, len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op2(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    got = {}
    for r in QUERIES["op2_nearest_vectors"](spark, small).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        found.sort()
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        best = np.lexsort((ids, -scores))[: min(20, len(ids) - 1)]
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert all(s == pytest.approx(scores[ids == v][0], abs=1e-12) for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(ids[best].tolist())) / len(best)
    assert hits / len(got) >= 0.9


def test_op2_recall(spark, small):
    """At 2,000 vectors: 0.95 of the true neighbours on average, and no query without most of them."""
    from medallion_marts.llm import permutation_index

    table = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = table.toPandas().sort_values("vec_id")
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    found = {}
    for r in permutation_index.search(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q, near in found.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        recall.append(len(near & set(ids[np.lexsort((ids, -scores))[:20]].tolist())) / 20)
    assert len(ids) >= 2000 and np.mean(recall) >= 0.94 and min(recall) >= 0.7


def _labels(spark, small, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{small}/labels.parquet").collect() if r[column] is not None}


def test_op3(spark, small, documents, fold):
    labels, got = _labels(spark, small, "toxic"), {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, small).collect()}
    text_of = dict(documents)
    assert set(got) == set(text_of)
    for i, r in got.items():
        assert r.held_out == (fold(i, 3) == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        for s in r.spans:
            assert text_of[i][s.start : s.end].isalpha()
    held = [(got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.85


def test_op4(spark, small, documents, fold):
    labels, got = _labels(spark, small, "quality"), {r.doc_id: r for r in QUERIES["op4_quality"](spark, small).collect()}
    assert set(got) == {i for i, _ in documents}
    for i, r in got.items():
        assert r.held_out == (fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    ranks = sorted((got[i].score, y) for i, y in labels.items())
    ones = [k for k, (_, y) in enumerate(ranks) if y]
    zeros = len(ranks) - len(ones)
    assert (sum(ones) - len(ones) * (len(ones) - 1) / 2) / (len(ones) * zeros) > 0.9  # area under the curve


def test_op7(spark, small, documents):
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, small).collect()}
    for i, text in documents:
        ids = t.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_op9(spark, small, documents, fold):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, small).collect()}
    assert set(got) == set(lang)
    held = [got[i].lang_pred == lang[i] for i in lang if fold(i, 5) == 0]
    assert all(got[i].held_out == (fold(i, 5) == 0) for i in lang) and sum(held) / len(held) > 0.95


def check_packing(pieces, expected_ids):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(expected_ids)
    for i, ids in expected_ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding


def test_op10(spark, small, documents):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {i: [*t.encode(text or "", add_special_tokens=False).ids, 0] for i, text in documents}
    assert check_packing(QUERIES["op10_packing"](spark, small).collect(), ids) == 0


def test_pipeline(spark, small):
    """Each stage on its own input: what it must drop, and that the columns stay."""
    small = small.replace("sf0.001", "sf0.01")  # the smallest tables hold too few toxic documents to learn from
    import corpus_pipeline

    from medallion_marts.llm import near_dedup

    docs = spark.read.parquet(f"{small}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language_id", "exact_dedup", "near_dedup", "packing"]
    toxic = _labels(spark, small, "toxic")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, small).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after.items()) <= set(before.items()) and docs.count() == len(after)
        gone = set(before) - set(after)
        if name == "toxicity":
            assert sum(toxic.get(i) == 0 for i in gone) <= 1 and sum(toxic.get(i) == 1 for i in gone) > 0
        elif name == "language_id":
            assert all(not any(ch.isalpha() for ch in before[i] or "") for i in gone)
        elif name == "exact_dedup":
            last = {text: i for i, text in sorted(before.items())}
            assert set(after) == set(last.values())
        else:
            sets = {i: set(near_dedup.shingle_set(text).tolist()) for i, text in before.items()}
            parent = {i: i for i in sets}

            def root(i):
                while parent[i] != i:
                    i = parent[i]
                return i

            order = sorted(sets)
            for k, a in enumerate(order):
                for b in order[k + 1 :]:
                    both = len(sets[a] & sets[b])
                    if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((root(a), root(b)))
                        parent[y] = x
            assert set(after) == {root(i) for i in sets}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)


def test_op12(spark, small, documents):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_token_counts"](spark, small).collect()}
    assert set(got) == {i for i, _ in documents}
    for i, text in documents:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == (i, len((text or "").encode()), n, n > 1024)
