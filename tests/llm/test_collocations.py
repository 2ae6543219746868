"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion_marts.llm import collocations as module


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", piece) if w] for piece in re.split("[.,;:!?\n-\r]", low)]


def expected(rows, least, top, swallowed=50):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in words_of(text):
            n[lang] += len(piece)
            for k in (1, 2, 3):
                f[lang].update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for p, a in counts.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and b >= least and 100 * b >= swallowed * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in counts.items()):
                continue
            score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def run(docs, **params):
    return sorted(tuple(r) for r in module.collocations(docs, **params).collect())


def invented(seed, n):
    rng = random.Random(seed)
    pool = ["The", "the", "cat", "sat", "ON", "mat", "é", "漢字", "x-y", "a"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", " \x0b", " "]
    return [(k, rng.choice(["en", "fr", None]), "".join(rng.choice(pool) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for k in range(n)]


SHAPE = "doc_id long, lang string, text string"


@pytest.mark.parametrize("size,shards", [(1 << 20, 4), (40, 4), (40, 1), (300, 16)])
def test_against_plain_counts(spark, monkeypatch, size, shards):
    monkeypatch.setattr(module, "SLICE", size)
    monkeypatch.setattr(module, "PENDING", 50)
    rows = invented(size, 120)
    assert run(spark.createDataFrame(rows, SHAPE).repartition(3), least=4, top=25, shards=shards) == expected(rows, 4, 25)


def test_a_full_bitmap_and_local_support_of_one(spark, monkeypatch):
    """Every phrase passes a bitmap of 64 bytes, and results stay; so they do with too many shares to broadcast."""
    rows = invented(7, 150)
    docs = spark.createDataFrame(rows, SHAPE)
    monkeypatch.setattr(module, "POSITIONS", 1 / 4096)
    monkeypatch.setattr(module, "MAX_SHARES", 0)
    assert run(docs, least=3, top=1000) == expected(rows, 3, 1000)


def test_shards_find_every_frequent_phrase(spark):
    """A phrase reaches, in some shard, its share of the support."""
    rng = np.random.default_rng(0)
    for _ in range(200):
        words, least = rng.integers(1, 1000, 4), int(rng.integers(2, 40))
        found = rng.multinomial(least, rng.dirichlet(np.ones(4)))
        assert any(n >= max(1, -(-least * w // words.sum())) for n, w in zip(found, words))


def test_words_of_one_hash(monkeypatch):
    """Bytes decide, not hashes."""
    monkeypatch.setattr(module.Words, "hashes", lambda self, seed: np.zeros(len(self.starts), np.uint64))
    words = next(module.slices(pa.array(["ab cd ab ef", "ab"]), 100))
    ids, first = module._Exact._ids(words, np.array([0, 1]))
    assert ids.tolist() == [0, 1, 0, 2, 3] and first.tolist() == [0, 1, 3, 4]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_slices_keep_words_and_pieces(size):
    texts = [None, "", "one two,three", "four", " five\tSix. seven  ", "é eight"]
    got, two, three = [], [], []
    for w in module.slices(pa.array(texts), size):
        text = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
        got += text[w.old :]
        two += [(text[k], text[k + 1]) for k in np.flatnonzero(w.two)]
        three += [tuple(text[k : k + 3]) for k in np.flatnonzero(w.three)]
    pieces = [p for t in texts for p in words_of(t)]
    assert got == [w for p in pieces for w in p]
    assert two == [x for p in pieces for x in zip(p, p[1:])] and three == [x for p in pieces for x in zip(p, p[1:], p[2:])]


def test_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", 1, "a", 3 * 10**15), ("en", 1, "b", 2 * 10**15), ("en", 2, "a b", 10**15 + 1)], "lang string, k int, phrase string, f long")
    assert module._scored(counts).first().score == 1_000_000 * (10**15 + 1) ** 2 // (6 * 10**30)


def test_odd_tables(spark):
    rows = [(1, None, None), (2, "en", ""), (None, "en", "a b a b a b"), (None, "en", "a b a b a b"), (3, "", "a a a a. a a"), (3, "", "a a a a. a a"), (4, "en", "w" * 50 + " " + "long text " * 30_000)]
    docs = spark.createDataFrame(rows, SHAPE).withColumns({"shard": F.lit("clash"), "lang_key": F.lit("x"), "need": F.lit(5), "n": F.lit(1), "a.b": F.lit(2), "phrase": F.lit("q")})
    assert run(docs, least=2) == expected(rows, 2, 2000)
    assert run(docs.limit(0)) == []
