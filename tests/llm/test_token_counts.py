"""Spliced counts against those of whole texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_marts.llm import token_counts

PARTS = ["a", "b", "the ", "  ", "\n", "'s", "'ll", "'", "!!", "<|endoftext|>", "<|endo", "漢字", "é", "\U0001f600", "123", "   \n\t", "x'sy", "…", " ", "aaaa", "ing", "\x00"]


def path(name="byte_bpe_50k.json"):
    import public_tokenizers as P

    return P.path(name)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path())
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def splicing():
    return token_counts.Counter(path(), chunk=150, overlap=20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(PARTS), st.sampled_from([1, 1, 2, 9, 40])), max_size=120))
def test_splices(library, splicing, parts):
    text = "".join(p * n for p, n in parts)
    assert splicing.of([text]) == [library(text)]


@pytest.mark.parametrize("text", ["a" * 3000, "!" * 3000, " " * 3000, "漢" * 2000, "\U0001f600" * 900, "<|endoftext|>" * 300, "\n" * 31 + "<|endoftext|>" * 40, "ab" * 900 + " " * 900])
def test_runs_widen_the_overlap(library, splicing, text):
    before = splicing.widened
    assert splicing.of([text]) == [library(text)]
    assert splicing.widened >= before


def test_overlaps_widen_when_nothing_aligns(library):
    counter = token_counts.Counter(path(), chunk=400, overlap=20)
    text = "\U0001f600" * 300 + "plain words " * 100
    assert counter.of([text]) == [library(text)] and counter.chunk < len(text)


def test_other_files_are_encoded_whole(spark, docs_of):
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["Hello there, you", "", None, "x " * 20_000]
    docs = docs_of(list(enumerate(texts)))
    word, piece = Tokenizer.from_file(path("word_bpe_49k.json")), sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for name, count in (("word_bpe_49k.json", lambda t: len(word.encode(t, add_special_tokens=False).ids)), ("piece_bpe_32k.model", lambda t: len(piece.encode(t)))):
        assert token_counts.Counter(path(name)).chunk is None
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path(name)).collect()}
        assert got == {k: count(t or "") for k, t in enumerate(texts)}


def test_odd_tables(spark, docs_of, library):
    long = " ".join(f"word{k} it's\n" for k in range(60_000)) + "<|endoftext|>"
    texts = [None, "", " ", "a", "a", long, "<|endoftext|>"]
    docs = docs_of([*enumerate(texts), (None, "x"), (3, "a")]).withColumns({"n_bytes": F.lit("clash"), "n_tokens": F.lit(1), "a.b": F.lit(2)})
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs, path()).where("doc_id IS NOT NULL").collect())
    want = sorted((k, len((t or "").encode()), library(t or ""), library(t or "") > 1024) for k, t in [*enumerate(texts), (3, "a")])
    assert got == want and len(long) > 10 * token_counts.CHUNK
    assert token_counts.count_tokens(docs.limit(0), path()).count() == 0
    assert token_counts.count_tokens(docs, path()).count() == len(texts) + 2
