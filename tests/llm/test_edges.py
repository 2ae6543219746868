"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion_marts.llm import bpe, context_mixing, exact_dedup, language_id, near_dedup, packing, permutation_index, quality, toxicity
from medallion_marts.llm.graph import components

WORDS = "the of and ther ing tion ed es st en at on re nd or ti ha he".split()


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "x"), (5, prose(1)), (5, prose(1)), (None, prose(1)), (7, "123 !!"), (8, prose(2) * 60), (9, "é漢字 \U0001f600" * 50), (10, " \x00 a\x0bb")]


@pytest.fixture(scope="module")
def odd(docs_of):
    return docs_of(ODD).withColumns({"id": F.lit("clash"), "row": F.lit(1), "part": F.lit(2), "_digest": F.lit("d"), "score": F.lit(0.5), "a": F.lit(1), "_bits": F.lit(1)})


@pytest.fixture(scope="module")
def none(docs_of):
    return docs_of([])


LABELS = "doc_id long, quality int, toxic int"


def paths():
    import public_tokenizers as P

    return P


def test_exact_dedup(odd, none, docs_of):
    assert exact_dedup.find_copies(none).count() == exact_dedup.drop_copies(none).count() == 0
    got = [tuple(r) for r in exact_dedup.find_copies(odd).select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert len(got) == len(ODD)
    assert sorted(r[1:] for r in got if r[0] == 5) == [(5, 3, True)] * 2 and (None, 5, 3, False) in got
    assert (1, 2, 2, False) in got and (2, 2, 2, True) in got and (4, 4, 1, True) in got
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7, 8, 9, 10]
    only_null = exact_dedup.find_copies(docs_of([(None, "q"), (None, "q")]))
    assert [tuple(r)[1:4] for r in only_null.collect()] == [(None, 2, True)] * 2


def test_exact_dedup_with_a_full_filter(odd, docs_of, monkeypatch):
    """A filter too small for its rows sends them all the long way; results stay."""
    many = docs_of([(k, f"text {k % 700}") for k in range(1000)])
    before = [sorted(map(str, f(df).collect())) for f in (exact_dedup.find_copies, exact_dedup.drop_copies) for df in (odd, many)]
    monkeypatch.setattr(exact_dedup, "FILTER_BYTES", 1)
    assert [sorted(map(str, f(df).collect())) for f in (exact_dedup.find_copies, exact_dedup.drop_copies) for df in (odd, many)] == before


def test_exact_dedup_moves_no_texts_and_no_python(docs_of):
    """No Python in the plans; what finds copies never shuffles a text, and what drops them only rows of the second filter."""
    docs = docs_of([(k, f"text {k % 700}") for k in range(1000)])
    for df, allowed in ((exact_dedup.find_copies(docs), 0), (exact_dedup.drop_copies(docs), 2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        inner = df._jdf.queryExecution().optimizedPlan().toString()
        assert inner.count("_maybe") > 0
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert sum("text" in line for line in shuffled) <= allowed


def test_bpe(odd, none):
    P = paths()
    run = lambda df: bpe.encode_and_decode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True)
    assert run(none).count() == 0
    got = run(odd).collect()
    assert len(got) == len(ODD) and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    _, _, encoder = bpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = {i: t for i, t in ODD}
    for r in got:
        assert encoder.decode(r.ids) == (texts[r.doc_id] or "").encode()


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60) | st.text("aeinrst hT'!", max_size=60).map(str.encode))
def test_bpe_merges(data):
    import tiktoken

    P = paths()
    _, _, encoder = bpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    t = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    assert encoder.encode(data) == (t._core_bpe.encode_single_piece(data) if data else [])


def test_packing(odd, none):
    path = paths().path("byte_bpe_50k.json")
    assert packing.pack(none, path).count() == 0
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    pieces = packing.pack(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), path).collect()
    from test_queries import check_packing

    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in ODD if i is not None}
    assert check_packing(pieces, ids) == 0 and len(ids[1]) == 1
    assert packing.pack(odd, path).count() >= len(ODD)


def test_packing_special_strings():
    ids = packing.ids_of(paths().path("byte_bpe_50k.json"))
    assert ids.merge is not None
    for text in ("a<|endoftext|>b", "漢字 x", "plain text's", "  two  spaces \n\n ends ", "é\u00a0ñ\x1c\x85x 12½ _a", "!?" * 400_000, "", " "):
        assert np.frombuffer(ids.of(text), np.uint32).tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(1, 6))
def test_sum_of_squares(sizes, max_open):
    packer = packing.Packer(0, window=16, max_open=max_open)
    for k, n in enumerate(sizes):
        packer.add(k, np.arange(n, dtype=np.uint32).tobytes())
        assert packer.levels.n_open <= max_open
    packer.finish()
    filled, of = {}, {}
    for doc, start, length, _, total, sequence, offset in packer.rows:
        assert offset == filled.get(sequence, 0) and total == sizes[doc]
        filled[sequence] = offset + length
        of.setdefault(doc, []).append((start, length))
    assert sum(filled.values()) == sum(sizes) and all(n == 16 or n & (n - 1) == 0 for n in filled.values())
    for doc, pieces in of.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == sizes[doc]


def test_windows_close_by_the_rule():
    """Most windows of rests are filled by the rule, as documents come; cuts come last, and are counted apart."""
    rng = np.random.default_rng(0)
    for docs, open_share, cut_share in ((300, 1, 3), (2000, 0.4, 0.8), (20_000, 0.1, 0.06)):
        packer = packing.Packer(0)
        sizes = np.minimum(5000, rng.lognormal(6.3, 0.9, docs)).astype(int) + 1
        for k, n in enumerate(sizes):
            packer.add(k, np.zeros(n, np.uint32).tobytes())
        assert packer.cuts == packer.by_cut == 0 and packer.levels.n_open < open_share * docs
        packer.again()
        packer.finish()
        rests = int((sizes % packing.WINDOW).sum())
        assert packing.WINDOW * (packer.by_rule + packer.by_cut) + packer.last == rests and packer.last < packing.WINDOW
        assert packer.by_cut < cut_share * packer.by_rule and packer.cuts < 0.5 * docs


def test_second_step_packs_what_tasks_leave(spark, docs_of):
    """Windows are full but for the last ones, though every task leaves many open, and each id is in one piece."""
    from test_queries import check_packing

    path = paths().path("byte_bpe_50k.json")
    texts = [(k, prose(k, 20 + 13 * k % 400)) for k in range(400)]
    pieces = packing.pack(docs_of(texts).repartition(16, "doc_id"), path).collect()
    ids = packing.ids_of(path)
    assert check_packing(pieces, {k: [*np.frombuffer(ids.of(t), np.uint32).tolist(), 0] for k, t in texts}) == 0
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert sum(n < packing.WINDOW for n in filled.values()) <= 10


def test_cuts_fill_two_levels():
    levels = packing.Levels(10)
    for level, n in ((6, 1), (8, 2), (9, 2)):
        levels.count[level] = n
    assert levels.to_fill(6) == 8  # 2 and the rest of 4 fill both
    assert levels.to_fill(7) == 9  # no two are filled; of two crowds the fuller


def test_sum_of_squares_choice():
    levels = packing.Levels(10)
    for level, n in ((3, 3), (6, 1)):
        levels.count[level] = n
    brute = lambda size: min((sum(c * c for c in after(levels.count, h, size)), -h) for h in (0, 3, 6) if h + size <= 10)

    def after(count, h, size):
        c = count[1:10].tolist()
        if h:
            c[h - 1] -= 1
        if h + size < 10:
            c[h + size - 1] += 1
        return c

    for size in range(1, 10):
        assert levels.choose(size) == -brute(size)[1]


def test_filters_keep_rows_with_any_columns(odd, docs_of):
    """Names with dots, and ones that the filters use themselves."""
    docs = odd.withColumns({"a.b": F.lit(1), "_row": F.lit(2), "`q`": F.lit(3), "_text": F.lit(4)})
    for keep in (lambda d: toxicity.keep_clean(d, None), lambda d: language_id.keep_identified(d, None)):
        kept = keep(docs)
        assert kept.columns == docs.columns and 0 < kept.count() <= len(ODD)
        assert keep(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in language_id.keep_identified(docs, None).where("doc_id IS NOT NULL").collect()) == [4, 5, 5, 8, 9, 10]


def test_near_dedup(odd, none, docs_of):
    assert near_dedup.near_copies(none).count() == near_dedup.drop_near_copies(none).count() == 0
    got = [tuple(r) for r in near_dedup.near_copies(odd).collect()]
    assert len(got) == len(ODD)
    assert {r[0]: r[1:] for r in got if r[0] in (1, 2, 3)} == {i: (0, i, True) for i in (1, 2, 3)}
    assert {r[1:] for r in got if r[0] == 4} == {(1, 4, True)}
    assert [r[2:] for r in got if r[0] is None] == [(5, False)]
    assert near_dedup.drop_near_copies(odd).columns == odd.columns
    edited = prose(5).split()
    edited[60] = "changed"
    twins = docs_of([(11, prose(5)), (12, " ".join(edited)), (13, prose(6)), (14, prose(5).upper().replace(" ", "\n"))])
    assert sorted((r.doc_id, r.component_id) for r in near_dedup.near_copies(twins).collect()) == [(11, 11), (12, 11), (13, 13), (14, 11)]


def test_near_dedup_crowded_region(docs_of, monkeypatch):
    """A chain of near copies among many somewhat similar texts, with a reach of one neighbour."""
    monkeypatch.setattr(near_dedup, "REACH", 1)
    monkeypatch.setattr(near_dedup, "CELL", 16)
    rng, rows = random.Random(3), []
    common = prose(9, 300).split()
    for k in range(60):
        words = list(common)
        for at in rng.sample(range(300), 8):
            words[at] = f"w{k}x{at}"
        rows.append((k, " ".join(words)))
    sets = {i: set(near_dedup.shingle_set(t).tolist()) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {(r.doc_id, r.component_id) for r in near_dedup.near_copies(docs_of(rows), 80).collect()} == {(i, root(i)) for i in sets}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "cc", " ", "\n", " ", "é", "\x1c", "\x0b"]), max_size=40).map("".join))
def test_words_are_split_at_ascii_space(text):
    words = text.encode().lower().split()
    got = near_dedup.word_hashes(text.encode())
    assert len(got) == len(words)
    same = {}
    assert all(same.setdefault(w, h) == h for w, h in zip(words, got.tolist())) and len(set(got.tolist())) == len(set(words))


def test_long_texts_hash_alike(monkeypatch):
    text = (prose(4, 4000) + " " + "y" * 5000 + " " + prose(5, 400)).encode()
    whole = near_dedup.word_hashes(text)
    monkeypatch.setattr(near_dedup, "_SEGMENT", 1000)
    assert (near_dedup.word_hashes(text) == whole).all()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, edges):
    parent = list(range(13))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    nodes = {i for a, b in edges if a != b for i in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((i, root(i)) for i in nodes)


def test_permutation_index(spark):
    kind = "vec_id long, embedding array<float>, label int, id int"
    run = lambda rows, **more: [tuple(r) for r in permutation_index.search(spark.createDataFrame(rows, kind), **more).orderBy("query_id", "rank").collect()]
    assert run([]) == []
    v = lambda i, x: (i, x, 0, 1)
    bad = [v(40, None), v(60, [0.0, 0.0]), v(80, [1.0, None]), v(100, [float("nan"), 1.0]), v(120, [float("inf"), 1.0]), v(140, [1.0]), v(None, [1.0, 1.0]), v(160, [])]
    rows = [v(20, [1.0, 0.0]), v(1, [2.0, 0.0]), v(2, [2.0, 0.0]), v(2, [2.0, 0.0]), v(3, [-1.0, 5.0])]
    assert run(bad + rows) == [(20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 3, -1.0)]
    assert run([v(20, [1.0, 0.0])]) == []


def test_permutation_index_crowd(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16))
    x[:400] = x[0] + 0.01 * rng.normal(size=(400, 16))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in permutation_index.search(df, block=300, query_block=20, least=64).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 900, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-s)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(1)
    order = np.array([rng.permutation(12)[:5] for _ in range(50)])
    block = permutation_index.Block(*permutation_index.Block.pack(np.arange(50), rng.normal(size=(50, 3)), order, 12))
    place = np.full((50, 12), 5)
    np.put_along_axis(place, order, np.arange(5)[None].repeat(50, 0), 1)
    query = np.full(12, 5)
    query[order[7]] = np.arange(5)
    footrule = np.abs(place - query).sum(axis=1)
    near = block.near(order[7], 10)
    assert 7 in near and footrule[near].max() <= np.sort(footrule)[len(near) - 1]


def test_language_id(odd, none, docs_of):
    assert language_id.identify(none).count() == 0
    got = language_id.identify(odd).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 7)} == {"und"} and {r.lang_pred for r in got if r.doc_id in (5, 8)} == {"en"}
    nothing = docs_of([(1, "abc"), (2, None)], lang=None)
    assert {(r.lang_pred, r.score) for r in language_id.identify(nothing).collect()} == {("und", 0.0)}


def test_ppm_code_lengths():
    """Against a plain recursion over counts."""
    text = b"abracadabra abra cadabra"
    padded = b"\0\0\0" + text
    grams = np.array([list(padded[k : k + 4]) for k in range(len(text))])
    m = language_id.build(grams, np.zeros(len(grams), int), np.ones(len(grams)), ["x"])

    def p(context, byte):
        after = [text[k] for k in range(len(text)) if padded[k + 3 - len(context) : k + 3] == context]
        lower = p(context[1:], byte) if context else 1 / 256
        if not after:
            return lower
        distinct = len(set(after))
        return after.count(byte) / (len(after) + distinct) if byte in after else distinct / (len(after) + distinct) * lower

    for sample in (text, b"abba cab", b"a"):
        q = b"\0\0\0" + sample
        assert m.bits(sample)[0] == pytest.approx(-sum(np.log2(p(q[k : k + 3], sample[k])) for k in range(len(sample))), rel=1e-4)


def test_ppm_many_languages_and_long_texts(monkeypatch):
    """Each of many languages has the code lengths that it has alone, also over slabs and for bytes of all values."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(k, 256, 300, dtype=np.uint8)) for k in range(250)]
    grams = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"\0\0\0" + t, np.uint8), 4) for t in texts])
    of = np.repeat(np.arange(250), 300)
    together = language_id.build(grams, of, np.ones(len(grams)), [f"l{k:03}" for k in range(250)])
    text = texts[0] + texts[200] * 3 + b"\xff"
    bits = together.bits(text)
    for k in (0, 7, 200, 249):
        alone = language_id.build(grams[of == k], np.zeros(300, int), np.ones(300), ["x"])
        assert alone.bits(text)[0] == pytest.approx(bits[k], rel=1e-9)
        assert int(np.argmin(together.bits(texts[k]))) == k
    monkeypatch.setattr(language_id, "SLAB", 7)
    assert together.bits(text) == pytest.approx(bits, rel=1e-9) and together.bits(b"") == pytest.approx(0)


def test_toxicity(spark, odd, none, docs_of):
    no_labels = spark.createDataFrame([], LABELS)
    assert toxicity.assess(none, no_labels).count() == 0
    assert {r.score for r in toxicity.assess(odd, no_labels).collect()} == {0.0}
    rows = [(i, prose(i, 60) + (" you idiot moron" if i % 2 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows] + [(None, 1, 1), (3, None, None)], LABELS)
    model = toxicity.learn(docs_of(rows), labels)
    got = {r.doc_id: r for r in toxicity.tag(docs_of([(1, prose(99)), (2, "What an IDIOT! You idiot moron"), (3, None), (4, "")]), model).collect()}
    assert got[2].score > 0.7 > 0.5 > max(got[i].score for i in (1, 3, 4))
    assert {(8, 13), (19, 24), (25, 30)} <= {(s.start, s.end) for s in got[2].spans}
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_crf_marginals():
    """Jumping over plain tokens gives the marginals of the whole chain."""
    m = toxicity.Model({}, -2.0, np.array([[0.3, -0.5], [0.1, 0.8]]), np.zeros(4))
    length, at, emission = 700, [0, 3, 4, 400, 699], [1.5, -0.7, 3.0, 2.0, 0.5]
    e = np.ones((length, 2))
    e[:, 1] = np.exp(-2.0)
    for k, x in zip(at, emission):
        e[k, 1] *= np.exp(x)
    step = np.exp(m.transition)
    alpha, state = np.empty((length, 2)), np.array([1.0, 0.0])
    for t in range(length):
        state = (state @ step) * e[t]
        state /= state.sum()
        alpha[t] = state
    beta, marginal = np.ones(2), np.empty(length)
    for t in range(length - 1, -1, -1):
        both = alpha[t] * beta
        marginal[t] = both[1] / both.sum()
        beta = step @ (e[t] * beta)
        beta /= beta.sum()
    assert m.marginals(at, emission, length) == pytest.approx(marginal[at], rel=1e-6)


def test_crf_gradient():
    """The gradient of the likelihood of documents' labels, by differences; and the likelihood by all taggings."""
    rng = np.random.default_rng(4)
    n, length, k = 5, 4, 3
    index, mask = rng.integers(0, k + 1, (n, length, 2)), np.array([[True] * 4, [True] * 3 + [False], [True] * 4, [True] + [False] * 3, [True] * 4])
    doc, toxic = np.array([0, 0, 1, 2, 3]), np.array([1, 0, 1, 0])
    theta = rng.normal(size=k + 5)
    value, grad = toxicity.chain_likelihood(theta, index, mask, doc, toxic, k, 0.3)
    import itertools

    w, trans = np.append(theta[:k], 0.0), theta[k + 1 :].reshape(2, 2)
    log_none = np.zeros(4)
    for i in range(n):
        m = int(mask[i].sum())
        score = lambda tags: sum(trans[a, b] + b * (w[index[i, t]].sum() + theta[k]) for t, (a, b) in enumerate(zip((0, *tags), tags)))  # noqa: E731, B023
        log_none[doc[i]] += score((0,) * m) - np.log(sum(np.exp(score(tags)) for tags in itertools.product((0, 1), repeat=m)))
    expected = sum(np.log(1 - np.exp(x)) if y else x for x, y in zip(log_none, toxic)) - 0.15 * (theta**2).sum()
    assert value == pytest.approx(expected)
    for j in range(len(theta)):
        up, down = theta.copy(), theta.copy()
        up[j] += 1e-6
        down[j] -= 1e-6
        slope = (toxicity.chain_likelihood(up, index, mask, doc, toxic, k, 0.3)[0] - toxicity.chain_likelihood(down, index, mask, doc, toxic, k, 0.3)[0]) / 2e-6
        assert slope == pytest.approx(grad[j], abs=1e-5)


def test_toxicity_windows_hold_every_hit():
    rng = random.Random(2)
    for length in (1, 5, 60, 4000):
        at = sorted(rng.sample(range(length), min(length, 50)))
        spans = toxicity.windows(at, length)
        places = [p for s in spans for p in s]
        assert len(places) == len(set(places)) and set(at) <= set(places) <= set(range(length)) and max(map(len, spans)) <= toxicity.LONGEST
    assert toxicity.windows([], 0) == []


def test_toxic_span_in_a_very_long_text(spark, docs_of):
    rows = [(i, prose(i, 60) + (" you idiot moron" if i % 2 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], LABELS)
    model = toxicity.learn(docs_of(rows), labels)
    text = prose(7, 30_000) + " you idiot moron " + prose(8, 30_000)
    got = {r.doc_id: r for r in toxicity.tag(docs_of([(1, text), (2, prose(7, 30_000)), (3, ""), (4, "qq")]), model).collect()}
    assert got[1].n_toxic >= 1 and text[got[1].spans[0].start : got[1].spans[-1].end].split()[-1] == "moron" and got[1].score > got[2].score
    assert got[3].score == got[4].score > 0


def test_quality(spark, odd, none, docs_of):
    no_labels = spark.createDataFrame([], LABELS)
    assert quality.assess(none, no_labels).count() == 0
    assert {r.score for r in quality.assess(odd, no_labels).collect()} == {0.5}
    rows = [(i, prose(i, 60) if i % 2 else prose(i, 60).replace(" ", "%%% ")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    model = quality.learn(docs_of(rows), labels)
    got = {r.doc_id: r.score for r in quality.score(docs_of([(1, prose(99)), (2, prose(98).replace(" ", "%%% ")), (3, None), (4, "")]), model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4]


def test_quality_learns_from_long_texts(spark, docs_of):
    long = docs_of([(i, (prose(i, 60) if i % 2 else prose(i, 60).replace(" ", "%%% ")) * 100) for i in range(120)] + [(200, None), (201, "")])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], LABELS)
    of_long = {r.doc_id: r.score for r in quality.score(long, quality.learn(long, labels)).collect()}
    assert min(of_long[i] for i in range(1, 120, 2)) > 0.5 > max(of_long[i] for i in range(0, 120, 2))


def test_convolution_and_gradient():
    model = quality.train([prose(k, 40).encode() for k in range(6)] + [b"x" * 300] * 6, np.array([1.0] * 6 + [0.0] * 6), epochs=2)
    text = prose(3, 90)
    b = quality.padded(text.encode())
    n = len(b) - quality.WIDTH + 1
    again = quality.repeats(b[:n])
    response = np.array([model.bias + sum(model.taps[k, b[i + k]] for k in range(quality.WIDTH)) + model.repeat * again[i] for i in range(n)])
    blocks = np.maximum(response.reshape(-1, quality.BLOCK, quality.FILTERS).max(axis=1), 0)
    chunks = np.maximum(blocks[1:], blocks[:-1])
    x = np.concatenate([chunks.max(axis=0), chunks.mean(axis=0), [again.mean(), 1.0]])
    assert quality.Scorer(model)(text) == pytest.approx(1 / (1 + np.exp(-x @ model.head)), rel=1e-4)
    params = {"taps": model.taps.copy(), "repeat": model.repeat.copy(), "bias": model.bias.copy(), "head": model.head.copy()}
    data = [b]

    def loss():
        p = quality.Scorer(quality.Model(**params))(text)
        return -np.log(p)

    grad = quality._gradient(params, data, [again], np.array([1.0]))
    for name in ("head", "bias"):
        k = int(np.argmax(np.abs(grad[name])))
        params[name][k] += 1e-3
        up = loss()
        params[name][k] -= 2e-3
        down = loss()
        params[name][k] += 1e-3
        assert (up - down) / 2e-3 == pytest.approx(grad[name][k], rel=0.05, abs=1e-3)


def test_context_mixing(odd, none):
    assert context_mixing.assess(none).count() == 0
    got = context_mixing.assess(odd).collect()
    assert len(got) == len(ODD)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1} and all(r.score <= 0 and r.base_score < 0 for r in got)
    assert len({round(r.score, 9) for r in got if r.doc_id in (1, 2)}) == 1


def test_probabilities_sum_to_one():
    """Over all next bytes and the end, after any beginning."""
    from test_context_mixing import bit_by_bit, model_of

    texts = [prose(k, 50).encode() for k in range(12)]
    m = model_of(texts)
    start = texts[0][:40]
    assert context_mixing.all_bits([start], m)[0] == pytest.approx(bit_by_bit(start, m), rel=1e-4)

    def first_bits(data, n):
        """Bits of the first n bytes alone."""
        laid = context_mixing.lay_out([(data, False)])
        i = context_mixing.inputs(laid, m)
        signed = np.clip((m.weights[:, i.gate] * i.x).sum(axis=0), -16, 16)
        return np.log2(1 + np.exp(-signed.astype(float)))[: i.first[n]].sum() + 8 * i.escapes[:n].sum()

    def end_bits():
        laid = context_mixing.lay_out([(start, True)])
        i = context_mixing.inputs(laid, m)
        signed = np.clip((m.weights[:, i.gate] * i.x).sum(axis=0), -16, 16)
        return np.log2(1 + np.exp(-signed.astype(float)))[i.first[40] :].sum()

    before = first_bits(start + b"q", 40)
    total = sum(2 ** -(first_bits(start + bytes([b]), 41) - before) for b in range(256)) + 2 ** -end_bits()
    # Bytes with a symbol of their own leave their share of the escape unused.
    escape = 2 ** -(first_bits(start + b"\x01", 41) - before)
    assert total + escape * (m.coding.n - 2) == pytest.approx(1, rel=1e-3)


def test_long_text_is_scored_in_pieces(monkeypatch):
    from test_context_mixing import model_of

    texts = [prose(k, 50).encode() for k in range(6)]
    m = model_of(texts)
    whole = context_mixing.all_bits([texts[0] * 20, b"", texts[1]], m)
    monkeypatch.setattr(context_mixing, "GROUP", 10)
    assert context_mixing.all_bits([texts[0] * 20, b"", texts[1]], m) == pytest.approx(whole)


def test_huffman():
    paths_ = context_mixing.huffman([5, 1, 1, 3])
    assert [len(p) for p in paths_] == [1, 3, 3, 2]
    assert len({tuple(p) for p in paths_}) == 4


def test_pipeline_with_odd_tables(odd, none, small):
    """Every stage, one after another: nulls, empty and repeated rows, columns of any names, and no rows at all."""
    import corpus_pipeline

    spark = odd.sparkSession
    for docs, least in ((odd.withColumns({"a.b": F.lit(1), "_row": F.lit(2), "_digest": F.lit("x")}), 4), (none, 0), (odd.where("text IS NULL"), 0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns == columns, name
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() >= least and not docs.where("text IS NULL").count()
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small)
        assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_language_ties_go_to_one_language(docs_of):
    """Two languages learned from the same texts have equal code lengths: the least name is told, with half of the certainty."""
    rows = [(k, prose(k, 60)) for k in range(40)]
    docs = docs_of(rows, "bb").unionByName(docs_of([(100 + k, t) for k, t in rows], "aa"))
    got = language_id.predict(docs, language_id.learn(docs)).collect()
    assert {r.lang_pred for r in got} == {"aa"} and all(r.score == pytest.approx(0.5) for r in got)
