"""The language model learns from all documents and goes on learning in every text."""

import math
import random
import zlib

import numpy as np
import pytest

from medallion_marts.llm import context_mixing


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("the of and ther ing tion ed es".split()) for _ in range(2)) for _ in range(n))


def model_of(texts, sizes=(16, 16, 16, 16), reserved=None):
    coding = context_mixing.make_coding(texts)
    counts = context_mixing.Counts(coding, sizes)
    counts.add(texts)
    blocks = {b: context_mixing.odds_of(context_mixing.added([row])) for b, *row in counts.rows()}
    model = context_mixing.Model(coding, context_mixing.filled(blocks, sizes), None, None)
    context_mixing.learn_weights(model, texts if reserved is None else reserved)
    return model


def bit_by_bit(text, model):
    """Bits of a text by the definition: one decision after another, in plain Python floats."""
    c, sizes = model.coding, [len(t).bit_length() - 1 for t in model.odds]
    w32 = lambda x: x & 0xFFFFFFFF
    u = [0] * 6 + [b + 1 for b in text] + [0]
    symbol = lambda k: int(c.symbol[u[k]]) if k >= 0 else 0
    edges, change = context_mixing.stretches(len(text) + 1), np.zeros((context_mixing.INPUTS, 1))
    total, seen, right, gradient, curvature = 0.0, {}, False, np.zeros(context_mixing.INPUTS), 0.0
    mix = int(context_mixing._MIX)
    for k in range(6, len(u)):
        if k - 6 in edges[1:]:
            change[:, 0] += context_mixing.RATE * gradient / (curvature * model.power + context_mixing.STEADY)
            gradient, curvature = np.zeros(context_mixing.INPUTS), 0.0
        tree = int(c.trees[c.row[symbol(k - 2) * c.n + symbol(k - 1)] * c.n + symbol(k - 3)])
        keys = []
        for order, bits in zip(context_mixing.ORDERS, sizes):
            if order:
                key = sum(u[k - j] * int(context_mixing._M[j - 1]) for j in range(1, order + 1))
            else:
                word = []
                while not context_mixing.SPACE[u[k - 1 - len(word)]]:
                    word.append(u[k - 1 - len(word)])
                key = sum((w32(x * 0x6659FD93) ^ 0xA5A5A5A5) * pow(context_mixing._BASE, j, 1 << 32) for j, x in enumerate(reversed(word)))
                key = w32(w32(key) * mix) ^ w32(tree * 0xC2B2AE35)
            keys.append(w32(w32(key) * mix) >> (32 - bits))
        run = tuple(u[k - 6 : k])
        expected = seen.get(run, -1)
        path = lambda s: [int(e) for e in c.entry[c.start[tree * c.n + s] :][: c.length[tree * c.n + s]]]  # noqa: E731, B023
        theirs = path(int(c.symbol[expected])) if expected >= 0 else []
        for depth, entry in enumerate(path(symbol(k))):
            sign, place = (1 if entry & 1 else -1), entry >> 1 & 15
            odds = [int(model.odds[j][key ^ place]) for j, key in enumerate(keys)]
            x, gate = [float(c.odds[entry >> 5]), *[o / 10 for o in odds], 0.0, 0.25], 2 * (odds[-1] != 0) + (depth == 0)
            if depth < len(theirs) and theirs[depth] >> 5 == entry >> 5:
                x[-2] = (1.0 if theirs[depth] == entry else -1.0) * sign
                gate += 8 if right else 4
            x = np.array(x) * sign
            dot = float((model.weights[:, gate] + change[:, 0]) @ x)
            total += math.log2(1 + math.exp(-max(-16, min(16, dot))))
            miss = 1 / (1 + math.exp(max(-16, min(16, dot))))
            gradient += miss * x
            curvature += miss * (1 - miss)
        right = expected == u[k]
        seen[run] = u[k]
        total += 8 * (symbol(k) == 1)
    return total


def test_score_bit_by_bit():
    texts = [prose(k).encode() for k in range(12)]
    model = model_of(texts[:9], reserved=texts[9:])
    for data in (texts[0], texts[11], b"", b"x", (prose(30) + " " + prose(30)).encode(), "z\u00e9 of \x01the".encode(), b"the" * 50):
        assert context_mixing.all_bits([data], model)[0] == pytest.approx(bit_by_bit(data, model), rel=1e-4)


def test_every_learned_byte_and_ngram_counts(spark, docs_of):
    """Bytes and trees come from all documents, not from the reserved ones or the most frequent bytes."""
    rows = [(k, prose(k) + " " + "".join(chr(c) for c in range(0x80 + 97 * k, 0x80 + 97 * k + 12))) for k in range(160)]
    rows += [(1000 + k, "жзи " * 20 + "".join(map(chr, range(33, 127)))) for k in range(3)]
    model, _, _, _ = context_mixing.learn(docs_of(rows))
    used = np.unique(np.frombuffer(context_mixing.lowered("".join(t for _, t in rows)), np.uint8)).astype(int)
    assert len(used) > 120 and (model.coding.symbol[used + 1] > 1).all()
    local = context_mixing.make_coding([context_mixing.lowered(t) for _, t in rows])
    assert model.coding.n == local.n and np.array_equal(model.coding.symbol, local.symbol)
    assert np.array_equal(model.coding.length, local.length) and np.array_equal(model.coding.entry, local.entry)


def test_tables_over_many_tasks(spark, docs_of, monkeypatch):
    """Counts of many tasks, added up in several rounds, are those of one; the reserved documents are in the final tables."""
    monkeypatch.setattr(context_mixing, "FAN_IN", 2)
    rows = [(k, prose(k)) for k in range(300)]
    one, _, n1, v1 = context_mixing.learn(docs_of(rows).coalesce(1))
    many, _, n2, v2 = context_mixing.learn(docs_of(rows).repartition(7))
    assert (n1, v1) == (n2, v2) and all(np.array_equal(a, b) for a, b in zip(one.odds, many.odds))
    counts = context_mixing.Counts(one.coding, tuple(len(t).bit_length() - 1 for t in one.odds))
    counts.add([context_mixing.lowered(t) for _, t in rows])
    blocks = {b: context_mixing.odds_of(context_mixing.added([row])) for b, *row in counts.rows()}
    assert all(np.array_equal(a, b) for a, b in zip(one.odds, context_mixing.filled(blocks, counts.sizes)))


def test_tables_grow_with_what_is_learned():
    sizes = [context_mixing.bits_for([n] * 4, 2.5)[0] for n in (0, 10_000, 100_000, 1_000_000, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == context_mixing.LEAST_BITS < sizes[2] < sizes[3] < sizes[4] == context_mixing.MOST_BITS


def test_counts_in_runs_are_exact(monkeypatch):
    texts = [prose(k).encode() for k in range(8)]
    coding = context_mixing.make_coding(texts)
    whole = context_mixing.Counts(coding, (18, 18, 18, 18))
    whole.add(texts)
    expected = {b: context_mixing.added([row]) for b, *row in whole.rows()}
    monkeypatch.setattr(context_mixing, "WAITING", 50)
    parts, got = context_mixing.Counts(coding, (18, 18, 18, 18)), {}
    for t in texts:
        parts.add([t])
        for b, *row in parts.rows():
            got[b] = context_mixing.added([row], got.get(b))
    assert set(got) == set(expected) and all(np.array_equal(got[b], expected[b]) for b in got)
    made = sum(int(coding.length[coding.codes(context_mixing.lay_out([(t, True)]))[1][6:]].sum()) for t in texts)
    assert sum(x.sum() for x in got.values()) == 4 * made  # every decision counts, once in each table


def test_pieces_carry_context_word_and_matches(monkeypatch):
    """A text costs the same in one piece and in many, but for where the weights are refined."""
    texts = [prose(k).encode() for k in range(8)]
    model = model_of(texts)
    monkeypatch.setattr(context_mixing, "RATE", 0.0)
    data = [prose(20, 200).encode() * 3 + b"x" * 70 + prose(20, 200).encode(), b"", prose(21).encode()]
    whole = context_mixing.all_bits(data, model)
    counted = context_mixing.Counts(model.coding, (16, 16, 16, 16))
    counted.add(data)
    counted = list(counted.rows())
    for size in (4, 7, 100, 1000):
        monkeypatch.setattr(context_mixing, "CHUNK", size)
        assert np.allclose(context_mixing.all_bits(data, model), whole, rtol=1e-6)
        again = context_mixing.Counts(model.coding, (16, 16, 16, 16))
        again.add(data)
        assert list(again.rows()) == counted


def test_refined_throughout():
    stretches = context_mixing.stretches(1 << 18)
    assert max(np.diff(stretches)) <= 1024 and stretches[-1] == 1 << 18 and len(context_mixing.stretches(500)) > 3
    texts = [prose(k).encode() for k in range(8)]
    model = model_of(texts)
    other = (" ".join(f"{random.Random(k % 50).getrandbits(30)}" for k in range(2000))).encode()
    bits, model.power = context_mixing.all_bits([other], model)[0], model.power
    rate, context_mixing.RATE = context_mixing.RATE, 0.0
    try:
        assert bits < 0.97 * context_mixing.all_bits([other], model)[0]
    finally:
        context_mixing.RATE = rate


def test_texts_do_not_affect_one_another():
    texts = [prose(k, 10 + 37 * k).encode() for k in range(12)]
    model = model_of(texts[:6])
    together = context_mixing.all_bits(texts, model)
    assert np.allclose(together, [context_mixing.all_bits([t], model)[0] for t in texts], rtol=1e-5)


def test_nothing_comes_from_a_sample(spark, docs_of, monkeypatch):
    """Which ids the documents have makes no difference to weights, trees and tables; table sizes come from the decisions of all of them."""
    seen = []
    monkeypatch.setattr(context_mixing, "bits_for", lambda most, rate, real=context_mixing.bits_for: seen.append((most, rate)) or real(most, rate))
    texts = [prose(k) + " " + str(k) * 30 for k in range(60)]
    one, other = (context_mixing.learn(docs_of([(start + k, t) for k, t in enumerate(texts)]))[0] for start in (0, 5000))
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.power, other.power)
    assert all(np.array_equal(a, b) for a, b in zip(one.odds, other.odds))
    made = learned = 0
    for t in texts:
        laid = context_mixing.lay_out([(context_mixing.lowered(t), True)])
        code = one.coding.codes(laid)[1][laid.real()]
        made, learned = made + int(one.coding.length[code].sum()), learned + len(code)
    assert [rate for _, rate in seen] == pytest.approx([made / learned] * 2, rel=1e-12) and seen[0][0][1] == learned


def test_equal_sets_of_weights_are_worked_out_as_one(monkeypatch):
    """No gates are worked out for weights that all sets share; scores are those of the gated way and of the definition."""
    texts = [prose(k, 10 + 23 * k).encode() for k in range(14)]
    model = model_of(texts[:9])
    model.weights = np.ascontiguousarray(context_mixing.first_weights().T)
    laid = context_mixing.lay_out([(texts[12], True)])
    assert context_mixing.inputs(laid, model).gate is None
    one = context_mixing.all_bits(texts, model)
    assert one[12] == pytest.approx(bit_by_bit(texts[12], model), rel=1e-4)
    monkeypatch.setattr(context_mixing.Model, "one_set", lambda self: None)
    assert context_mixing.inputs(laid, model).gate is not None
    assert np.allclose(context_mixing.all_bits(texts, model), one, rtol=1e-6)


def test_arrays_of_a_group_fit_a_cache():
    """Short texts are worked on in groups whose inputs take a few megabytes at most, and each text is in one group."""
    texts = [prose(k, 400).encode() for k in range(120)]
    model = model_of(texts[:4])
    model.weights = np.ascontiguousarray(context_mixing.first_weights().T)
    seen = []
    for numbers, pieces, carry, _ in context_mixing.groups(texts):
        seen += numbers
        assert context_mixing.inputs(context_mixing.lay_out(pieces, carry), model).x.nbytes < 3 << 20
    assert sorted(seen) == list(range(len(texts)))


def test_repeated_keys_are_held_once(monkeypatch):
    """A counting task hands its counts on when too many different keys are held, however often they come."""
    texts = [prose(k).encode() for k in range(8)]
    counts = context_mixing.Counts(context_mixing.make_coding(texts), (18, 18, 18, 18))
    monkeypatch.setattr(context_mixing, "WAITING", 500)
    counts.add(texts)
    different = sum(len(np.unique(t.take()[0])) for t in counts.tallies)
    monkeypatch.setattr(context_mixing, "KEYS_HELD", 2 * different)
    for _ in range(9):
        counts.add(texts)
        assert not counts.full()
    monkeypatch.setattr(context_mixing, "KEYS_HELD", different // 2)
    assert counts.full()


def test_counts_of_any_size_are_exact(monkeypatch):
    """Runs keep counts in 16 bits; larger ones, and those that grow beyond, lose nothing."""
    monkeypatch.setattr(context_mixing, "WAITING", 1000)
    rng, tally, expected = np.random.default_rng(5), context_mixing.Tally(), {}
    top = (1 << 48) - 1
    for k in range(40):
        keys = np.concatenate([np.full(n, key, np.uint64) for key, n in ((top, 70_000), (0, 65_535), (7, 2_000 * k), (9, 65_536))] + [rng.integers(0, 50, 300).astype(np.uint64) << np.uint64(40)])
        for key, n in zip(*np.unique(keys, return_counts=True)):
            expected[int(key)] = expected.get(int(key), 0) + int(n)
        tally.add(rng.permutation(keys))
    keys, n = tally.take()
    assert dict(zip(keys.tolist(), n.tolist())) == expected and (np.diff(keys.astype(np.int64)) > 0).all() and not tally.size()


def test_weights_come_from_every_document(spark, docs_of):
    """Sets of weights are learned, from all documents, each judged by the counts of the half that it is not in."""
    rows = [(k, prose(k % 70) + " " + str(k % 70) * 20) for k in range(80)] + [(900, None), (901, "")]
    model = context_mixing.learn(docs_of(rows).repartition(3))[0]
    first = np.ascontiguousarray(context_mixing.first_weights().T)
    assert model.one_set() is None and np.abs(model.weights - first).max() > 0.1
    halves = [[context_mixing.lowered(t) for _, t in rows if zlib.crc32((t or "").encode()) % 2 == half] for half in (0, 1)]
    sizes, sums = tuple(len(t).bit_length() - 1 for t in model.odds), context_mixing.WeightSums()
    for mine, others in (halves, halves[::-1]):
        counts = context_mixing.Counts(model.coding, sizes)
        counts.add(others)
        blocks = {b: context_mixing.odds_of(context_mixing.added([row])) for b, *row in counts.rows()}
        sums.add(mine, context_mixing.Model(model.coding, context_mixing.filled(blocks, sizes), None, None))
    made = sum(int(model.coding.length[model.coding.codes(context_mixing.lay_out([(t, True)]))[1][6:]].sum()) for half in halves for t in half)
    assert sums.seen == made and model.power == pytest.approx(sums.power(), abs=2e-4)
    fresh = [prose(1000 + k).encode() for k in range(20)]
    bits = lambda w: context_mixing.all_bits(fresh, context_mixing.Model(model.coding, model.odds, np.ascontiguousarray(w, np.float32), model.power)).sum()
    # Forms are taken at weights on the way, so those of one task and of three differ somewhat, but not in what they are worth.
    assert bits(model.weights) < bits(first) and bits(model.weights) == pytest.approx(bits(sums.weights().T), rel=0.02)


def test_sums_of_weights_are_added():
    """Where every sum is taken at the same weights, those of two tasks together are those of one; without documents the first weights stay."""
    texts = [prose(k).encode() for k in range(10)]
    model = model_of(texts[:5])
    model.weights = None
    parts = []
    for some in (texts[:4], texts[4:]):
        parts.append(context_mixing.WeightSums())
        parts[-1].add(some, model)
    both = context_mixing.WeightSums()
    for part in parts:
        both.unpack(part.packed())
    assert both.seen == parts[0].seen + parts[1].seen and np.array_equal(both.curve, parts[0].curve + parts[1].curve)
    assert np.allclose(context_mixing.WeightSums().weights(), context_mixing.first_weights())
    x = context_mixing.inputs(context_mixing.lay_out([(texts[0], True)]), model).x.astype(float)
    assert np.allclose(sum(context_mixing.WeightSums().unpack(p.packed()).squares for p in parts), both.squares) and (x**2).sum() < both.squares.sum()
