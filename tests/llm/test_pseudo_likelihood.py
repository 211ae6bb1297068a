import math

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import pseudo_likelihood as pl

from . import brute


def fluent(seed, n):
    """Words that follow each other in a fixed cycle of triples, so both sides tell much."""
    r = np.random.default_rng(seed)
    return [(i, " ".join(w for k in r.integers(40, size=60) for w in (f"a{k}", f"b{k}", f"c{k}")), None, None, None, "", "") for i in range(n)]


@pytest.fixture(scope="module")
def trained(spark):
    return pl.trained(spark.createDataFrame(fluent(1, 400), brute.SCHEMA).repartition(2), rounds=2, copy_tokens=30_000, batch_size=256)


def plain(net, tokens, i):
    """Log-probability of the i-th token, place by place."""
    w = {k: v.astype(np.float64) for k, v in net.w.items()}
    at = lambda k: w["embed"][tokens[k] if 0 <= k < len(tokens) else pl.VOCABULARY]
    far = sum(at(i + s) for s in range(-pl.REACH, pl.REACH + 1) if s) / (2 * pl.REACH)
    h = np.tanh(np.concatenate([*(at(i + s) for s in (-2, -1, 1, 2)), far]) @ w["w1"] + w["b1"])
    k = next(c for c in range(pl.CLASSES) if tokens[i] < pl.EDGES[c + 1])
    one, two = h @ w["wc"] + w["bc"], w["ww"][pl.EDGES[k] : pl.EDGES[k + 1]] @ h + w["bw"][pl.EDGES[k] : pl.EDGES[k + 1]]
    return one[k] - np.log(np.exp(one).sum()) + two[tokens[i] - pl.EDGES[k]] - np.log(np.exp(two).sum())


def test_scores_equal_brute_force(spark, trained):
    net, words, chances = trained
    rows = brute.documents(25) + [(900, "a1 b1 c1 Ünseen a1 zz\x00z b2", None, None, None, "", "")]
    got = {r.doc_id: r for r in pl.score(spark.createDataFrame(rows, brute.SCHEMA), net, words, chances).collect()}
    hashed = lambda w: int(words(pl.Words([w], pl.SPACED, True).hashes())[0])
    for doc_id, text, *_ in rows:
        parts = (text or "").encode().lower().split()
        assert got[doc_id].n_tokens == len(parts)
        if len(parts) > 300:
            continue
        tokens, total = [hashed(w) for w in parts], 0.0
        for i, w in enumerate(parts):
            total += plain(net, tokens, i)
            if tokens[i] == 0:
                total += sum(chances[a, b] for a, b in zip([256, *w], [*w, 256], strict=True))
        assert math.isclose(got[doc_id].log_probability, total, rel_tol=1e-4, abs_tol=1e-4)


def test_probabilities_sum_to_one(trained):
    net, _, chances = trained
    strips = np.full((pl.VOCABULARY, 2 * pl.REACH + 1), pl.VOCABULARY)
    strips[:, pl.REACH - 1], strips[:, pl.REACH + 2], strips[:, pl.REACH] = 3, 9, np.arange(pl.VOCABULARY)
    total = sum(math.exp(net.log_probability(x)[0]) for x in strips)
    assert math.isclose(total, 1, rel_tol=1e-4) and np.allclose(np.exp(chances).sum(1), 1)


def test_held_out_beats_frequencies(spark, trained):
    mean = lambda rows: np.mean([r.mean_log_probability for r in pl.score(spark.createDataFrame(rows, brute.SCHEMA), *trained).collect()])
    held = mean(fluent(2, 30))
    assert held > -math.log(120) + 0.7
    assert mean([(i, " ".join(np.random.default_rng(i).permutation(r[1].split())), *r[2:]) for i, r in enumerate(fluent(2, 30))]) < held - 0.7


def test_gradient_is_right():
    """A step along each weight's own gradient, against differences of the likelihood."""
    r = np.random.default_rng(0)
    net = pl.Network.start(np.ones(pl.VOCABULARY))
    for k, v in net.w.items():
        net.w[k] = (v + r.standard_normal(v.shape) * 0.3).astype(np.float32)
    net.w["embed"][pl.VOCABULARY] = 0
    pad = np.full(pl.REACH, pl.VOCABULARY)
    strip = np.concatenate([pad, r.integers(0, 40, 30), pad])
    inner = np.arange(pl.REACH, len(strip) - pl.REACH)
    found = {}

    class Noted(pl.Network):
        def _step(self, name, gradient, squares, rate, at=slice(None)):
            found.setdefault(name, np.zeros(self.w[name].shape))[at] += gradient

    Noted(net.w).learn(strip, inner, {}, 0.1)
    for name, at in (("embed", (5, 3)), ("w1", (4, 2)), ("w1", (4 * pl.EMBEDDING + 1, 2)), ("b1", (3,)), ("wc", (2, 1)), ("bc", (1,)), ("ww", (9, 4)), ("bw", (17,))):
        values = []
        for move in (1e-2, -1e-2):
            net.w[name][at] += move
            values.append(-net.log_probability(strip).mean())
            net.w[name][at] -= move
        assert math.isclose((values[0] - values[1]) / 2e-2, found[name][at], rel_tol=0.03, abs_tol=2e-4), name


def test_model_does_not_depend_on_partitions(spark):
    rows = fluent(5, 120) + brute.documents(40)
    scores = []
    for parts in (2, 7):
        df = spark.createDataFrame(rows, brute.SCHEMA).repartition(parts)
        scores.append({(r.doc_id, r.n_tokens): r.mean_log_probability for r in pl.pseudo_likelihood(df, copy_tokens=7000, batch_size=512).collect()})
    assert scores[0].keys() == scores[1].keys()
    assert max(abs(v - scores[1][k]) for k, v in scores[0].items() if v is not None) < 1e-6


def test_awkward_inputs(spark):
    frame = spark.createDataFrame([*brute.documents(15), (None, "a b", None, None, None, "", "")], brute.SCHEMA)
    out = pl.pseudo_likelihood(frame).collect()
    assert len(out) == 19 and all((r.mean_log_probability is None) == (r.n_tokens == 0) for r in out)
    assert pl.pseudo_likelihood(frame.limit(0)).count() == 0


def test_every_token_is_a_target_once(spark, monkeypatch):
    """Over the segments of all rounds and copies, those of very short and very long texts too."""
    texts = ["one", "two words", " ".join(f"w{k}" for k in range(3 * pl.SEGMENT + 17)), None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    words, counts = pl.vocabulary(df)
    met = []
    monkeypatch.setattr(pl.Network, "learn", lambda self, strip, target, squares, rate: met.extend(strip[target].tolist()))

    class Held:
        value = pl.Network.start(counts).packed()

    for r in pl.dealt(df, words).where("kind = 0").collect():
        batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([r.key]), pa.array([bytes(r.part)])], ["copy", "key", "part"])
        list(pl._train(Held, 16, 0.1)([batch]))
    assert len(met) == counts.sum() == 3 + 3 * pl.SEGMENT + 17 and np.array_equal(np.bincount(met, minlength=pl.VOCABULARY), counts)


def test_long_text_scores_as_in_one_piece(trained):
    net, _, _ = trained
    tokens = np.random.default_rng(3).integers(1, 60, 3 * pl.STRIP)
    pad = np.full(pl.REACH, pl.VOCABULARY)
    whole = net.log_probability(np.concatenate([pad, tokens, pad]))
    cut = np.concatenate([net.log_probability(x) for x in pl.segments(tokens)])
    assert np.allclose(whole, cut, atol=1e-5)


def test_a_step_takes_the_weights_of_all_classes_in_few_parts(monkeypatch):
    """Of a minibatch that meets every class; a step for each class took more time than its products."""
    met = []
    monkeypatch.setattr(pl.Network, "_step", lambda self, name, gradient, squares, rate, at=slice(None): met.append((name, gradient.size)))
    pad = np.full(pl.REACH, pl.VOCABULARY)
    strip = np.concatenate([pad, np.arange(pl.VOCABULARY), pad])
    pl.Network.start(np.ones(pl.VOCABULARY)).learn(strip, np.arange(pl.REACH, len(strip) - pl.REACH), {}, 0.1)
    assert len(met) < 32 and sum(n for name, n in met if name == "ww") == pl.VOCABULARY * pl.HIDDEN


def test_words_whose_hashes_begin_alike_are_told_apart():
    r = np.random.default_rng(4)
    known = np.unique(np.concatenate([r.integers(0, 2**64, 3000, np.uint64), np.uint64(2**64 - 1) - np.arange(9, dtype=np.uint64), np.arange(7, dtype=np.uint64)]))
    r.shuffle(known)
    asked = np.concatenate([known, known + np.uint64(1), known ^ np.uint64(1 << 20), r.integers(0, 2**64, 500, np.uint64)])
    plain = {h: k + 1 for k, h in enumerate(known.tolist())}
    for hashes in (known, known[:1], known[:0]):
        numbers = pl.Vocabulary(hashes)(asked)
        assert numbers.tolist() == [n if (n := plain.get(h, 0)) <= len(hashes) else 0 for h in asked.tolist()]


def test_spelling_is_of_each_byte_and_the_end():
    found = pl.Words([b"ab \xff", b"", b"c"], pl.SPACED, lower=True)
    for other, want in (([0, 1, 2], [(256, 97, 0), (97, 98, 0), (98, 256, 0), (256, 255, 1), (255, 256, 1), (256, 99, 2), (99, 256, 2)]), ([2], [(256, 99, 0), (99, 256, 0)]), ([], [])):
        assert list(zip(*(x.tolist() for x in pl.spelling(found, np.array(other, np.int64))), strict=True)) == want
