"""The window network: its probabilities, its gradient, and what training gains."""

import random

import numpy as np
from cases import AWKWARD

from feedloom.llm.pseudo_likelihood import CLASSES, WITHIN, Network, log_probabilities, score, surroundings, tokens, train, train_batch


def sentences(n, seed=0):
    rng = random.Random(seed)
    return [" ".join(f"{rng.choice(['red', 'blue'])} {rng.choice(['cat', 'dog'])} sat on the mat ." for _ in range(12)) for _ in range(n)]


def test_probabilities_of_all_tokens_add_up_to_one():
    net = Network.start(1)
    around = np.array([[3, 4096, 17, 9]])
    every = np.arange(CLASSES * WITHIN)
    total = np.exp(log_probabilities(net, every, np.repeat(around, len(every), axis=0))).sum()
    assert np.isclose(total, 1, atol=1e-4)


def test_surroundings_stop_at_the_ends_of_texts():
    ids, counts = np.array([1, 2, 3, 7, 8]), np.array([3, 0, 2])
    none = CLASSES * WITHIN
    assert surroundings(ids, counts).tolist() == [[none, none, 2, 3], [none, 1, 3, none], [1, 2, none, none], [none, none, 8, none], [none, 7, none, none]]


def test_a_step_raises_the_likelihood():
    ids, counts = tokens([s.encode() for s in sentences(20)])
    around, net = surroundings(ids, counts), Network.start()
    first = log_probabilities(net, ids, around).mean()
    for _ in range(30):
        train_batch(net, ids, around, 1.0)
    assert log_probabilities(net, ids, around).mean() > first + 1


def test_trained_scores_prefer_the_language_of_the_corpus(spark):
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(sentences(400))], "doc_id long, text string").repartition(4)
    net = train(docs, rounds=3, stride=1)
    rng = random.Random(9)
    seen = sentences(5, seed=77)
    mixed = [" ".join(rng.sample(s.split(), len(s.split()))) for s in seen]
    rows = spark.createDataFrame([*enumerate(seen), *enumerate(mixed, 100)], "doc_id long, text string")
    mean = {r["doc_id"]: r["mean_log_likelihood"] for r in score(rows, net).collect()}
    assert max(mean[100 + k] for k in range(5)) < min(mean[k] for k in range(5))


def test_every_position_is_a_training_target(spark):
    words = [f"word{i}" for i in range(8)]
    net = train(spark.createDataFrame([(i, " ".join(words)) for i in range(200)], "doc_id long, text string"))
    ids, _ = tokens([" ".join(words).encode()])
    assert len(set(ids.tolist())) == 8 and all(net.out_bias[i // WITHIN, i % WITHIN] > 0 for i in ids.tolist())


def test_awkward_rows(texts, spark):
    net = train(texts(AWKWARD), rounds=1)
    rows = score(texts(AWKWARD), net).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        if r["n_tokens"] == 0:
            assert r["log_likelihood"] == 0 and r["mean_log_likelihood"] is None
        else:
            assert r["log_likelihood"] < 0 and np.isclose(r["mean_log_likelihood"], r["log_likelihood"] / r["n_tokens"])
    assert sorted(r["n_tokens"] for r in rows) == sorted([0, 0, 0, 9, 1, 1, 30_000, 9])
    assert (train(texts([])).flat() == Network.start().flat()).all() and score(texts([]), net).count() == 0


def plain_log_probability(net, ids, position):
    """One token's log-probability by loops over units and tokens."""
    nothing = CLASSES * WITHIN
    around = [ids[position + k] if 0 <= position + k < len(ids) else nothing for k in (-2, -1, 1, 2)]
    hidden = [np.tanh(net.bias[h] + sum(net.tables[p][a][h] for p, a in enumerate(around))) for h in range(len(net.bias))]
    kind, inner = divmod(ids[position], WITHIN)
    top = [net.class_bias[c] + sum(x * net.class_out[h][c] for h, x in enumerate(hidden)) for c in range(CLASSES)]
    low = [net.out_bias[kind][w] + sum(x * net.out[kind][h][w] for h, x in enumerate(hidden)) for w in range(WITHIN)]
    return top[kind] - np.log(np.exp(top).sum()) + low[inner] - np.log(np.exp(low).sum())


def spiky(seed=3):
    net = Network.start(seed)
    net.class_bias[5] = 4
    net.out_bias[:, 7] = -3
    return net


def test_scores_equal_a_plain_double_loop(spark):
    net, text = spiky(), "the cat sat on the Mat and the dog ran"
    ids = tokens([text.encode()])[0].tolist()
    expected = sum(plain_log_probability(net, ids, k) for k in range(len(ids)))
    row = score(spark.createDataFrame([(1, text)], "doc_id long, text string"), net).first()
    assert row["n_tokens"] == 10 and np.isclose(row["log_likelihood"], expected, atol=1e-3)


def test_far_logits_keep_their_probabilities():
    net = Network.start(2)
    net.class_bias[:] = np.linspace(-200, 200, CLASSES)
    net.class_out[:, 3] = 300
    ids = np.array([3 * WITHIN, 60 * WITHIN, 63 * WITHIN + 1])
    around = np.array([[1, 2, 3, 4], [900, 901, 902, 903], [7, 7, 7, 7]])
    hidden = np.tanh(net.bias + sum(net.tables[p][around[:, p]] for p in range(4))).astype(np.float64)
    top = hidden @ net.class_out.astype(np.float64) + net.class_bias
    top -= np.log(np.exp(top - top.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)) + top.max(axis=1, keepdims=True)
    got = log_probabilities(net, ids, around)
    assert np.isfinite(got).all() and np.allclose(got, top[np.arange(3), ids // WITHIN] + [np.log(1 / WITHIN)] * 3, atol=2)


def test_a_step_follows_the_numerical_gradient():
    """Of each weight that a step moves, the slope of the mean log-probability has the step's sign and, up to its own rate, its size."""
    ids, counts = tokens([b"a b a c a b a c b a"])
    around, net = surroundings(ids, counts), spiky(4)
    moved = Network.from_flat(net.flat())
    train_batch(moved, ids, around, 1e-3)

    def slope(name, at):
        sides = []
        for h in (1e-2, -1e-2):
            other = Network.from_flat(net.flat())
            getattr(other, name)[at] += np.float32(h)
            sides.append(log_probabilities(other, ids, around).sum())
        return (sides[0] - sides[1]) / 2e-2

    kind, token = int(ids[0]) // WITHIN, int(ids[0])
    for name, at, rate in (("class_bias", (kind,), 1 / 10), ("class_out", (3, kind), 1 / 10), ("bias", (2,), 1 / 10), ("out_bias", (kind, token % WITHIN), 1 / 16), ("tables", (0, token, 5), None)):
        step = float(getattr(moved, name)[at] - getattr(net, name)[at]) / 1e-3
        expected = slope(name, at)
        if rate is None:
            times = int((around[:, 0] == token).sum())
            rate = 1 / np.sqrt(16 * times)
        assert np.isclose(step, rate * expected, rtol=0.05, atol=2e-3), (name, step, rate * expected)
