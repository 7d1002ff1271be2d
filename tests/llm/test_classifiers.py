"""The chain over lines and the tolerant lexicon: exact small cases, and accuracy on held-out documents."""

import itertools

import numpy as np
import pytest
from cases import AWKWARD, LABELLED
from pyspark.sql import functions as F

from feedloom.llm import quality_crf, toxicity
from feedloom.llm.common import held_out
from feedloom.llm.quality_crf import N_FEATURES, Chain, features, fit_chain, forward_backward, marginals
from feedloom.llm.toxicity import Lexicon, Term, choose_terms, edits_for, readings


def test_messages_agree_with_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([1, 4, 2, 5, 1, 3])
    potentials, transitions = rng.normal(size=(counts.sum(), 2)), rng.normal(size=(2, 2))
    ahead, back, total = forward_backward(potentials, counts, transitions)
    at = 0
    for k, n in enumerate(counts):
        own = potentials[at : at + n]
        weights = {}
        for path in itertools.product((0, 1), repeat=int(n)):
            weights[path] = np.exp(sum(own[t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
        z = sum(weights.values())
        assert np.isclose(total[k], np.log(z))
        for t in range(n):
            good = sum(w for path, w in weights.items() if path[t]) / z
            assert np.isclose(np.exp(ahead[at + t, 1] + back[at + t, 1] - total[k]), good)
        at += n


def test_a_fitted_chain_beats_the_start():
    texts = ["A plain line of words here.\nAnother plain line of words."] * 10 + ["BUY!! NOW!! BUY!! NOW!!\n### %%% ### %%%"] * 10
    rows, _, counts = features(texts)
    labels = np.array([1] * 10 + [0] * 10)
    chain = fit_chain(rows, counts, labels)
    good = marginals(chain, rows, counts)
    assert (good[:20] > 0.9).all() and (good[20:] < 0.1).all()


def test_neighbouring_lines_enter_the_features():
    rows, lengths, counts = features(["plain words here.\n### %%% ###\nplain words here."])
    assert rows.shape == (3, N_FEATURES) and counts.tolist() == [3] and lengths.tolist() == [18, 12, 18]
    shape = quality_crf.N_SHAPE
    assert (rows[1, shape : 2 * shape] == rows[0, :shape]).all() and (rows[1, 2 * shape : 3 * shape] == rows[2, :shape]).all()
    assert not rows[0, shape : 2 * shape].any()


def labelled(spark, label):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    return spark.read.parquet(f"{LABELLED}/documents.parquet"), labels, labels.where(~held_out(F.col("doc_id")))


def accuracy(scored, labels, threshold):
    judged = scored.join(labels, "doc_id").where(held_out(F.col("doc_id")))
    return judged.agg(F.avg(((F.col("_s") >= threshold) == (F.col("label") == 1)).cast("double"))).first()[0]


def test_quality_on_held_out_documents(spark):
    docs, labels, known = labelled(spark, "quality")
    chain = quality_crf.fit(docs, known)
    assert accuracy(quality_crf.score(docs, chain, "_s"), labels, 0.3) >= 0.95
    assert chain == chain and (quality_crf.fit(docs, known).weights == chain.weights).all()


def test_toxicity_on_held_out_documents(spark):
    docs, labels, known = labelled(spark, "toxic")
    assert accuracy(toxicity.score(docs, toxicity.fit(docs, known), "_s"), labels, 0.5) >= 0.93


@pytest.mark.parametrize("operator", ["quality", "toxic"])
def test_awkward_rows_keep_their_places(texts, operator):
    docs = texts(AWKWARD)
    if operator == "quality":
        scored = quality_crf.score(docs, Chain(np.linspace(-1, 1, N_FEATURES), np.eye(2)))
    else:
        model = toxicity.ToxicModel(Lexicon([Term("words", False, 2.0)]), np.ones(7))
        scored = toxicity.score(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    rows = scored.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert scored.where(F.lit(False)).count() == 0


def test_fits_without_labels(texts, spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, label int")
    assert quality_crf.score(texts(AWKWARD), quality_crf.fit(texts(AWKWARD), none)).count() == len(AWKWARD)
    assert toxicity.score(texts(AWKWARD), toxicity.fit(texts(AWKWARD), none)).count() == len(AWKWARD)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + row[1:], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_the_automaton_accepts_what_the_edit_distance_allows():
    terms = [Term("idiot", False, 3.0), Term("worthless", False, 2.0), Term("scum", False, 1.0), Term("pathet", True, 1.5), Term("disgust", True, 1.2)]
    lexicon, rng = Lexicon(terms), np.random.default_rng(5)
    words = {"idiot", "idiots", "idot", "iddiot", "xdiot", "worthles", "wrthles", "scum", "scam", "pathetic", "pathxtic", "disgusting", "disgsting", "dissgusted", "", "i"}
    for t in terms:
        for _ in range(150):
            w = list(t.text)
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(0, len(w) + 1))
                match rng.integers(0, 3):
                    case 0:
                        w.insert(k, "abcdeiost"[rng.integers(0, 9)])
                    case 1 if k < len(w):
                        del w[k]
                    case 2 if k < len(w):
                        w[k] = "abcdeiost"[rng.integers(0, 9)]
            words.add("".join(w) + ("ing" if t.stem else ""))
    for word in words:
        near = []
        for k, t in enumerate(terms):
            d = min(distance(word[:n], t.text) for n in range(len(word) + 1)) if t.stem else distance(word, t.text)
            if d <= edits_for(t.text, t.stem):
                near.append((d, -t.weight, k))
        found = lexicon.look_up(word)
        assert (found is not None) == bool(near), word
        if near and not terms[found[0]].stem:
            assert found[1] == min(near)[0], word


def test_quotation_reads_differently_from_abuse():
    lexicon = Lexicon([Term("idiot", False, 3.0)])
    accepted = {"idiot": (0, 0)}
    plain = readings("you are an idiot and that is all", lexicon, accepted)[0][0][2]
    quoted = readings('the word "idiot" was quoted here', lexicon, accepted)[0][0][2]
    assert plain == 0 and quoted >= 0.8


def test_terms_need_toxic_documents():
    chosen = choose_terms([("bad", 50, 0), ("bad*", 50, 1), ("baddest", 10, 0), ("the", 100, 900), ("rare", 1, 0)], 100, 900)
    assert [(t.text, t.stem) for t in chosen] == [("bad", False), ("baddest", False)]
