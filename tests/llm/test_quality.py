from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tripwright.llm import quality


def corpus(n=150):
    draw = random.Random(2)
    words = ["river", "stone", "walked", "the", "and", "green", "house"]
    rows, labels = [], []
    for k in range(n):
        good = [" ".join(draw.choices(words, k=9)).capitalize() + "." for _ in range(draw.randint(1, 6))]
        bad = ["$$$ ".join(draw.choices(words, k=9)).upper() + "!!" for _ in range(draw.randint(1, 6))]
        rows.append((k, "\n".join(good if k % 3 else bad)))
        labels.append((k, int(bool(k % 3)), 0))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_marginals_equal_those_of_all_labellings():
    draw = np.random.default_rng(0)
    counts = np.array([4, 1, 3])
    unary, moves = draw.normal(size=(8, 2)), draw.normal(size=(2, 2))
    own, pairs = quality._Chains(counts).marginals(unary, moves)
    at = 0
    for n in counts:
        weights = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            s = sum(unary[at + t, y] for t, y in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(s)
        whole = sum(weights.values())
        for t in range(n):
            assert own[at + t, 1] == pytest.approx(sum(w for y, w in weights.items() if y[t]) / whole)
        for t in range(1, n):
            assert pairs[at + t, 0, 1] == pytest.approx(sum(w for y, w in weights.items() if (y[t - 1], y[t]) == (0, 1)) / whole)
        at += n


def test_held_out_documents_are_told_apart(spark, make_docs):
    rows, labels = corpus()
    docs, truth = make_docs(rows), {k: q for k, q, _ in labels}
    model = quality.train(docs, labelled(spark, labels), 60)
    found = quality.score_quality(docs, model).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 20 and all(r.predicted == truth[r.doc_id] for r in held)
    assert all((r.score >= 0.5) == bool(r.predicted) and 0 <= r.score <= 1 for r in found)
    assert {r.doc_id for r in quality.keep_good(docs, model).collect()} == {k for k in truth if truth[k]}


def test_neighbouring_lines_count():
    x, _, counts = quality.features(["a b.\n$$ %% $$\nc d.", "$$ %% $$"])
    assert counts.tolist() == [3, 1]
    assert not np.allclose(x[1], x[3]) and np.allclose(x[1, : quality.OWN], x[3, : quality.OWN])


def test_odd_rows_have_scores(spark, make_docs):
    rows, labels = corpus(60)
    odd = [(None, None), (None, ""), (900, ""), (901, "\n\n"), (901, "\n\n"), (902, "wort " * 20000), (903, "é ß")]
    docs = make_docs([*rows, *odd], extra={"label": "clash", "score": 3})
    model = quality.train(docs, labelled(spark, [*labels, (None, 1, None), (1, 1, 1), (903, None, 0)]), 30)
    found = quality.score_quality(docs, model).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (None, 900)}) == 1
    assert "label" in quality.keep_good(docs, model).columns


def test_nothing_to_learn_from(spark, make_docs):
    none = quality.train(make_docs([]), labelled(spark, []))
    assert none is None
    assert quality.score_quality(make_docs([(1, "x")]), none).first().score == 0.5
    assert quality.score_quality(make_docs([]), none).count() == 0
