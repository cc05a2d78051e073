"""Ranked search against a plain loop over all items and documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tripwright.llm import ranking
from tripwright.llm.ranking import EXACT, IMPACT, Items, rank_documents, tiles_of

ITEMS = "item_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top=10):
    held = [(d, Counter(words(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t in words(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(rows)[:top])]
    return out


def ranked(spark, make_docs, docs, items, **more):
    got = rank_documents(make_docs(docs, extra={"item": 1, "score": 2, "term": 3}), spark.createDataFrame(items, ITEMS), **more)
    return [(r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()]


def key(row):
    return tuple((v is None, v) for v in row)


def corpus(seed, n=120):
    draw = random.Random(seed)
    text = lambda k: " ".join(f"W{draw.randrange(60)}" for _ in range(draw.randint(0, k)))
    docs = [(d, text(40)) for d in range(n)]
    docs += [(n, None), (n + 1, "  ..  "), (3, docs[5][1]), (None, docs[5][1]), (n + 2, "Ünï 日本 " * 50)]
    return docs, [(k, text(12)) for k in range(20)] + [(50, None), (51, ""), (52, "w1 " * 400 + "ünÏ"), (53, "nothing")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_loop(spark, make_docs, seed):
    docs, items = corpus(seed)
    got = ranked(spark, make_docs, docs, items)
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_many_small_tiles_and_groups_give_the_same(spark, make_docs, monkeypatch):
    docs, items = corpus(3)
    for name, value in {"ITEM_TILE": 3, "TERM_TILE": 4, "GROUP_TERMS": 30}.items():
        monkeypatch.setattr(ranking, name, value)
    got = ranked(spark, make_docs, docs, items, top=4)
    assert sorted(got, key=key) == sorted(brute(docs, items, 4), key=key)


def test_equal_scores_go_by_id(spark, make_docs):
    docs = [(d, "alpha beta") for d in range(40, 0, -1)] + [(99, "gamma")]
    got = ranked(spark, make_docs, docs, [(7, "alpha")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))


def test_sums_of_a_tile_stay_exact():
    """Weights that add up beyond what float64 holds are cut into more tiles, none is lost."""
    items = Items()
    items.add(0, "a " * 5 + "b c d e f g h " * 3)
    items.add(1, "a b")
    weights = np.full(len(items.terms), EXACT // IMPACT // 3, np.int64)
    tiles = tiles_of(items, weights, 0, 2)
    total = np.zeros((2, len(items.terms)), object)
    for tile in tiles:
        assert (tile.dense().sum(1) * IMPACT < EXACT).all()
        total[:, tile.columns] += tile.dense().astype(np.int64).astype(object)
    want = np.zeros((2, len(items.terms)), object)
    for i in range(2):
        want[i, items.columns[i]] = weights[items.columns[i]].astype(object) * items.repeats[i].astype(object)
    assert (total == want).all()


def test_a_very_long_text_is_taken_whole(spark, make_docs):
    docs = [(1, "filler " * 400_000 + "needle"), (2, "x" * 3_000_000 + " needle"), (3, "other")]
    got = ranked(spark, make_docs, docs, [(1, "needle")])
    assert sorted(got, key=key) == sorted(brute(docs, [(1, "needle")]), key=key)


def test_empty_tables(spark, make_docs):
    assert ranked(spark, make_docs, [], [(1, "a")]) == []
    assert ranked(spark, make_docs, [(1, "a")], []) == []
    assert ranked(spark, make_docs, [(1, None)], [(1, "a")]) == []
