from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from tests.llm.conftest import by_id
from tripwright.llm import jaccard


def brute(rows, size=5, percent=80):
    sets, root = {}, {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets[doc_id], root[doc_id] = frozenset(grams), doc_id

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    partners = {d: set() for d in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
            if sets[a] != sets[b]:
                partners[a].add(sets[b])
                partners[b].add(sets[a])
    return {d: (len(sets[d]), find(d), len(partners[d])) for d in sets}


def corpus(seed, families=12, extra=40):
    """Families of near copies around the threshold, copies, and a passage that many share."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4000)}"
    passage = " ".join(word() for _ in range(30))
    rows = []
    for _ in range(families):
        base = [word() for _ in range(draw.randint(3, 90))]
        for _ in range(draw.randint(1, 9)):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                own[draw.randrange(len(own))] = word()
            rows.append(" ".join(own))
    rows += [" ".join(word() for _ in range(draw.randint(0, 60))) for _ in range(extra)]
    rows = [r + " " + passage if draw.random() < 0.3 else r.upper() if draw.random() < 0.1 else r for r in rows]
    draw.shuffle(rows)
    return [(10 * k + 3, r) for k, r in enumerate(rows)]


@pytest.mark.parametrize(
    ("seed", "limits"),
    [(1, {}), (2, {"block_classes": 3}), (3, {"block_shingles": 100, "frequent_limit": 5}), (4, {"frequent_limit": 0})],
)
def test_links_are_those_of_brute_force(make_docs, seed, limits):
    rows = corpus(seed)
    found = jaccard.jaccard_join(make_docs(rows), **limits)
    assert by_id(found, "n_shingles", "component_id", "n_links") == brute(rows)


def test_a_large_block_is_joined_in_cells(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 8)
    rows = corpus(7, families=3, extra=5) + [(9000 + k, " ".join([*map(str, range(40)), f"x{k}", *map(str, range(41, 60 + k % 9))])) for k in range(40)]
    found = jaccard.jaccard_join(make_docs(rows), block_classes=8)
    assert by_id(found, "n_shingles", "component_id", "n_links") == brute(rows)


def test_the_local_join_with_pivots_finds_all_links(monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 10)
    draw = np.random.default_rng(3)
    sets = []
    for _ in range(20):
        base = draw.choice(5000, 60, replace=False)
        for _ in range(8):
            own = base.copy()
            own[draw.integers(0, 60, draw.integers(0, 9))] = draw.integers(5000, 9000)
            sets.append(np.unique(own).astype(np.uint64))
    local = jaccard._Local(sets, [-1] * len(sets), 80)
    local.run()
    for a, one in enumerate(sets):
        linked = [len(np.intersect1d(one, o)) * 100 >= 80 * len(np.union1d(one, o)) for o in sets]
        assert local.links[a] == sum(linked) - 1
        assert all(local.find(a) == local.find(b) for b, yes in enumerate(linked) if yes)


def test_odd_rows(make_docs):
    text = "one two three four five six"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  b"), (6, text), (6, text), (7, text + " seven"), (None, text), (None, "q r s")]
    found = jaccard.jaccard_join(make_docs(rows, extra={"cls": 1, "block": 2, "n": 3})).collect()
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found)
    assert got == [(0, 1, 0), (0, 2, 6), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 2, 6), (6, 2, 6), (7, 3, 7)]
    assert jaccard.jaccard_join(make_docs([])).count() == 0


def test_one_row_of_each_component_stays(make_docs):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(9, text + " x"), (4, text), (4, text), (None, text), (None, None), (None, None), (8, "other words"), (None, "q r"), (None, "q r")]
    kept = jaccard.one_of_each(make_docs(rows, extra={"row": 1, "id": 2, "first": 3, "text_hash": 4}))
    got = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert got == sorted([(4, text), (0, ""), (0, ""), (8, "other words"), (0, "q r")])
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_a_long_word_and_a_long_text(make_docs):
    long = "z" * 1_300_000
    rows = [(1, long), (2, long), (3, "a " * 400_000), (4, "a " * 5)]
    assert by_id(jaccard.jaccard_join(make_docs(rows)), "component_id") == {1: 1, 2: 1, 3: 3, 4: 3}


def quoting(n, own=60, seed=5):
    """Texts of their own that all quote one passage and are else unlike."""
    draw = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(20))
    return [(k, " ".join(f"w{draw.randrange(10**6)}" for _ in range(own)) + " " + passage) for k in range(n)]


def test_sketches_differ_in_no_more_cells_than_sets_in_shingles():
    draw = np.random.default_rng(2)
    for n in (1, 2, 63, 64, 65, 300, 1000):
        one = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        other = np.unique(np.concatenate((one[: 9 * n // 10], draw.integers(0, 1 << 63, n // 4, dtype=np.uint64))))
        a, b = (np.frombuffer(jaccard.sketch(s), np.uint8) for s in (one, other))
        while len(a) != len(b):
            a, b = (x if len(x) == min(len(a), len(b)) else x[: len(x) // 2] ^ x[len(x) // 2 :] for x in (a, b))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(one, other))
        assert 64 <= 8 * len(jaccard.sketch(one)) < max(65, 2 * n)


@pytest.mark.parametrize("percent", [40, 80])
def test_sketches_leave_no_link_out_and_part_what_is_unlike(percent):
    draw = np.random.default_rng(4)
    sets = []
    for size in (1, 3, 60, 120, 130, 500):
        base = draw.integers(0, 1 << 63, size, dtype=np.uint64)
        for _ in range(6):
            own = base.copy()
            own[draw.integers(0, size, draw.integers(0, 1 + size // 8))] = draw.integers(0, 1 << 63, dtype=np.uint64)
            sets.append(np.unique(own[: size - draw.integers(0, 1 + size // 6)]))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    sketches = [jaccard.sketch(s) for s in sets]
    alone = np.full(len(sets), -1)
    label = jaccard._hang_together(sizes, sketches, alone, percent)
    sides = np.arange(len(sets)) % 2
    across = jaccard._hang_together(sizes, sketches, sides, percent)
    for (a, one), (b, two) in combinations(enumerate(sets), 2):
        if 100 * len(np.intersect1d(one, two)) >= percent * len(np.union1d(one, two)):
            assert label[a] == label[b]
            assert sides[a] == sides[b] or across[a] == across[b]
    assert percent < 80 or len(set(label[sizes > 40].tolist())) >= 4


@pytest.mark.parametrize(("seed", "cells"), [(11, (6, 1 << 23)), (12, (1 << 13, 90)), (13, (2, 1 << 23))])
def test_crowds_are_compared_in_cells(make_docs, monkeypatch, seed, cells):
    monkeypatch.setattr(jaccard, "CELL_CLASSES", cells[0])
    monkeypatch.setattr(jaccard, "CELL_BYTES", cells[1])
    rows = corpus(seed) + [(9000 + k, text) for k, text in quoting(30)]
    rows += [(9500 + k, " ".join([*map(str, range(40)), f"x{k}", *map(str, range(41, 60 + k % 9))])) for k in range(20)]
    found = jaccard.jaccard_join(make_docs(rows), frequent_limit=0)
    assert by_id(found, "n_shingles", "component_id", "n_links") == brute(rows)


def test_texts_that_only_quote_each_other_are_no_large_block(make_docs, monkeypatch):
    loaded = []
    sets_of = jaccard._sets_of
    monkeypatch.setattr(jaccard, "_sets_of", lambda rows, members, size: loaded.append(members.count()) or sets_of(rows, members, size))
    monkeypatch.setattr(jaccard, "_large", lambda *_: pytest.fail("sets of unlike texts repeated in cells"))
    rows = quoting(60) + [(100, quoting(1)[0][1] + " end")]
    found = jaccard.jaccard_join(make_docs(rows), frequent_limit=0, block_classes=8)
    assert by_id(found, "n_shingles", "component_id", "n_links") == brute(rows)
    assert loaded == [2]


def test_disk_is_given_back(spark, make_docs):
    import time

    from tripwright.llm import tables

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size())} if files.size() else set()

    before = {f for f in shuffled() if f.startswith("shuffle_")}
    rows = tables.written(make_docs(quoting(20)).repartition(3, "doc_id"), "given-back")
    until = time.time() + 20
    while left := {f for f in shuffled() if f.startswith("shuffle_")} - before:
        assert time.time() < until, left
        time.sleep(0.2)
    assert rows.count() == 20
    path = spark._jvm.org.apache.hadoop.fs.Path(rows.inputFiles()[0]).getParent()
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(path)
    tables.discard(rows)
    assert not files.exists(path)
