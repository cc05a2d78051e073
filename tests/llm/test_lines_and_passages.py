from __future__ import annotations

import random
import re

import pytest

from tests.llm.conftest import by_id
from tripwright.llm import decontaminate, linededup

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(rows, items, window):
    out = {}
    for doc_id, text in rows:
        words, hit, names = re.findall(WORD, lower(text)), set(), set()
        for item, body in items:
            own = re.findall(WORD, lower(body))
            n = min(window, len(own))
            grams = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    names.add(str(item))
        out[doc_id] = (len(words), len(hit), sorted(names))
    return out


@pytest.mark.parametrize("group_words", [decontaminate.GROUP_WORDS, 17, 5])
def test_hits_are_those_of_brute_force(spark, make_docs, group_words):
    draw = random.Random(4)
    vocabulary = ["a", "b", "c", "é", "7"]
    text = lambda n: "".join(draw.choice(vocabulary) + draw.choice([" ", "-", "\n", ". "]) for _ in range(n))
    items = [(k, text(draw.choice([0, 2, 3, 4, 6, 9]))) for k in range(12)] + [(12, None)]
    rows = [(k, text(draw.randint(0, 60)).upper()) for k in range(40)] + [(99, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_passages(make_docs(rows, extra={"items": 1, "at": 2}), benchmark, 4, group_words)
    assert by_id(found, "n_words", "n_hit", "items") == brute_hits(rows, items, 4)
    clean = {d for d, r in brute_hits(rows, items, 4).items() if not r[1]}
    assert {r.doc_id for r in decontaminate.without_passages(make_docs(rows), benchmark, 4, group_words).collect()} == clean


def test_spans_are_characters_of_the_original(spark, make_docs):
    benchmark = spark.createDataFrame([(1, "Über den Wolken")], "item_id long, text string")
    text = 'x "Über -- DEN Wolken" und über den Wolken'
    (row,) = decontaminate.find_passages(make_docs([(1, text)]), benchmark).collect()
    assert [text[a:b] for a, b in row.spans] == ["Über -- DEN Wolken"]


def test_benchmarks_that_are_empty(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(make_docs([(1, "a b")]), none).first().n_hit == 0
    assert decontaminate.find_passages(make_docs([]), none).count() == 0


def test_a_long_benchmark_is_cut_so_that_no_window_is_lost():
    """More than a million different words, and one item longer than a group."""
    long = " ".join(f"w{k}" for k in range(1_200_000))
    groups = list(decontaminate.groups_of([("a", "x y z"), ("long", long), ("b", "y z")], 10, 200_000))
    assert max(sum(len(t.split()) for _, t in g) for g in groups) <= 200_000
    starts = [int(t.split()[0][1:]) for g in groups for n, t in g if n == "long"]
    ends = [int(t.split()[-1][1:]) for g in groups for n, t in g if n == "long"]
    assert starts[0] == 0 and ends[-1] == 1_199_999
    assert all(b - a == 9 - 1 for a, b in zip(starts[1:], ends))
    assert groups[0][0] == ("a", "x y z") and groups[-1][-1] == ("b", "y z")


def brute_lines(rows):
    strip = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            where.setdefault(strip(line), set()).add(doc_id)
    shared = {k: max(v) for k, v in where.items() if len(k) >= 20 and len(v) >= 3}
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if shared.get(strip(x), doc_id) == doc_id]
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("bits", [linededup.FILTER_BITS, 64])
def test_lines_are_those_of_brute_force(make_docs, bits):
    draw = random.Random(9)
    pool = [f"{'Line' if k % 2 else 'lïne'} number {k} of {'x' * (k % 25)}" for k in range(30)]
    rows = [(k * 3, "\n".join(draw.choice(["", " ", "\t"]) + draw.choice([str.upper, str])(draw.choice(pool)) for _ in range(draw.randint(0, 9)))) for k in range(60)]
    rows += [(500, None), (501, ""), (502, "\n")]
    found = linededup.drop_shared_lines(make_docs(rows, extra={"key": 1, "drop": 2}), bits=bits)
    assert {d: v[1:] for d, v in by_id(found, "doc_id", "n_lines", "n_dropped", "kept").items()} == brute_lines(rows)


def test_repeated_and_nameless_rows(make_docs):
    line = "a line of more than twenty characters"
    rows = [(1, line), (1, line), (None, line + "\nx"), (2, line)]
    found = sorted((r.doc_id or 0, r.n_dropped, r.kept) for r in linededup.drop_shared_lines(make_docs(rows)).collect())
    assert found == [(0, 1, "x"), (1, 1, ""), (1, 1, ""), (2, 0, line)]
    twice = [(1, line), (1, line), (2, line)]
    assert all(r.n_dropped == 0 for r in linededup.drop_shared_lines(make_docs(twice)).collect())
    assert linededup.drop_shared_lines(make_docs([])).count() == 0
