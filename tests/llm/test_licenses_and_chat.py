from __future__ import annotations

import itertools
import random
import re

import pytest

from tests.llm.conftest import by_id
from tripwright.llm import chat, licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_base(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({n for _, n in places}))


def test_base_columns_are_those_of_brute_force(make_docs):
    draw = random.Random(1)
    parts = ["under the", "MIT", "License", "mit license", "Apache", "license,", "Version", "2.0", "CC", "BY-NC", "by", "nc 4", "Ünder the", "x", "\n", "K"]
    rows = [(k, draw.choice([" ", "--", " \t"]).join(draw.choice(parts) for _ in range(draw.randint(0, 40)))) for k in range(300)]
    rows += [(900, None), (901, ""), (902, "Under the MIT\nLicense")]
    found = licenses.scan_licenses(make_docs(rows, extra={"words": 1, "print": 2, "labels": 3}))
    got = by_id(found, "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {d: brute_base(t) for d, t in rows}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found.collect())


@pytest.mark.parametrize("k", range(len(licenses.TEMPLATES)))
def test_every_template_is_found_where_it_stands(make_docs, k):
    label, text, _ = licenses.TEMPLATES[k]
    shuffled = " ".join(sorted(text.split(), key=lambda w: w[::-1]))
    rows = [(1, f"some words before: {text.title()}. and after"), (2, shuffled), (3, "a text without any of that")]
    found = by_id(licenses.scan_licenses(make_docs(rows)), "labels", "score")
    assert label in found[1][0].split(",") and found[1][1] == 1.0
    assert found[2][0] == "" and found[3] == ("", 0.0)


def test_texts_without_anchors_hold_no_key_phrase():
    assert all(any(a in key for a in licenses.anchors()) for _, _, key in licenses.TEMPLATES)


def test_repeated_and_nameless_rows(make_docs):
    rows = [(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc"), (None, None)]
    found = licenses.scan_licenses(make_docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_base) for r in found) == [(0, 0), (0, 1), (1, 1), (1, 1)]
    assert licenses.scan_licenses(make_docs([])).count() == 0


TURNS = "conv_id long, turn long, role string, text string"


def transcripts(n=60):
    draw = random.Random(3)
    rows = []
    for c in range(n):
        marked = c % 3
        turns = (["system"] if draw.random() < 0.4 else []) + ["user", "assistant"] * draw.randint(1, 5)
        for t, role in enumerate(turns):
            text = {"system": "Follow these rules.", "user": "What is that?", "assistant": "It is this.\nAnd that.\nAnd more."}[role]
            rows.append((c, t, role, f"{role.title()}: {text}" if marked else text))
    return rows


def best_path(model, seen):
    n = len(chat.ROLES)
    scored = {}
    for path in itertools.product(range(n), repeat=len(seen)):
        s = model.start[path[0]] + sum(seen[t][r] for t, r in enumerate(path))
        scored[path] = s + sum(model.moves[a][b] for a, b in zip(path, path[1:]))
    return max(scored, key=scored.get)


@pytest.mark.parametrize("segment", [1, 2, 3, 256])
def test_the_path_is_the_best_of_all(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    draw = random.Random(segment)
    texts = ["User: hi?", "Assistant: x\ny", "", "long " * 30, "System: z", "ok?"]
    rows = [(c, t, None, draw.choice(texts)) for c in range(12) for t in range(draw.randint(1, 7))]
    turns = spark.createDataFrame(rows, TURNS)
    model = chat.train(spark.createDataFrame(transcripts(), TURNS))
    evidence = {(r.conv_id, r.turn): r.e for r in chat.observed(turns).select("conv_id", "turn", chat._evidence(model).alias("e")).collect()}
    found = {(r.conv_id, r.turn): r.role_pred for r in chat.parse_roles(turns, model).collect()}
    for c in range(12):
        own = sorted(t for k, t in evidence if k == c)
        want = [chat.ROLES[s] for s in best_path(model, [evidence[c, t] for t in own])]
        assert [found[c, t] for t in own] == want


def test_held_out_roles_are_recovered_and_rendered(spark):
    from tripwright.llm.sample import held_out

    turns = spark.createDataFrame(transcripts(), TURNS)
    found = chat.parse_roles(turns, chat.train(turns)).withColumn("out", held_out("conv_id")).collect()
    truth = {(c, t): role for c, t, role, _ in transcripts()}
    held = [r for r in found if r.out]
    assert len(held) > 20 and all(truth[r.conv_id, r.turn] == r.role_pred for r in held)
    assert next(r for r in found if r.rendered.startswith("<|user|>")).rendered == "<|user|>\nWhat is that?\n<|end|>"


def test_odd_turns(spark):
    model = chat.train(spark.createDataFrame(transcripts(), TURNS))
    rows = [(None, None, None, None), (None, 1, "x", "a"), (1, 1, None, ""), (1, 1, None, ""), (1, None, None, "Q: why?"), (2, 10**12, "user", "w " * 50000)]
    found = chat.parse_roles(spark.createDataFrame(rows, TURNS + ", evidence string".replace(", evidence string", "")), model).collect()
    assert len(found) == len(rows) and all(r.role_pred in chat.ROLES for r in found)
    assert "<|user|>\nwhy?\n<|end|>" in {r.rendered for r in found}
    none = spark.createDataFrame([], TURNS)
    assert chat.parse_roles(none, chat.train(none)).count() == 0
