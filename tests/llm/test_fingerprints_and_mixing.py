from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from tripwright.llm import merkle, mixing
from tripwright.llm.queries import op6_mix_sources

TEXT = "\n".join(f"Paragraph {k} says something. It has two sentences of its own {k}." for k in range(40))


def test_equal_texts_have_equal_roots_and_edits_are_located():
    lines = TEXT.split("\n")
    lines[17] = "Something else."
    a, b = merkle.tree(TEXT), merkle.tree("\n".join(lines))
    assert merkle.tree(TEXT).text() == a.text() and a.root != b.root
    assert merkle.parse(a.text()) == a
    assert merkle.edits(a.text(), b.text()) == [17] and merkle.edits(a.text(), a.text()) == []
    assert 0.9 < merkle.likeness(a, b) < 1 and merkle.likeness(a, merkle.tree("Other words!")) == 0


def test_all_characters_are_in_the_tree():
    for text in (TEXT, "", "a.b!?  c\t", "...", " x " * 50, "é" * 100):
        assert all("".join(merkle._PIECE.findall(p)) == p for p in text.split("\n"))
        assert merkle.tree(text).root != merkle.tree(text + " ").root


def test_moved_lines_keep_most_of_the_tree():
    lines = TEXT.split("\n")
    moved = "\n".join([*lines[5:], *lines[:5]])
    assert merkle.likeness(merkle.tree(TEXT), merkle.tree(moved)) == 1.0


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc_id, text) in enumerate(order):
        changed = merkle.edited(text or "", order[(k + 1) % len(order)][1] or "")
        out[doc_id] = (len(text or ""), hashlib.sha256(changed.encode()).hexdigest())
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 57])
def test_the_next_document_is_the_right_one(make_docs, n):
    rows = [((7 * k) % 101, [None, "", "ab", TEXT[k : k + 200 + k]][k % 4]) for k in range(n)]
    found = merkle.fingerprint_documents(make_docs(rows, extra={"part": 1, "place": 2}))
    assert by_id(found, "n_chars", "edited_sha256") == expected(rows)
    for r in found.collect():
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_repeated_and_nameless_rows_keep_their_place(make_docs):
    rows = [(2, "bbb"), (2, "bbb"), (1, "aaa"), (None, "nnn"), (None, "nnn")]
    found = merkle.fingerprint_documents(make_docs(rows)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((r.doc_id or 0, r.edited_sha256) for r in found)
    assert got == sorted([(2, sha("bbb")), (2, sha("bba")), (1, sha("aan")), (0, sha("nnn")), (0, sha("nnb"))])
    assert merkle.fingerprint_documents(make_docs([])).count() == 0


def walk(classes, periods):
    """All (class, member, block, slot) of the first periods, one period after the other."""
    schedule = mixing.Schedule(classes)
    return [x for j in range(periods) for x in schedule.planned(j)], schedule


WEIGHTS = [
    [(1, 1)], [(1, 1), (999, 1)], [(333, 2), (334, 1)], [(k + 1, 1) for k in range(25)], [(7, 1), *[(1 + k / 37, 1) for k in range(19)]],
    [(0.3, 3), (0.001, 90), (0.01, 1)], [(0.18, 5), (0.001, 100)], [(3**0.5, 4), (2**0.5, 7), (0.1, 3)], [(1, 1), (1e-4, 2)], [(5, 40)],
]


@pytest.mark.parametrize("weights", WEIGHTS)
@pytest.mark.parametrize("period", [4, 64])
def test_every_source_stays_within_one_block_across_periods(monkeypatch, weights, period):
    """Periods are planned apart, and still no source is ever a block off its weight."""
    monkeypatch.setattr(mixing, "PERIOD", period)
    plan, schedule = walk([(w, 1 << 40, m) for w, m in weights], 40)
    total = sum(Fraction(w) * m for w, m in weights)
    exact = [Fraction(w) / total for w, m in weights for _ in range(m)]
    start = [sum(m for _, m in weights[:c]) for c in range(len(weights))]
    got = [0] * len(exact)
    assert [p[3] for p in plan] == list(range(40 * schedule.period))
    for n, (c, member, k, slot) in enumerate(plan):
        assert k == got[start[c] + member]
        got[start[c] + member] += 1
        if n < 3000 or n % 101 == 0 or slot % schedule.period in (0, schedule.period - 1):
            assert all(abs(g - w * (slot + 1)) < 1 for g, w in zip(got, exact))


def test_periods_meet_for_random_weights(monkeypatch):
    draw = random.Random(4)
    monkeypatch.setattr(mixing, "LOOK", 7)
    for _ in range(60):
        monkeypatch.setattr(mixing, "PERIOD", draw.choice([2, 8, 32]))
        weights = [(draw.choice([draw.random(), draw.random() ** 4 + 0.01, 1.0, 0.5]), draw.randint(1, 4)) for _ in range(draw.randint(1, 7))]
        plan, schedule = walk([(w, 1 << 40, m) for w, m in weights], 6)
        total = sum(Fraction(w) * m for w, m in weights)
        got = {}
        assert [p[3] for p in plan] == list(range(6 * schedule.period))
        for c, member, k, slot in plan:
            assert got.get((c, member), 0) == k
            got[c, member] = k + 1
            w = Fraction(weights[c][0]) / total
            assert abs(k + 1 - w * (slot + 1)) < 1 and k <= w * (slot + 1)


def test_weights_far_apart_end_within_64_bits():
    plan, schedule = walk([(1e-300, 3, 1), (1.0, 5, 2)], 1)
    assert schedule.period is None and len(plan) == 13
    assert len({p[3] for p in plan}) == 13 and max(p[3] for p in plan) < 1 << 59


def test_a_mixture_keeps_every_row_and_the_weights(make_docs):
    rows = [(k, f"t{k}", None, "ab"[k % 4 == 0]) for k in range(800)] + [(900, "x", None, None), (901, "y", None, "never")]
    docs = make_docs(rows, extra={"mix_slot": 1, "row": 2, "key": 3, "share": 4})
    weights = {"a": 1, "b": 1, "": 0.2}
    placed = mixing.mix(docs, weights, block=4).collect()
    assert sorted(r["row"].doc_id for r in placed) == sorted(r[0] for r in rows)
    named = [r for r in placed if r.mix_place is not None]
    assert len({r.mix_place for r in named}) == len(named) == len(rows) - 1
    first = {r.mix_slot for r in named if r.source == "b" and r.mix_slot < 100}
    assert len(first) in (45, 46)
    ordered = mixing.in_order(docs, weights)
    assert ordered.columns == docs.columns
    named = [r for r in mixing.mix(docs, weights).collect() if r.mix_place is not None]
    want = [r["row"].doc_id for r in sorted(named, key=lambda r: r.mix_place)] + [901]
    assert [r.doc_id for r in ordered.collect()] == want


def test_the_query_holds_uneven_weights_over_many_slots(spark, make_docs, tmp_path, monkeypatch):
    """Blocks of one row: over 10^5 slots of the query no source is a block off while all last."""
    monkeypatch.setattr(mixing.mix, "__defaults__", (1,))
    counts = [60_000, *[2_000 + 317 * k for k in range(19)]]
    spark.sql("select 1 as x").select(
        F.posexplode(F.array(*[F.lit(n) for n in counts])).alias("s", "n")
    ).select("s", F.explode(F.sequence(F.lit(1), "n")).alias("k")).selectExpr(
        "cast(k * 100 + s as long) as doc_id", "'x' as text", "cast(null as string) as lang", "concat('s', s) as source", "1L as n_chars"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    placed = op6_mix_sources(spark, str(tmp_path)).select("mix_slot", "source", "mix_block").toPandas().sort_values("mix_slot")
    assert len(placed) == sum(counts) > 100_000 and placed.mix_slot.is_unique
    total = sum(Fraction(n**0.5) for n in counts)
    last = min(int(Fraction(n) * total / Fraction(n**0.5)) for n in counts)
    first_dry = int((placed.mix_slot < last).sum())
    assert first_dry == last and list(placed.mix_slot[:last]) == list(range(last))
    for s, n in enumerate(counts):
        own = placed[placed.source == f"s{s}"]
        w = float(Fraction(n**0.5) / total)
        behind = own.mix_slot.to_numpy() * w - own.mix_block.to_numpy()
        # Block k stands in a slot from k / w on, and its slot ends before (k + 1) / w.
        assert (behind + w > -1e-6).all() and (behind + w < 1 + w + 1e-6).all()


def test_a_mixture_follows_weights_that_are_no_whole_slots(make_docs):
    weights = {"a": 2004, "b": 2004, "c": 2004, "d": 2004, "e": 1984}
    docs = make_docs([(k, "x", None, "abcde"[k % 5]) for k in range(30_000)])
    placed = sorted((r.mix_slot, r.source) for r in mixing.mix(docs, weights, block=1).collect())
    got = dict.fromkeys(weights, 0)
    for slot, (at, source) in enumerate(placed):
        got[source] += 1
        assert at == slot and all(abs(got[s] - Fraction(w * (slot + 1), 10_000)) < 1 for s, w in weights.items())
        if 6000 in got.values():
            break


@pytest.mark.parametrize("small", [995, 1100])
def test_many_sources_are_mixed_whole(spark, make_docs, tmp_path, small):
    rows = [(k, "x", None, f"s{k}") for k in range(small)] + [(small + k, "x", None, "big") for k in range(40_000)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    placed = op6_mix_sources(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in placed) == list(range(len(rows)))
    assert len({r.mix_place for r in placed}) == len(rows) and None not in {r.mix_place for r in placed}
    total = small + Fraction(200.0)  # roots of 1 and of 40,000
    for r in placed:
        w = Fraction(200) / total if r.source == "big" else 1 / total
        assert r.mix_block / w - 1 < r.mix_slot < (r.mix_block + 1) / w + 1


def test_mixing_nothing(make_docs):
    empty = make_docs([])
    assert mixing.mix(empty, mixing.targets(empty)).count() == 0
    assert mixing.mix(empty, {"a": 1.0}).count() == 0 and mixing.Schedule([]).periods() == 0
