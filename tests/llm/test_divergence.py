"""The audit of sources against plain counting, and its prefixes level by level."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripwright.llm import divergence, terms
from tripwright.llm.bloom import filter_of, holds
from tripwright.llm.divergence import audit_sources, kept_terms


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(rows, min_docs=30, top=50):
    docs = [(lang or "", source or "", words(text)) for _, text, lang, source in rows]
    df, groups, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, _, terms in docs:
        df[lang].update(set(terms))
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in df.items()}
    for lang, source, terms in docs:
        own = Counter(t for t in terms if df[lang][t] >= min_docs)
        groups[lang, source].update(own)
        langs[lang].update(own)

    def shares(lang, counts):
        v, n = len(kept[lang]), sum(counts.values())
        return {t: 1 + (10**9 * (counts[t] + 5)) // (n + 5 * v) for t in kept[lang]}

    p = {g: shares(g[0], c) for g, c in groups.items()}
    q = {lang: shares(lang, c) for lang, c in langs.items()}
    out = []
    for lang, source in p:
        own = p[lang, source]
        pairs = [(-sum(abs(own[t] - p[g][t]) for t in own), g[1].encode(), g[1]) for g in p if g[0] == lang and g[1] != source]
        terms = [(q[lang][t] - own[t], t.encode(), t) for t in own if groups[lang, source][t] and own[t] > q[lang][t]]
        for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, name, -value, k + 1) for k, (value, _, name) in enumerate(listed)]
    return sorted(out)


def audited(docs, **more):
    return sorted(tuple(r) for r in audit_sources(docs, **more).collect())


def corpus(seed, n=150):
    draw = random.Random(seed)
    vocabulary = ["a", "ab", "abcd", "abcde", "abcdefgh", "abcdefghi", "é", "日本語", "日本", "ßtraße", "x" * 40, "x" * 41]
    vocabulary += [f"term{chr(97 + k)}" for k in range(15)]
    rows = []
    for d in range(n):
        lang, source = draw.choice([("en", "s1"), ("en", "s1"), ("en", "s2"), ("de", None), ("de", "ß"), (None, "only")])
        some = draw.sample(vocabulary, 14)
        rows.append((d, " ".join(draw.choice(some).title() for _ in range(draw.randint(0, 30))), lang, source))
    return rows + [(None, None, "en", "bare"), (1, "", "xx", "p"), (1, "12 34", "xx", "q"), (1, "zz", "xx", "r")]


@pytest.mark.parametrize(("seed", "min_docs"), [(1, 30), (2, 5), (3, 1)])
def test_equals_plain_counting(make_docs, seed, min_docs):
    rows = corpus(seed)
    docs = make_docs(rows, extra={"term": "t", "n": 1, "p": 2, "block": 3})
    assert audited(docs, min_docs=min_docs, top=7) == brute(rows, min_docs, 7)


def test_blocks_tiles_and_flushes_change_nothing(make_docs, monkeypatch):
    draw = random.Random(5)
    rows = [(d, " ".join(f"t{chr(97 + draw.randrange(26))}" for _ in range(9)), "en", f"s{draw.randrange(9)}") for d in range(200)]
    for name, value in {"SOURCE_BLOCK": 2, "TERM_TILE": 5, "HELD": 8, "WAITING": 9, "GIVEN": 3, "DEEPER": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    assert audited(make_docs(rows), min_docs=3) == brute(rows, 3)


def test_only_extensions_of_kept_prefixes_are_counted(spark, make_docs):
    rows = [(d, f"common{'abcdefgh'[d % 8]}long and rare{chr(97 + d % 26)}{d // 26}", "en", "s") for d in range(64)]
    found = {bytes(r.term).decode() for r in kept_terms(make_docs(rows), 8).collect()}
    assert found == {f"common{c}long" for c in "abcdefgh"} | {"and"}


def test_a_filter_holds_its_keys_and_little_else(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as key")
    own = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    bits = filter_of(keys, 5000)
    assert holds(bits, own).all()
    assert holds(bits, own + np.uint64(1)).sum() < 250
    assert not filter_of(keys.limit(0), 0).any()


def test_counts_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(divergence.share(F.lit(3 * 10**13), F.lit(7 * 10**14), F.lit(10**9)).alias("p")).head()
    assert row.p == 1 + (10**9 * (3 * 10**13 + 5)) // (7 * 10**14 + 5 * 10**9)


def test_terms_of_many_texts_at_once(monkeypatch):
    draw = random.Random(9)
    letters = ["a", "Z", "é", "日", " ", "1", "\n", "b", "c"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(200)]
    texts += [None, "", "x" * 15 + "A", "x" * 16 + "a", "x" * 17, "y" * 8 + "z" + "y" * 8, "y" * 8 + "w" + "y" * 8]
    for size, longer in ((1 << 20, 0), (40, 0), (40, 2), (1 << 20, 8)):
        monkeypatch.setattr(terms, "STRETCH", size)
        got = [Counter() for _ in texts]
        for distinct, which, row in terms.letter_terms(pa.array(texts), longer):
            assert len(set(distinct)) == len(distinct)
            for w, r in zip(which.tolist(), row.tolist()):
                got[r][distinct[w].decode()] += 1
        assert got == [Counter(t for t in words(x) if len(t.encode()) > longer) for x in texts]
        cut = [Counter() for _ in texts]
        for distinct, which, row in terms.letter_terms(pa.array(texts), longer, 9):
            for w, r in zip(which.tolist(), row.tolist()):
                cut[r][distinct[w]] += 1
        whole = [[t.encode() for t in words(x) if len(t.encode()) > longer] for x in texts]
        assert cut == [Counter(t if len(t) <= 9 else t[:9] + b"+" for t in x) for x in whole]


def test_short_prefixes_of_many_texts(monkeypatch):
    texts = ["abcdef abcdefg ab AB", None, "é日本語 x1y", "abcdefg " * 3, "z" * 50 + " abcdef"]
    want = Counter()
    for t in texts:
        own = {w.encode() for w in words(t)}
        want.update({(w[:6], len(w) > 6) for w in own})
    for size in (1 << 20, 30):
        monkeypatch.setattr(terms, "STRETCH", size)
        got = Counter()
        for codes, counts in terms.short_prefixes(pa.array(texts)):
            for prefix, more, n in zip(*terms.spelled(codes), counts.tolist()):
                got[prefix, bool(more)] += n
        assert got == want


def test_empty_table_and_one_long_term(make_docs):
    assert audited(make_docs([])) == []
    rows = [(d, "q" * 3_000_000 + " w", "en", f"s{d}") for d in range(2)]
    assert audited(make_docs(rows), min_docs=2) == brute(rows, 2)
