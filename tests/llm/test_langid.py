from __future__ import annotations

import random

import numpy as np

from tripwright.llm import langid

WORDS = {
    "aa": ["lorem", "ipsum", "dolor", "amet"],
    "bb": ["zwölf", "straße", "über", "größe"],
    "cc": ["kikoko", "wakaka", "kuku", "mwiki"],
    "dd": ["xyzzy", "qwyx", "zyxq", "yxyx"],
}


def corpus(n=160):
    draw = random.Random(1)
    rows = []
    for k in range(n):
        lang = sorted(WORDS)[k % 4]
        rows.append((k, " ".join(draw.choices(WORDS[lang], k=12)), lang, "s"))
    return rows


def test_codewords_differ_in_many_places():
    for n in (1, 2, 3, 4, 5, 6, 7, 12, 40):
        codes = langid.codewords(n)
        assert len(codes) == n and set(np.unique(codes)) <= {-1, 1}
        gaps = [(a != b).sum() for k, a in enumerate(codes) for b in codes[:k]]
        if n >= 3:
            assert min(gaps) >= codes.shape[1] // 2


def test_a_wrong_bit_is_mended():
    codes = langid.codewords(5)
    model = langid.Model(list("abcde"), codes, np.zeros((langid.FEATURES, 15)), np.zeros(15), np.ones(15))
    for k, code in enumerate(codes):
        votes = 3.0 * code
        votes[[2, 7, 11]] *= -1
        model.bias = votes
        name, score, unclear = model.predict(["text"])[0]
        assert name == "abcde"[k] and score > 0.5 and not unclear


def test_languages_are_learned_from_the_fold_and_told_on_the_rest(make_docs):
    docs = make_docs(corpus())
    found = {r.doc_id: r for r in langid.identify(docs, langid.train(docs, 50)).collect()}
    truth = {r[0]: r[2] for r in corpus()}
    held = [r for r in found.values() if r.held_out]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1 for r in held)


def test_held_out_rows_and_labels_do_not_matter(make_docs):
    from tripwright.llm.sample import held_out

    docs = make_docs(corpus())
    out = {r.doc_id for r in docs.filter(held_out()).collect()}
    other = make_docs([(i, t if i not in out else "zzz", lang if i not in out else "cc", s) for i, t, lang, s in corpus()])
    a, b = langid.train(docs, 50), langid.train(other, 50)
    assert (a.weights == b.weights).all() and a.languages == b.languages


def test_texts_without_letters_are_unknown(make_docs):
    docs = make_docs([*corpus(), (900, None, "aa", "s"), (901, "", "aa", "s"), (None, "12 !?", None, "s"), (903, "zwölf über", None, None)])
    found = {r.doc_id: r for r in langid.identify(docs, langid.train(docs, 50)).collect()}
    assert all((found[k].lang_pred, found[k].score) == ("und", 0.0) for k in (900, 901, None))
    assert found[903].lang_pred == "bb" and not found[None].held_out


def test_a_text_does_not_depend_on_its_neighbours():
    texts = ["abc def", "", "ghi" * 50, "x"]
    alone = np.concatenate([langid.features([t]) for t in texts])
    assert np.allclose(alone, langid.features(texts))


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "abc", None, "s")])
    assert langid.identify(docs, langid.train(docs)).first().lang_pred == "und"
    assert langid.identify(make_docs([]), langid.train(make_docs([]))).count() == 0
