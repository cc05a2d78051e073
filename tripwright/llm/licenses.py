"""Licences named or quoted in a text, by a positional index of rare words; Spark functions only."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The phrases that always count, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Wording of well-known public licences and notices: label, text, key phrase.
TEMPLATES = [
    ("mit", "released under the mit license", "under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge to any person",
    ),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted",
        "permission to use copy modify and or distribute this software",
    ),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2"),
    ("epl-2", "made available under the terms of the eclipse public license 2 0", "eclipse public license 2"),
    ("bsl-1", "distributed under the boost software license version 1 0", "boost software license version 1"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    (
        "cc-by-sa",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        "creative commons attribution sharealike",
    ),
]
#: Words of a template that are looked up: its rarest among all templates.
RARE = 6
#: Share of a template's rare words, by their weight, that must stand at one offset.
ENOUGH = 0.6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


@dataclass(frozen=True)
class Posting:
    word: str
    template: int
    at: int
    weight: float


def index() -> list[Posting]:
    """Where the rare words of each template stand, with their share of its weight."""
    split = [text.split() for _, text, _ in TEMPLATES]
    spread = Counter(w for words in split for w in set(words))
    idf = {w: math.log(1 + len(TEMPLATES) / n) for w, n in spread.items()}
    postings = []
    for number, words in enumerate(split):
        rare = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE]
        at = [(w, k) for k, w in enumerate(words) if w in rare]
        total = sum(idf[w] for w, _ in at)
        postings += [Posting(w, number, k, idf[w] / total) for w, k in at]
    return postings


def anchors() -> list[str]:
    """A few words of which every key phrase has one: texts without any cannot be labelled."""
    phrases = [key.split() for _, _, key in TEMPLATES]
    chosen: list[str] = []
    while phrases:
        often = Counter(w for p in phrases for w in set(p) if len(w) > 3)
        if not often:
            return sorted({*chosen, *(p[0] for p in phrases)})
        best = min(often, key=lambda w: (-often[w], w))
        chosen.append(best)
        phrases = [p for p in phrases if best not in p]
    return sorted(chosen)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BREAK), lambda w: w != "")


def _starts(words: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase begins."""
    own = phrase.split()
    last = F.size(words) - len(own)
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def here(k: Column) -> Column:
        found = F.lit(True)
        for j, word in enumerate(own):
            found = found & (F.get(words, k + j) == word)
        return found

    return F.filter(places, here)


def _pattern(phrases: list[str]) -> str:
    return "(?i)" + "|".join(_GAP.join(p.split()) for p in phrases)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences in ``docs`` (doc_id, text), one row per document.

    (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score). Base labels
    come from the phrases of BASE alone. The method adds labels: the rare words of a text are
    looked up in the templates' index, and words that stand in a text as they do in a template
    agree on an offset. Where ENOUGH of a template's weight agrees and its key phrase begins
    at the right word, its label is given. ``score`` is 1 with a base label, else the best
    share of any template, 0 without an anchor word.

    Null texts have no words. Equal rows get equal results, ids may repeat or be null. Texts
    are read twice and never shuffled; texts without an anchor word, nearly all, are only
    counted.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    maybe = F.col("text").rlike(_pattern(list(BASE)))
    words = F.when(maybe, _words(F.col("text"))).otherwise(F.array().cast("array<string>"))
    counted = rows.select("doc_id", "print", F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"), words.alias("words"))
    for k, phrase in enumerate(BASE):
        counted = counted.withColumn(f"base{k}", _starts(F.col("words"), phrase))
    every = F.concat(*[f"base{k}" for k in range(len(BASE))])
    named = F.array_compact(F.array(*[F.when(F.size(f"base{k}") > 0, label) for k, label in enumerate(BASE.values())]))
    base = counted.select(
        "doc_id",
        "print",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(named)).alias("base"),
    )
    more = _by_index(rows)
    joined = base.join(more, (base.doc_id.eqNullSafe(more.of)) & (base["print"] == more.of_print), "left")
    every_label = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every_label, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.round("share", 6), F.lit(0.0))).alias("score"),
    )


#: Set in a mask where the key phrase stands; the other bits are words of the template.
_KEY_BIT = 1 << 62


def _by_index(rows: DataFrame) -> DataFrame:
    """(of, of_print, found, share) of texts that share an offset with a template.

    A text gives a row for each rare word and each key phrase in it. Rows that agree on the
    template's offset are put together as bits, in the map tasks first; words do not move.
    """
    postings = index()
    rare = sorted({p.word for p in postings})
    cells = [
        F.struct(F.lit(p.word).alias("rare"), F.lit(p.template).alias("template"), F.lit(p.at).alias("at"))
        for p in postings
    ]
    listed = rows.sparkSession.range(1).select(F.inline(F.array(*cells)))
    texts = rows.filter(F.col("text").rlike("(?i)" + "|".join(anchors())))
    texts = texts.select("doc_id", "print", _words(F.col("text")).alias("words"))
    numbered = F.transform("words", lambda w, k: F.struct(w.alias("word"), F.lit(None).cast("int").alias("key"), k.alias("place")))
    tokens = F.filter(numbered, lambda t: t["word"].isin(rare))
    keys = [_keys_of(k, template) for k, template in enumerate(TEMPLATES)]
    seen = texts.select("doc_id", "print", F.inline(F.concat(tokens, *keys)))
    met = seen.join(F.broadcast(listed), F.col("word") == F.col("rare"), "left")
    bit = F.when(F.col("key").isNotNull(), F.lit(_KEY_BIT)).otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at")))
    votes = met.select(
        "doc_id",
        "print",
        F.coalesce("key", "template").alias("template"),
        (F.col("place") - F.coalesce("at", F.lit(0))).alias("offset"),
        bit.alias("bit"),
    )
    masks = votes.groupBy("doc_id", "print", "template", "offset").agg(F.bit_or("bit").alias("mask"))
    own = F.get(_weights(postings), F.col("template"))
    held = F.transform(own, lambda w: F.when(F.col("mask").bitwiseAND(w["bit"]) != 0, w["weight"]).otherwise(0.0))
    share = F.round(F.aggregate(held, F.lit(0.0), lambda total, w: total + w), 6)
    label = F.get(F.array(*[F.lit(name) for name, _, _ in TEMPLATES]), F.col("template"))
    named = (F.col("share") >= ENOUGH) & (F.col("mask").bitwiseAND(F.lit(_KEY_BIT)) != 0)
    best = masks.withColumn("share", share).groupBy("doc_id", "print").agg(
        F.max("share").alias("share"), F.collect_set(F.when(named, label)).alias("found")
    )
    return best.select(F.col("doc_id").alias("of"), F.col("print").alias("of_print"), "found", "share")


def _weights(postings: list[Posting]) -> Column:
    """Per template, the bits of its rare words and what they weigh."""
    per_template = []
    for k in range(len(TEMPLATES)):
        own = [F.struct(F.lit(1 << p.at).cast("bigint").alias("bit"), F.lit(p.weight).alias("weight")) for p in postings if p.template == k]
        per_template.append(F.array(*own))
    return F.array(*per_template)


def _keys_of(number: int, template: tuple[str, str, str]) -> Column:
    """Where a template would begin, for each place of its key phrase in the words."""
    words, key = template[1].split(), template[2].split()
    at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
    none = F.lit(None).cast("string")
    return F.transform(
        _starts(F.col("words"), template[2]),
        lambda s: F.struct(none.alias("word"), F.lit(number).alias("key"), (s - at).alias("place")),
    )


def _license_sql() -> str:
    lowered = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    postings = ", ".join(f"('{p.word}', {p.template}, {p.at}, {p.weight!r}::double)" for p in index())
    keys = []
    for k, (label, text, key) in enumerate(TEMPLATES):
        own, words = key.split(), text.split()
        at = next(j for j in range(len(words)) if words[j : j + len(own)] == own)
        keys.append(f"({k}, '{label}', {at}, {[*own]!r})")
    base = ", ".join(f"('{label}', {p.split()!r})" for p, label in BASE.items())
    return f"""
with docs as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
    from documents
), base as (select * from (values {base}) as t(label, own)
), places as (
    select doc_id, label, k - 1 as place
    from (select doc_id, words, label, own, unnest(range(1, len(words) - len(own) + 2)) as k from docs, base)
    where words[k : k + len(own) - 1] = own
), found_base as (
    select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word, list(distinct label) as base
    from places group by doc_id
), postings as (select * from (values {postings}) as t(word, template, pos, weight)
), key_words as (select * from (values {", ".join(keys)}) as t(template, label, pos, own)
), tokens as (
    select doc_id, unnest(words) as word, generate_subscripts(words, 1) - 1 as place
    from docs where regexp_matches(text, '(?i){"|".join(anchors())}')
), votes as (
    select distinct t.doc_id, p.template, t.place - p.pos as off, p.pos, p.weight
    from tokens t join postings p on t.word = p.word
), shares as (
    select doc_id, template, off, round(sum(weight), 6) as share from votes group by all
), top as (select doc_id, max(share) as share from shares group by doc_id
), named as (
    select s.doc_id, list(distinct k.label) as found
    from shares s join key_words k on s.template = k.template join docs d on d.doc_id = s.doc_id
    where s.share >= {ENOUGH} and s.off + k.pos >= 0
        and d.words[s.off + k.pos + 1 : s.off + k.pos + len(k.own)] = k.own
    group by s.doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(b.n_base, 0)::bigint as n_base,
    b.first_word::bigint as first_word, b.last_word::bigint as last_word,
    array_to_string(list_sort(coalesce(b.base, [])), ',') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(b.base, []), coalesce(n.found, [])))), ',') as labels,
    case when b.n_base > 0 then 1.0::double else coalesce(round(t.share, 6), 0)::double end as score
from docs d left join found_base b using (doc_id) left join top t using (doc_id) left join named n using (doc_id)
"""


LICENSE_SQL = _license_sql()
