"""Which terms set a source apart from its language, and how far sources are from each other."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.bloom import filter_of, holds
from tripwright.llm.tables import carried, pieces, unpacked, written
from tripwright.llm.terms import MORE, SHORT, letter_terms, short_prefixes, spelled, term_keys

MIN_DOCS = 30
TOP_TERMS = 50
#: Rows handled at a time, if their texts are short.
ROWS = 1024
#: On the first level prefixes have SHORT bytes; each level has so many times those of the one before.
DEEPER = 4
#: Different terms, and (source, term) counters, that a task holds before it passes them on.
HELD, WAITING = 1 << 18, 1 << 20
#: Rows that a task passes on at a time.
GIVEN = 1 << 15
#: Sources and kept terms that meet in one block of pairs.
SOURCE_BLOCK, TERM_TILE = 64, 1024
SCALE, PRIOR = 1_000_000_000, 5


def _salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each (lang, prefix), the same that ``_passing`` finds in texts."""
    for batch in batches:
        prefixes = batch.column("prefix").to_pylist()
        raw, ends = np.frombuffer(b"".join(prefixes), np.uint8), np.cumsum([len(p) for p in prefixes], dtype=np.int64)
        starts = np.concatenate((np.zeros(1, np.int64), ends))[: len(ends)]
        salts = np.array([_salt(lang) for lang in batch.column("lang").to_pylist()], np.uint64)
        keys = (term_keys(raw, starts, ends) ^ salts).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])


def _filter(prefixes: DataFrame) -> Broadcast:
    """The Bloom filter of a table (lang, prefix), in the tasks' hands."""
    keys = prefixes.select("lang", "prefix").mapInArrow(_keys, "key long")
    return carried(prefixes.sparkSession, filter_of(keys, prefixes.count()))


def _passing(bits: np.ndarray, lang: str, length: int | None) -> Callable:
    """Which terms of a text the filter lets through, by their first ``length`` bytes or whole."""
    salt = _salt(lang)

    def passing(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return holds(bits, term_keys(raw, starts, ends if length is None else np.minimum(ends, starts + length)) ^ salt)

    return passing


class _Numbers(dict):
    """Numbers things in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.things: list = []

    def __missing__(self, thing):
        self[thing] = number = len(self.things)
        self.things.append(thing)
        return number

    def of(self, things: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, things), np.int64, len(things))


class _Language:
    """What a task holds of one language: numbered terms or prefixes, and counts of them."""

    def __init__(self, passing: Callable):
        self.passing = passing
        self.terms = _Numbers()
        self.counts = np.zeros(0, np.int64)


def _by_language(piece: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for lang in pc.unique(piece.column("lang")).to_pylist():
        yield lang, piece.filter(pc.equal(piece.column("lang"), lang))


_LEVEL = pa.schema([("lang", pa.string()), ("prefix", pa.binary()), ("open", pa.bool_()), ("n", pa.int64())])


def _first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language, the documents that hold each prefix of SHORT bytes."""
    held: dict[str, tuple[list, list]] = {}
    waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            codes, counts = _summed(*parts)
            for at in range(0, len(codes), GIVEN):
                prefixes, more = spelled(codes[at : at + GIVEN])
                columns = [[lang] * len(prefixes), prefixes, more, counts[at : at + GIVEN]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LEVEL.types)], schema=_LEVEL)

    for piece in pieces(batches, ROWS):
        for lang, rows in _by_language(piece):
            mine = held.setdefault(lang, ([], []))
            for codes, counts in short_prefixes(rows.column("text")):
                mine[0].append(codes)
                mine[1].append(counts)
                waiting += len(codes)
        if waiting >= WAITING:
            for lang, parts in held.items():
                codes, counts = _summed(*parts)
                held[lang] = [codes], [counts]
            waiting = sum(len(codes[0]) for codes, _ in held.values())
            if waiting >= WAITING // 2:
                yield from flush()
                held, waiting = {}, 0
    yield from flush()


def _extend(length: int, before: int, parcel: Broadcast):
    """Per task and language, the documents that hold each prefix of ``length`` bytes.

    Terms of up to ``before`` bytes were settled on an earlier level. A longer one counts if
    its prefix of ``before`` bytes was kept; one of ``length`` bytes or fewer is complete.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = unpacked(parcel)
        languages: dict[str, _Language] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in languages.items():
                for at in range(0, len(own.terms.things), GIVEN):
                    things = own.terms.things[at : at + GIVEN]
                    more = [t.endswith(MORE) for t in things]
                    columns = [[lang] * len(things), [t.removesuffix(MORE) for t in things], more, own.counts[at : at + GIVEN]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LEVEL.types)], schema=_LEVEL)

        for piece in pieces(batches, ROWS):
            for lang, rows in _by_language(piece):
                own = languages.setdefault(lang, _Language(_passing(bits, lang, before)))
                seen = [np.zeros(0, np.int64)]
                for terms, which, row in letter_terms(rows.column("text"), before, length, own.passing):
                    seen.append(np.unique((row << 40) | own.terms.of(terms)[which]))
                once = (seen[1] if len(seen) == 2 else np.unique(np.concatenate(seen))) & ((1 << 40) - 1)
                counts = np.bincount(once, minlength=len(own.terms))
                counts[: len(own.counts)] += own.counts
                own.counts = counts
            if sum(len(x.terms) for x in languages.values()) >= HELD:
                yield from flush()
                languages = {}
        yield from flush()

    return run


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term): the terms, as bytes, that ``min_docs`` documents of a language hold.

    Byte prefixes are extended level by level, to 6, 24, 96 ... bytes. On every level each task
    counts a document once for each of its prefixes and passes one number per prefix; those
    found in too few documents go, and none of their extensions is counted again. What goes on
    is held in a Bloom filter of bounded size, which lets some prefixes through that are
    already out; their own counts put them out again. Levels end when no prefix is left open.
    """
    found: DataFrame | None = None
    parcel, before, length = None, 0, SHORT
    while True:
        level = _first_level if parcel is None else _extend(length, before, parcel)
        counted = docs.select("lang", "text").mapInArrow(level, "lang string, prefix binary, open boolean, n long")
        sums = counted.groupBy("lang", "prefix", "open").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
        level = written(sums.select("lang", "prefix", "open"), "prefixes")
        complete = level.filter(~F.col("open")).select("lang", F.col("prefix").alias("term"))
        found = complete if found is None else found.unionByName(complete)
        still_open = level.filter("open")
        if still_open.isEmpty():
            return found
        parcel = _filter(still_open)
        before, length = length, DEEPER * length


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64())])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, number = np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(flat, kind="stable")
    flat, number = flat[order], number[order]
    starts = np.flatnonzero(np.diff(flat, prepend=-1))
    return flat[starts], np.add.reduceat(number, starts) if len(starts) else number


def _occurrences(parcel: Broadcast):
    """Per task, how often each term that may be kept occurs in each (lang, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = unpacked(parcel)
        languages: dict[str, _Language] = {}
        sources = _Numbers()
        held: dict[str, tuple[list, list]] = {}

        def squeeze() -> int:
            for lang in held:
                keys, counts = _summed(*held[lang])
                held[lang] = [keys], [counts]
            return sum(len(k[0]) for k, _ in held.values())

        def flush() -> Iterator[pa.RecordBatch]:
            squeeze()
            names = pa.array(sources.things, pa.string())
            for lang, ([keys], [counts]) in held.items():
                terms = pa.array(languages[lang].terms.things, pa.binary())
                for at in range(0, len(keys), GIVEN):
                    own = keys[at : at + GIVEN]
                    columns = [pa.array([lang] * len(own), pa.string()), names.take(pa.array(own >> 32)),
                               terms.take(pa.array(own & 0xFFFFFFFF)), pa.array(counts[at : at + GIVEN])]
                    yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

        waiting = 0
        for piece in pieces(batches, ROWS):
            for lang, rows in _by_language(piece):
                own = languages.setdefault(lang, _Language(_passing(bits, lang, None)))
                lead = sources.of(rows.column("source").to_pylist()) << 32
                parts = []
                for terms, which, row in letter_terms(rows.column("text"), passing=own.passing):
                    parts.append(lead[row] | own.terms.of(terms)[which])
                flat, number = np.unique(np.concatenate(parts), return_counts=True)
                mine = held.setdefault(lang, ([], []))
                mine[0].append(flat)
                mine[1].append(number)
                waiting += len(flat)
            if waiting >= WAITING:
                waiting = 0
                full = squeeze() >= WAITING
                if full or sum(len(x.terms) for x in languages.values()) >= HELD:
                    yield from flush()
                    languages, held, sources = {}, {}, _Numbers()
        yield from flush()

    return run


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 * (count + 5) / (total + 5 * kept)) in whole numbers of any size; 0 if none is kept."""

    count, total, held = (c.cast("decimal(20,0)") for c in (count, total, kept))
    over = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = (total + F.lit(PRIOR) * held).cast("decimal(22,0)")
    return F.when(kept > 0, F.lit(1) + F.call_function("div", over, under)).otherwise(F.lit(0)).cast("long")


_PARTS = pa.schema(
    [("lang", pa.string()), ("x", pa.string()), ("y", pa.string()), ("part", pa.int64()), ("seen", pa.int64()), ("gap", pa.int64())]
)


def _distances(rows: pa.Table) -> pa.Table:
    """Sums of differences over the terms of one tile, between the sources of two blocks.

    ``seen`` is the number of terms that any of these sources holds; in all others of the tile
    two sources differ by ``gap``, the difference of their shares of a term without occurrence.
    """
    lang, first, second = (rows.column(c)[0].as_py() for c in ("lang", "a", "b"))
    rows = rows.sort_by([("source", "ascending")])
    encoded = rows.column("source").combine_chunks().dictionary_encode()
    names, number = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
    block = np.zeros(len(names), np.int64)
    block[number] = rows.column("block").to_numpy()
    p = rows.column("p").to_numpy()
    terms = rows.column("term").combine_chunks()
    none = terms.is_null().to_numpy(zero_copy_only=False)
    columns = terms.filter(pa.array(~none)).dictionary_encode()
    base = np.zeros(len(names), np.int64)
    base[number[none]] = p[none]
    dense = np.repeat(base[:, None], len(columns.dictionary), axis=1)
    dense[number[~none], columns.indices.to_numpy()] = p[~none]
    out: list[list] = [[], [], [], []]
    right = np.flatnonzero(block == second)
    for i in np.flatnonzero(block == first).tolist():
        others = right[right > i] if first == second else right
        out[0] += [names[i]] * len(others)
        out[1] += [names[j] for j in others.tolist()]
        out[2].append(np.abs(dense[i] - dense[others]).sum(1))
        out[3].append(np.abs(base[i] - base[others]))
    n = len(out[0])
    part, gap = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in out[2:])
    seen = np.full(n, dense.shape[1], np.int64)
    return pa.Table.from_arrays([pa.array([lang] * n, pa.string()), pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                                 pa.array(part), pa.array(seen), pa.array(gap)], schema=_PARTS)


def _pairs(groups: DataFrame, shares: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways.

    Sources are cut into blocks and kept terms into tiles; one task of the many holds the
    sources of two blocks over the terms of one tile.
    """
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    most = F.max("block").over(Window.partitionBy("lang"))
    placed = groups.withColumn("block", F.floor(number / F.lit(SOURCE_BLOCK)).cast("int")).withColumn("last", most)
    placed = written(placed.withColumn("tiles", F.greatest(F.lit(1), F.ceil(F.col("kept") / F.lit(TERM_TILE))).cast("int")), "sources")
    where = placed.select("lang", "source", "block", "last", "tiles")
    held = shares.select("lang", "source", "term", "p").join(where, ["lang", "source"])
    held = held.withColumn("tile", F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int"))
    bare = placed.select(
        "lang", "source", F.lit(None).cast("binary").alias("term"), F.col("p0").alias("p"), "block", "last", "tiles",
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
    )
    meeting = held.unionByName(bare).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    meeting = meeting.withColumns({"a": F.least("block", "other"), "b": F.greatest("block", "other")})
    parts = meeting.groupBy("lang", "tile", "a", "b").applyInArrow(
        _distances, "lang string, x string, y string, part long, seen long, gap long"
    )
    sums = parts.groupBy("lang", "x", "y").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"), F.max("gap").alias("gap"))
    whole = sums.join(kept, "lang", "left")
    value = F.col("part") + (F.coalesce("kept", F.lit(0)) - F.col("seen")) * F.col("gap")
    ways = [F.struct(F.col(s).alias("source"), F.col(i).alias("item")) for s, i in (("x", "y"), ("y", "x"))]
    both = F.array(*ways)
    return whole.select("lang", value.alias("value"), F.inline(both)).select("lang", "source", "item", "value")


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) over ``docs`` (text, lang, source); nulls are ''.

    Terms are runs of letters A-Z, lower-cased, and of anything beyond ASCII. A language keeps
    the terms that ``min_docs`` of its rows hold (see ``kept_terms``). A group is a (lang,
    source) that occurs. With V kept terms and N occurrences of them in the group, a kept term
    with count occurrences has the share p = 1 + floor(1e9 * (count + 5) / (N + 5 V)); q is the
    same over the whole language. All numbers are whole.

    ``pair``: for each other source of the language, the sum of the differences of p over all
    kept terms; 0 where none is kept. ``term``: the ``top`` kept terms that occur in the group
    and have p > q, by p - q. Ranks count from 1 per group and part, by value descending, then
    item ascending in UTF-8. Equal rows are documents of their own. A language with one source
    has no pairs. An empty table gives no rows. Other columns are ignored.

    Texts are read once a level and once for the occurrences and never shuffled.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    terms = written(kept_terms(rows, min_docs), "kept")
    parcel = _filter(terms.withColumnRenamed("term", "prefix"))
    counted = rows.mapInArrow(_occurrences(parcel), "lang string, source string, term binary, n long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    counts = written(summed.join(terms, ["lang", "term"]), "counts")

    kept = terms.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(kept, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.na.fill(0, ["kept", "total"])
    groups = written(groups.withColumn("p0", share(F.lit(0), F.col("total"), F.col("kept"))), "groups")
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("all"), F.max("kept").alias("kept"))
    by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang")
    by_lang = by_lang.select("lang", "term", share(F.col("n"), F.col("all"), F.col("kept")).alias("q"))
    apart = shares.join(by_lang, ["lang", "term"]).filter(F.col("p") > F.col("q"))
    apart = apart.select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    named = apart.withColumn("rank", rank).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    pairs = _pairs(groups, shares, kept).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(named.select(*columns))


DIVERGENCE_SQL = """
with docs as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents
), words as (
    select d, lang, source, unnest(terms) as term from docs
), kept as (
    select lang, term from words group by lang, term having count(distinct d) >= 30
), sizes as (
    select lang, count(*)::hugeint as v from kept group by lang
), grouped as (
    select distinct lang, source from docs
), counts as (
    select lang, source, term, count(*)::hugeint as n from words semi join kept using (lang, term) group by all
), dense as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n
    from grouped g join kept k using (lang) left join counts c using (lang, source, term)
), shares as (
    select lang, source, term, n,
        1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source)::hugeint + 5 * v) as p
    from dense join sizes using (lang)
), whole as (
    select lang, term, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang)::hugeint + 5 * v) as q
    from (select lang, term, sum(n)::hugeint as n from dense group by lang, term) join sizes using (lang)
), distances as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p))::bigint as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
    select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value
    from grouped a join grouped b on a.lang = b.lang and a.source <> b.source
    left join distances t on t.lang = a.lang and t.source = a.source and t.item = b.source
), apart as (
    select lang, source, term as item, (p - q)::bigint as value from shares join whole using (lang, term) where n > 0 and p > q
), ranked as (
    select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term' as part, item, value from apart
), numbered as (
    select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from ranked
)
select lang, source, part, item, value, rank from numbered where part = 'pair' or rank <= 50
"""
