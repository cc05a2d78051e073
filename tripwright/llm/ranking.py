"""Ranked lexical search: every item against every document, by dense blocked multiplication."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.tables import carried, pieces, unpacked, written
from tripwright.llm.terms import WORDS, stretches

TOP = 10
#: Items of a tile, terms of a tile, and documents of a tile: what one multiplication takes.
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 512, 256
#: Different item terms that a worker holds at a time, and the postings (item, term) of these items;
#: more items make another pass over the documents.
GROUP_TERMS, GROUP_POSTINGS = 1 << 19, 1 << 21
#: Sums of whole numbers up to here are exact in float64, in any order of adding.
EXACT = 1 << 53
#: An impact is below this: (1e9 * tf) div (1000 * tf + 8 * m) with m of 25 at least.
IMPACT = 1_000_000


@dataclass
class Items:
    """A group of items: their distinct terms, and per item how often it holds each."""

    terms: dict[bytes, int] = field(default_factory=dict)
    numbers: list[int] = field(default_factory=list)
    columns: list[np.ndarray] = field(default_factory=list)
    repeats: list[np.ndarray] = field(default_factory=list)
    postings: int = 0

    def add(self, number: int, text: str | None) -> None:
        counts: Counter[bytes] = Counter()
        for own in stretches(text, WORDS):
            counts.update(own)
        if counts:
            self.numbers.append(number)
            self.columns.append(np.array([self.terms.setdefault(t, len(self.terms)) for t in counts], np.int64))
            self.repeats.append(np.fromiter(counts.values(), np.int64, len(counts)))
            self.postings += len(counts)

    def full(self) -> bool:
        return len(self.terms) >= GROUP_TERMS or self.postings >= GROUP_POSTINGS


def weight(n_docs: int, df: int) -> int:
    """floor(1000 * ln((2 N + 2) / (2 df + 1))) in doubles."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Tile:
    """Some columns of one item tile: of group term ``columns[j]`` the item i has ``values[i, j]``."""

    columns: np.ndarray
    rows: np.ndarray
    inner: np.ndarray
    values: np.ndarray
    n_items: int

    def dense(self) -> np.ndarray:
        out = np.zeros((self.n_items, len(self.columns)))
        out[self.rows, self.inner] = self.values
        return out


def tiles_of(items: Items, weights: np.ndarray, first: int, last: int) -> list[Tile]:
    """Term tiles over the compact vocabulary of items ``first`` to ``last``.

    Within a tile no item's weights add up to EXACT / IMPACT, so no sum of products leaves the
    whole numbers that float64 holds. An item whose weights are too large for that has them
    spread over more tiles; one cell that is too large alone is cut into several.
    """
    most = EXACT // IMPACT - 1
    rows = np.concatenate([np.full(len(items.columns[i]), i - first) for i in range(first, last)])
    columns = np.concatenate(items.columns[first:last])
    values = weights[columns] * np.concatenate(items.repeats[first:last])
    while len(values) and values.max() > most:
        over = values > most
        rows, columns = np.concatenate((rows, rows[over])), np.concatenate((columns, columns[over]))
        values = np.concatenate((np.minimum(values, most), values[over] - most))
    keep = values > 0
    rows, columns, values = rows[keep], columns[keep], values[keep]
    if not len(values):
        return []
    # A cell that was cut has its parts in tiles of their own: layer k holds the k-th parts.
    order = np.lexsort((rows, columns))
    rows, columns, values = rows[order], columns[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    starts = np.flatnonzero(new)
    layer = np.arange(len(rows)) - starts[np.cumsum(new) - 1]
    out = []
    for k in range(int(layer.max()) + 1):
        own = layer == k
        r, c, v = rows[own], columns[own], values[own]
        used, inner = np.unique(c, return_inverse=True)
        at = 0
        while at < len(used):
            end = min(at + TERM_TILE, len(used))
            while True:
                here = (inner >= at) & (inner < end)
                if end == at + 1 or np.bincount(r[here], v[here]).max() <= most:
                    break
                end = at + (end - at) // 2
            out.append(Tile(used[at:end], r[here], inner[here] - at, v[here], last - first))
            at = end
    return out


class Best:
    """The ``top`` best documents of every item so far, equal scores by ascending id, null ids last."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.least = np.zeros(n_items, np.int64)  # the score to reach; 0 while places are free
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """Scores (items from ``first`` on x documents). Ties with the last place stay in."""
        i, d = np.nonzero((scores > 0) & (scores >= self.least[first : first + len(scores), None]))
        if not len(i):
            return
        item = np.concatenate((self.item, i + first))
        score = np.concatenate((self.score, scores[i, d]))
        ids, nulls = np.concatenate((self.doc, doc[d])), np.concatenate((self.null, null[d]))
        order = np.lexsort((ids, nulls, -score, item))
        item, score, ids, nulls = item[order], score[order], ids[order], nulls[order]
        begins = np.searchsorted(item, item)
        place = np.arange(len(item)) - begins
        keep = place < self.top
        self.item, self.score, self.doc, self.null = item[keep], score[keep], ids[keep], nulls[keep]
        last = place == self.top - 1
        self.least[item[last]] = score[last]


def _term_counts(text: str | None, get) -> tuple[int, np.ndarray, np.ndarray]:
    """All terms of a text with repeats; the group's terms among them and how often they occur."""
    n, found = 0, []
    for own in stretches(text, WORDS):
        n += len(own)
        ids = np.fromiter(map(get, own), np.int64, len(own))
        found.append(np.unique(ids[ids >= 0], return_counts=True))
    if len(found) == 1:
        return n, *found[0]
    if not found:
        return n, np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return n, ids, np.bincount(at, np.concatenate([f[1] for f in found])).astype(np.int64)


class _Absent(dict):
    def __missing__(self, key):
        return -1


_STATS = pa.schema([("term", pa.int64()), ("n", pa.int64())])
_N_DOCS, _N_TERMS = -1, -2


def _survey(parcel: Broadcast):
    """Per task: documents with terms, all their terms, and per item term its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Absent(unpacked(parcel))
        df = np.zeros(len(terms), np.int64)
        docs = total = 0
        for piece in pieces(batches):
            for text in piece.column("text").to_pylist():
                n, ids, _ = _term_counts(text, terms.__getitem__)
                docs += n > 0
                total += n
                df[ids] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_N_DOCS, _N_TERMS, *held.tolist()], pa.int64()), pa.array([docs, total, *df[held].tolist()], pa.int64())],
            schema=_STATS,
        )

    return run


_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _scores(parcel: Broadcast, n_docs: int, n_terms: int, top: int):
    """The best documents of a task for every item of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, numbers, tiled = unpacked(parcel)
        get = _Absent(terms).__getitem__
        best = Best(len(numbers), top)
        column_of = np.full(len(terms), -1, np.int64)
        for piece in pieces(batches, DOC_TILE):
            ids = piece.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False)
            cells = []
            for k, text in enumerate(piece.column("text").to_pylist()):
                n, own, tf = _term_counts(text, get)
                if len(own):
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    # The product stays below 2 ** 63 for tf below nine thousand million.
                    cells.append((np.full(len(own), k), own, (1_000_000_000 * tf) // (1000 * tf + 8 * m)))
            if not cells:
                continue
            row, own, impact = (np.concatenate(c) for c in zip(*cells))
            for first, n_items, tiles in tiled:
                total = np.zeros((n_items, len(doc)), np.int64)
                for tile in tiles:
                    column_of[tile.columns] = np.arange(len(tile.columns))
                    inner = column_of[own]
                    here = inner >= 0
                    if here.any():
                        impacts = np.zeros((len(tile.columns), len(doc)))
                        impacts[inner[here], row[here]] = impact[here]
                        total += (tile.dense() @ impacts).astype(np.int64)
                    column_of[tile.columns] = -1
                best.add(first, total, doc, null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(numbers, np.int64)[best.item]), pa.array(best.doc, mask=best.null), pa.array(best.score)],
            schema=_FOUND,
        )

    return run


def _groups(numbered: DataFrame) -> Iterator[Items]:
    """Items in groups that fit a worker, one group at a time on the driver."""
    group = Items()
    for row in numbered.select("item", "text").toLocalIterator():
        group.add(row.item, row.text)
        if group.full():
            yield group
            group = Items()
    if group.numbers:
        yield group


def _ranked_group(docs: DataFrame, group: Items, top: int) -> DataFrame:
    spark = docs.sparkSession
    surveyed = docs.select("text").mapInArrow(_survey(carried(spark, group.terms)), "term long, n long")
    # One number for each term of the group at most, and two more.
    counts = dict(surveyed.groupBy("term").agg(F.sum("n").alias("n")).collect())
    n_docs, n_terms = counts.get(_N_DOCS, 0), counts.get(_N_TERMS, 0)
    weights = np.array([weight(n_docs, counts.get(k, 0)) for k in range(len(group.terms))], np.int64)
    tiled = []
    for first in range(0, len(group.numbers), ITEM_TILE):
        last = min(first + ITEM_TILE, len(group.numbers))
        tiled.append((first, last - first, tiles_of(group, weights, first, last)))
    parcel = carried(spark, (group.terms, group.numbers, tiled))
    return docs.mapInArrow(_scores(parcel, n_docs, max(n_terms, 1), top), "item long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best of ``docs`` (doc_id, text) for every item
    of ``items`` (item_id, text), with scores above 0, equal scores by ascending doc_id.

    Terms are runs of ASCII digits and letters and of anything beyond ASCII; only A-Z are
    lower-cased. Weights and impacts are whole numbers; a score sums their products over the
    item's terms, repeats included. They are multiplied as matrices in float64: tiles of items
    over tiles of the items' own vocabulary (nothing else of the documents' vocabulary counts)
    times tiles of documents. A tile's sums stay below 2 ** 53, so they are exact, and tiles
    are added as 64-bit integers. Each task keeps the ``top`` best of its documents per item,
    ties included by id, and one window puts the tasks' lists together.

    Items come to the driver in groups of a bounded number of terms, and each group is one pass
    over the documents for the statistics and one for the scores; their texts are never
    shuffled. Every row of ``docs`` is a document of its own, also with an equal or a null id
    (null last among equals); every row of ``items`` is an item of its own, with its ranks.
    Null and empty texts have no terms: such documents are found by nothing, such items find
    nothing. Empty tables give no rows. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Numbers tell rows apart; written, since a row may get another number when it is read again.
    numbered = items.select("item_id", F.col("text").cast("string").alias("text")).withColumn(
        "item", F.monotonically_increasing_id()
    )
    numbered = written(numbered, "items")
    found = [_ranked_group(rows, group, top) for group in _groups(numbered)]
    if not found:
        empty = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"))
        return empty.withColumn("score", F.col("doc_id")).filter(F.lit(False))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


RANK_SQL = """
with doc_terms as (
    select doc_id, row_number() over () as d, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
    from documents
), held as (
    select doc_id, d, len(terms)::bigint as n, terms from doc_terms where len(terms) > 0
), sizes as (
    select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from held
), wanted as (
    select item_id, i, term, count(*)::bigint as repeats
    from (select item_id, row_number() over () as i, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark)
    group by all
), postings as (
    select d, any_value(doc_id) as doc_id, any_value(n) as n, term, count(*)::bigint as tf
    from (select d, doc_id, n, unnest(terms) as term from held)
    where term in (select term from wanted) group by d, term
), weights as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint as w
    from (select term, count(*)::bigint as df from postings group by term), sizes
), impacts as (
    select d, doc_id, term,
        (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75::hugeint * n * n_docs) // n_terms)::bigint)) as impact
    from postings, sizes
), scored as (
    select i, any_value(item_id) as item_id, d, any_value(doc_id) as doc_id, sum(repeats * w * impact)::bigint as score
    from wanted join weights using (term) join impacts using (term) group by i, d
), ranked as (
    select *, row_number() over (partition by i order by score desc, doc_id) as rank from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
