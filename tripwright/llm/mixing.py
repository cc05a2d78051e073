"""Interleaving sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.tables import partitions

#: Documents of one source that are scheduled together.
BLOCK = 16
#: Slots of a period, at least: each is planned by itself, in a task of the many.
PERIOD = 1 << 16
#: Release times looked at together where a period begins.
LOOK = 1 << 18
#: Rows of one source that are numbered together, about.
CUT_ROWS = 1 << 17
#: Ranges that the keys of a source are cut into at most: sixteen bits of the key.
MOST_CUTS = 1 << 16
#: Windows longer than this are planned as one period, and slots end here: from then on none stays
#: empty, so that places are whole numbers of 64 bits whatever the weights.
LONGEST, FAR = 1 << 40, 1 << 58
#: Rows of the schedule that are given at a time.
PLANNED = 1 << 14


class Schedule:
    """Earliest deadline first over Pfair windows, from any slot on.

    A class (weight, blocks, members) is sources with equal weights and numbers of blocks. With
    w the exact share of one source, its block k is released at floor(k / w) and due at
    ceil((k + 1) / w); nothing is rounded to slots of a period. Each slot takes the released
    block that is due first, ties by class and member, so all deadlines are met and after every
    slot each source is less than a block off its share.

    The slots are cut into periods that are planned apart. What period j begins from follows
    from its first slot t alone: a source has had floor(w t) blocks, and one more if it is
    ahead. Which are ahead is found by taking the open blocks in order of their deadlines, as
    long as all that are taken, and the blocks wholly before t, fit into the slots between their
    releases and t. Such a choice meets every later deadline if any does, and the exact shares
    show that one does; so each period, with blocks due by its end where the next begins with
    them done, can be planned without the others.

    Sources go on for ever in this reckoning; blocks that a source does not have are left out,
    and a slot in which no block is released stays empty.
    """

    def __init__(self, classes: Iterable[tuple[float, int, int]]):
        exact = [(Fraction(w), blocks, members) for w, blocks, members in classes]
        scale = max((w.denominator for w, _, _ in exact), default=1)  # all are powers of two
        self.share = [int(w * scale) for w, _, _ in exact]
        self.blocks = [n for _, n, _ in exact]
        self.members = [m for _, _, m in exact]
        self.total = sum(w * m for w, m in zip(self.share, self.members))
        self.classes = range(len(exact))
        # A block's window is shorter than a period, so none spans one.
        longest = -(-self.total // min(self.share)) if exact else 1
        self.period = max(PERIOD, 1 << (2 * longest + 2).bit_length()) if longest <= LONGEST else None

    def periods(self) -> int:
        """Periods until the last block of all sources is due."""
        slots = max((self.due(c, n - 1) for c, n in enumerate(self.blocks) if n), default=0)
        return min(1, slots) if self.period is None else -(-slots // self.period)

    def released(self, c: int, k: int) -> int:
        return k * self.total // self.share[c]

    def due(self, c: int, k: int) -> int:
        return -(-(k + 1) * self.total // self.share[c])

    def begun(self, t: int) -> list[tuple[int, int]]:
        """Per class, how many blocks each member has had before slot t, and how many members one more."""
        whole = [self.share[c] * t // self.total for c in self.classes]
        left = t - sum(n * m for n, m in zip(whole, self.members))
        ahead = [0] * len(whole)
        if left:
            free = [c for c in self.classes if self.share[c] * t % self.total]
            release = np.array([self.released(c, whole[c]) for c in free], np.int64)
            marks = np.unique(release)
            room = self._room(t, whole, marks)
            for at in sorted(range(len(free)), key=lambda i: (self.due(free[i], whole[free[i]]), free[i])):
                c = free[at]
                upto = int(np.searchsorted(marks, release[at], "right"))
                ahead[c] = min(self.members[c], left, int(room[:upto].min()))
                room[:upto] -= ahead[c]
                left -= ahead[c]
            if left:
                raise AssertionError("slots before a period are not filled")
        return list(zip(whole, ahead))

    def _room(self, t: int, whole: list[int], marks: np.ndarray) -> np.ndarray:
        """Per release in ``marks``, the fewest slots left over between it, or a release up to
        the mark before, and t, by blocks that are wholly before t."""
        room = np.full(len(marks), np.iinfo(np.int64).max)
        taken, end = 0, t
        while end > int(marks[0]):
            begin = max(int(marks[0]), end - LOOK)
            released = np.zeros(end - begin, np.int64)
            for c in self.classes:
                first = -(-begin * self.share[c] // self.total)
                last = min(whole[c], -(-end * self.share[c] // self.total))
                at = np.array([self.released(c, k) for k in range(first, last)], np.int64) - begin
                np.add.at(released, at, self.members[c])
            slots = np.arange(begin, end)
            left = (t - slots) - taken - np.cumsum(released[::-1])[::-1]
            np.minimum.at(room, np.searchsorted(marks, slots, "left").clip(max=len(marks) - 1), np.where(slots <= marks[-1], left, room[-1]))
            taken += int(released.sum())
            end = begin
        return room

    def planned(self, j: int) -> Iterator[tuple[int, int, int, int]]:
        """(class, member, block, slot) of the blocks of period j, slot by slot."""
        if self.period is None:
            begin, end = 0, None
            had, will = [(0, 0) for _ in self.classes], [(n, 0) for n in self.blocks]
        else:
            begin, end = j * self.period, (j + 1) * self.period
            had, will = self.begun(begin), self.begun(end)
        waiting: list[tuple[int, int, int, int, int]] = []

        def open_block(c: int, k: int) -> None:
            """Queue the members' block k, if it is one of this period's and there is such a block."""
            if k >= self.blocks[c] or k > will[c][0]:
                return
            first = had[c][1] if k == had[c][0] else 0
            last = will[c][1] if k == will[c][0] else self.members[c]
            if first < last:
                heapq.heappush(waiting, (max(begin, self.released(c, k)), c, k, first, last))
            else:
                open_block(c, k + 1)

        for c in self.classes:
            open_block(c, had[c][0])
        ready: list[tuple[int, int, int, int, int]] = []
        slot = begin
        while waiting or ready:
            if not ready:
                slot = max(slot, min(waiting[0][0], FAR))
            while waiting and (waiting[0][0] <= slot or (slot >= FAR and not ready)):
                _, c, k, first, last = heapq.heappop(waiting)
                due = self.due(c, k)
                heapq.heappush(ready, (due if end is None else min(end, due), c, k, first, last))
                open_block(c, k + 1)
            due, c, k, member, last = ready[0]
            if due < slot + 1:
                raise AssertionError("a deadline is missed")
            if member + 1 < last:
                heapq.heapreplace(ready, (due, c, k, member + 1, last))
            else:
                heapq.heappop(ready)
            yield c, member, k, slot
            slot += 1


_PLAN = pa.schema(
    [("of_weight", pa.float64()), ("of_blocks", pa.int64()), ("of_member", pa.int64()), ("of_block", pa.int64()),
     ("mix_slot", pa.int64())]
)


def _planned(classes: list[tuple[float, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(classes)
        for batch in batches:
            for j in batch.column(0).to_pylist():
                slots = schedule.planned(j)
                while held := list(islice(slots, PLANNED)):
                    rows = [(*classes[c][:2], member, k, slot) for c, member, k, slot in held]
                    columns = [pa.array(x, t) for x, t in zip(zip(*rows), _PLAN.types)]
                    yield pa.RecordBatch.from_arrays(columns, schema=_PLAN)

    return run


def targets(docs: DataFrame) -> DataFrame:
    """(source, weight) of every source, as ``tempered`` with the power 0.5; stays in Spark."""
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    return counts.select("source", F.sqrt("n").alias("weight"))


def _numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds ``at``: the number of a row in its group, by ``cut`` and ``order``, from 0 on."""
    sizes = df.groupBy(*group, "cut").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy(*group).orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, "cut", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*group, "cut").orderBy(*order)
    counted = df.withColumn("at", F.row_number().over(inside) - 1)
    return counted.join(bases, [*group, "cut"]).withColumn("at", F.col("base") + F.col("at")).drop("base")


def _cut(column: str, rows: int) -> Column:
    """The range of a hexadecimal key, one of as many as ``rows`` rows call for; order is kept."""
    cuts = min(MOST_CUTS, 1 << max(0, (rows // CUT_ROWS).bit_length()))
    bits = F.conv(F.substring(column, 1, 4), 16, 10).cast("int")
    return F.shiftright(bits, 16 - (cuts.bit_length() - 1))


def _exact_slots(rows: DataFrame, weights: DataFrame, block: int, n_rows: int) -> DataFrame:
    """(of_source, of_block, mix_slot) of every block of a source with a positive weight."""
    spark = rows.sparkSession
    given = weights.select(F.coalesce("source", F.lit("")).alias("source"), F.col("weight").cast("double").alias("weight"))
    counts = rows.groupBy("source").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    sources = counts.join(given.filter("weight > 0"), "source").withColumn("hash", F.md5(F.col("source").cast("binary")))
    # Sources of a class may stand in any order that is the same in every run.
    members = _numbered(sources.withColumn("cut", _cut("hash", n_rows)), ["weight", "blocks"], ["hash", "source"])
    found = sources.groupBy("weight", "blocks").agg(F.count("*").alias("members")).collect()
    classes = sorted((r.weight, r.blocks, r.members) for r in found)
    schedule = Schedule(classes)
    periods = schedule.periods()
    numbers = spark.range(0, periods, 1, max(1, min(periods, partitions(spark))))
    plan = numbers.mapInArrow(
        _planned(classes), "of_weight double, of_blocks long, of_member long, of_block long, mix_slot long"
    )
    same = (F.col("weight") == F.col("of_weight")) & (F.col("blocks") == F.col("of_blocks")) & (F.col("at") == F.col("of_member"))
    return plan.join(members, same).select(F.col("source").alias("of_source"), "of_block", "mix_slot")


def mix(docs: DataFrame, weights: Mapping[str, float] | DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, ...) with where it stands in the mixture.

    (row, source, key, mix_block, mix_slot, mix_place): ``row`` is the whole row as a struct,
    ``mix_block`` the number of its block in its source, ``mix_slot`` the slot of that block,
    ``mix_place`` a number by which rows are in the order of the mixture. Within a source rows
    are in the order of ``key``, the md5 of their id, then of the id, then of the hash of the
    row; equal rows are alike in any order. A null source is the source named "".

    ``weights`` is a mapping or a table (source, weight), one row a source. They are held
    exactly over the whole run (see ``Schedule``), any number of sources is taken, and periods
    of the schedule are planned in tasks of their own. What comes to the driver and goes to
    each task is a row for each distinct pair of a weight and a number of blocks: with weights
    that follow from counts never more than the root of twice the rows.

    No row is lost: when a source runs dry its slots stay empty; rows of sources without a
    positive weight have no slot and no place and belong after all others. An empty table gives
    no rows. Input columns may have any names.

    Sources are numbered by way of ranges of their keys, as many as the rows call for, so that
    a source which holds a third of the rows is spread over tasks; rows with one and the same
    id are in one range.
    """
    spark = docs.sparkSession
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    n_rows = docs.count()
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("doc_id").alias("id"),
        key.alias("key"),
        F.xxhash64(*docs.columns).alias("tie"),
    ).withColumn("cut", _cut("key", n_rows))
    numbered = _numbered(rows, ["source"], ["key", "id", "tie"])
    numbered = numbered.withColumns({"mix_block": F.floor(F.col("at") / F.lit(block)), "inner": F.col("at") % F.lit(block)})
    if not isinstance(weights, DataFrame):
        named = [(s, float(w)) for s, w in sorted(weights.items())]
        weights = spark.createDataFrame(named, "source string, weight double")
    slots = _exact_slots(rows, weights, block, n_rows)
    own = (F.col("source") == F.col("of_source")) & (F.col("mix_block") == F.col("of_block"))
    return numbered.join(slots, own, "left").select(
        "row", "source", "key", "mix_block", "mix_slot", (F.col("mix_slot") * F.lit(block) + F.col("inner")).alias("mix_place")
    )


def in_order(docs: DataFrame, weights: Mapping[str, float] | DataFrame) -> DataFrame:
    """The same rows, sorted into the order of the mixture."""
    mixed = mix(docs, weights)
    order = [F.asc_nulls_last("mix_place"), "source", "key", F.xxhash64("row")]
    return mixed.orderBy(*order).select("row.*")


#: Weights in whole numbers: a double of 1 or more times 2 ** 52 is one. Blocks of the same slot
#: are ordered by deadline, weight, number of blocks, and the md5 of the source.
MIX_SQL = f"""
with recursive counted as (
    select coalesce(source, '') as source, count(*) as n from documents group by 1
), listed as (
    select list(source order by n, md5(source)) as names,
        list((sqrt(n) * 4503599627370496)::hugeint order by n, md5(source)) as share,
        list(((n + {BLOCK} - 1) // {BLOCK})::hugeint order by n, md5(source)) as blocks from counted
), summed as (
    select names, share, blocks, list_reduce(share, lambda a, b: a + b) as total from listed
), steps as (
    select 0::bigint as slot, list_transform(share, lambda s: 0::hugeint) as done, null::bigint as pick, names, share, blocks, total
    from summed
    union all
    select slot + 1, list_transform(done, lambda k, i: case when i = pick_now then k + 1 else k end), pick_now,
        names, share, blocks, total
    from (
        select slot, done, names, share, blocks, total, list_min(list_transform(range(1, len(share) + 1), lambda i:
            case when done[i] < blocks[i] and done[i] * total // share[i] <= slot
            then (((done[i] + 1) * total + share[i] - 1) // share[i]) * 100000 + i end)) % 100000 as pick_now
        from steps where list_sum(list_transform(done, lambda k: k::bigint)) < list_sum(list_transform(blocks, lambda k: k::bigint))
    )
), plan as (
    select names[pick] as source, (done[pick] - 1)::bigint as mix_block, slot - 1 as mix_slot from steps where pick is not null
), numbered as (
    select doc_id, coalesce(source, '') as source,
        row_number() over (partition by coalesce(source, '') order by md5(coalesce(doc_id::varchar, '')), doc_id) - 1 as row
    from documents
)
select n.doc_id, n.source, p.mix_block, p.mix_slot::bigint as mix_slot, (p.mix_slot * {BLOCK} + n.row % {BLOCK})::bigint as mix_place
from numbered n join plan p on n.source = p.source and n.row // {BLOCK} = p.mix_block
"""
