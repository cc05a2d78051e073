"""Exact join of documents on the Jaccard likeness of their word shingles."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import words
from tripwright.llm.graph import components
from tripwright.llm.tables import discard, partitions, pieces, spread, written

SIZE = 5
PERCENT = 80
#: Shingles known by their frequency; 5 bytes each, broadcast.
FREQUENT_LIMIT = 1 << 22
#: Bits of the filter that finds the documents of candidate classes again; broadcast.
FILTER_BITS = 1 << 26
#: Classes, and bytes of their sketches, that one task compares at a time.
CELL_CLASSES, CELL_BYTES = 1 << 13, 1 << 23
#: What one task joins at a time: classes, and shingles in their sets.
BLOCK_CLASSES, BLOCK_SHINGLES = 1 << 12, 1 << 21
#: Pivots of one step of the local join, and classes that are joined without a further step.
PIVOTS, LEAF = 8, 96
#: Distance from a block's pivot is cut into this many rings.
RINGS = 20
_FLUSH = 1 << 22
#: Tasks that share the postings of one frequent shingle.
_SALTS = 16


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The ascending hashes of each text's distinct shingles."""
    raw, offsets = words.text_bytes(texts)
    raw = words.LOWER[raw]
    starts, ends = words.spans(raw, offsets, words.NOT_SPACE)
    hashed = words.hashes(raw, starts, ends)
    flat, counts = words.shingles(hashed, words.per_row(starts, offsets), size)
    return np.split(flat, np.cumsum(counts)[:-1])


def digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def sketch(own: np.ndarray) -> bytes:
    """The parity of the shingles in each of 64 or more cells, as many as the set at least.

    Two sketches differ in no more cells than their sets in shingles. One of twice the cells
    becomes one of fewer when its halves are put over each other.
    """
    cells = 1 << max(6, (len(own) - 1).bit_length())
    at = (own & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=cells) & 1).astype(np.uint8)).tobytes()


def needed(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set it links to, at least."""
    return -(-percent * n // 100)


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins and ends in ascending 32-bit keys."""
    edges = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def _pack(keys: np.ndarray) -> bytes:
    """Ascending 32-bit keys as compressed byte planes of their differences."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)


_SURVEY = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()),
        ("sketch", pa.binary()), ("bucket", pa.int32()), ("payload", pa.binary()),
    ]
)


def _survey(size: int, buckets: int):
    """Each document's class and sketch, and packed shingle keys of all of them for the counts."""

    def keys_out(kept: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(kept))
        cuts = _cuts(keys, buckets)
        filled = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
        none = [None] * len(filled)
        packed = [_pack(keys[cuts[k] : cuts[k + 1]]) for k in filled]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip((none, none, none, none, none, filled, packed), _SURVEY.types)],
            schema=_SURVEY,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0
        for piece in pieces(batches):
            sets = shingle_sets(piece.column("text"), size)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                schema=_SURVEY,
            )
            kept += [(s >> np.uint64(32)).astype(np.uint32) for s in sets]
            held += sum(map(len, sets))
            if held > _FLUSH:
                yield keys_out(kept)
                kept, held = [], 0
        if held:
            yield keys_out(kept)

    return run


_COUNTS = pa.schema([("level", pa.int32()), ("n", pa.int64()), ("keys", pa.binary())])


def _count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys seen three times or more, by eighths of a power of two of their count."""
    merged: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[int, list[np.ndarray]] = {}

    def merge(bucket: int) -> None:
        keys, counts = merged.get(bucket, (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
        new, n = np.unique(np.concatenate(waiting.pop(bucket)), return_counts=True)
        both, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
        merged[bucket] = both, np.bincount(at, np.concatenate((counts, n)), len(both)).astype(np.int64)

    for batch in batches:
        for bucket, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "payload"))):
            waiting.setdefault(bucket, []).append(_unpack(data))
            if sum(map(len, waiting[bucket])) > _FLUSH:
                merge(bucket)
    for bucket in list(waiting):
        merge(bucket)
    for keys, counts in merged.values():
        often = counts >= 3
        keys, levels = keys[often], _level(counts[often])
        for level in np.unique(levels):
            own = keys[levels == level]
            yield pa.RecordBatch.from_pydict(
                {"level": [int(level)], "n": [len(own)], "keys": [own.tobytes()]}, schema=_COUNTS
            )


def _level(counts: np.ndarray) -> np.ndarray:
    return np.floor(8 * np.log2(counts)).astype(np.uint8)


def _frequent(survey: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent keys (ascending) and the level of their counts, ``limit`` at most.

    Only the order in which shingles are tried depends on them; links do not.
    """
    packed = survey.filter("bucket is not null").select("bucket", "payload")
    counted = written(spread(packed, "bucket").mapInArrow(_count_keys, "level int, n long, keys binary"), "counts")
    sizes = {r.level: r.n for r in counted.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    total, lowest = 0, 256
    for level in sorted(sizes, reverse=True):
        total += sizes[level]
        if total > limit:
            break
        lowest = level
    rows = counted.filter(F.col("level") >= lowest).select("level", "keys").collect()
    discard(counted)
    keys = [np.frombuffer(r["keys"], np.uint32) for r in rows]
    levels = [np.full(len(k), r.level, np.uint8) for k, r in zip(keys, rows)]
    if not keys:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint8)
    flat = np.concatenate(keys)
    order = np.argsort(flat)
    return flat[order], np.concatenate(levels)[order]


_POSTINGS = pa.schema(
    [("bucket", pa.int32()), ("payload", pa.binary()), ("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64())]
)
_POSTINGS_DDL = "bucket int, payload binary, key long, id long, n long"
#: A packed posting: shingle, short id of the class, twice its size, plus one if ``early``.
_PACKED = np.dtype([("key", "<u8"), ("id", "<i8"), ("n", "<u4")])


def _short(cls: bytes) -> int:
    """The class's id among candidates; classes that share one are only compared in vain."""
    return int.from_bytes(cls[:8], "big", signed=True)


def _post(size: int, percent: int, buckets: int, frequent):
    """The shingles through which each class must meet any class it links to.

    All classes order shingles alike, the frequent ones last. A class is posted under its
    first n - needed + 1: of two linked sets, the smallest common shingle is among these in
    both, and in the smaller set it is ``early``, where the rest still holds all that two sets
    of its size would share. Copies inside a task are posted once. Postings under frequent
    shingles are rows; the others, of which none is very common, travel packed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, levels = frequent.value
        seen: set[bytes] = set()
        rare: list[np.ndarray] = []
        held = 0
        bits = np.zeros(1 << 24, bool)
        bits[common >> 8] = True

        def rare_out() -> pa.RecordBatch:
            postings = np.concatenate(rare)
            postings = postings[np.argsort(postings["key"], kind="stable")]
            cuts = _cuts((postings["key"] >> np.uint64(32)).astype(np.uint32), buckets)
            filled = [k for k in range(buckets) if cuts[k + 1] > cuts[k]]
            payload = [postings[cuts[k] : cuts[k + 1]].tobytes() for k in filled]
            none = [None] * len(filled)
            columns = [filled, payload, none, none, none]
            return pa.RecordBatch.from_pydict(dict(zip(_POSTINGS.names, columns)), schema=_POSTINGS)

        for piece in pieces(batches):
            hot: list[tuple] = []
            for own in shingle_sets(piece.column("text"), size):
                n = len(own)
                if not n or (cls := digest(own)) in seen:
                    continue
                seen.add(cls)
                take = n - needed(n, percent) + 1
                early = n - -(-2 * percent * n // (100 + percent)) + 1
                short = (own >> np.uint64(32)).astype(np.uint32)
                maybe = np.flatnonzero(bits[short >> 8])
                level = np.zeros(n, np.uint8)
                if len(maybe) and len(common):
                    at = np.minimum(np.searchsorted(common, short[maybe]), len(common) - 1)
                    level[maybe] = np.where(common[at] == short[maybe], levels[at], 0)
                first = own[level == 0][:take]
                if len(first):
                    postings = np.empty(len(first), _PACKED)
                    postings["key"], postings["id"] = first, _short(cls)
                    postings["n"] = 2 * n + (np.arange(len(first)) < early)
                    rare.append(postings)
                    held += len(first)
                if len(first) < take:
                    often = np.flatnonzero(level)
                    order = np.lexsort((own[often], level[often]))[: take - len(first)]
                    keys = own[often[order]].view(np.int64).tolist()
                    hot += [((k + 7919 * (cls[0] % _SALTS)) % buckets, None, k, _short(cls), n) for k in keys]
            if hot:
                yield pa.RecordBatch.from_pydict(dict(zip(_POSTINGS.names, zip(*hot))), schema=_POSTINGS)
            if held > _FLUSH // 2:
                yield rare_out()
                rare, held = [], 0
        if held:
            yield rare_out()

    return run


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("band", pa.int64())])


def _chained(postings: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of classes, next to each other by size under a shingle, that links may run through.

    Two classes can only link if the smaller has the shingle early and the larger is not too
    large for it. Where no class reaches the next larger one, the chain is cut.
    """
    postings = postings[np.argsort(postings["key"], kind="stable")]
    same = postings["key"][1:] == postings["key"][:-1]
    shared = np.zeros(len(postings), bool)
    shared[1:] |= same
    shared[:-1] |= same
    postings = postings[shared]
    size = (postings["n"] >> 1).astype(np.int64)
    # Of equal sizes, early ones first: they reach the others.
    order = np.lexsort((postings["id"], 1 - (postings["n"] & 1), size, postings["key"]))
    postings, size = postings[order], size[order]
    if len(postings) < 2:
        return np.zeros((0, 2), np.int64)
    last_early = np.maximum.accumulate(np.where(postings["n"] & 1, np.arange(len(postings)), -1))
    before = last_early[:-1]
    reached = (before >= 0) & (postings["key"][1:] == postings["key"][before])
    reached &= 100 * size[before] >= percent * size[1:]
    pairs = np.stack((postings["id"][1:][reached], postings["id"][before[reached]]), 1)
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def _meet(percent: int):
    """Edges that hold together all classes which may link through a shingle.

    Rare shingles chain classes by size. Under a frequent one, each class hangs on the first
    of its band of sizes that comes by in this task, which is given out to meet those of other
    tasks and bands; linked classes are in the same band or in neighbouring ones.
    """

    def edges(pairs: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none], schema=_EDGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[np.ndarray]] = {}
        heads: dict[tuple[int, int], int] = {}
        for batch in batches:
            pairs = []
            for bucket, data, key, own, n in zip(*(batch.column(c).to_pylist() for c in _POSTINGS.names)):
                if data is not None:
                    by_bucket.setdefault(bucket, []).append(np.frombuffer(data, _PACKED))
                    continue
                band = int(np.log(n) / np.log(100 / percent) + 1e-9)
                if heads.setdefault((key, band), own) != own:
                    pairs.append((own, heads[key, band]))
            if pairs:
                yield edges(np.array(pairs, np.int64))
        if heads:
            firsts, keys = list(heads.values()), list(heads)
            columns = [firsts, firsts, [k for k, _ in keys], [b for _, b in keys]]
            yield pa.RecordBatch.from_pydict(dict(zip(_EDGES.names, columns)), schema=_EDGES)
        for parts in by_bucket.values():
            pairs = _chained(np.concatenate(parts), percent)
            if len(pairs):
                yield edges(pairs)

    return run


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between short ids; written."""
    met = spread(postings, "bucket").mapInArrow(_meet(percent), "a long, b long, key long, band long")
    met = written(met, "met")
    heads = met.filter("key is not null").select("key", "band", "a")
    least = heads.groupBy("key", "band").agg(F.min("a").alias("b"))
    often = heads.join(least, ["key", "band"]).select("a", "b")
    above = least.select("key", (F.col("band") - 1).alias("band"), F.col("b").alias("a"))
    across = least.join(above, ["key", "band"]).select("a", "b")
    return met.filter("key is null").select("a", "b").union(often).union(across)


def _filter_of(ids: DataFrame, bits: int) -> np.ndarray:
    """A bit for the hash of every id, put together from parts of a fixed size."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in batch.column("at").to_pylist():
                parts.setdefault(at >> 16, np.zeros(1 << 16, bool))[at & 0xFFFF] = True
        for part, own in parts.items():
            bits_of = pa.array([np.packbits(own).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), bits_of], ["part", "own"])

    at = ids.select(F.pmod(F.hash("doc_id"), F.lit(bits)).alias("at")).distinct()
    at = at.withColumn("part", F.shiftright("at", 16))
    rows = spread(at, "part").mapInArrow(fill, "part int, own binary").collect()
    out = np.zeros(max(bits >> 3, 1 << 13), np.uint8)
    for row in rows:
        out[row.part << 13 : (row.part + 1) << 13] = np.frombuffer(row.own, np.uint8)
    return out


_SETS = pa.schema([("of", pa.int64()), ("cls", pa.binary()), ("own", pa.binary())])


def _load(size: int, wanted):
    """(doc_id, cls, own) of the documents that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for piece in pieces(batches):
            at = piece.column("at").to_numpy(zero_copy_only=False)
            keep = ((bits[at >> 3] >> (7 - (at & 7))) & 1).astype(bool)
            if keep.any():
                chosen = pa.array(keep)
                sets = shingle_sets(piece.column("text").filter(chosen), size)
                columns = [piece.column("doc_id").filter(chosen), [digest(s) for s in sets], [s.tobytes() for s in sets]]
                yield pa.RecordBatch.from_pydict(dict(zip(_SETS.names, columns)), schema=_SETS)

    return run


class _Local:
    """Exact links among the sets of one block, found with pivots.

    A step takes pivots, measures every set's distance to them and gives each set to its
    nearest pivot's region. A set also enters the region of a pivot that is farther by two
    link distances at most: by the triangle inequality no linked pair is missed. Regions that
    are smaller than the whole are joined by the same step, small ones set by set.
    """

    def __init__(self, sets: list[np.ndarray], sides: list[int], percent: int):
        self.n = len(sets)
        self.size = np.array([len(s) for s in sets])
        _, local = np.unique(np.concatenate(sets), return_inverse=True)
        self.ids = np.split(local, np.cumsum(self.size)[:-1])
        self.marks = np.zeros(int(local.max()) + 1, np.int32)
        self.sides, self.percent = np.array(sides), percent
        self.reach = 1 - percent / 100 + 1e-9
        self.root = list(range(self.n))
        self.links = np.zeros(self.n, np.int64)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def common(self, one: int, flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Shingles that ``one`` shares with each of the sets laid out in ``flat``."""
        self.marks[self.ids[one]] = 1
        out = np.add.reduceat(self.marks[flat], begins)
        self.marks[self.ids[one]] = 0
        return out

    def layout(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([self.ids[m] for m in members])
        return flat, np.concatenate(([0], np.cumsum(self.size[members])[:-1]))

    def join(self, members: np.ndarray, home: np.ndarray) -> None:
        """All links between a member at home here and any other; of two homes, each pair once."""
        flat, begins = self.layout(members)
        if len(members) > LEAF:
            pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
            shared = np.stack([self.common(p, flat, begins) for p in pivots], 1)
            both = self.size[members][:, None] + self.size[pivots][None, :] - shared
            apart = 1 - shared / both
            nearest = apart.argmin(1)
            inside = apart - apart.min(1, keepdims=True) <= 2 * self.reach
            if max(inside.sum(0)) < 0.7 * len(members):
                for k in range(len(pivots)):
                    own = inside[:, k]
                    if (home & (nearest == k)).any():
                        self.join(members[own], (home & (nearest == k))[own])
                return
        for i in np.flatnonzero(home):
            one = members[i]
            # Of two linked members, the other is at home elsewhere or counted from its own side.
            near = (self.size[members] * 100 >= self.percent * self.size[one]) & (
                self.size[one] * 100 >= self.percent * self.size[members]
            )
            near[i] = False
            if self.sides[one] >= 0:
                near &= self.sides[members] != self.sides[one]
            at = np.flatnonzero(near)
            if not len(at):
                continue
            if len(at) == len(members) - 1:
                shared = self.common(one, flat, begins)[at]
            else:
                shared = self.common(one, *self.layout(members[at]))
            whole = self.size[one] + self.size[members[at]] - shared
            linked = members[at[100 * shared >= self.percent * whole]]
            self.links[one] += len(linked)
            for other in linked.tolist():
                a, b = self.find(int(one)), self.find(other)
                if a != b:
                    self.root[max(a, b)] = min(a, b)

    def run(self) -> None:
        self.join(np.arange(self.n), np.ones(self.n, bool))


_LINKS = pa.schema([("cls", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def _join_blocks(percent: int):
    """The local join over rows (block, side, cls, own) that come sorted by block."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        rows = list({r[2]: r for r in rows}.values())
        names = [r[2] for r in rows]
        local = _Local([np.frombuffer(r[3], np.uint64) for r in rows], [r[1] for r in rows], percent)
        local.run()
        roots = [names[local.find(i)] for i in range(len(rows))]
        return pa.RecordBatch.from_pydict(
            {"cls": names, "root": roots, "links": local.links.tolist()}, schema=_LINKS
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "side", "cls", "own"))):
                if row[0] != block and rows:
                    yield work(rows)
                    rows = []
                block = row[0]
                rows.append(row)
        if rows:
            yield work(rows)

    return run


def _local_join(rows: DataFrame, percent: int) -> DataFrame:
    ready = spread(rows, "block").sortWithinPartitions("block", "cls")
    return ready.select("block", "side", "cls", "own").mapInArrow(
        _join_blocks(percent), "cls binary, root binary, links long"
    )


def _distances(percent: int):
    schema = pa.schema(
        [("block", pa.int64()), ("cls", pa.binary()), ("n", pa.int64()), ("own", pa.binary()),
         ("pivot", pa.binary()), ("ring", pa.int32()), ("linked", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rings, linked = [], []
            for own, other in zip(piece.column("own").to_pylist(), piece.column("pivot_own").to_pylist()):
                x, y = np.frombuffer(own, np.uint64), np.frombuffer(other, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                whole = len(x) + len(y) - shared
                rings.append((whole - shared) * RINGS // whole)
                linked.append(100 * shared >= percent * whole)
            columns = [piece.column(c) for c in ("block", "cls", "n", "own", "pivot")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rings, pa.int32()), pa.array(linked, pa.bool_())], schema=schema
            )

    return run


def _large(sets: DataFrame, percent: int) -> DataFrame:
    """(cls, root, links) for blocks that no task could hold.

    A block's smallest class is its pivot. Distance to it puts each class into a ring, rings
    into cells that a task can hold, and two cells meet only if their rings are no farther
    apart than a link. Classes so near to the pivot that they must all be linked are counted,
    not compared.
    """
    pivots = sets.groupBy("block").agg(F.min_by("own", "cls").alias("pivot_own"), F.min("cls").alias("pivot"))
    rung = sets.join(pivots, "block").mapInArrow(
        _distances(percent),
        "block long, cls binary, n long, own binary, pivot binary, ring int, linked boolean",
    )
    rung = written(rung, "rings")
    rings = rung.groupBy("block", "ring").agg(
        F.count("*").alias("members"),
        F.greatest(
            F.ceil(F.count("*") / F.lit(BLOCK_CLASSES // 2)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES // 2))
        ).alias("parts"),
    )
    sized = rung.join(rings.select("block", "ring", "parts"), ["block", "ring"])
    sized = sized.withColumn("part", F.pmod(F.xxhash64("cls"), "parts"))
    cells = rings.select("block", "ring", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = cells.select("block", F.col("ring").alias("ring2"), F.col("part").alias("part2"))
    window = -(-(100 - percent) * RINGS // 100)
    met = cells.join(other, "block").filter(
        ((F.col("ring") < F.col("ring2")) | ((F.col("ring") == F.col("ring2")) & (F.col("part") <= F.col("part2"))))
        & (F.col("ring2") - F.col("ring") <= window)
        & ~_certain("ring", "ring2", percent)
    )
    pair = F.xxhash64("block", "ring", "part", "ring2", "part2")
    alone = (F.col("ring") == F.col("ring2")) & (F.col("part") == F.col("part2"))
    sides = met.select(
        F.col("block").alias("of"), pair.alias("block"), "ring", "part",
        F.when(alone, -1).otherwise(0).alias("side"),
    ).union(
        met.filter(~alone).select(
            F.col("block").alias("of"), pair.alias("block"), F.col("ring2").alias("ring"),
            F.col("part2").alias("part"), F.lit(1).alias("side"),
        )
    )
    placed = sized.select(F.col("block").alias("of"), "ring", "part", "cls", "own").join(sides, ["of", "ring", "part"])
    checked = _local_join(placed, percent)
    near = rings.select("block", F.col("ring").alias("ring2"), "members")
    counted = (
        rings.select("block", "ring")
        .join(near, "block")
        .filter(_certain("ring", "ring2", percent))
        .groupBy("block", "ring")
        .agg((F.sum("members") - F.max(F.when(F.col("ring") == F.col("ring2"), 1).otherwise(0))).alias("links"))
    )
    known = rung.join(counted, ["block", "ring"], "left").select(
        "cls", F.when(F.col("linked"), F.col("pivot")).otherwise(F.col("cls")).alias("root"),
        F.coalesce("links", F.lit(0)).alias("links"),
    )
    return checked.union(known)


def _certain(a: str, b: str, percent: int):
    """Rings so near to the pivot that all their classes are linked with each other."""
    return (F.col(a) + F.col(b) + 2) * 100 <= (100 - percent) * RINGS


def jaccard_join(
    docs: DataFrame,
    size: int = SIZE,
    percent: int = PERCENT,
    frequent_limit: int = FREQUENT_LIMIT,
    block_classes: int = BLOCK_CLASSES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(doc_id, text_hash, component, n_shingles, component_id, n_links) per row of ``docs``.

    Two documents link when 100 * |A and B| >= percent * |A or B| over their distinct shingles
    of ``size`` words. Texts with equal sets form a class; ``component_id`` is the smallest
    doc_id that links lead to, ``n_links`` the number of different sets linked to this one.
    The result is exact: shingles are 64-bit hashes, classes 128-bit ones.

    ``docs`` has doc_id and text. ``component`` is a digest that all documents of a component
    share, ``text_hash`` Spark's xxhash64 of the text.

    Null and empty texts have no shingles, no component and no links; their ``component_id``
    is their own id. Equal ids are separate rows. A null id is never a component's smallest; a component
    without any id has a null one. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    survey = written(
        rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
            _survey(size, buckets),
            "doc_id long, text_hash long, n long, cls binary, sketch binary, bucket int, payload binary",
        ),
        "survey",
    )
    frequent = spark.sparkContext.broadcast(_frequent(survey, frequent_limit))
    classes = written(survey.filter("bucket is null").drop("bucket", "payload"), "classes")
    discard(survey)
    postings = rows.select("text").mapInArrow(_post(size, percent, buckets, frequent), _POSTINGS_DDL)
    blocks = components(_candidates(postings, percent), "blocks").withColumnsRenamed({"v": "id", "root": "block"})
    members = _nearer(_members(classes, blocks), percent)
    classes = classes.drop("sketch")
    total = members.groupBy("block").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    too_large = (F.col("classes") > block_classes) | (F.col("shingles") > block_shingles)
    # At most one in so many classes, or in so many shingles.
    large = written(total.filter(too_large).select("block"), "large")
    sets = _sets_of(rows, members, size)
    if large.isEmpty():
        found = _local_join(sets.withColumn("side", F.lit(-1)), percent)
    else:
        sets = written(sets, "sets")
        small = sets.join(F.broadcast(large), "block", "left_anti").withColumn("side", F.lit(-1))
        rest = sets.join(F.broadcast(large), "block").dropDuplicates(["cls"])
        joined = written(_local_join(small, percent).union(_large(rest, percent)), "joined")
        discard(sets)
        merged = components(joined.select(F.col("cls").alias("a"), F.col("root").alias("b")), "links")
        links = joined.groupBy("cls").agg(F.sum("links").alias("links"))
        found = merged.withColumnRenamed("v", "cls").join(links, "cls")
    found = written(found, "found")
    named = classes.join(found, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named.join(least.filter("least is not null"), "root", "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("n") > 0, F.col("root")).alias("component"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )


def _members(classes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, id, cls, n, doc_id, sketch) of every class in a block, with one of its documents; written."""
    short = F.conv(F.substring(F.hex("cls"), 1, 16), 16, -10).cast("long")
    named = classes.filter("n > 0").withColumn("id", short).join(blocks, "id")
    first = [F.first(c).alias(c) for c in ("id", "n", "sketch")]
    return written(named.groupBy("block", "cls").agg(*first, F.min("doc_id").alias("doc_id")), "members")


def _hang_together(sizes: np.ndarray, sketches: list[bytes], sides: np.ndarray, percent: int) -> np.ndarray:
    """For each class the first one that it hangs together with, by size, if sketches allow a link.

    Sets link only if they differ in (100 - percent) / (100 + percent) of their summed sizes
    at most, and sketches differ in no more. Sizes ascend; of two sides, only pairs across count.
    """
    label = np.arange(len(sizes))
    widths = np.array([len(s) for s in sketches])
    stops = np.searchsorted(sizes * percent, sizes * 100, "right")
    for width in np.unique(widths):
        low, high = np.searchsorted(widths, [width, width + 1])
        parts = []
        for wide in np.unique(widths[low : stops[high - 1]]):
            a, b = np.searchsorted(widths, [wide, wide + 1])
            cells = np.frombuffer(b"".join(sketches[a : min(b, stops[high - 1])]), np.uint64).reshape(-1, wide // 8)
            while cells.shape[1] > width // 8:
                half = cells.shape[1] // 2
                cells = cells[:, :half] ^ cells[:, half:]
            parts.append(cells)
        cells = np.concatenate(parts)
        for i in range(low, high):
            others = slice(i + 1, stops[i])
            new = label[others] != label[i]
            if sides[i] >= 0:
                new &= sides[others] != sides[i]
            at = i + 1 + np.flatnonzero(new)
            if not len(at):
                continue
            differ = np.bitwise_count(cells[at - low] ^ cells[i - low]).sum(1, dtype=np.int64)
            near = at[differ * (100 + percent) <= (sizes[at] + sizes[i]) * (100 - percent)]
            if len(near):
                one = np.unique(np.append(label[near], label[i]))
                label[np.isin(label, one)] = one[0]
    return label


_NEAR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(percent: int):
    """Edges (a, b) over rows (block, side, id, n, sketch) that come sorted by block; classes without any are left out."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[3])
        ids = np.array([r[2] for r in rows], np.int64)
        sizes = np.array([r[3] for r in rows], np.int64)
        label = _hang_together(sizes, [r[4] for r in rows], np.array([r[1] for r in rows]), percent)
        among = np.bincount(label, minlength=len(label))[label] > 1
        return pa.RecordBatch.from_arrays([pa.array(ids[among]), pa.array(ids[label[among]])], schema=_NEAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "side", "id", "n", "sketch"))):
                if row[0] != block and rows:
                    yield work(rows)
                    rows = []
                block = row[0]
                rows.append(row)
        if rows:
            yield work(rows)

    return run


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    ready = spread(rows, "block").sortWithinPartitions("block")
    return ready.select("block", "side", "id", "n", "sketch").mapInArrow(_compare(percent), "a long, b long")


def _cells(members: DataFrame, percent: int) -> DataFrame:
    """Rows of blocks that no task could compare, once for each two cells that may hold a link.

    Cells are cut by size, and where a size is frequent by hash; only sketches are repeated.
    """
    banded = members.withColumn("band", F.floor(3 * F.log2("n")))
    bands = banded.groupBy("block", "band").agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.greatest(
            F.ceil(F.count("*") / F.lit(CELL_CLASSES // 2)),
            F.ceil(F.sum(F.length("sketch")) / F.lit(CELL_BYTES // 2)),
        ).alias("parts"),
    )
    sized = banded.join(bands.select("block", "band", "parts"), ["block", "band"])
    sized = sized.withColumn("part", F.pmod(F.xxhash64("cls"), "parts"))
    cells = bands.select("block", "band", "least", "most", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = cells.select("block", F.col("band").alias("band2"), F.col("least").alias("least2"), F.col("part").alias("part2"))
    met = cells.join(other, "block").filter(
        ((F.col("band") < F.col("band2")) | ((F.col("band") == F.col("band2")) & (F.col("part") <= F.col("part2"))))
        & (F.col("least2") * percent <= F.col("most") * 100)
    )
    pair = F.xxhash64("block", "band", "part", "band2", "part2")
    alone = (F.col("band") == F.col("band2")) & (F.col("part") == F.col("part2"))
    sides = met.select(
        F.col("block").alias("of"), pair.alias("block"), "band", "part",
        F.when(alone, -1).otherwise(0).alias("side"),
    ).union(
        met.filter(~alone).select(
            F.col("block").alias("of"), pair.alias("block"), F.col("band2").alias("band"),
            F.col("part2").alias("part"), F.lit(1).alias("side"),
        )
    )
    placed = sized.select(F.col("block").alias("of"), "band", "part", "id", "n", "sketch")
    return placed.join(sides, ["of", "band", "part"])


def _nearer(members: DataFrame, percent: int) -> DataFrame:
    """(block, cls, n, doc_id) of the classes that sketches let link, in the blocks these make; written.

    Classes that only quote the same passages fall apart here, before any set is loaded or
    repeated. Sketches leave no link out.
    """
    total = members.groupBy("block").agg(F.count("*").alias("classes"), F.sum(F.length("sketch")).alias("bytes"))
    too_large = (F.col("classes") > CELL_CLASSES) | (F.col("bytes") > CELL_BYTES)
    large = written(total.filter(too_large).select("block"), "crowds")
    small = members.join(F.broadcast(large), "block", "left_anti")
    near = _compared(small.withColumn("side", F.lit(-1)), percent)
    if not large.isEmpty():
        edges = _compared(_cells(members.join(F.broadcast(large), "block"), percent), percent)
        near = near.union(components(edges, "near").select(F.col("v").alias("a"), F.col("root").alias("b")))
    named = near.withColumnsRenamed({"a": "id", "b": "block"})
    nearer = written(members.drop("block").join(named, "id").select("block", "cls", "n", "doc_id"), "near")
    discard(members)
    return nearer


def _sets_of(rows: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(block, cls, n, own) of the members, from one more scan of the texts.

    A document that is repeated may give its class more than once.
    """
    spark = rows.sparkSession
    bits = 1 << 16
    wanted = 16 * max(1, members.count())
    while bits < min(wanted, FILTER_BITS):
        bits <<= 1
    wanted = spark.sparkContext.broadcast(_filter_of(members, bits))
    loaded = rows.select("doc_id", F.pmod(F.hash("doc_id"), F.lit(bits)).alias("at"), "text").mapInArrow(
        _load(size, wanted), "of long, cls binary, own binary"
    )
    same = (loaded.cls == members.cls) & loaded.of.eqNullSafe(members.doc_id)
    return loaded.join(members, same).select("block", members.cls, "n", "own")


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest text hash.

    Rows without shingles all stay. Of repeated rows one stays.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    groups = written(jaccard_join(rows.select("doc_id", "text"), size, percent), "groups")
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col("text_hash").alias("print"))
    first = groups.filter("n_shingles > 0").groupBy("component").agg(F.min(key).alias("first"))
    loose = groups.filter("n_shingles = 0").select("doc_id", "text_hash").distinct()
    stays = first.select("first.id", "first.print", F.lit(True).alias("single")).union(
        loose.withColumn("single", F.lit(False))
    )
    own = rows.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    kept = own.join(stays, own.doc_id.eqNullSafe(stays.id) & (own.text_hash == stays["print"]))
    repeated = groups.filter("n_shingles > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
    if not repeated.isEmpty():
        single = kept.filter("single").dropDuplicates(["doc_id", "text_hash"])
        kept = kept.filter("not single").union(single)
    return kept.select("row.*")
