"""Near-duplicate embeddings by counting collisions on many one-dimensional projections."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.llm.graph import components
from tripwright.llm.tables import spread, written

COSINE = 0.98
#: Directions whose collisions are counted for a pair.
DIRECTIONS = 32
#: Half width of the windows that count, of the window along the sorted direction, and the whole
#: width of a cell, in standard deviations of the difference of a pair right at the cosine.
WINDOW, SORTED, CELL = 1.2, 4.0, 12.0
#: Distinct vectors of a label that meet in one sorted list; larger labels are cut into cells
#: that are to hold CROWD of them.
LIST, CROWD = 2048, 256
#: Share of unlike vectors that a cell's direction is taken to leave together, which decides on
#: the number of directions of a cell, and so on time only.
LEFT = 0.47
#: What may be lost: pairs at the cosine that meet in no cell, and that fall short of the count.
MISSED, SHORT = 1e-5, 2e-4
#: Rows of a cell that one task compares with one another, and pairs counted at a time.
BLOCK, PAIRS = 4096, 1 << 16
#: Large cells up to this number are broadcast: a megabyte.
FEW = 1 << 15
SEED = 13


def spread_of(dimension: int, cosine: float = COSINE) -> float:
    """Standard deviation, over random directions, of the difference of a pair at the cosine."""
    return math.sqrt((2 - 2 * cosine) / dimension)


def directions(dimension: int, n: int, seed: int) -> np.ndarray:
    drawn = np.random.default_rng([SEED, dimension, seed]).standard_normal((n, dimension))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def count_needed(dimension: int, cosine: float = COSINE, pairs: int = 50_000) -> int:
    """The number of collisions that all but SHORT of random pairs right at the cosine reach.

    Closer pairs collide more often. The directions are drawn without regard to the data, so
    pairs drawn without regard to them stand for any.
    """
    if dimension == 1:
        return DIRECTIONS  # a pair at the cosine or above is one and the same direction
    draw = np.random.default_rng([SEED, dimension])
    short = np.zeros(DIRECTIONS + 1, np.int64)
    step = max(1, min(pairs, (1 << 22) // dimension))
    ways = directions(dimension, DIRECTIONS, 0)
    for at in range(0, pairs, step):
        n = min(step, pairs - at)
        u, v = draw.standard_normal((2, n, dimension))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        v -= (u * v).sum(1, keepdims=True) * u
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        apart = (1 - cosine) * u - math.sqrt(1 - cosine**2) * v
        hits = (np.abs(apart @ ways.T) <= WINDOW * spread_of(dimension, cosine)).sum(1)
        short += np.bincount(hits, minlength=DIRECTIONS + 1)
    return max(1, int(np.searchsorted(np.cumsum(short), SHORT * pairs, "right")))


def plan_of(n: int) -> tuple[int, int]:
    """Directions of a cell and number of tables for a label of ``n`` distinct vectors.

    A pair at the cosine stays in one cell of a table with probability p; tables are added
    until all but MISSED of such pairs meet in one at least.
    """
    if n <= LIST:
        return 0, 1
    depth = max(1, math.ceil(math.log(n / CROWD) / -math.log(LEFT)))
    p = (1 - math.sqrt(2 / math.pi) / CELL) ** depth * math.erf(SORTED / math.sqrt(2))
    return depth, max(1, math.ceil(math.log(MISSED) / math.log1p(-p)))


_ROWS = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("team", pa.string()), ("given", pa.binary())])


def _units(given: np.ndarray) -> np.ndarray:
    """Vectors, one a row, at length one in double precision."""
    x = given.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _keyed(kind: str):
    """Equal vectors of equal labels get equal keys; rows that link with nothing get none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, teams, given = [], [], []
            for label, value in zip(batch.column("label").to_pylist(), batch.column("embedding").to_pylist()):
                x = np.array(value, kind) + 0.0 if label is not None and value and None not in value else np.zeros(1)
                if not np.isfinite(x).all() or not x.any():
                    keys.append(None), teams.append(None), given.append(None)
                    continue
                team = f"{len(x)}/{label}"
                keys.append(hashlib.blake2b(x.tobytes() + team.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                teams.append(team)
                given.append(x.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(teams, pa.string()), pa.array(given, pa.binary())],
                schema=_ROWS,
            )

    return run


_PLACED = pa.schema(
    [("cell", pa.int64()), ("table", pa.int32()), ("key", pa.binary()), ("given", pa.binary()),
     ("sight", pa.binary()), ("cells", pa.binary()), ("copies", pa.int64())]
)
_PLACED_DDL = "cell long, table int, key binary, given binary, sight binary, cells binary, copies long"


def _cells(units: np.ndarray, team: str, n: int) -> np.ndarray:
    """The cell of every vector in each table of its team: a hash of its place on a grid."""
    dimension = units.shape[1]
    depth, tables = plan_of(n)
    out = np.empty((len(units), tables), np.int64)
    width = CELL * spread_of(dimension)
    for t in range(tables):
        shift = np.random.default_rng([SEED, dimension, 1 + t, depth]).random(depth)
        grid = np.floor(units @ directions(dimension, depth, 1 + t).T / width + shift).astype(np.int64)
        lead = f"{team}|{t}|".encode("utf-8", "surrogatepass")
        out[:, t] = [
            int.from_bytes(hashlib.blake2b(lead + g.tobytes(), digest_size=8).digest(), "little", signed=True) for g in grid
        ]
    return out


def _teams(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Distinct vectors of one team at a time, at length one, with their cells in each table."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            piece = batch.slice(at, 1024)
            for team in pc.unique(piece.column("team")).to_pylist():
                rows = piece.filter(pc.equal(piece.column("team"), team))
                units = _units(_matrix(rows.column("given"), kind))
                yield rows, units, _cells(units, team, rows.column("n")[0].as_py())


def _place(kind: str):
    """Each distinct vector once for each table, with its projections and its cells so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, units, cells in _teams(batches, kind):
            sight = (units @ directions(units.shape[1], DIRECTIONS, 0).T).astype(np.float32)
            seen = pa.array([x.tobytes() for x in sight], pa.binary())
            for t in range(cells.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[:, t]), pa.array([t] * len(units), pa.int32()), rows.column("key"), rows.column("given"),
                     seen, pa.array([x.tobytes() for x in cells[:, : t + 1]], pa.binary()), rows.column("copies")],
                    schema=_PLACED,
                )

    return run


_SIZES = pa.schema([("table", pa.int32()), ("cell", pa.int64()), ("n", pa.int64())])


def _sizes(kind: str):
    """Per piece, the rows of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, cells in _teams(batches, kind):
            for t in range(cells.shape[1]):
                own, n = np.unique(cells[:, t], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([t] * len(own), pa.int32()), pa.array(own), pa.array(n)], schema=_SIZES)

    return run


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the ends of all links (a, b) have the same root."""
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            nxt = root[root]
            if (nxt == root).all():
                break
            root[:] = nxt


_LINKS = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("head", pa.binary())])


class _List:
    """The vectors of a cell, or of two blocks of a large one, sorted along one direction."""

    def __init__(self, table: int, rows: pa.Table, cosine: float, kind: str):
        units = _units(_matrix(rows.column("given"), kind))
        sight = _matrix(rows.column("sight"), "float32")
        along = sight[:, table % DIRECTIONS]
        order = np.argsort(along, kind="stable")
        self.table, self.cosine = table, cosine
        self.units, self.sight, self.along = units[order], sight[order], along[order]
        self.cells = _matrix(rows.column("cells"), "int64")[order]
        self.side = np.array(rows.column("side").to_pylist(), np.int8)[order]
        self.copies = np.array(rows.column("copies").to_pylist(), np.int64)[order]
        self.keys = [rows.column("key")[i].as_py() for i in order.tolist()]
        self.crossing = rows.column("a")[0].as_py() != rows.column("b")[0].as_py()
        self.sigma = spread_of(units.shape[1], cosine)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within the window that is centred on the first along the sorted direction."""
        ends = np.searchsorted(self.along, self.along + np.float32(SORTED * self.sigma), "right")
        begins = np.arange(1, len(ends) + 1)
        sizes = ends - begins
        upto = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
            own = sizes[at:stop]
            first = np.repeat(np.arange(at, stop), own)
            inner = np.arange(len(first)) - np.repeat(np.cumsum(own) - own, own)
            yield first, begins[first] + inner
            at = stop

    def links(self, needed: int) -> tuple[np.ndarray, np.ndarray]:
        """Links counted per vector, with copies, and the first vector each hangs together with.

        A pair that also meets in an earlier table's cell and window is counted there.
        """
        n = np.zeros(len(self.keys), np.int64)
        root = np.arange(len(self.keys))
        near = np.float32(WINDOW * self.sigma)
        wide = np.float32(SORTED * self.sigma)
        for a, b in self.pairs():
            if self.crossing:
                across = self.side[a] != self.side[b]
                a, b = a[across], b[across]
            hits = (np.abs(self.sight[a] - self.sight[b]) <= near).sum(1)
            a, b = a[hits >= needed], b[hits >= needed]
            same = np.einsum("ij,ij->i", self.units[a], self.units[b]) >= self.cosine
            a, b = a[same], b[same]
            for t in range(self.table):
                met = self.cells[a, t] == self.cells[b, t]
                met &= np.abs(self.sight[a, t % DIRECTIONS] - self.sight[b, t % DIRECTIONS]) <= wide
                a, b = a[~met], b[~met]
            np.add.at(n, a, self.copies[b])
            np.add.at(n, b, self.copies[a])
            _unite(root, a, b)
        return n, root


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal values of ``names``, as one table a run."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            mark = tuple(marks[:, a].tolist())
            if held and mark != last:
                yield pa.Table.from_batches(held)
                held = []
            last = mark
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


_MEETING = ("table", "cell", "a", "b")


def _meet(cosine: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed: dict[int, int] = {}
        for rows in _runs(batches, _MEETING):
            if rows.num_rows < 2:
                continue
            own = _List(rows.column("table")[0].as_py(), rows, cosine, kind)
            dimension = own.units.shape[1]
            if dimension not in needed:
                needed[dimension] = count_needed(dimension, cosine)
            n, root = own.links(needed[dimension])
            linked = np.flatnonzero(n).tolist()
            if linked:
                keys = own.keys
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in linked], pa.binary()), pa.array(n[linked]),
                     pa.array([keys[root[i]] for i in linked], pa.binary())],
                    schema=_LINKS,
                )

    return run


def _meetings(placed: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Rows with the blocks (a, b) of their cell in which they meet others, and their side there.

    A cell of more than ``block`` rows is dealt into blocks, and every two of them meet in a
    task of their own, so no task holds more than two. ``sizes`` (table, cell, n) has the rows
    of cells, piece by piece; the large cells are broadcast if they are few.
    """
    large = sizes.groupBy("table", "cell").agg(F.sum("n").alias("n")).filter(F.col("n") > block)
    blocks = written(large.select("table", "cell", F.ceil(F.col("n") / F.lit(block // 2)).cast("int").alias("blocks")), "blocks")
    few = blocks.count() <= FEW
    joined = placed.join(F.broadcast(blocks) if few else blocks, ["table", "cell"], "left")
    own = F.coalesce(F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"), F.lit(0))
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    met = joined.withColumn("own", own).withColumn("other", F.explode(others))
    return met.withColumns(
        {"a": F.least("own", "other"), "b": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("tinyint")}
    ).drop("own", "other", "blocks")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Two rows link if their labels are equal and not null, their vectors have the same number of
    components and their cosine in double precision is ``cosine`` or more. Vectors that are
    null, empty or zero, or hold null or non-finite components, link with nothing.
    ``n_links`` counts the other rows a row links with directly, ``component_id`` is the smallest
    id reachable by links, ``kept`` tells whether that is the row's own.

    Copies are one class from the first task on. Each vector is projected on random directions.
    The vectors of a label (of a large label: those in one cell, in each of several tables) are
    sorted along one direction; pairs in the window centred on each vector have their collisions
    on all directions counted, and pairs with as many as ``count_needed`` asks for are verified.
    A pair is counted in the first table it meets in, so links come out as one number per
    vector, and what hangs together as one row per vector; pairs are never rows. Cells of more
    than ``block`` vectors are dealt into blocks that meet two by two.

    No pair below the cosine is linked. A pair right at it is missed with a probability of
    about MISSED + SHORT; closer ones less often. Every row is a vector of its own, also with
    an equal or a null id (a null id is no smallest id, and not kept). An empty table gives no
    rows. Other columns are ignored.
    """
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    kind = "float32" if chosen.schema["embedding"].dataType.elementType == T.FloatType() else "float64"
    keyed = chosen.mapInArrow(_keyed(kind), "vec_id long, key binary, team string, given binary")
    classes = keyed.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("team").alias("team"), F.min("given").alias("given")
    )
    classes = written(classes, "classes")
    sizes = classes.groupBy("team").agg(F.count("*").alias("n"))
    sized = classes.join(sizes, "team").select("team", "n", "given", "key", "copies")
    placed = sized.mapInArrow(_place(kind), _PLACED_DDL)
    cells = sized.select("team", "n", "given").mapInArrow(_sizes(kind), "table int, cell long, n long")
    dealt = spread(_meetings(placed, cells, block), *_MEETING).sortWithinPartitions(*_MEETING)
    links = written(dealt.mapInArrow(_meet(cosine, kind), "key binary, n long, head binary"), "links")

    roots = components(links.filter("key <> head").select(F.col("key").alias("a"), F.col("head").alias("b")), "vectors")
    counts = links.groupBy("key").agg(F.sum("n").alias("n"))
    found = classes.select("key", "least", "copies").join(counts, "key", "left")
    found = found.join(roots.withColumnRenamed("v", "key"), "key", "left")
    found = found.withColumn("root", F.coalesce("root", "key"))
    heads = found.groupBy("root").agg(F.min("least").alias("component_id"))
    n_links = F.coalesce("n", F.lit(0)) + F.col("copies") - 1
    known = written(found.join(heads, "root").select("key", n_links.alias("n_links"), "component_id"), "known")
    linked = keyed.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


NEAR_VECTORS_SQL = """
with recursive given as (
    select row_number() over () as r, vec_id, label, embedding::double[] as v from embeddings
), fit as (
    select r, vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) as size from given
    where label is not null and v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
    select a.r as a, b.r as b from fit a join fit b on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
    where list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.98
), reached as (
    select r, r as other from given
    union
    select reached.r, links.b from reached join links on links.a = reached.other
), least as (
    select reached.r, min(given.vec_id) as component_id from reached join given on given.r = reached.other group by reached.r
)
select vec_id, (select count(*) from links where links.a = given.r)::bigint as n_links, component_id,
    coalesce(vec_id = component_id, false) as kept
from given join least using (r)
"""
