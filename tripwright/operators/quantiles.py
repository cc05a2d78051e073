"""Exact percentiles per group, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripwright.session import work_dir

# Slices that a group is cut into at a time, by a sketch of its distinct values.
SLICES = 64
# Distinct values that one task may rank; a slice with more is cut again.
SLICE_LIMIT = 1_000_000
# Parts that a group's values are spread over where they meet the group's bounds.
SALTS = 32


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Sequence[float],
    slice_limit: int = SLICE_LIMIT,
) -> DataFrame:
    """Per group, an array ``percentiles`` of exact, linearly interpolated percentiles.

    Spark's own percentile keeps one counter per distinct value of a group in one task; the
    result here is the same to the bit. The input is read once: values are counted, with map
    tasks combining, and the counts are written. Groups with up to ``slice_limit`` distinct
    values are ranked as they are, in one pass. A larger group is cut into slices by a
    mergeable sketch of its distinct values, counts per slice tell which slice holds a wanted
    rank, and only those slices stay open; they are written and, if still too large for a
    task, cut again. The sketch decides how much is ranked where, never what comes out.
    """
    fractions = sorted(fractions)
    names = [f"_key{i}" for i in range(len(keys))]
    filled = df.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(value).cast("double").alias("_v"),
    ).filter("_v is not null")
    values = _kept(filled.groupBy(*names, "_v").agg(F.count("*").alias("_n")), "values")
    sizes = values.groupBy(*names).agg(F.sum("_n").alias("_total"), F.count("*").alias("_values"))
    at = _ranked_whole(values, names, fractions)
    if (sizes.agg(F.max("_values")).head()[0] or 0) > slice_limit:
        sizes = _kept(sizes, "sizes")
        small = sizes.filter(F.col("_values") <= slice_limit)
        large = sizes.filter(F.col("_values") > slice_limit)
        at = _ranked_whole(_of(values, small, names), names, fractions)
        found = _by_cutting(_of(values, large, names), large, names, fractions, slice_limit)
        cells = F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_at")
        by_group = found.groupBy(*names).agg(cells)
        both = by_group.alias("a").join(large.alias("b"), _same("a", "b", names))
        at = at.unionByName(both.select(*[F.col(f"a.{n}").alias(n) for n in names], "_total", "_at"))
    return at.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)],
        F.array(*[_between(i, f) for i, f in enumerate(fractions)]).alias("percentiles"),
    )


def _kept(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read from there."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of(values: DataFrame, groups: DataFrame, names: Sequence[str]) -> DataFrame:
    return values.alias("a").join(groups.alias("b"), _same("a", "b", names), "left_semi")


def _ranked_whole(values: DataFrame, names: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """(names, _total, _at): per group its size and the values at the wanted ranks, by index.

    One shuffle: sizes, running sums and what is picked by them all go by the group.
    """
    group = Window.partitionBy(*names)
    ordered = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = values.withColumns({"_end": F.sum("_n").over(ordered), "_total": F.sum("_n").over(group)})
    start = F.col("_end") - F.col("_n")
    picked = []
    for i, rank in enumerate(_rank_columns(fractions)):
        inside = (rank >= start) & (rank < F.col("_end"))
        picked.append((F.lit(i), F.max(F.when(inside, F.col("_v")))))
    return placed.groupBy(*names).agg(
        F.max("_total").alias("_total"), F.create_map(*[c for pair in picked for c in pair]).alias("_at")
    )


def _by_cutting(
    values: DataFrame, sizes: DataFrame, names: Sequence[str], fractions: Sequence[float], slice_limit: int
) -> DataFrame:
    """(names, _i, _v): the value at each wanted rank of large groups."""
    values = values.withColumn("_slice", F.lit(""))
    cells = [F.struct(F.lit(i).alias("_i"), r.alias("_rank")) for i, r in enumerate(_rank_columns(fractions))]
    wanted = sizes.select(*names, F.lit("").alias("_slice"), F.inline(F.array(*cells)))
    found: DataFrame | None = None
    most, before = slice_limit + 1, None
    # Cutting ends when slices are small, or would no longer get smaller.
    while most > slice_limit and most != before:
        values, wanted, settled = (_kept(x, "open") for x in _cut(values, wanted, names))
        found = settled if found is None else found.unionByName(settled)
        open_slices = values.groupBy(*names, "_slice").agg(F.count("*").alias("_values"))
        before, most = most, open_slices.agg(F.max("_values")).head()[0] or 0
    return found.unionByName(_ranked(values, wanted, names))


def _position(fraction: float) -> Column:
    return F.lit(float(fraction)) * (F.col("_total") - 1)


def _rank_columns(fractions: Sequence[float]) -> list[Column]:
    """Per fraction, the two zero-based ranks whose values it lies between."""
    return [rank(_position(f)) for f in fractions for rank in (F.floor, F.ceil)]


def _between(i: int, fraction: float) -> Column:
    """The value at a fractional rank, worked out as Spark's percentile does."""
    position = _position(fraction)
    lower, upper = F.floor(position), F.ceil(position)
    low, high = F.col("_at")[2 * i], F.col("_at")[2 * i + 1]
    mixed = (upper - position) * low + (position - lower) * high
    return F.when((lower == upper) | (low == high), low).otherwise(mixed)


def _same(a: str, b: str, columns: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return on


def _cut(
    values: DataFrame, wanted: DataFrame, names: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut every group into slices and keep those that hold a wanted rank.

    Returns their values, the ranks counted from the beginning of the slice, and the ranks
    that are settled because their slice is one value.
    """
    group = [*names, "_slice"]
    grid = [k / SLICES for k in range(1, SLICES)]
    sketch = F.percentile_approx("_v", grid)
    bounds = values.groupBy(*group).agg(F.array_distinct(sketch).alias("_bounds"))
    # A large group meets its bounds in many tasks.
    salted = values.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)))
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")
    copies = bounds.withColumn("_salt", F.explode(salts))
    met = salted.alias("a").join(copies.alias("b"), _same("a", "b", [*group, "_salt"]))
    v = F.col("a._v")
    sliced = met.select(
        *[F.col(f"a.{c}").alias(c) for c in group],
        "_v",
        "_n",
        F.size(F.filter("_bounds", lambda b: b < v)).alias("_part"),
    )
    sizes = sliced.groupBy(*group, "_part").agg(
        F.sum("_n").alias("_size"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    # At most SLICES rows per group.
    ordered = Window.partitionBy(*group).orderBy("_part")
    upto = F.sum("_size").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = sizes.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_size"))
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))
    held = wanted.alias("a").join(spans.alias("b"), _same("a", "b", group)).filter(inside)
    held = held.select(
        *[F.col(f"a.{c}").alias(c) for c in group],
        "_part",
        "_i",
        (F.col("_rank") - F.col("_start")).alias("_rank"),
        "_least",
        "_most",
    )
    one = F.col("_least") == F.col("_most")
    settled = held.filter(one).select(*names, "_i", F.col("_least").alias("_v"))
    open_ranks = held.filter(~one)
    slices = open_ranks.select(*group, "_part").distinct()
    kept = sliced.alias("a").join(slices.alias("b"), _same("a", "b", [*group, "_part"]), "left_semi")
    name = F.concat("_slice", F.lit("/"), F.col("_part").cast("string")).alias("_slice")
    return (
        kept.select(*names, name, "_v", "_n"),
        open_ranks.select(*names, name, "_i", "_rank"),
        settled,
    )


def _ranked(values: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    """(names, _i, _v): the value at each wanted rank, from the values of its slice."""
    group = [*names, "_slice"]
    ordered = Window.partitionBy(*group).orderBy("_v")
    upto = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = values.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_n"))
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))
    held = wanted.alias("a").join(spans.alias("b"), _same("a", "b", group)).filter(inside)
    return held.select(*[F.col(f"a.{n}").alias(n) for n in names], "_i", "_v")
