"""Roles of the turns of a transcript by a hidden Markov model, and their canonical rendering."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.sample import held_out
from tripwright.llm.tables import partitions

#: The roles, and words that mark a speaker at the head of a turn.
ROLES = ["assistant", "system", "user"]
MARKERS = {
    "assistant": ["assistant", "ai", "bot", "model", "gpt", "answer", "a"],
    "system": ["system", "instruction", "instructions", "context"],
    "user": ["user", "human", "customer", "question", "prompt", "q"],
}
#: Turn numbers of one segment; segments are decoded apart and put together.
SEGMENT = 256
_ALL = "|".join(w for words in MARKERS.values() for w in words)
_HEAD = rf"^\s*(?:[#*\[<|]+\s*)?(?i:({_ALL}))\s*(?:[\]>|*]+)?\s*(?::|>|\n)\s*(?:\*\*)?\s*"
#: Values of each feature of a turn.
SIZES = {"marker": len(ROLES) + 1, "length": 16, "lines": 8, "asks": 2, "first": 2, "parity": 2}


def observed(turns: DataFrame) -> DataFrame:
    """Adds what is seen of each turn: speaker marker, length, lines, question, place."""
    text = F.coalesce(F.col("text"), F.lit(""))
    word = F.lower(F.regexp_extract(text, _HEAD, 1))
    marker = F.lit(0)
    for k, role in enumerate(ROLES):
        marker = F.when(word.isin(MARKERS[role]), k + 1).otherwise(marker)
    lines = F.size(F.split(text, "\n"))
    turn = F.coalesce(F.col("turn"), F.lit(-1))
    return turns.withColumns(
        {
            "marker": marker,
            "length": F.least(F.floor(F.log2(F.length(text) + F.lit(1))), F.lit(SIZES["length"] - 1)).cast("int"),
            "lines": F.least(lines - 1, F.lit(SIZES["lines"] - 1)),
            "asks": F.rtrim(text).endswith("?").cast("int"),
            "first": (turn <= 0).cast("int"),
            "parity": F.pmod(turn, F.lit(2)).cast("int"),
        }
    )


@dataclass(frozen=True)
class Model:
    """Logarithms of probabilities: first role, role after role, feature value in a role."""

    start: list[float]
    moves: list[list[float]]
    seen: dict[str, list[list[float]]]


def _logs(counts: list[float]) -> list[float]:
    total = sum(counts) + len(counts)
    return [math.log((c + 1) / total) for c in counts]


def train(turns: DataFrame) -> Model:
    """Counts over all turns (conv_id, turn, role, text) whose conversation is not held out.

    Transitions are counted between turns whose numbers follow each other. What reaches the
    driver is a few hundred counts. A role that is none of ROLES is not learned from.
    """
    known = observed(turns.filter(~held_out("conv_id")).filter(F.col("role").isin(ROLES)))
    counts: dict[tuple, float] = {}
    features = list(SIZES)
    kinds = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("v")) for f in features]))
    for r in known.select("role", kinds.alias("x")).groupBy("role", "x.f", "x.v").count().collect():
        counts[r.f, r.role, r.v] = r["count"]
    one = known.filter("turn is not null").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    after = one.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("later"))
    for r in one.join(after, ["conv_id", "turn"]).groupBy("role", "later").count().collect():
        counts["move", r.role, r.later] = r["count"]
    seen = {f: [_logs([counts.get((f, role, v), 0) for v in range(SIZES[f])]) for role in ROLES] for f in features}
    moves = [_logs([counts.get(("move", a, b), 0) for b in ROLES]) for a in ROLES]
    start = _logs([counts.get(("first", role, 1), 0) for role in ROLES])
    return Model(start, moves, seen)


def _evidence(model: Model) -> Column:
    """Per role, the log probability of what is seen of a turn."""
    per_role = []
    for k in range(len(ROLES)):
        parts = [F.element_at(F.array(*[F.lit(x) for x in rows[k]]), F.col(f).cast("int") + 1) for f, rows in model.seen.items()]
        per_role.append(sum(parts[1:], parts[0]))
    return F.array(*per_role)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    held, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        at = [batch.schema.names.index(k) for k in keys]
        for row in zip(*columns):
            key = tuple(row[k] for k in at)
            if rows and key != held:
                yield held, rows
                rows = []
            held = key
            rows.append(row)
    if rows:
        yield held, rows


def _through(moves: np.ndarray, evidence: list[list[float]]) -> np.ndarray:
    """Best score from each role of the segment's first turn to each role of its last."""
    best = np.full(moves.shape, -np.inf)
    np.fill_diagonal(best, evidence[0])
    for seen in evidence[1:]:
        best = (best[:, :, None] + moves[None]).max(1) + np.array(seen)
    return best


_BESTS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("best", pa.list_(pa.float64()))])
_ENDS = pa.schema([("of", pa.int64()), ("of_segment", pa.int64()), ("opens", pa.int32()), ("last", pa.int32())])
_PATHS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("text", pa.string()), ("state", pa.int32())])


def _segments(moves: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.array(moves)
        for (conv, segment), rows in _groups(batches, ["conv_id", "segment"]):
            best = _through(step, [r[-1] for r in rows])
            yield pa.RecordBatch.from_pydict({"conv_id": [conv], "segment": [segment], "best": [best.ravel().tolist()]}, schema=_BESTS)

    return run


def _across(start: list[float], moves: list[list[float]]):
    """Viterbi over whole segments: the roles of the first and last turn of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.array(moves)
        for (conv,), rows in _groups(batches, ["conv_id"]):
            arrive, back = np.array(start), []
            for row in rows:
                total = arrive[:, None] + np.array(row[2]).reshape(step.shape)
                score, opened = total.max(0), total.argmax(0)
                onward = score[:, None] + step
                arrive, left = onward.max(0), onward.argmax(0)
                back.append((opened, left))
            last = int(score.argmax())
            ends = []
            for k in range(len(back) - 1, -1, -1):
                opens = int(back[k][0][last])
                ends.append((opens, last))
                last = int(back[k - 1][1][opens]) if k else 0
            ends.reverse()
            columns = [[conv] * len(rows), [r[1] for r in rows], *zip(*ends)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ENDS.types)], schema=_ENDS)

    return run


def _inside(moves: list[list[float]]):
    """Viterbi inside a segment between the roles that are settled at both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.array(moves)
        for _, rows in _groups(batches, ["conv_id", "segment"]):
            score, back = np.full(len(step), -np.inf), []
            score[rows[0][4]] = 0
            for row in rows[1:]:
                total = score[:, None] + step
                back.append(total.argmax(0))
                score = total.max(0) + np.array(row[6])
            state = rows[0][5]
            path = [state]
            for choice in reversed(back):
                state = int(choice[state])
                path.append(state)
            path.reverse()
            columns = [[r[0] for r in rows], [r[2] for r in rows], [r[3] for r in rows], path]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PATHS.types)], schema=_PATHS)

    return run


def parse_roles(turns: DataFrame, model: Model) -> DataFrame:
    """(conv_id, turn, role_pred, rendered) of every row of ``turns`` (conv_id, turn, text).

    Roles are the most likely path of the model through each conversation, by turn number,
    ties by text, rows without a turn number first. Given roles are not looked at. The
    rendering is ``<|role|>``, the text without its speaker marker, ``<|end|>``; null texts
    are empty. Rows without conversation id are one conversation. Repeated rows are turns.

    A conversation is never gathered: its segments of SEGMENT turn numbers are scored apart,
    a small matrix for each settles the roles at their borders, and segments are decoded
    between those. Rows with equal turn numbers are in one segment.
    """
    n = partitions(turns.sparkSession)
    segment = F.floor(F.coalesce(F.col("turn").cast("long"), F.lit(-1)) / F.lit(SEGMENT))
    seen = observed(turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("text").cast("string").alias("text")))
    rows = seen.select("conv_id", segment.cast("long").alias("segment"), "turn", "text", _evidence(model).alias("evidence"))
    dealt = rows.select("conv_id", "segment", "turn", F.xxhash64("text").alias("tie"), "evidence").repartition(n, "conv_id", "segment")
    scored = dealt.sortWithinPartitions("conv_id", "segment", "turn", "tie").select("conv_id", "segment", "evidence")
    bests = scored.mapInArrow(_segments(model.moves), "conv_id long, segment long, best array<double>")
    chain = bests.repartition(n, "conv_id").sortWithinPartitions("conv_id", "segment")
    ends = chain.mapInArrow(_across(model.start, model.moves), "of long, of_segment long, opens int, last int")
    both = rows.join(ends, rows.conv_id.eqNullSafe(ends.of) & (rows.segment == ends.of_segment))
    placed = both.repartition(n, "conv_id", "segment").withColumn("tie", F.xxhash64("text"))
    ready = placed.sortWithinPartitions("conv_id", "segment", "turn", "tie")
    paths = ready.select("conv_id", "segment", "turn", "text", "opens", "last", "evidence").mapInArrow(
        _inside(model.moves), "conv_id long, turn long, text string, state int"
    )
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("state") + 1)
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), _HEAD, "")
    rendered = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.trim(bare), F.lit("\n<|end|>"))
    return paths.select("conv_id", "turn", role.alias("role_pred"), rendered.alias("rendered"))
