"""Quality of a document from a linear-chain conditional random field over its lines."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.sample import held_out, per_label
from tripwright.llm.tables import carried, per_batch, pieces, texts, unpacked

#: Learning takes so many documents of each label at most.
ROWS_PER_LABEL = 1500
BAD, GOOD = 0, 1
_RUN = re.compile(r"([^\w\s])\1")
_CLASSES = [
    np.array([chr(b).isupper() for b in range(128)] + [False] * 128),
    np.array([chr(b).islower() for b in range(128)] + [False] * 128),
    np.arange(256) >= 128,
    np.array([chr(b).isdigit() and b < 128 for b in range(256)]),
    np.isin(np.arange(256), [9, 11, 12, 13, 32]),
    np.isin(np.arange(256), list(b".,")),
    np.isin(np.arange(256), list(b"!?")),
    np.isin(np.arange(256), list(b"#$%&*+<=>@\\^_`|~/")),
    np.isin(np.arange(256), list(b"\"'()-:;[]{}")),
]
#: Features of a line by itself; its neighbours' come beside them.
OWN = len(_CLASSES) + 8


def own_features(text: str) -> np.ndarray:
    """What each line looks like: shares of kinds of characters, words, repetition, endings."""
    lines = text.split("\n")
    raw = np.frombuffer((text + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = np.maximum(ends - starts, 1)
    out = np.zeros((len(lines), OWN), np.float32)
    for k, kind in enumerate(_CLASSES):
        seen = np.cumsum(np.concatenate(([0], kind[raw])))
        out[:, k] = (seen[ends] - seen[starts]) / size
    for k, line in enumerate(lines):
        words = line.split()
        n = max(1, len(words))
        distinct = len(set(words)) / n
        letters = len(line) / n
        out[k, len(_CLASSES) :] = (
            min(8.0, np.log1p(len(line))), min(8.0, np.log1p(len(words))), distinct,
            distinct < 0.4 and n > 8, min(3.0, letters / 8), bool(_RUN.search(line)),
            line[-1:] in ".!?" and line != "", not words,
        )
    return out


def features(rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, lines per text): a line's own features and its neighbours'."""
    parts, sizes, counts = [], [], []
    for text in rows:
        own = own_features(text)
        n = len(own)
        wide = np.zeros((n, 3 * OWN + 3), np.float32)
        wide[:, :OWN] = own
        wide[1:, OWN : 2 * OWN] = own[:-1]
        wide[:-1, 2 * OWN : 3 * OWN] = own[1:]
        wide[0, -3] = wide[-1, -2] = 1
        wide[:, -1] = 1
        parts.append(wide)
        sizes.append(np.array([len(line) + 1 for line in text.split("\n")], np.float64))
        counts.append(n)
    return np.concatenate(parts), np.concatenate(sizes), np.array(counts)


class _Chains:
    """Positions of many chains of different lengths, step by step, longest first."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        begins = np.concatenate(([0], np.cumsum(counts)[:-1]))[order]
        lengths = counts[order]
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), "left") if len(counts) else []
        self.steps = [begins[:m] + t for t, m in enumerate(alive)]

    def marginals(self, unary: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each line's labels, and summed ones of neighbouring labels per line."""
        forward, backward = unary.copy(), np.zeros_like(unary)
        for before, here in zip(self.steps, self.steps[1:]):
            last = forward[before[: len(here)]]
            forward[here] += np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1])
        for here, after in zip(self.steps[-2::-1], self.steps[:0:-1]):
            ahead = unary[after] + backward[after]
            backward[here[: len(after)]] = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
        both = forward + backward
        whole = np.logaddexp(both[:, 0], both[:, 1])
        pairs = np.zeros((len(unary), 2, 2))
        for before, here in zip(self.steps, self.steps[1:]):
            at = before[: len(here)]
            ahead = (unary[here] + backward[here])[:, None, :]
            pairs[here] = np.exp(forward[at][:, :, None] + moves + ahead - whole[at][:, None, None])
        return np.exp(both - whole[:, None]), pairs


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float

    def raw_scores(self, x: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted share of good lines of each text."""
        unary = self.unary(x)
        good = _Chains(counts).marginals(unary, self.moves)[0][:, GOOD]
        begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
        return np.add.reduceat(good * sizes, begins) / np.add.reduceat(sizes, begins)

    def unary(self, x: np.ndarray) -> np.ndarray:
        lean = ((x - self.mean) / self.scale) @ self.weights
        return np.stack((-lean / 2, lean / 2), 1).astype(np.float64)

    def score(self, rows: list[str]) -> np.ndarray:
        raw = np.clip(self.raw_scores(*features(rows)), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(raw / (1 - raw)) + self.offset, -500, 500)))


def learn(x: np.ndarray, sizes: np.ndarray, counts: np.ndarray, labels: np.ndarray, weight: np.ndarray, steps: int = 200) -> Model:
    """Fit line weights and label moves: each document's lines carry its label.

    Documents count by ``weight`` whatever their number of lines. The document score is the
    marginals' weighted mean, put on the scale of probabilities by a logistic curve.
    """
    mean, scale = x.mean(0), x.std(0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    flat = ((x - mean) / scale).astype(np.float64)
    chains = _Chains(counts)
    line_weight = np.repeat(weight / counts, counts)
    line_weight /= line_weight.sum()
    truth = np.repeat(labels, counts)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    inner = np.ones(len(truth), bool)
    inner[first] = False
    w, moves = np.zeros(flat.shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (truth[inner], truth[inner]), line_weight[inner])
    for step in range(1, steps + 1):
        lean = flat @ w
        own, pairs = chains.marginals(np.stack((-lean / 2, lean / 2), 1), moves)
        pull_w = flat.T @ (line_weight * (truth - own[:, GOOD])) - 1e-4 * w
        pull_m = seen_moves - (pairs * line_weight[:, None, None]).sum(0) - 1e-2 * moves
        for k, (value, pull) in enumerate(((w, pull_w), (moves, pull_m))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * pull
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * pull**2
            size = np.sqrt(state[2 * k + 1] / (1 - 0.99**step)) + 1e-8
            value += 0.05 * (state[2 * k] / (1 - 0.9**step)) / size
    model = Model(mean, scale, w, moves, 1.0, 0.0)
    raw = np.clip(model.raw_scores(x, sizes, counts), 1e-6, 1 - 1e-6)
    model.slope, model.offset = _curve(np.log(raw / (1 - raw)), labels, weight)
    return model


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by damped Newton steps."""
    design = np.stack((x, np.ones_like(x)), 1)
    at = np.array([0.5, 0.0])
    weight = weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        pull = design.T @ (weight * (y - p)) - 1e-4 * at
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        at = at + np.clip(np.linalg.solve(curve, pull), -1, 1)
    return float(max(at[0], 1e-3)), float(at[1])


def train(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> Model | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality): a bounded sample.

    Rows that are held out are not read. Sampled labels weigh as often as they are in the
    whole table. None if there is nothing to learn from.
    """
    known = labels.filter(~held_out()).select("doc_id", F.col("quality").cast("int").alias("label")).filter("label in (0, 1)")
    often = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = per_label(known, rows_per_label)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def run(batches):
        for piece in pieces(batches):
            x, sizes, counts = features(texts(piece.column("text")))
            cuts = np.cumsum(counts)[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), piece.column("label"),
                    pa.array([p.tobytes() for p in np.split(x, cuts)], pa.binary()),
                    pa.array([p.tobytes() for p in np.split(sizes, cuts)], pa.binary()),
                ],
                ["doc_id", "label", "x", "sizes"],
            )

    one = sample.dropDuplicates(["doc_id"]).select("doc_id", F.col("label").cast("int").alias("label"), "text")
    found = sorted(one.mapInArrow(run, "doc_id long, label int, x binary, sizes binary").collect(), key=lambda r: r.doc_id)
    if not found:
        return None
    y = np.array([r.label for r in found])
    drawn = np.bincount(y, minlength=2)
    weight = np.array([often[k] / drawn[k] for k in y])
    sizes = [np.frombuffer(r.sizes, np.float64) for r in found]
    x = np.concatenate([np.frombuffer(r.x, np.float32) for r in found]).reshape(-1, 3 * OWN + 3)
    return learn(x, np.concatenate(sizes), np.array([len(s) for s in sizes]), y, weight)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)


def score_quality(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Only the text is looked at, all of it. Null and empty texts are one empty line and get the
    score the model gives that. Without a model every score is 0.5. ``predicted`` is 1 from
    0.5 on. Equal texts get equal scores; equal and null ids are kept as they are.
    """
    known = carried(docs.sparkSession, model)

    def make():
        own = unpacked(known)

        def work(piece: pa.RecordBatch) -> dict:
            rows = texts(piece.column("text"))
            scores = own.score(rows) if own is not None else np.full(len(rows), 0.5)
            return {
                "doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"),
                "score": scores, "predicted": (scores >= 0.5).astype(np.int32),
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(per_batch(make, _SCHEMA), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, with all their columns."""
    known = carried(docs.sparkSession, model)

    def run(batches):
        own = unpacked(known)
        for piece in pieces(batches):
            scores = own.score(texts(piece.column("text"))) if own is not None else np.full(piece.num_rows, 0.5)
            yield piece.filter(pa.array(scores >= 0.5))

    return docs.mapInArrow(run, docs.schema)
