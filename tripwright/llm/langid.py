"""Language of a text by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.sample import held_out, per_label
from tripwright.llm.tables import carried, per_batch, pieces, texts, unpacked

#: Learning takes so many rows of each language at most.
ROWS_PER_LANGUAGE = 400
FEATURES = 1 << 12
#: Learned from more languages than this, a model would not fit the driver.
MAX_LANGUAGES = 512
UNKNOWN = "und"
#: A prediction is ambiguous if the runner-up comes this close.
MARGIN = 0.2
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters in lower case, bytes beyond ASCII as they are, anything else a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPREAD = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1, one per language, as far apart as a short code allows.

    Up to six languages take all ways to split them in two; more take the rows of a Hadamard
    matrix without its constant column, any two of which differ in half their places.
    """
    if n <= 6:
        splits = np.arange(1 << max(0, n - 1))[1:]
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return 1 - 2 * bits
    width = 1 << (n - 1).bit_length()
    shared = np.arange(n)[:, None] & np.arange(1, width)[None, :]
    parity = np.zeros_like(shared)
    while shared.any():
        parity ^= shared & 1
        shared >>= 1
    return 1 - 2 * parity


def features(rows: list[str]) -> np.ndarray:
    """Hashed byte n-grams of one to three per text: roots of their counts, of length one.

    Every text is padded with spaces of its own, so no n-gram reaches into another text.
    """
    plain = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_PLAIN) + b"   " for t in rows]
    raw = np.frombuffer(b"".join(plain), np.uint8).astype(np.uint32)
    sizes = np.array([len(p) for p in plain])
    row = np.repeat(np.arange(len(plain)) * FEATURES, sizes)
    out = np.zeros(len(plain) * FEATURES, np.float32)
    mixed = np.zeros(len(raw), np.uint32)
    live = np.ones(len(raw), bool)
    ends = np.cumsum(sizes)
    for k in range(3):
        live[ends - 1 - k] = False
        own = raw if k == 0 else np.append(raw[k:], np.zeros(k, np.uint32))
        mixed = mixed + (own + np.uint32(1 + 61 * k)) * _SPREAD[k]
        at = ((mixed ^ (mixed >> np.uint32(15))) * _SPREAD[0]) >> np.uint32(32 - FEATURES.bit_length() + 1)
        keep = live & ~((raw == 32) & (own == 32)) if k < 2 else live & (raw + own != 64)
        out += np.bincount(row[keep] + at[keep], minlength=len(out)).astype(np.float32)
    out = np.sqrt(out.reshape(len(plain), FEATURES))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, rows: list[str]) -> list[tuple[str, float, bool]]:
        """(language, score, ambiguous) of each text."""
        lettered = [k for k, t in enumerate(rows) if _LETTER.search(t)]
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(rows)
        if not self.languages or not lettered:
            return out
        votes = features([rows[k] for k in lettered]) @ self.weights + self.bias
        # The loss of a codeword: how badly each classifier's vote fits its bit, by its trust.
        loss = (np.logaddexp(0, -votes[:, None, :] * self.codes[None]) * self.trust).sum(2)
        odds = np.exp(loss.min(1, keepdims=True) - loss)
        share = odds / odds.sum(1, keepdims=True)
        best = share.argmax(1)
        wrong = (np.sign(votes) * self.codes[best] < 0).sum(1)
        second = np.partition(share, -2, 1)[:, -2] if len(self.languages) > 1 else np.zeros(len(best))
        sure = share[np.arange(len(best)), best]
        unclear = (sure - second < MARGIN) | (wrong > self.correctable())
        for k, b, s, u in zip(lettered, best.tolist(), sure.tolist(), unclear.tolist()):
            out[k] = (self.languages[b], float(s), bool(u))
        return out

    def correctable(self) -> int:
        """Wrong bits that decoding surely mends."""
        gaps = (self.codes[:, None, :] != self.codes[None]).sum(2)
        return max(0, int(gaps[gaps > 0].min() - 1) // 2) if gaps.any() else 0


def learn(x: np.ndarray, names: list[str], steps: int = 300) -> Model:
    """A logistic classifier for each bit of the code, by gradient steps over all rows."""
    languages = sorted(set(names))
    codes = codewords(len(languages))
    if not len(languages) or not codes.shape[1]:
        empty = np.zeros((FEATURES, codes.shape[1]), np.float32)
        return Model(languages, codes, empty, np.zeros(codes.shape[1]), np.zeros(codes.shape[1]))
    of = np.array([languages.index(n) for n in names])
    target = codes[of].astype(np.float32)
    share = (1 / np.bincount(of))[of][:, None].astype(np.float32)
    share /= share.sum()
    w, b = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        pull = share * target / (1 + np.exp(target * (x @ w + b)))
        speed_w = 0.9 * speed_w + x.T @ pull - 1e-5 * w
        speed_b = 0.9 * speed_b + pull.sum(0)
        w += 4 * speed_w
        b += 4 * speed_b
    right = ((x @ w + b) * target > 0).mean(0)
    return Model(languages, codes, w, b, np.maximum(0, 2 * right - 1))


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from ``docs`` (doc_id, text, lang): a bounded sample of the rows not held out."""
    fit = docs.filter(~held_out() & F.col("text").isNotNull())
    labelled = fit.select("doc_id", F.col("lang").alias("label"))
    if labelled.select("label").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    chosen = per_label(labelled, rows_per_language)
    sample = fit.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def run(batches):
        for piece in pieces(batches):
            x = features(texts(piece.column("text"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "label", "x"],
            )

    lettered = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    found = sorted(lettered.mapInArrow(run, "doc_id long, label string, x binary").collect())
    if not found:
        return learn(np.zeros((0, FEATURES), np.float32), [])
    x = np.stack([np.frombuffer(r.x, np.float16) for r in found]).astype(np.float32)
    return learn(x, [r.label for r in found])


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
     ("score", pa.float64()), ("ambiguous", pa.bool_())]
)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) per row of ``docs`` (doc_id, text).

    Only the text is looked at, all of it. Texts that are null, empty or without a letter are
    ``und`` with score 0 and ambiguous, as is everything if nothing was learned. ``ambiguous``
    is also set if the runner-up is within MARGIN or more bits are wrong than the code mends.
    Equal rows give equal results; equal and null ids are kept as they are.
    """
    known = carried(docs.sparkSession, model)

    def make():
        own = unpacked(known)

        def work(piece: pa.RecordBatch) -> dict:
            found = own.predict(texts(piece.column("text")))
            names, scores, unclear = zip(*found)
            return {
                "doc_id": piece.column("doc_id"), "held_out": piece.column("held_out"),
                "lang_pred": names, "score": scores, "ambiguous": unclear,
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(
        per_batch(make, _SCHEMA), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )
