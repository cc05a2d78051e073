"""Dropping lines that many documents share, with two Bloom filters before any shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.tables import per_batch, pieces, spread, texts, written

MIN_CHARS = 20
MIN_DOCS = 3
#: Bits of each filter and of the parts they are put together from. Eight megabytes are
#: broadcast at any input size; beyond some ten million lines more unrepeated lines pass the
#: filter and are shuffled as digests, the result stays the same.
FILTER_BITS = 1 << 26
PART_BITS = 1 << 20
_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    """A digest of the stripped line in lower case (A-Z), or None if it is too short."""
    bare = line.strip(_SPACE)
    if len(bare) < min_chars:
        return None
    return hashlib.blake2b(bare.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def keys_of(text: str, min_chars: int) -> set[bytes]:
    keys = {line_key(line, min_chars) for line in text.split("\n")}
    keys.discard(None)
    return keys


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Two bits of the filter for each 128-bit key."""
    return (keys & np.uint64(bits - 1)).astype(np.int64)


def _as_words(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def _local_filters(min_chars: int, bits: int, part_bits: int):
    """Bits that this task sets in the filter of keys seen once, and in that of keys seen twice."""
    schema = pa.schema([("part", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def flush(kept: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(kept), axis=0, return_counts=True)
        once = np.unique(_places(keys, bits))
        twice = np.unique(_places(keys[counts > 1], bits))
        edges = np.arange(0, bits + 1, part_bits)
        a, b = np.searchsorted(once, edges), np.searchsorted(twice, edges)
        filled = np.flatnonzero(np.diff(a)).tolist()
        part = lambda bits_set, at, k: (bits_set[at[k] : at[k + 1]] % part_bits).astype("<u4").tobytes()
        return pa.RecordBatch.from_pydict(
            {"part": filled, "once": [part(once, a, k) for k in filled], "twice": [part(twice, b, k) for k in filled]},
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for piece in pieces(batches):
            own = [k for text in texts(piece.column("text")) for k in keys_of(text, min_chars)]
            if own:
                kept.append(_as_words(own))
                held += len(own)
            if held > 1 << 21:
                yield flush(kept)
                kept, held = [], 0
        if held:
            yield flush(kept)

    return run


def _merge_filters(part_bits: int):
    """Per part, the bits that two tasks set once or one task set twice."""
    schema = pa.schema([("part", pa.int32()), ("twice", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for part, once, twice in zip(*(batch.column(c).to_pylist() for c in ("part", "once", "twice"))):
                if part not in parts:
                    parts[part] = np.zeros(part_bits, bool), np.zeros(part_bits, bool)
                seen, again = parts[part]
                new = np.frombuffer(once, "<u4")
                again[new[seen[new]]] = True
                again[np.frombuffer(twice, "<u4")] = True
                seen[new] = True
        for part, (_, again) in parts.items():
            yield pa.RecordBatch.from_pydict({"part": [part], "twice": [np.packbits(again).tobytes()]}, schema=schema)

    return run


def repeated_filter(docs: DataFrame, min_chars: int, bits: int, part_bits: int) -> np.ndarray:
    """The packed filter of keys that two documents hold, or that look so."""
    local = docs.select("text").mapInArrow(
        _local_filters(min_chars, bits, part_bits), "part int, once binary, twice binary"
    )
    merged = spread(local, "part").mapInArrow(_merge_filters(part_bits), "part int, twice binary")
    out = np.zeros(bits >> 3, np.uint8)
    for row in merged.collect():
        at = row.part * (part_bits >> 3)
        out[at : at + (part_bits >> 3)] = np.frombuffer(row.twice, np.uint8)
    return out


_SUSPECTS = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])


def _suspects(min_chars: int, bits: int, filter_):
    def make():
        seen = filter_.value

        def work(piece: pa.RecordBatch) -> dict:
            ids, keys = [], []
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts(piece.column("text"))):
                own = keys_of(text, min_chars)
                ids += [doc_id] * len(own)
                keys += own
            if not keys:
                return {"doc_id": [], "key": []}
            at = _places(_as_words(keys), bits)
            hit = ((seen[at >> 3] >> (7 - (at & 7))) & 1).all(1)
            chosen = np.flatnonzero(hit).tolist()
            return {"doc_id": [ids[k] for k in chosen], "key": [keys[k] for k in chosen]}

        return work

    return per_batch(make, _SUSPECTS)


_KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())]
)


def _rewrite(min_chars: int):
    def make():
        def work(piece: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": piece.column("doc_id"), "n_lines": [], "n_dropped": [], "kept": []}
            for text, drop in zip(texts(piece.column("text")), piece.column("drop").to_pylist()):
                if drop:
                    lines = text.split("\n")
                    gone = set(drop)
                    kept = [line for line in lines if line_key(line, min_chars) not in gone]
                    out["n_lines"].append(len(lines))
                    out["n_dropped"].append(len(lines) - len(kept))
                    out["kept"].append("\n".join(kept))
                else:
                    out["n_lines"].append(text.count("\n") + 1)
                    out["n_dropped"].append(0)
                    out["kept"].append(text)
            return out

        return work

    return per_batch(make, _KEPT)


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) per row of ``docs`` (doc_id, text).

    A line's key is the line stripped of ASCII white space with A-Z in lower case. Lines whose
    key has ``min_chars`` code points or more and stands in ``min_docs`` documents or more are
    dropped but in the document with the largest id that holds it; there all of them stay.

    Tasks set bits for their keys in two filters, of keys seen once and seen twice, which are
    merged part by part. Only keys in the second are shuffled, as 128-bit digests, to be
    counted exactly. Counts combine in the map tasks, so a line that is everywhere is no
    burden; the few lines that stand in more than a two-thousandth of all suspects come back
    to the documents by broadcast (2,000 at most), the others by an equi-join.

    Null and empty texts are one empty line. Rows with equal ids count as one document, rows
    without id as one document below all others. An empty table gives no rows.
    """
    part_bits = min(PART_BITS, bits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    filter_ = docs.sparkSession.sparkContext.broadcast(repeated_filter(rows, min_chars, bits, part_bits))
    suspects = rows.mapInArrow(_suspects(min_chars, bits, filter_), "doc_id long, key binary").distinct()
    suspects = written(suspects, "suspects")
    counted = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    shared = written(counted.filter(F.col("n") >= min_docs), "shared")
    hot_from = max(min_docs, suspects.count() // 2000 + 1)
    hot = shared.filter(F.col("n") >= hot_from).select("key", "last")
    cold = shared.filter(F.col("n") < hot_from).select("key", "last")
    elsewhere = F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last"))
    drops = suspects.join(F.broadcast(hot), "key").union(suspects.join(cold, "key")).filter(elsewhere)
    per_doc = drops.groupBy("doc_id").agg(F.collect_list("key").alias("drop")).withColumnRenamed("doc_id", "of")
    both = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "drop")
    return both.mapInArrow(_rewrite(min_chars), "doc_id long, n_lines long, n_dropped long, kept string")


LINE_DEDUP_SQL = """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select doc_id, pos, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines
), shared as (
    select key, max(doc_id) as last from keyed where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
)
select k.doc_id, count(*)::bigint as n_lines,
    count(*) filter (where s.key is not null and k.doc_id <> s.last)::bigint as n_dropped,
    sha256(coalesce(string_agg(k.line, chr(10) order by k.pos)
        filter (where s.key is null or k.doc_id = s.last), '')) as kept_sha256
from keyed k left join shared s on k.key = s.key
group by k.doc_id
"""
