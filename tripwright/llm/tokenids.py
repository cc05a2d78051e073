"""Documents as token ids in range-coded segments, and back."""

from __future__ import annotations

import json
import os
import struct
import sys
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwright.llm.rangecoder import decode, encode
from tripwright.llm.ranges import dealt
from tripwright.llm.tables import partitions, pieces

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Ids of a segment, from which on it is closed after the document at hand.
SEGMENT = 1 << 21
#: Bytes that a task spends on remembering the ids of stretches, and stretches that are given
#: to the tokenizer at a time, and as one text.
REMEMBERED, CODED, JOINED = 24 << 20, 1 << 14, 32
#: Texts, and bytes of them, that are cut into stretches at a time.
CUT_ROWS, CUT_BYTES = 4096, 4 << 20


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = _MARK
    for first in (0x41, 0x61):
        kinds[first : first + 26] = _LETTER
    kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
    return kinds


#: Bytes of ASCII: white space, letters, and all else that can be seen.
_SPACE, _LETTER, _MARK = 1, 2, 3
_KINDS = _kinds()
#: Bytes that are white space, not to be seen, or may begin white space of more than one byte.
_DOUBTFUL = np.zeros(256, np.int64)
_DOUBTFUL[[*range(0x21), 0x7F, *range(0xC0, 0xC3), *range(0xE0, 0xE4)]] = 1


def _stretches(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where stretches of the texts in ``data`` begin, which begin there themselves.

    A text is cut before white space that follows something else, and after an ASCII letter
    that something else in ASCII follows. What begins with a byte from 0x80 on is taken for
    something else than white space where no white space begins so.
    """
    kinds = _KINDS.take(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (kinds[:-1] == _LETTER) & (kinds[1:] == _MARK)
    at = np.flatnonzero(kinds == _SPACE)
    at = at[at > 0]
    cut[at] = kinds[at - 1] >= _LETTER
    # After two bytes of 0xC3 to 0xDF, three of 0xE4 to 0xEF or four of 0xF0 on.
    at = at[data[at - 1] >= 0x80]
    two, three, four = (data[np.maximum(at - n, 0)] for n in (2, 3, 4))
    cut[at] = ((two >= 0xC3) & (two <= 0xDF)) | ((three >= 0xE4) & (three <= 0xEF)) | (four >= 0xF0)
    cut[begins] = True
    return np.flatnonzero(cut[:-1])


def _bytes(column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column without nulls, and the bounds of the texts in them."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if bounds[0] == bounds[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _joinable(stretches: pa.LargeStringArray) -> np.ndarray:
    """Whether each begins with a space and holds something else after it, but no other white space.

    Such stretches are parted again when a text is made of them.
    """
    if not len(stretches):
        return np.zeros(0, bool)
    data, bounds = _bytes(stretches)
    doubtful = np.concatenate(([0], np.cumsum(_DOUBTFUL.take(data))))[bounds]
    return (np.diff(bounds) > 1) & (data[bounds[:-1]] == 0x20) & (np.diff(doubtful) == 1)


class Tokens:
    """The tokenizer with a memory for stretches of text.

    The rule for splitting a text that GPT-2 came with never takes white space together with
    what stands before it, nor a letter with a mark or digit after it, and looks back at
    nothing, so stretches cut there can be encoded one by one: the different ones of many
    texts once, and looked up when they come again. Texts that hold a token added to the
    vocabulary are encoded whole, and so are all where the tokenizer has another rule.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {id: t.content for id, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = [*added.values()]
        # A token is written with one character for each of its bytes, an added one as it is.
        words = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(words.values()) + 1, np.int64)
        for word, id in words.items():
            self.sizes[id] = len(added[id].encode()) if id in added else len(word)
        self.joins = not any(" " in s for s in self.special)
        parts = json.loads(self.tokenizer.to_str())
        rule = parts.get("pre_tokenizer") or {}
        self.by_stretch = (
            [rule.get(k) for k in ("type", "use_regex", "add_prefix_space")] == ["ByteLevel", True, False]
            and not any(parts.get(k) for k in ("normalizer", "truncation", "padding"))
            and parts["model"].get("dropout") is None
        )
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.lengths = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _apart(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches one after another, and how many each has."""
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), "<u4"), np.fromiter(map(len, coded), np.int64, len(coded))

    def _joined(self, new: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same from texts of ``JOINED`` stretches each, parted again by the bytes of their ids."""
        data, bounds = _bytes(new)
        cuts = [*bounds[:-1:JOINED].tolist(), len(data)]
        texts = [data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([c.ids for c in coded]), "<u4")
        after, ends = np.cumsum(self.sizes.take(ids)), bounds[1:]
        at = np.searchsorted(after, ends)
        if not len(after) or after[-1] != ends[-1] or at[-1] + 1 != len(after) or (after[at] != ends).any():
            return self._apart(new.to_pylist())
        return ids, np.diff(at, prepend=-1)

    def _places(self, wanted: pa.LargeStringArray) -> np.ndarray:
        """Where in the memory stretches are; those that are new come into it."""
        if self.known.nbytes + self.ids.nbytes + self.lengths.nbytes > REMEMBERED:
            self.forget()
        found = pc.index_in(wanted, value_set=self.known)
        places, is_new = found.fill_null(0).to_numpy().astype(np.int64), found.is_null()
        new = wanted.filter(is_new)
        joins = _joinable(new) & self.joins
        order = np.concatenate((np.flatnonzero(joins), np.flatnonzero(~joins)))
        own = np.empty(len(new), np.int64)
        own[order] = np.arange(len(self.known), len(self.known) + len(new))
        places[is_new.to_numpy(zero_copy_only=False)] = own
        new, together, parts = new.take(pa.array(order)), int(joins.sum()), []
        for at in range(0, together, CODED):
            parts.append(self._joined(new.slice(at, min(CODED, together - at))))
        for at in range(together, len(new), CODED):
            parts.append(self._apart(new.slice(at, CODED).to_pylist()))
        self.ids = np.concatenate([self.ids, *(ids for ids, _ in parts)])
        self.lengths = np.concatenate([self.lengths, *(lengths for _, lengths in parts)])
        self.known = pa.concat_arrays([self.known, new])
        return places

    def encode(self, rows: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is the empty text."""
        column = rows if isinstance(rows, pa.Array) else pa.array(rows, pa.string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if not self.by_stretch:
            return [self._whole(t) for t in column.to_pylist()]
        data, bounds = _bytes(column)
        if not len(data):
            return [np.zeros(0, "<u4") for _ in range(len(column))]
        begins = _stretches(data, bounds[:-1][np.diff(bounds) > 0])
        edges = pa.py_buffer(np.append(begins, bounds[-1]))
        stretches = pa.LargeStringArray.from_buffers(len(begins), edges, pa.py_buffer(data)).dictionary_encode()
        places = self._places(stretches.dictionary).take(stretches.indices.to_numpy())
        # Each id from where in the memory its stretch's ids begin.
        own = self.lengths.take(places)
        ends = np.cumsum(own)
        shift = (np.cumsum(self.lengths) - self.lengths).take(places) - (ends - own)
        ids = self.ids.take(np.repeat(shift, own) + np.arange(ends[-1]))
        edges = np.concatenate(([0], ends)).take(np.searchsorted(begins, bounds))
        out = [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for special in self.special:
            for row in np.flatnonzero(pc.match_substring(column, special).to_numpy(zero_copy_only=False)).tolist():
                out[row] = self._whole(column[row].as_py())
        return out


def tokens_of(path: str) -> Tokens:
    """One per Python worker and vocabulary."""
    kept = sys.modules.setdefault("_tripwright_tokens", {})
    if path not in kept:
        kept[path] = Tokens(path)
    return kept[path]


_SEGMENTS = pa.schema(
    [("shard", pa.int64()), ("segment", pa.int64()), ("n_tokens", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]
)
SEGMENTS_DDL = "shard long, segment long, n_tokens long, doc_ids array<long>, lengths array<long>, data binary"


def _pack(path: str, end: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        shard, number = None, 0
        ids: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            row = [shard, number, len(flat), list(doc_ids), [len(x) for x in ids], encode(flat)]
            return pa.RecordBatch.from_pydict({c: [v] for c, v in zip(_SEGMENTS.names, row)}, schema=_SEGMENTS)

        tail = np.array([end], "<u4")
        for piece in pieces(batches, CUT_ROWS, CUT_BYTES):
            coded = tokens.encode(piece.column("text"))
            for own_shard, doc_id, own in zip(piece.column("shard").to_pylist(), piece.column("doc_id").to_pylist(), coded):
                if ids and (own_shard != shard or held >= segment_ids):
                    yield close()
                    number = number + 1 if own_shard == shard else 0
                    ids, doc_ids, held = [], [], 0
                if own_shard != shard:
                    shard, number = own_shard, 0
                ids.append(np.concatenate((own, tail)))
                doc_ids.append(doc_id)
                held += len(own) + 1
        tokens.forget()
        if ids:
            yield close()

    return run


def encode_documents(
    docs: DataFrame, path: str | None = None, order: str = "doc_id", end: int = END, segment_ids: int = SEGMENT
) -> DataFrame:
    """Segments (shard, segment, n_tokens, doc_ids, lengths, data) of ``docs`` (doc_id, text).

    Rows go in ascending ``order`` (a whole number; null first, ties by id and text) through
    shards and segments. Each text is encoded whole with the tokenizer in the file ``path``
    and closed by the id ``end``; null and empty texts are that id alone. The texts move once.
    An empty table gives no segments. Other columns are ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(order).cast("long").alias("place"),
    )
    ranged = dealt(rows, "place", "shard", partitions(docs.sparkSession))
    sorted_rows = ranged.sortWithinPartitions("shard", "place", "doc_id", "text")
    return sorted_rows.select("shard", "doc_id", "text").mapInArrow(_pack(path, end, segment_ids), SEGMENTS_DDL)


_DECODED = pa.schema(
    [("shard", pa.int64()), ("segment", pa.int64()), ("doc_id", pa.int64()), ("inner", pa.int64()),
     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, 1):
        shard, number, _, doc_ids, lengths, data = (piece.column(c).to_pylist()[0] for c in _SEGMENTS.names)
        ids = decode(data).astype("<u4")
        ends = np.cumsum(np.array(lengths, np.int64))
        if int(ends[-1]) != len(ids):
            raise ValueError(f"segment {shard}/{number} holds {len(ids)} ids, not {ends[-1]}")
        starts = ends - lengths
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)]
        n = len(doc_ids)
        columns = [[shard] * n, [number] * n, doc_ids, starts, lengths, sums]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DECODED.types)], schema=_DECODED)


def describe(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded segments.

    Only counts of segments and shards are summed up in order, in two steps; ids stay where
    they were decoded.
    """
    sizes = segments.select("shard", "segment", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "segment", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("ahead"))
    begins = sizes.join(shards, "shard").select("shard", "segment", (F.col("base") + F.col("ahead")).alias("begin"))
    rows = segments.mapInArrow(
        _unpack, "shard long, segment long, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return rows.join(begins, ["shard", "segment"]).select(
        "doc_id", (F.col("begin") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_as_filed(docs: DataFrame) -> DataFrame:
    """Segments of ``docs`` in the order in which its files hold the rows.

    Files are in the order of their part numbers. Rows that come from no file go by doc_id.
    """
    rows = docs.select("doc_id", "text")
    try:
        part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
        filed = docs.select("doc_id", "text", (part * F.lit(1 << 36) + F.col("_metadata.row_index")).alias("place"))
    except AnalysisException:
        filed = rows.withColumn("place", F.col("doc_id").cast("long"))
    return encode_documents(filed, order="place")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS_DDL).parquet(path)
