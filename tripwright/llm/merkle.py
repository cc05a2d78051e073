"""Fingerprints of documents as Merkle trees over sections, paragraphs and their pieces."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.ranges import apart, bounds, with_range
from tripwright.llm.tables import partitions, pieces, texts

#: A piece is a sentence, or some two dozen characters of one to the end of a word.
_PIECE = re.compile(r"[^.!?]{1,24}[^\s.!?]*[.!?]*\s*|[.!?]+\s*")
#: One paragraph in so many, chosen by its hash, ends a section; so does an empty line.
SECTION = 8


@dataclass(frozen=True)
class Tree:
    """root, and per section its hash and paragraphs, each a hash and its pieces' hashes."""

    root: str
    sections: tuple[tuple[str, tuple[tuple[str, tuple[str, ...]], ...]], ...]
    size: int

    def text(self) -> str:
        """The fingerprint: ``root/section.paragraph,piece,piece.paragraph.../section...``"""
        return "/".join(
            [self.root]
            + [".".join([name] + [",".join((p, *own)) for p, own in paragraphs]) for name, paragraphs in self.sections]
        )

    def paragraphs(self) -> list[tuple[str, tuple[str, ...]]]:
        return [p for _, own in self.sections for p in own]


def tree(text: str) -> Tree:
    """The tree of a text. A parent hashes its children's hashes; equal texts, equal trees."""
    sha = hashlib.sha256
    sections, tops, size = [], [], 0
    paragraphs, inner = [], []
    for paragraph in text.split("\n"):
        leaves = [sha(p.encode("utf-8", "surrogatepass")).digest() for p in _PIECE.findall(paragraph)]
        own = sha(b"p" + b"".join(leaves)).digest()
        paragraphs.append((own[:6].hex(), tuple(leaf[:4].hex() for leaf in leaves)))
        inner.append(own)
        size += len(leaves)
        if not leaves or own[0] % SECTION == 0:
            tops.append(sha(b"s" + b"".join(inner)).digest())
            sections.append((tops[-1][:8].hex(), tuple(paragraphs)))
            paragraphs, inner = [], []
    if inner:
        tops.append(sha(b"s" + b"".join(inner)).digest())
        sections.append((tops[-1][:8].hex(), tuple(paragraphs)))
    return Tree(sha(b"d" + b"".join(tops)).hexdigest(), tuple(sections), size)


def parse(fingerprint: str) -> Tree:
    """The tree that a fingerprint writes down."""
    root, *rest = fingerprint.split("/")
    sections, size = [], 0
    for part in rest:
        name, *paragraphs = part.split(".")
        own = [tuple(p.split(",")) for p in paragraphs]
        size += sum(len(p) - 1 for p in own)
        sections.append((name, tuple((p[0], p[1:]) for p in own)))
    return Tree(root, tuple(sections), size)


def likeness(a: Tree, b: Tree) -> float:
    """Share of pieces that both trees hold, of the larger one's: 1 for equal texts.

    Equal branches are taken whole, from the root down; only what is left is compared piece
    by piece.
    """
    if a.root == b.root:
        return 1.0
    common, left, right = 0, a.paragraphs(), Counter(b.paragraphs())
    rest_a: list[tuple[str, ...]] = []
    for paragraph in left:
        if right.get(paragraph, 0):
            right[paragraph] -= 1
            common += len(paragraph[1])
        else:
            rest_a.append(paragraph[1])
    rest_b = Counter(leaf for (_, own), n in right.items() for leaf in own * n)
    for own in rest_a:
        for leaf in own:
            if rest_b.get(leaf, 0):
                rest_b[leaf] -= 1
                common += 1
    return common / max(a.size, b.size, 1)


def edits(before: str, after: str) -> list[int]:
    """Numbers of the paragraphs of ``after`` that ``before`` does not hold, from fingerprints.

    Branches whose hashes occur on both sides are not entered.
    """
    a, b = parse(before), parse(after)
    if a.root == b.root:
        return []
    sections, known = {s for s, _ in a.sections}, {p for p, _ in a.paragraphs()}
    changed, at = [], 0
    for name, paragraphs in b.sections:
        if name not in sections:
            changed += [at + k for k, (p, _) in enumerate(paragraphs) if p not in known]
        at += len(paragraphs)
    return changed


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many characters of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, next text) of rows that come in order, range by range."""
    held: tuple | None = None
    for piece in pieces(batches):
        columns = [piece.column(c).to_pylist() for c in ("part", "borrowed", "doc_id")]
        for part, borrowed, doc_id, text in zip(*columns, texts(piece.column("text"))):
            if held is not None and held[0] == part:
                yield held[1], held[2], text
            held = None if borrowed else (part, doc_id, text)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    last: tuple[str, Tree] | None = None
    for doc_id, text, following in _pairs(batches):
        own = last[1] if last is not None and last[0] == text else tree(text)
        after = tree(following)
        last = following, after
        changed = edited(text, following)
        other = tree(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        rows.append((doc_id, len(text), sha, own.text(), other.text(), likeness(own, other), likeness(own, after)))
        size += len(text)
        if size > 1 << 21:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of edited texts, and how like they are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    The edited text ends in the beginning of the next document by descending id; after the
    last comes the first. Rows with equal ids are ordered by text, rows without id come last,
    by the hash of their text. A null text is empty; a lone document is its own next.

    Rows are dealt out by ranges of ids, so the texts move once. The first row of each range
    also goes to the range before it, whose last row it follows.
    """
    parts = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    inner = bounds(rows, "doc_id", parts)
    place = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.col("doc_id"))
    named = with_range(rows.filter("doc_id is not null").select("doc_id"), "doc_id", "part", inner)
    firsts = named.groupBy("part").agg(F.max("doc_id").alias("place"))
    nameless = rows.filter("doc_id is null").agg(F.max(F.xxhash64("text")).alias("place")).filter("place is not null")
    firsts = firsts.union(nameless.select(F.lit(-1).cast("long").alias("part"), "place"))
    heads = sorted((r.part, r.place) for r in firsts.collect())
    before = [(part, place_, heads[(k + 1) % len(heads)][0]) for k, (part, place_) in enumerate(heads)]
    lent = docs.sparkSession.createDataFrame(before, "part long, place long, lent_to long")
    ranged = with_range(rows, "doc_id", "part", inner).withColumn("place", place)
    ranged = ranged.join(F.broadcast(lent), ["part", "place"], "left")
    one = F.array(F.struct(F.col("part"), F.lit(False).alias("borrowed")))
    two = F.array(
        F.struct(F.col("part"), F.lit(False).alias("borrowed")),
        F.struct(F.col("lent_to").alias("part"), F.lit(True).alias("borrowed")),
    )
    copies = ranged.select(
        "doc_id", "text", "place", F.explode(F.when(F.col("lent_to").isNull(), one).otherwise(two)).alias("at")
    ).select("doc_id", "text", "place", "at.part", "at.borrowed")
    ordered = apart(copies, "part", parts).sortWithinPartitions("part", "borrowed", F.desc("place"), "text")
    return ordered.select("part", "borrowed", "doc_id", "text").mapInArrow(
        _fingerprints,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
