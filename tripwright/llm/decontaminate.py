"""Finding benchmark passages in documents with one Aho-Corasick automaton."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.tables import per_batch, pieces, texts, written

WINDOW = 10
#: Words of the items that one automaton takes: it stands in every Python worker and has a node
#: for each word of each window at most. A longer benchmark is scanned for in groups.
GROUP_WORDS = 200_000
#: Words are runs of ASCII letters, digits and anything beyond ASCII.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_OTHER = "\x00"


def normal_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


class Windows:
    """All windows of all items, as one automaton whose letters are words.

    Every word of the benchmark is one character, any other word another, so that a document
    is scanned once, word by word, and a match ends at a word's number.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.letters: dict[bytes, str] = {}
        owners: dict[str, list[int]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        for name, text in items:
            coded = "".join(self._letter(w) for w in normal_words(text))
            for at in range(max(1, len(coded) - window + 1) if coded else 0):
                own = owners.setdefault(coded[at : at + window], [])
                if number[name] not in own:
                    own.append(number[name])
        self.automaton = ahocorasick.Automaton()
        for coded, own in owners.items():
            self.automaton.add_word(coded, (len(coded), own))
        self.any = bool(owners)
        if self.any:
            self.automaton.make_automaton()

    def _letter(self, word: bytes) -> str:
        letter = self.letters.get(word)
        if letter is None:
            code = len(self.letters) + 1
            letter = self.letters[word] = chr(code if code < 0xD800 else code + 0x800)
        return letter

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Word spans [first, end) under any window, merged, and the items they belong to."""
        spans: list[list[int]] = []
        found: set[int] = set()
        if self.any:
            get = self.letters.get
            coded = "".join([get(w, _OTHER) for w in words])
            for last, (size, own) in self.automaton.iter(coded):
                found.update(own)
                first = last + 1 - size
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = last + 1
                else:
                    spans.append([first, last + 1])
        return spans, found


def original(text: str, spans: list[list[int]]) -> list[list[int]]:
    """The same spans as character offsets into the text as it was."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [[at[a][0], at[b - 1][1]] for a, b in spans]


def groups_of(items: Iterable[tuple[str, str]], window: int, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items in groups of ``limit`` words, about; an item of more is cut so that no window is lost."""
    held: list[tuple[str, str]] = []
    size = 0
    for name, text in items:
        words = normal_words(text)
        step = max(1, limit - window + 1)
        for at in range(0, max(1, len(words) - window + 1), step):
            part = words[at : at + step + window - 1]
            if held and size + len(part) > limit:
                yield held
                held, size = [], 0
            held.append((name, b" ".join(part).decode("utf-8", "surrogatepass")))
            size += len(part)
    if held:
        yield held


def _automata(benchmark: DataFrame, window: int, limit: int) -> Iterator[Callable[[], Windows]]:
    """Per group of items, what gives a task its windows: they are built once in each Python worker.

    One group at a time is on the driver and, by broadcast, in the tasks.
    """
    named = benchmark.filter("text is not null").select(F.col("item_id").cast("string").alias("name"), "text")
    items = ((r.name or "", r.text) for r in named.toLocalIterator())
    for group in groups_of(items, window, limit):
        parcel = benchmark.sparkSession.sparkContext.broadcast(group)
        yield partial(_built, uuid.uuid4().hex, parcel, window)


def _built(name: str, parcel: Broadcast, window: int) -> Windows:
    kept = sys.modules.setdefault("_tripwright_windows", {})
    if name not in kept:
        kept.clear()
        kept[name] = Windows(parcel.value, window)
    return kept[name]


def merged(spans: list[list[int]]) -> list[list[int]]:
    """Spans in order, those that meet or overlap as one."""
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


_MARKED = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("found", pa.list_(pa.string())), ("at", pa.list_(pa.list_(pa.int64())))]
)
_MARKED_DDL = "doc_id long, text string, found array<string>, at array<array<long>>"


def _mark(windows_of: Callable[[], Windows]):
    """Adds what the items of one group hit, in words, to what earlier groups did."""

    def make():
        windows = windows_of()

        def work(piece: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": piece.column("doc_id"), "text": piece.column("text"), "found": [], "at": []}
            before = zip(texts(piece.column("text")), piece.column("found").to_pylist(), piece.column("at").to_pylist())
            for text, names, spans in before:
                more, own = windows.scan(normal_words(text))
                out["found"].append(sorted({*names, *(windows.names[k] for k in own)}))
                out["at"].append(merged(spans + more))
            return out

        return work

    return per_batch(make, _MARKED)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
     ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.list_(pa.int64())))]
)


def _counted(marked: pa.RecordBatch) -> dict:
    out: dict = {c: [] for c in _SCHEMA.names}
    out["doc_id"], out["items"] = marked.column("doc_id"), marked.column("found")
    for text, spans in zip(texts(marked.column("text")), marked.column("at").to_pylist()):
        out["n_words"].append(len(normal_words(text)))
        out["n_hit"].append(sum(b - a for a, b in spans))
        out["spans"].append(original(text, spans))
    return out


_DDL = "doc_id long, n_words long, n_hit long, items array<string>, spans array<array<long>>"


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, group_words: int = GROUP_WORDS
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) per row of ``docs`` (doc_id, text).

    A window is ``window`` consecutive words of an item of ``benchmark`` (item_id, text), or
    all words of a shorter one. ``n_hit`` counts the document's words inside any window that
    occurs, ``items`` names the items with such windows (ascending as text), ``spans`` are the
    hit stretches as [start, end) characters of the original text.

    Null and empty texts have no words, on either side; items with equal ids are one, a null
    item id is named as an empty text. Equal documents and ids are separate rows. An empty
    benchmark hits nothing. The documents are read once and nothing is shuffled. A benchmark of
    more than ``group_words`` words is scanned for in groups, each with an automaton of its
    own; documents are written between groups, with what was found so far.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    automata = _automata(benchmark, window, group_words)
    first, second = next(automata, None), next(automata, None)
    if second is not None:
        nothing = {"found": F.array().cast("array<string>"), "at": F.array().cast("array<array<long>>")}
        marked = chosen.withColumns(nothing)
        for windows_of in chain((first, second), automata):
            marked = written(marked.mapInArrow(_mark(windows_of), _MARKED_DDL), "marked")
        return marked.mapInArrow(per_batch(lambda: _counted, _SCHEMA), _DDL)
    windows_of = first or partial(Windows, [], window)

    def make():
        windows = windows_of()

        def work(piece: pa.RecordBatch) -> dict:
            out: dict = {c: [] for c in _SCHEMA.names}
            out["doc_id"] = piece.column("doc_id")
            for text in texts(piece.column("text")):
                words = normal_words(text)
                spans, found = windows.scan(words)
                out["n_words"].append(len(words))
                out["n_hit"].append(sum(b - a for a, b in spans))
                out["items"].append([windows.names[k] for k in sorted(found)])
                out["spans"].append(original(text, spans))
            return out

        return work

    return chosen.mapInArrow(per_batch(make, _SCHEMA), _DDL)


def without_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, group_words: int = GROUP_WORDS
) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, with all their columns."""

    def keep(windows_of: Callable[[], Windows]):
        def run(batches):
            windows = windows_of()
            for piece in pieces(batches):
                clean = [not windows.scan(normal_words(t))[0] for t in texts(piece.column("text"))]
                yield piece.filter(pa.array(clean, pa.bool_()))

        return run

    for n, windows_of in enumerate(_automata(benchmark, window, group_words)):
        docs = (written(docs, "decontaminated") if n else docs).mapInArrow(keep(windows_of), docs.schema)
    return docs


DECONTAMINATE_SQL = """
with lowered as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
    from documents
), item_words as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
    from benchmark where text is not null
), windows as (
    select distinct item_id, least(10, len(words)) as size,
        array_to_string(words[pos : pos + least(10, len(words)) - 1], ' ') as phrase
    from (select item_id, words, unnest(range(1, greatest(2, len(words) - 8))) as pos from item_words where len(words) > 0)
), grams as (
    select doc_id, size, pos, array_to_string(words[pos : pos + size - 1], ' ') as phrase
    from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as pos
          from lowered, (select distinct size from windows) where len(words) >= size)
), hits as (
    select g.doc_id, g.pos, g.size, w.item_id from grams g join windows w on g.size = w.size and g.phrase = w.phrase
), hit_words as (
    select doc_id, count(distinct word) as n_hit
    from (select doc_id, unnest(range(pos, pos + size)) as word from hits) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
    from (select distinct doc_id, item_id::varchar as name from hits) group by doc_id
)
select l.doc_id, coalesce(len(l.words), 0)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
    coalesce(i.n_items, 0)::bigint as n_items, sha256(coalesce(i.names, '')) as items_sha256,
    coalesce(h.n_hit, 0) > 0 as contaminated
from lowered l left join hit_words h using (doc_id) left join items i using (doc_id)
"""
