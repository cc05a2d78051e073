"""Terms of texts, found over UTF-8 bytes a bounded stretch at a time."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from tripwright.llm.words import LOWER, hashes, mix, per_row, spans, text_bytes

#: Bytes of a text that are split at a time; a stretch ends where no term does.
STRETCH = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: After lower-casing A-Z: digits, letters and anything beyond ASCII; or the same without digits.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
LETTERS = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = {WORDS: re.compile(rb"[^0-9a-z\x80-\xff]"), LETTERS: re.compile(rb"[^a-z\x80-\xff]")}


def stretches(text: str | None, kind: re.Pattern, size: int = STRETCH) -> Iterator[list[bytes]]:
    """The terms of a whole text, in order, as lists of those in about ``size`` bytes each.

    Only A-Z are lower-cased. A null text has no terms; a term of any length stays whole.
    """
    raw = text.encode("utf-8", "surrogatepass").translate(_LOWER) if text else b""
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > size:
            gap = _BREAK[kind].search(raw, at + size)
            end = gap.start() if gap else end
        yield kind.findall(raw, at, end)
        at = end


IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """What tells terms apart: their first and last eight bytes and length, and a hash if longer."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    n = ends - starts
    first = eight[starts] & _FIRST_BYTES[np.minimum(n, 8)]
    last = np.where(n > 8, eight[np.maximum(ends - 8, 0)], np.uint64(0))
    inner = np.zeros(len(n), np.uint64)
    long = np.flatnonzero(n > 16)
    inner[long] = hashes(raw, starts[long], ends[long])
    return [first, last, inner, n.astype(np.uint64)]


def term_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    first, last, inner, n = _codes(raw, starts, ends)
    return mix(first ^ mix(last ^ mix(inner + n)))


#: Marks a prefix of a longer term; no term holds it.
MORE = b"+"


def letter_terms(
    column: pa.Array, longer_than: int = 0, cut: int | None = None, passing: Callable | None = None
) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """The terms of many texts at once: distinct terms, and per occurrence its term and its row.

    Terms are those of ``stretches`` with LETTERS; only those of more than ``longer_than``
    bytes are given. With ``cut`` a longer term is its first ``cut`` bytes and MORE. ``passing``
    (bytes, starts, ends) may say which terms are of interest; others may be left out. Texts of
    up to STRETCH bytes come first, together, as arrays; longer ones follow a stretch at a time.
    """
    raw, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    large = np.flatnonzero(sizes > STRETCH)
    if len(large):
        rows = np.flatnonzero(sizes <= STRETCH)
        for terms, which, row in letter_terms(column.take(pa.array(rows)), longer_than, cut, passing):
            yield terms, which, rows[row]
        for k in large.tolist():
            for own in stretches(column[k].as_py(), LETTERS):
                number: dict[bytes, int] = {}
                shown = [t if cut is None or len(t) <= cut else t[:cut] + MORE for t in own if len(t) > longer_than]
                which = np.array([number.setdefault(t, len(number)) for t in shown], np.int64)
                yield list(number), which, np.full(len(which), k)
        return
    raw = LOWER[raw]
    starts, ends = spans(raw, offsets, IS_LETTER)
    row = np.repeat(np.arange(len(sizes)), per_row(starts, offsets))
    if longer_than:
        wanted = ends - starts > longer_than
        starts, ends, row = starts[wanted], ends[wanted], row[wanted]
    if passing is not None:
        wanted = np.flatnonzero(passing(raw, starts, ends))
        starts, ends, row = starts[wanted], ends[wanted], row[wanted]
    more = np.zeros(len(starts), np.uint64)
    if cut is not None:
        more = (ends - starts > cut).astype(np.uint64)
        ends = np.minimum(ends, starts + cut)
    codes = [*_codes(raw, starts, ends), more]
    first, last, inner, n, _ = codes
    key = mix(first ^ mix(last ^ mix(inner + n))) ^ more
    _, at, which = np.unique(key, return_index=True, return_inverse=True)
    if any((c != c[at][which]).any() for c in codes):  # two terms with one key: number them by all that tells them apart
        at, which = np.unique(np.stack(codes), axis=1, return_index=True, return_inverse=True)[1:]
    data = raw.tobytes()
    marks = [b"", MORE]
    distinct = [data[a:b] + marks[m] for a, b, m in zip(starts[at].tolist(), ends[at].tolist(), more[at].tolist())]
    yield distinct, which, row


#: Bytes of a prefix that a code holds as they are: six, then whether the term goes on.
SHORT = 6
_GOES_ON = 1 << 8 * SHORT


def short_prefixes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The first SHORT bytes of all terms of many texts, as codes, each once for a text: codes
    and their numbers of texts."""
    raw, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    large = np.flatnonzero(sizes > STRETCH)
    if len(large):
        yield from short_prefixes(column.take(pa.array(np.flatnonzero(sizes <= STRETCH))))
        for k in large.tolist():
            seen: set[int] = set()
            for own in stretches(column[k].as_py(), LETTERS):
                seen.update(int.from_bytes(t[:SHORT], "little") | (_GOES_ON if len(t) > SHORT else 0) for t in own)
            yield np.array(sorted(seen), np.int64), np.ones(len(seen), np.int64)
        return
    raw = LOWER[raw]
    starts, ends = spans(raw, offsets, IS_LETTER)
    row = np.repeat(np.arange(len(sizes)), per_row(starts, offsets))
    eight = np.ndarray((len(raw) + 1,), "<u8", np.concatenate((raw, np.zeros(8, np.uint8))).data, strides=(1,))
    n = ends - starts
    codes = (eight[starts] & _FIRST_BYTES[np.minimum(n, SHORT)]).astype(np.int64) | np.where(n > SHORT, _GOES_ON, 0)
    # Rows of a piece are few: row and code are one number.
    once = np.unique((row << (8 * SHORT + 1)) | codes) & (2 * _GOES_ON - 1)
    yield np.unique(once, return_counts=True)


def spelled(codes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The prefixes behind codes, and whether their terms go on."""
    raw = (codes & (_GOES_ON - 1)).astype("<u8").tobytes()
    return [raw[k : k + 8].rstrip(b"\0") for k in range(0, len(raw), 8)], codes >= _GOES_ON
