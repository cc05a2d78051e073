"""Token ids as bytes: an adaptive range coder driven by mixed predictions of order 0 to 2.

A segment holds a header and independent blocks. The header lists the segment's ids, most
frequent first; inside, an id is its rank in that list. Every block starts from a fresh model
and carries its own checksum, so one can be decoded without the others and damage is found.
A block is cut into lanes with a stream of bytes each. All lanes are coded in step, one id of
each at a time, and learn in one model, so the work is a fixed number of array operations per
step and what one lane has seen helps all.

The model of a block, before each id:

- order 2: the id that last followed the two ids before, and how often that was right;
- order 1: the same after the one id before, and counts of symbols after it;
- order 0: counts of symbols in the block so far.

An id is coded as a symbol: "as order 2 says", "as order 1 says", or the bit length of its
rank + 1, followed by the remaining bits as they are. Counts of symbols are kept by the id
before and by how far orders 1 and 2 can be trusted; a symbol's frequency mixes the counts of
its own context with those by the id before alone, by trust alone, and of order 0. The model
learns from every id; it does so in rounds of one step at first and ``ROUND`` later.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"TWID"
VERSION = 2
#: Ids of one block, ids of one of its lanes at least, and steps from one learning to the next.
BLOCK = 1 << 21
LANE = 1024
ROUND = 32
_HEAD = "<4sIQIII"
_TOP = np.uint64(1 << 63)
_LOW = np.uint64((1 << 31) - 1)
_MIN = np.uint64(1 << 31)
_WORD = np.uint64(32)
#: Ids before with counts of their own; the others share by bit length.
_OWN = 40
#: Weight of a context's own counts, share of each of the others, and counts that are halved.
_COUNTED, _SHARE, _LIMIT = 32, 512, 1 << 15
_SLOTS2 = 1 << 17
#: Bits of a frequency, and ids that may differ: a step takes 31 bits from the range at most.
_PRECISION, _ALPHABET = 14, (1 << 23) - 1


def _rounds(steps: int) -> Iterator[tuple[int, int]]:
    """Begins and ends of rounds of 1, 1, 2, 2, 4, 4 ... steps."""
    at, size, again = 0, 1, False
    while at < steps:
        yield at, min(steps, at + size)
        at += size
        if again:
            size = min(ROUND, 2 * size)
        again = not again


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts * _SHARE // np.maximum(counts.sum(-1, keepdims=True), 1)


class _Model:
    """Predictions and counts of one block; whole numbers only, so that every machine agrees."""

    def __init__(self, ids: int, alphabet: int):
        classes = max(1, alphabet.bit_length())
        self.symbols = 2 + classes
        self.precision = min(_PRECISION, 31 - classes)
        top = np.arange(1, max(2, alphabet + 1))
        self.width = np.frexp(top)[1].astype(np.int64) - 1
        self.context1 = np.where(top <= _OWN, top - 1, _OWN + self.width) * 16
        self.counts = np.zeros((_OWN + classes, 16, self.symbols), np.int64)
        self.bits2 = min(_SLOTS2.bit_length() - 1, max(4, ids.bit_length()))
        # A slot holds a rank and in its lowest two bits how far to trust it.
        self.guess2 = np.full(1 << self.bits2, -4, np.int32)
        self.guess1 = np.full(len(top), -4, np.int32)
        self.refresh()

    def slot2(self, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        mixed = before * 2654435761 + earlier * 2246822519
        mixed &= 0xFFFFFFFF
        mixed >>= 32 - self.bits2
        return mixed

    def contexts(self, before: np.ndarray, says2: np.ndarray, says1: np.ndarray) -> np.ndarray:
        """Where the counts of each lane's context begin."""
        at = self.context1.take(before)
        at += (says2 & 3) << 2
        at += says1 & 3
        return at

    def refresh(self) -> None:
        """Frequencies of the symbols in each context, and their running sums, from the counts."""
        counts = self.counts
        mixed = counts * _COUNTED + 1
        mixed += _shares(counts.sum(1))[:, None]
        mixed += _shares(counts.sum(0)) + _shares(counts.sum((0, 1)))
        mixed *= (1 << self.precision) - self.symbols
        mixed //= (mixed.sum(-1, keepdims=True) // ((1 << self.precision) - self.symbols)) + 1
        mixed += 1
        ends = mixed.cumsum(-1)
        self.frequency = mixed.reshape(-1).astype(np.uint64)
        self.begin = (ends - mixed).reshape(-1).astype(np.uint64)
        self.ends = np.full((len(self.frequency) // self.symbols, max(16, -(-self.symbols // 8) * 8)), 0xFFFF, np.uint16)
        self.ends[:, : self.symbols - 1] = ends.reshape(-1, self.symbols)[:, :-1]

    def learn(
        self, coded: np.ndarray, rank: np.ndarray, slot2: np.ndarray, says2: np.ndarray, before: np.ndarray, says1: np.ndarray
    ) -> None:
        for guess, at, says in ((self.guess2, slot2, says2), (self.guess1, before, says1)):
            trust = says & 3
            new = np.where(trust > 0, says - trust + (trust >> 1), rank << 2)
            guess[at] = np.where(says >> 2 == rank, says + (trust < 3), new)
        self.counts += np.bincount(coded, minlength=self.counts.size).reshape(self.counts.shape)
        full = self.counts.sum(-1) > _LIMIT
        if full.any():
            self.counts[full] >>= 1
        self.refresh()


def _lanes(ids: int) -> tuple[int, int]:
    """Lanes of a block and the steps they take."""
    lanes = max(1, ids // LANE)
    return lanes, -(-ids // lanes)


def _encode_block(ranks: np.ndarray, alphabet: int) -> bytes:
    lanes, steps = _lanes(len(ranks))
    padded = np.zeros(lanes * steps, np.int64)
    padded[: len(ranks)] = ranks
    # Two steps ahead of the first stand for what came before.
    rows = np.zeros((steps + 2, lanes), np.int64)
    rows[2:] = padded.reshape(lanes, steps).T
    model = _Model(len(ranks), alphabet)
    precision = np.uint64(model.precision)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, _TOP)
    row = np.arange(lanes) * (steps + 4)
    out = np.zeros(lanes * (steps + 4), np.int64)
    filled = row.copy()
    for begin, end in _rounds(steps):
        rank, before = rows[begin + 2 : end + 2].reshape(-1), rows[begin + 1 : end + 1].reshape(-1)
        slot2 = model.slot2(before, rows[begin:end].reshape(-1))
        says2, says1 = model.guess2.take(slot2), model.guess1.take(before)
        width = model.width.take(rank)
        symbol = np.where(says1 >> 2 == rank, 1, width + 2)
        symbol[says2 >> 2 == rank] = 0
        coded = model.contexts(before, says2, says1) * model.symbols + symbol
        width[symbol < 2] = 0
        bits = width.astype(np.uint64)
        rest = (rank + 1 & ((1 << width) - 1)).astype(np.uint64)
        first, own = model.begin.take(coded), model.frequency.take(coded)
        shape = (end - begin, lanes)
        for a, b, c, d in zip(first.reshape(shape), own.reshape(shape), bits.reshape(shape), rest.reshape(shape)):
            span >>= precision
            a *= span
            low += a
            span *= b
            span >>= c
            d *= span
            low += d
            over = (low >= _TOP).nonzero()[0]
            if len(over):
                out[filled[over] - 1] += 1
                low[over] -= _TOP
            short = (span < _MIN).nonzero()[0]
            if len(short):
                at, own_low = filled[short], low[short]
                out[at] = own_low >> np.uint64(31)
                filled[short] = at + 1
                own_low &= _LOW
                own_low <<= _WORD
                low[short] = own_low
                span[short] <<= _WORD
        model.learn(coded, rank, slot2, says2, before, says1)
    out[filled] = low >> np.uint64(31)
    out[filled + 1] = (low & _LOW) << np.uint64(1)
    out = out.reshape(lanes, -1)
    for k in range(out.shape[1] - 1, 0, -1):
        out[:, k - 1] += out[:, k] >> 32
        out[:, k] &= 0xFFFFFFFF
    sizes = filled - row + 2
    return sizes.astype("<u4").tobytes() + out[np.arange(out.shape[1]) < sizes[:, None]].astype("<u4").tobytes()


def _decode_block(block: bytes, ids: int, alphabet: int) -> np.ndarray:
    lanes, steps = _lanes(ids)
    sizes = np.frombuffer(block, "<u4", lanes).astype(np.int64)
    # Streams of the lanes one after another, three words of nothing after each.
    words = np.zeros(int(sizes.sum()) + 3 * lanes, np.uint64)
    row = np.concatenate(([0], np.cumsum(sizes + 3)[:-1]))
    words[np.arange(int(sizes.sum())) + np.repeat(np.arange(lanes) * 3, sizes)] = np.frombuffer(block, "<u4", offset=4 * lanes)
    code = (words[row] << np.uint64(31)) | (words[row + 1] >> np.uint64(1))
    # What comes after the first 63 bits, 32 at a time.
    coming = ((words[:-1] & np.uint64(1)) << np.uint64(31)) | (words[1:] >> np.uint64(1))
    used = row + 1
    model = _Model(ids, alphabet)
    precision = np.uint64(model.precision)
    bits_of = np.concatenate(([0, 0], np.arange(model.symbols - 2))).astype(np.uint64)
    least_of = (np.uint64(1) << bits_of) - np.uint64(1)
    span = np.full(lanes, _TOP)
    rows = np.zeros((steps + 2, lanes), np.int64)
    kept = [np.empty((ROUND, lanes), t) for t in (np.int64, np.int64, np.int32, np.int32)]
    coded_rows, slot_rows, rows2, rows1 = kept
    for begin, end in _rounds(steps):
        for k in range(end - begin):
            before = rows[begin + k + 1]
            slot2 = model.slot2(before, rows[begin + k])
            says2, says1 = model.guess2.take(slot2), model.guess1.take(before)
            context = model.contexts(before, says2, says1)
            span >>= precision
            value = (code // span).astype(np.uint16)
            # Bytes of 0 and 1, eight to a number; their sum is in the highest byte of the product.
            parts = (model.ends.take(context, 0) <= value[:, None]).view(np.uint64)
            below = parts[:, 0] + parts[:, 1]
            for more in range(2, parts.shape[1]):
                below += parts[:, more]
            below *= np.uint64(0x0101010101010101)
            below >>= np.uint64(56)
            symbol = below.view(np.int64)
            coded = context * model.symbols
            coded += symbol
            code -= span * model.begin.take(coded)
            span *= model.frequency.take(coded)
            span >>= bits_of.take(symbol)
            rest = code // span
            code -= span * rest
            rest += least_of.take(symbol)
            rank = rest.view(np.int64)
            told = (symbol < 2).nonzero()[0]
            rank[told] = np.where(symbol[told] == 0, says2[told], says1[told]) >> 2
            short = (span < _MIN).nonzero()[0]
            if len(short):
                at = used[short]
                code[short] = (code[short] << _WORD) | coming.take(at)
                used[short] = at + 1
                span[short] <<= _WORD
            rows[begin + k + 2] = rank
            coded_rows[k], slot_rows[k], rows2[k], rows1[k] = coded, slot2, says2, says1
        coded, slot2, says2, says1 = (x[: end - begin].reshape(-1) for x in kept)
        model.learn(
            coded, rows[begin + 2 : end + 2].reshape(-1), slot2, says2, rows[begin + 1 : end + 1].reshape(-1), says1
        )
    return rows[2:].T.reshape(-1)[:ids]


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, most frequent first, smaller before larger, and the place there of each id."""
    if len(ids) and int(ids.max()) < len(ids) + (1 << 16):
        table = np.bincount(ids)
        known = np.flatnonzero(table)
        known = known[np.lexsort((known, -table[known]))]
        table[known] = np.arange(len(known))
        return known, table.take(ids)
    known, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((known, -counts))
    places = np.empty(len(known), np.int64)
    places[order] = np.arange(len(known))
    return known[order], places[inverse.reshape(-1)]


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One segment of any number of ids (0 to 2 ** 32 - 1; 8 million different ones at most)."""
    ids = np.asarray(ids, np.uint32)
    known, ranks = _ranked(ids)
    if len(known) > _ALPHABET:
        raise ValueError(f"{len(known)} different ids in a segment, more than {_ALPHABET}")
    blocks = -(-len(ids) // block)
    steps = -(-len(ids) // blocks) if blocks else 0
    coded = [_encode_block(ranks[k * steps : (k + 1) * steps], len(known)) for k in range(blocks)]
    head = struct.pack(_HEAD, MAGIC, VERSION, len(ids), blocks, steps, len(known)) + known.astype("<u4").tobytes()
    sizes = np.array([[len(c), zlib.crc32(c)] for c in coded], "<u4").tobytes()
    return b"".join([head, sizes, struct.pack("<I", zlib.crc32(head + sizes)), *coded])


def decode(data: bytes, only: list[int] | None = None) -> np.ndarray:
    """The ids of a segment, or of some of its blocks; damaged bytes raise ValueError."""
    try:
        magic, version, n, blocks, steps, alphabet = struct.unpack_from(_HEAD, data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a segment of token ids")
        at = struct.calcsize(_HEAD) + 4 * alphabet
        end = at + 8 * blocks
        (check,) = struct.unpack_from("<I", data, end)
    except struct.error as error:
        raise ValueError("a segment is cut short") from error
    if zlib.crc32(data[:end]) != check:
        raise ValueError("a segment's header is damaged")
    ids = np.frombuffer(data, "<u4", alphabet, struct.calcsize(_HEAD))
    sizes = np.frombuffer(data, "<u4", 2 * blocks, at).reshape(-1, 2).astype(np.int64)
    begins = end + 4 + np.concatenate(([0], np.cumsum(sizes[:, 0])[:-1])) if blocks else []
    wanted = range(blocks) if only is None else only
    coded = [bytes(data[begins[k] : begins[k] + sizes[k, 0]]) for k in wanted]
    for k, own in zip(wanted, coded):
        if zlib.crc32(own) != sizes[k, 1]:
            raise ValueError(f"block {k} is damaged")
    ranks = [_decode_block(own, min(steps, n - k * steps), alphabet) for k, own in zip(wanted, coded)]
    return ids[np.concatenate(ranks)] if ranks else np.zeros(0, np.uint32)
