from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tests.llm.conftest import by_id
from tripwright.llm import rangecoder
from tripwright.llm.tokenids import Tokens, describe, encode_documents


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 5), max_size=400), st.sampled_from([1, 7, 64, 4096]))
def test_every_list_of_ids_comes_back(ids, block):
    assert rangecoder.decode(rangecoder.encode(np.array(ids, np.uint64), block)).tolist() == ids


def test_many_ids_come_back_and_repetition_is_short():
    ids = np.tile(np.arange(50), 2000)
    data = rangecoder.encode(ids)
    assert (rangecoder.decode(data) == ids).all()
    assert len(data) < len(ids) / 20


def test_one_block_is_decoded_alone_and_damage_is_found():
    ids = np.random.default_rng(5).integers(0, 900, 1000)
    data = bytearray(rangecoder.encode(ids, 250))
    assert (rangecoder.decode(bytes(data), [2]) == ids[500:750]).all()
    data[-1] ^= 1
    assert (rangecoder.decode(bytes(data), [0]) == ids[:250]).all()
    with pytest.raises(ValueError, match="block 3"):
        rangecoder.decode(bytes(data))
    data[9] ^= 1
    with pytest.raises(ValueError, match="header"):
        rangecoder.decode(bytes(data))
    with pytest.raises(ValueError):
        rangecoder.decode(bytes(data[:10]))


def test_what_one_part_of_a_block_has_seen_shortens_the_others():
    ids = np.tile(np.random.default_rng(6).integers(0, 3000, 5000), 24)
    data = rangecoder.encode(ids)
    assert (rangecoder.decode(data) == ids).all()
    assert len(data) < len(ids) * 0.75


def test_many_different_ids_come_back():
    ids = np.random.default_rng(7).permutation(np.repeat(np.arange(200_000), 2)) * 20_000 + 5
    assert (rangecoder.decode(rangecoder.encode(ids)) == ids).all()


class Counted:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.n = tokenizer, 0

    def encode(self, text, **options):
        self.n += len(text)
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.n += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_a_word_is_tokenized_once_whatever_mark_follows_it():
    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"It is extraordinarily{mark} extraordinarily{mark}\nso\t \n" for mark in ",.;:!?)1"]
    whole = [w.ids for w in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    tokens.tokenizer = Counted(tokens.tokenizer)
    assert [x.tolist() for x in tokens.encode(texts)] == whole
    assert tokens.tokenizer.n < 60


def test_stretches_hold_white_space_of_every_kind():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens, untouched = Tokens(path), Tokenizer.from_file(path)
    draw = random.Random(8)
    parts = [*" \n\t\r\x0b\x0c\x1c\x00\x7f\x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b", " ", " ", "a", "Wo", "é", "дом", "中", "😀"]
    parts += ["\u0301", "'s", "don't", "1", ",", "-", "’", "\u0fff", "\u4000", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(6000)]
    assert [x.tolist() for x in tokens.encode(texts)] == [untouched.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_tokenizer_with_another_rule_gets_whole_texts(tmp_path):
    vocabulary = {c: i for i, c in enumerate("ab .")} | {"a ": 4, "a b": 5}
    other = Tokenizer(BPE(vocabulary, [("a", " "), ("a ", "b")]))
    path = str(tmp_path / "other.json")
    other.save(path)
    texts = ["a b.a b", "b a", "", ". a b"]
    assert [x.tolist() for x in Tokens(path).encode(texts)] == [other.encode(t).ids for t in texts]


def test_stretches_give_the_same_ids_as_whole_texts():
    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(3)
    parts = [" ", " ", "a", "word", "\n", "\t", "é", "'s", "!", "1", "\x1c", "  ", " ", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(3000)]
    whole = tokens.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in tokens.encode(texts)] == [w.ids for w in whole]


def test_ids_are_those_of_the_untouched_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens, untouched = Tokens(path), Tokenizer.from_file(path)
    draw = random.Random(4)
    parts = [" ", "a", "word", "\n", "!", "<|endoftext|>", "<|endof", "text|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "\n <|endoftext|> \n", "<|endoftext|>"]
    assert [x.tolist() for x in tokens.encode(texts)] == [untouched.encode(t, add_special_tokens=False).ids for t in texts]


def test_segments_describe_every_document(make_docs):
    texts = {5: "one two", 3: None, 9: "", 7: "x" * 5000, 8: "one two"}
    docs = make_docs([*texts.items()], extra={"shard": 1, "place": "x"})
    found = by_id(describe(encode_documents(docs, segment_ids=40)), "start", "n_tokens", "ids_crc32")
    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for doc_id in sorted(texts):
        ids = np.append(tokens.encode([texts[doc_id] or ""])[0], 0).astype("<u4")
        assert found[doc_id] == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_repeated_and_nameless_rows_and_no_rows(make_docs):
    docs = make_docs([(None, "a"), (None, None), (1, "a"), (1, "a")])
    rows = describe(encode_documents(docs)).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 2), (False, 2), (True, 1), (True, 2)]
    assert describe(encode_documents(make_docs([]))).count() == 0
