import random
import struct

import pytest
from tokenizers import Tokenizer

from acreage.llm import bpe
from acreage.llm.queries import vocabulary_path

PATH = vocabulary_path()
RANDOM = random.Random(5)
POOLS = [
    "abcdefghijklmnopqrstuvwxyz ",
    "the and ing tion er re on at en ",
    "it's we'll they'd 'tis ''s ",
    "àéîõüßñçœ ÀÉÎÕÜÑÇ",
    "0123456789 ²³½ ٣ ",
    "!?.,;:--__()[]{} \t\n\x0b\x0c\r\x1c\x85\xa0 ​",
    "ΑΣΣς Σ ΌΣ. Жжя 日本語 한국어 🙂👍🏽‍",
    "éäñ ",
]
ODD = [
    None, "", " ", "\n\n", "a", "A" * 5000, "word " * 3000, "<|endoftext|>", "x<|startoftext|>y <|endoftext|>", "<|endoftext",
    "'s", "'", "a's", "''s", "'s's", "'rest'll'd've", "x'", "1's2't", "é's", "’s it’s — “don't” …", "'l", "'r e", "'re", "d'être l'été",
    "1234567890" * 50, "'" * 40, "don't", "DON'T", "﻿", "İstanbul",
]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_ids_and_decoded_text_are_the_librarys(spark, make_docs, reference):
    texts = ODD + [
        "".join(RANDOM.choice(RANDOM.choice(POOLS)) for _ in range(RANDOM.choice([3, 10, 60]))) for _ in range(400)
    ]
    for row in bpe.encode(make_docs(texts), PATH, decoded=True).collect():
        want = reference.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert ids_of(bytes(row.ids)) == want, repr(texts[row.doc_id])
        assert row.decoded == reference.decode(want, skip_special_tokens=False)


def test_neighbouring_texts_do_not_touch(reference):
    """A text may end in an apostrophe and the next begin with what would make a contraction."""
    own = bpe.WordBPE(PATH)
    for texts in (["it'", "s", "'", "re", "l", "l", "'v", "e"], ["é'", "s", "’", "s'", "ll", "é"], ["1", "2", "", "a", "b"]):
        assert [ids_of(i) for i in own.encode(texts)] == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_decode_is_an_operator_of_its_own(make_docs, reference):
    encoded = bpe.encode(make_docs(["some words", None]), PATH)
    found = {r.doc_id: r.decoded for r in bpe.decode(encoded, PATH).collect()}
    assert found == {0: reference.decode(reference.encode("some words", add_special_tokens=False).ids), 1: ""}


def test_long_texts_are_cut_at_white_space_and_words_forgotten(monkeypatch, reference):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 10)
    own = bpe.WordBPE(PATH)
    texts = [" ".join(RANDOM.choice(["lorem", "été", "it's", "42"]) for _ in range(200)), "x" * 300, "y z"] * 3
    for text, ids in zip(texts, own.encode(texts)):
        assert ids_of(ids) == reference.encode(text, add_special_tokens=False).ids


def test_columns_of_any_name_and_empty_tables(spark, make_docs):
    docs = spark.createDataFrame([(1, "a b", 7)], "doc_id long, text string, ids long")
    assert bpe.encode(docs, PATH).collect()[0].doc_id == 1
    assert bpe.encode(make_docs([]), PATH, decoded=True).count() == 0
