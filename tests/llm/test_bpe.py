import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of

from carlot.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, doc_id, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return (doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_as_the_library(spark, library, table):
    docs = table(spark)
    assert rows_of(bpe.round_trip(docs, PATH)) == sorted((expected(library, *r) for r in inputs(docs)), key=repr)


def test_empty_table(spark):
    assert rows_of(bpe.round_trip(empty_docs(spark), PATH)) == []


def test_random_texts(library):
    coder = bpe.ByteBpe(bpe.read_spec(PATH), cached=50)  # a small cache starts anew often
    rng = random.Random(1)
    letters = "ab 1.'\n\t \r é日😀½<|>endoftext_՘ "
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert coder.decode(ids) == text


def test_round_trip_as_tables(spark):
    docs = edge_docs(spark)
    back = bpe.decode_ids(bpe.encode_ids(docs, PATH), PATH)
    assert rows_of(back) == sorted(inputs(docs), key=repr)


def test_stale_entries_are_skipped():
    coder = bpe.ByteBpe(bpe.read_spec(PATH))
    assert coder.merge(b"") == []
    ids = coder.merge(b"aaaaaaa" * 50)
    assert b"".join(coder.strings[i] for i in ids) == b"aaaaaaa" * 50
