import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of
from hypothesis import given
from hypothesis import strategies as st

from carlot.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.integers(1, 32).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(0, (1 << w) - 1), max_size=70))), st.data())
def test_pack_and_unpack(case, data):
    width, ids = case
    packed = tf.pack(np.array(ids, "u4"), width)
    assert len(packed) == (len(ids) * width + 7) // 8
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert tf.unpack(packed, width, a, b).tolist() == ids[a:b]


def test_block_access():
    docs = [np.array(d, "u4") for d in ([1, 2, 3], [], [50_000], [7] * 100)]
    block = tf.Block(tf.make_block(docs, 17))
    assert [block.document(k).tolist() for k in range(4)] == [d.tolist() for d in docs]
    with pytest.raises(ValueError):
        tf.Block(b"xxxx" + tf.make_block(docs, 17)[4:])


def expected(rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("table", [edge_docs, all_docs])
@pytest.mark.parametrize("block_ids", [500, tf.BLOCK_IDS])
def test_files_round_trip(spark, table, block_ids):
    docs = table(spark).repartition(3)
    assert rows_of(tf.token_files(docs, PATH, 2, block_ids=block_ids)) == expected(inputs(docs))


def test_empty_table(spark):
    assert rows_of(tf.token_files(empty_docs(spark), PATH, 2)) == []


def test_random_access(spark, tmp_path):
    path = str(tmp_path / "files")
    tf.write_tokens(edge_docs(spark), PATH, 2, path, block_ids=64)
    from tokenizers import Tokenizer
    ids = Tokenizer.from_file(PATH).encode("one two three four five six seven eight nine ten", add_special_tokens=False).ids
    assert [d.tolist() for d in tf.read_document(spark, path, 11)] == [[*ids, 2]]
    assert len(tf.read_document(spark, path, 5)) == 3
    assert tf.read_document(spark, path, 6) == []
