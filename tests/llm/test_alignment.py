import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs, rows_of

from carlot.llm import alignment as al
from carlot.llm.bpe import byte_characters, read_spec

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Libraries:
    """Both tokenizers through their libraries, whole texts at once."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.of_char = {c: b for b, c in byte_characters().items()}

    def tokens(self, text: str):
        """((id, bytes), ...) of either side, or nothing."""
        if not text:
            return [], []
        a = [(i, bytes(self.of_char[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        data = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == data == b"".join(x for _, x in b) else ([], [])


@pytest.fixture(scope="module")
def libraries():
    return Libraries()


@pytest.fixture(scope="module")
def tools():
    with open(B_PATH, "rb") as f:
        return al.Tokenizers(read_spec(A_PATH), f.read())


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(a, b):
    """(links as (place of a, place of b, bytes), groups as (a ids, b ids), pairs in a group)."""
    a, b = spans(a), spans(b)
    links, j0 = [], 0
    for i, (_, x, y) in enumerate(a):
        while j0 < len(b) and b[j0][2] <= x:
            j0 += 1
        j = j0
        while j < len(b) and b[j][1] < y:
            links.append((i, j, min(y, b[j][2]) - max(x, b[j][1])))
            j += 1
    ends = sorted({y for *_, y in a} & {y for *_, y in b})
    groups, low, ai, bi = [], 0, 0, 0
    for end in ends:
        ga, gb = [], []
        while ai < len(a) and a[ai][2] <= end:
            ga.append(a[ai][0])
            ai += 1
        while bi < len(b) and b[bi][2] <= end:
            gb.append(b[bi][0])
            bi += 1
        groups.append((ga, gb))
        low = end
    return links, groups


def expected(libraries, rows):
    found, held = [], Counter()
    for doc_id, text in rows:
        a, b = libraries.tokens(text)
        links, groups = brute(a, b)
        pairs = [(a[i][0], b[j][0]) for i, j, _ in links]
        held.update(set(pairs))
        found.append((doc_id, a, b, groups, pairs))
    highest = {}
    for (a, _), n in held.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for doc_id, a, b, groups, pairs in found:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(pairs), sum(len(x) * len(y) for x, y in groups),
                    sum(held[p] == highest[p[0]] for p in pairs), sum(held[p] for p in pairs),
                    hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return sorted(out, key=repr)


ODD = [(1, "<|endoftext|> and <s> </s> <unk> <0x41>"), (2, "a▁b"), (3, "▁"), (4, " "), (5, "   x   y   "), (6, "\n\n a \n b\n"),
       (7, "x\x00y\t\tz\r\n"), (8, "ﬁ ½ é é İ 日本語 😀👩‍👩‍👧 ไทย عربى"), (9, "the the the the"), (10, "the the"),
       (11, "superlongunbrokenwordsuperlongunbrokenwordsuperlongunbrokenwordsuperlongunbrokenword" * 3), (12, "a" * 700 + " " * 70 + "b"),
       (13, "It's we'll  DON'T"), (None, "the the"), (9, "the"), (14, "​﻿͸ x y　z")]


def odd_docs(spark):
    return spark.createDataFrame([(*r, *[1] * 9) for r in ODD], "doc_id bigint, text string, block int, pair int, count int, best int, "
                                 "pairs int, start int, `column` int, value int, n_a int")


@pytest.mark.parametrize("entries", [40, al.BLOCK_ENTRIES])
@pytest.mark.parametrize("table", [edge_docs, odd_docs, all_docs])
def test_corpus(spark, libraries, monkeypatch, table, entries):
    if entries == 40 and table is all_docs:
        entries = 30_000
    monkeypatch.setattr(al, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(al, "MATRIX_BYTES", 5000 if entries < al.MATRIX_BYTES else al.MATRIX_BYTES)
    docs = table(spark).repartition(3)
    out = al.align_corpus(docs, A_PATH, B_PATH)
    assert out.columns == ["doc_id", *(name for name, _ in al.OUT)]
    assert rows_of(out) == expected(libraries, inputs(docs))


def test_empty_table(spark):
    assert rows_of(al.align_corpus(empty_docs(spark), A_PATH, B_PATH)) == []
    assert rows_of(al.alignments(empty_docs(spark), A_PATH, B_PATH)) == []


def test_alignments(spark, libraries):
    docs = odd_docs(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id <> 9").collect()}
    for r in al.alignments(docs.where("doc_id <> 9"), A_PATH, B_PATH).collect():
        a, b = libraries.tokens(texts[r["doc_id"]])
        links, groups = brute(a, b)
        assert (r["a_ids"], r["b_ids"]) == ([i for i, _ in a], [i for i, _ in b])
        assert list(zip(r["link_a"], r["link_b"], r["link_bytes"], strict=True)) == links
        assert r["a_group"] == [g for g, (x, _) in enumerate(groups) for _ in x]
        assert r["b_group"] == [g for g, (_, y) in enumerate(groups) for _ in y]


def dense(m: al.Csr) -> np.ndarray:
    out = np.zeros((m.rows, m.columns), int)
    np.add.at(out, (m.row_of(), m.column), 1 if m.value is None else m.value)
    return out


def test_products():
    r = random.Random(1)
    for _ in range(300):
        n, k, m = r.randint(0, 6), r.randint(0, 6), r.randint(0, 6)

        def matrix(rows, columns):
            entries = [sorted(r.sample(range(columns), r.randint(0, columns))) for _ in range(rows)]
            return al.Csr(np.cumsum([0, *map(len, entries)]), np.array([c for e in entries for c in e], int), columns)

        left, right = matrix(n, k), matrix(k, m)
        product = al.gustavson(left, right)
        assert (dense(product) == dense(left) @ dense(right)).all() and product.value.all()
        assert (al.row_sizes(left, right) == (dense(left) @ dense(right)).sum(axis=1)).all()
        vector = np.array([r.randint(0, 9) for _ in range(m)], int)
        assert (product.times(vector) == dense(product) @ vector).all()


def test_shared_groups(tools, libraries):
    texts = [t for _, t in ODD]
    m = al.align(*al.text_ids(tools, texts), tools.a_lengths, tools.b_lengths)
    shared = m.shared_group_links()
    want = [len(x) * len(y) for t in texts for x, y in brute(*libraries.tokens(t))[1]]
    assert len(shared.column) == sum(want) == m.shared_group_sizes().sum()
    assert set(zip(m.links.row_of(), m.links.column)) <= set(zip(shared.row_of(), shared.column))


def test_random_texts(tools, libraries):
    r = random.Random(3)
    alphabet = [*"abcdefg  \n\n\t.,'", "é", "日", "😀", "the", " and", "0x", "<", ">", "é", " "]
    for k in range(4000):
        signs = alphabet + [*"\t\r\x0b\x1c\x85\xa0\u2003\u200b\u3000\ufeff\u180e"] * (k % 4 == 0)
        text = "".join(r.choices(signs, k=r.randint(0, 60)))
        want = libraries.tokens(text)
        got = [ids.tolist() for ids, _ in al.text_ids(tools, [text])]
        assert got == [[i for i, _ in side] for side in want], repr(text)


def test_words_are_forgotten(tools, libraries):
    """A full memory starts anew and gives the same products."""
    texts = [t for _, t in ODD] * 2
    known, forgetful = al.Blocks(tools), al.Blocks(tools, limit=5)
    for some in ([t] for t in texts):
        for x, y in zip(known.products(some), forgetful.products(some), strict=True):
            assert np.array_equal(x, y)
    sizes = known.products(texts)[0]
    assert sizes[:, 0].tolist() == [len(libraries.tokens(t)[0]) for t in texts]
