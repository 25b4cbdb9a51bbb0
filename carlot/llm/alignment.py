"""Operator 11: alignment of two tokenizers' tokens by their bytes.

A text with a space before it is cut into tokens twice: by a byte-level BPE (A) and by a
sentence-piece model with byte fallback (B, which adds the space itself). Each side is a 0/1
incidence matrix of tokens by bytes, in hand-built CSR; Gustavson's row product A.B^T gives the
links (token pairs that share bytes, with how many). Places where tokens of both end cut a text
into groups; the product of the two token-by-group matrices gives the pairs that share a group. On
both sides a token ends before any white space that follows other characters, so a text's matrices
are block-diagonal over its words, and so are their products: in the corpus each distinct word is
multiplied once for as long as it is remembered, many new words as one block-diagonal matrix.

Corpus counts: how many documents hold an id pair linked. Documents are gathered in *blocks*,
each a sparse matrix of documents by the block's distinct pairs, written to the shared folder.
Pairs then meet by an ordinary aggregation (one row a pair and block), the counts go back to the
blocks that hold the pair, and a matrix-vector product sums them per document. So what is
shuffled is the vocabulary of each block, not its tokens; a pair comes from a block at most once,
so no pair is hot; and the table of counts is joined, never collected or broadcast unchecked.

Edge cases: NULL and empty texts, and texts whose joined token bytes differ from the space and
text on either side (the piece model reads U+2581 as a space), have no tokens: zeros and an empty
digest; special tokens' strings are plain text; repeated rows, and rows with NULL or repeated ids,
are documents of their own and count as such; ties for a token's best partner all count; texts of
any length are one matrix each; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.llm.bpe import read_spec
from carlot.llm.common import arrow_map, ddl, id_and_text, record_batch, written
from carlot.llm.token_files import LibraryBpe

#: Bytes of text in one block-diagonal matrix; entries (a document's distinct pairs) in one block.
MATRIX_BYTES, BLOCK_ENTRIES = 1 << 19, 1 << 21
#: Ids of B are below this in pair keys (A's id * PAIR + B's id).
PAIR = 1 << 20
#: Words up to this length are cut into pre-tokens at once.
CACHED_CHARS = 64

#: Token ids of some texts or words, one behind the other, and how many each has.
Ids = tuple[np.ndarray, np.ndarray]


# --- the two tokenizers ------------------------------------------------------------------

class Pieces:
    """Sentence-piece ids of words. No piece holds a space behind another character, or a line break,
    so none reaches over the beginning of white space."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in pieces):
            raise ValueError("pieces of this model reach over words")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.lead = len(self.model.encode("x"))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words with the white space before them; the model's own
        space goes to a letter that is cut off."""
        ids = self.model.encode(["x" + word for word in words], num_threads=1)
        size = np.fromiter(map(len, ids), "i8", len(ids)) - self.lead
        flat = np.fromiter(chain.from_iterable(ids), "i8", int(size.sum()) + self.lead * len(ids))
        return flat[ragged(np.cumsum(size + self.lead) - size, size)], size


class Tokenizers:
    """Both sides: ids of words and the bytes of each id."""

    #: A word with the white space before it, or the white space at a text's end.
    WORDS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    #: Other white space (in any of the libraries' views) can join a run of it: such texts are one word.
    SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")

    def __init__(self, spec: str, model: bytes):
        self.a, self.b = LibraryBpe(spec, cached=50_000), Pieces(model)
        a_bytes = [self.a.strings.get(i, b"") for i in range(max(self.a.strings) + 1)]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in side], "i8") for side in (a_bytes, self.b.bytes))
        self.a_bytes, self.b_bytes = a_bytes, self.b.bytes
        #: An id's decimal digits before each of the separators of a digest.
        self.a_shown, self.b_shown = ([[f"{i}{end}" for i in range(len(side))] for end in (",", "|", ";")] for side in (a_bytes, self.b.bytes))

    def words(self, text: str) -> list[str]:
        """Words of a space and ``text``; an empty text has none."""
        if not text:
            return []
        return [" " + text] if self.SPACE.search(text) else self.WORDS.findall(" " + text)

    def _a_ids(self, word: str) -> bytes:
        if len(word) <= CACHED_CHARS:
            piece = word[1:] if word[0] == " " and word[1:2] != "\n" else word
            if (ids := self.a._piece(piece)) is not None:
                return ids
        return self.a._joined(self.a.cut(word))

    def ids(self, words: list[str]) -> tuple[Ids, Ids, np.ndarray]:
        """Ids of A and of B of words, and whether both sides give a word back; if not, it has no ids."""
        a = [self._a_ids(word) for word in words]
        sides = [(np.frombuffer(b"".join(a), "<u4").astype("i8"), np.fromiter(map(len, a), "i8", len(a)) // 4), self.b.encode(words)]
        data = [word.encode() for word in words]
        size = np.fromiter(map(len, data), "i8", len(data))
        good = np.ones(len(words), bool)
        for (ids, count), lengths in zip(sides, (self.a_lengths, self.b_lengths), strict=True):
            good &= sums(lengths[ids], count) == size
        for (ids, count), strings in zip(sides, (self.a_bytes, self.b_bytes), strict=True):
            given = b"".join([strings[i] for i in ids[np.repeat(good, count)].tolist()])
            if given != b"".join([word for word, ok in zip(data, good.tolist(), strict=True) if ok]):
                ends = np.cumsum(count)
                good &= [b"".join([strings[i] for i in ids[end - n:end]]) == word for end, n, word in zip(ends, count, data, strict=True)]
        return *((ids[np.repeat(good, count)], np.where(good, count, 0)) for ids, count in sides), good


def sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the first size[0] values, of the next size[1], ..."""
    upto = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(size)
    return upto[ends] - upto[ends - size]


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] places, start[1], ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


# --- sparse matrices ---------------------------------------------------------------------

@dataclass
class Csr:
    """Rows ``start[i]`` to ``start[i + 1]`` of ``column`` and ``value`` (None: all ones)."""

    start: np.ndarray
    column: np.ndarray
    columns: int
    value: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.start) - 1

    def row_of(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.rows), np.diff(self.start))

    def times(self, vector: np.ndarray) -> np.ndarray:
        """Matrix by vector."""
        terms = vector[self.column] if self.value is None else vector[self.column] * self.value
        sums = np.concatenate(([0], np.cumsum(terms)))
        return sums[self.start[1:]] - sums[self.start[:-1]]


def row_sizes(left: Csr, right: Csr) -> np.ndarray:
    """Entries that each row of the product gathers before equal columns meet: Gustavson's first
    pass, without making them."""
    width = np.diff(right.start)[left.column]
    sums = np.concatenate(([0], np.cumsum(width)))
    return sums[left.start[1:]] - sums[left.start[:-1]]


def gustavson(left: Csr, right: Csr) -> Csr:
    """The product of two 0/1 matrices: row i gathers the rows of ``right`` that row i of ``left``
    names, and equal columns add up."""
    begin = right.start[left.column]
    width = right.start[left.column + 1] - begin
    ends = np.cumsum(width)
    total = int(ends[-1]) if len(ends) else 0
    take = np.arange(total) + np.repeat(begin - (ends - width), width)
    column = right.column[take]
    row = np.repeat(left.row_of(), width)
    key = row * right.columns + column
    if total and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    first = np.flatnonzero(np.concatenate((np.ones(min(total, 1), bool), key[1:] != key[:-1])))
    row, column = np.divmod(key[first], max(right.columns, 1))
    value = np.diff(np.concatenate((first, [total])))
    return Csr(np.searchsorted(row, np.arange(left.rows + 1)), column, right.columns, value)


def tokens_by_bytes(lengths: np.ndarray) -> Csr:
    """Each token's row names the bytes that it covers."""
    ends = np.concatenate(([0], np.cumsum(lengths)))
    return Csr(ends, np.arange(ends[-1]), int(ends[-1]))


def bytes_by_tokens(lengths: np.ndarray) -> Csr:
    """Its transpose: each byte's row names the token over it."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return Csr(np.arange(len(owner) + 1), owner, len(lengths))


@dataclass
class Aligned:
    """A batch of texts as one block-diagonal matrix."""

    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_text: np.ndarray
    #: Tokens of A by tokens of B; values: bytes shared.
    links: Csr

    def group_matrices(self) -> tuple[Csr, Csr]:
        """(tokens of A by groups, groups by tokens of B)."""
        n = len(self.group_text)
        return (Csr(np.arange(len(self.a) + 1), self.a_group, n),
                Csr(np.searchsorted(self.b_group, np.arange(n + 1)), np.arange(len(self.b)), len(self.b)))

    def shared_group_links(self) -> Csr:
        """Tokens of A by tokens of B in the same group."""
        return gustavson(*self.group_matrices())

    def shared_group_sizes(self) -> np.ndarray:
        """How many of these each token of A has; a group of n and m tokens would list n * m."""
        return row_sizes(*self.group_matrices())


def align(a: Ids, b: Ids, a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Align the ids of each text (or word), whose tokens of both sides cover the same bytes."""
    (a, a_count), (b, b_count) = a, b
    a_text, b_text = (np.repeat(np.arange(len(count)), count) for count in (a_count, b_count))
    a_bytes, b_bytes = a_lengths[a], b_lengths[b]
    links = gustavson(tokens_by_bytes(a_bytes), bytes_by_tokens(b_bytes))
    # a group ends where tokens of both end
    a_end, b_end = np.cumsum(a_bytes), np.cumsum(b_bytes)
    size = int(a_end[-1]) if len(a_end) else 0
    ends = np.zeros((2, size + 1), bool)
    ends[0, a_end], ends[1, b_end] = True, True
    both = np.flatnonzero(ends[0] & ends[1])
    a_group, b_group = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
    return Aligned(a, b, a_text, b_text, a_group, b_group, a_text[np.searchsorted(a_end, both)] if size else np.empty(0, "i8"), links)


def shown_groups(m: Aligned, n_texts: int, tools: Tokenizers) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text."""
    groups = len(m.group_text)
    a_first, b_first = np.searchsorted(m.a_group, np.arange(groups + 1)), np.searchsorted(m.b_group, np.arange(groups + 1))
    a_place = np.arange(len(m.a)) + b_first[m.a_group]            # B's tokens of earlier groups stand before
    b_place = np.arange(len(m.b)) + a_first[m.b_group + 1]        # and A's of this group too
    shown = np.empty(len(m.a) + len(m.b), object)
    for ids, group, place, table, last in ((m.a, m.a_group, a_place, tools.a_shown, 1), (m.b, m.b_group, b_place, tools.b_shown, 2)):
        ends = np.concatenate((group[1:] != group[:-1], np.ones(min(len(group), 1), bool)))
        plain, closing = table[0], table[last]
        shown[place] = [closing[i] if end else plain[i] for i, end in zip(ids.tolist(), ends.tolist(), strict=True)]
    upto = np.searchsorted(m.a_text, np.arange(n_texts + 1)) + np.searchsorted(m.b_text, np.arange(n_texts + 1))
    parts = shown.tolist()
    return ["".join(parts[x:y])[:-1] for x, y in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]


# --- the corpus --------------------------------------------------------------------------

SIZES = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
OUT = [*((name, "bigint") for name in (*SIZES, "n_best", "count_sum")), ("groups_sha256", "string")]


def extended(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` behind the ``used`` rows of an array that doubles when it is full."""
    if used + len(more) > len(array):
        array = np.concatenate((array[:used], np.empty((max(used, len(more)) + len(more), *array.shape[1:]), array.dtype)))
    array[used:used + len(more)] = more
    return array


class Blocks:
    """Products of the distinct words that a worker has met: sizes, links' id pairs, shown groups."""

    def __init__(self, tools: Tokenizers, limit: int = 4 << 20):
        self.tools, self.limit = tools, limit
        self.clear()

    def clear(self) -> None:
        self.place, self.shown, self.chars, self.n_pairs = {}, [], 0, 0
        self.good, self.sizes = np.empty(0, bool), np.empty((0, len(SIZES)), "i8")
        self.first, self.pairs = np.empty(0, "i8"), np.empty(0, "i8")

    def learn(self, words: list[str]) -> None:
        a, b, good = self.tools.ids(words)
        m = align(a, b, self.tools.a_lengths, self.tools.b_lengths)
        n, known, row = len(words), len(self.shown), m.links.row_of()
        counts = [np.bincount(x, minlength=n) for x in (m.a_text, m.b_text, m.group_text, m.a_text[row])]
        shared = np.bincount(m.a_text, weights=m.shared_group_sizes(), minlength=n).astype("i8")
        self.good = extended(self.good, known, good)
        self.sizes = extended(self.sizes, known, np.stack([*counts, shared], axis=1))
        self.first = extended(self.first, known, self.n_pairs + np.cumsum(counts[3]) - counts[3])
        self.pairs = extended(self.pairs, self.n_pairs, m.a[row] * PAIR + m.b[m.links.column])
        self.n_pairs += len(row)
        self.shown += shown_groups(m, n, self.tools)
        self.place.update(zip(words, range(known, known + n), strict=True))
        self.chars += sum(map(len, words))

    def products(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(sizes, digests) of each text, and (id pair, text) of all links."""
        if self.chars > self.limit:
            self.clear()
        words = [self.tools.words(text) for text in texts]
        new = set(chain.from_iterable(words)).difference(self.place)
        if new:
            self.learn(list(new))
        n_words = np.array([len(w) for w in words], "i8")
        at = np.fromiter(chain.from_iterable(map(self.place.__getitem__, w) for w in words), "i8", int(n_words.sum()))
        text = np.repeat(np.arange(len(texts)), n_words)
        whole = np.ones(len(texts), bool)
        whole[text[~self.good[at]]] = False
        at, text = at[whole[text]], text[whole[text]]
        ends = np.searchsorted(text, np.arange(len(texts) + 1))
        sums = np.concatenate((np.zeros((1, len(SIZES)), "i8"), np.cumsum(self.sizes[at], axis=0)))
        shown, places = self.shown, at.tolist()
        digests = [hashlib.sha256(";".join([shown[k] for k in places[x:y]]).encode()).hexdigest() if y > x else ""
                   for x, y in pairwise(ends.tolist())]
        links = self.sizes[at, SIZES.index("n_links")]
        return sums[ends[1:]] - sums[ends[:-1]], digests, self.pairs[ragged(self.first[at], links)], np.repeat(text, links)


_BLOCKS: dict[tuple, Blocks] = {}


def worker_blocks(spec: str, model: bytes) -> Blocks:
    """One a worker process, with all that it remembers."""
    key = hash(spec), hash(model)
    if key not in _BLOCKS:
        _BLOCKS[key] = Blocks(Tokenizers(spec, model))
    return _BLOCKS[key]


def some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc ids, texts) of about ``MATRIX_BYTES`` characters, or one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= MATRIX_BYTES or len(ids) == 4096:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def shared_tools(docs: DataFrame, vocabulary: str, model: str):
    with open(model, "rb") as f:
        data = f.read()
    return docs.sparkSession.sparkContext.broadcast((read_spec(vocabulary), data))  # two fixed files


def alignments(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per document: a_ids, b_ids, the group of each token, and the links as places in these
    arrays with the bytes shared."""
    tools, texts = shared_tools(docs, vocabulary, model), id_and_text(docs)
    arrays = ["a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b", "link_bytes"]
    fields = [("doc_id", texts.schema["doc_id"].dataType.simpleString()), *((name, "array<bigint>") for name in arrays)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_blocks(*tools.value).tools
        for ids, texts in some_texts(batches):
            m = align(*text_ids(both, texts), both.a_lengths, both.b_lengths)
            row, at = m.links.row_of(), np.arange(len(ids) + 1)
            a, b, g, k = (np.searchsorted(x, at) for x in (m.a_text, m.b_text, m.group_text, m.a_text[row]))
            yield record_batch([ids, *([x[lo:hi] - off for lo, hi, off in zip(cut[:-1], cut[1:], base[:-1])] for x, cut, base in (
                (m.a, a, 0 * a), (m.b, b, 0 * b), (m.a_group, a, g), (m.b_group, b, g),
                (row, k, a), (m.links.column, k, b), (m.links.value, k, 0 * k)))], fields)

    return arrow_map(texts, run, fields)


def text_ids(tools: Tokenizers, texts: list[str]) -> tuple[Ids, Ids]:
    """Ids of A and of B of texts; none where a word isn't given back."""
    words = [tools.words(text) for text in texts]
    n_words = np.array([len(w) for w in words], "i8")
    *sides, good = tools.ids(list(chain.from_iterable(words)))
    whole = sums(good.astype("i8"), n_words) == n_words
    kept = np.repeat(whole, n_words)
    return tuple((ids[np.repeat(kept, count)], np.where(whole, sums(count, n_words), 0)) for ids, count in sides)


def blocks_of(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """One row a block: its documents' own figures, its distinct pairs, and the matrix of documents by
    pairs (how often each is linked)."""
    tools, texts = shared_tools(docs, vocabulary, model), id_and_text(docs)
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    fields = [("block", "bigint"), ("doc_ids", f"array<{id_kind}>"), *((name, "array<bigint>") for name in SIZES),
              ("groups_sha256", "array<string>"), ("pairs", "binary"), ("start", "binary"), ("column", "binary"), ("value", "binary")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = worker_blocks(*tools.value), TaskContext.get().partitionId() << 32
        ids, sizes, digests, pairs, counts, widths, entries = [], [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            distinct, column = np.unique(np.concatenate(pairs), return_inverse=True)
            start = np.concatenate(([0], np.cumsum(np.concatenate(widths))))
            return record_batch([[block], [ids], *([x] for x in np.concatenate(sizes).T), [digests], [distinct.tobytes()],
                                 [start.astype("u4").tobytes()], [column.astype("u4").tobytes()],
                                 [np.concatenate(counts).astype("u4").tobytes()]], fields)

        for some, texts in some_texts(batches):
            size, digest, pair, text = known.products(texts)
            sizes.append(size)
            digests += digest
            # a text's links in order of their pairs: equal ones become one entry
            order = np.lexsort((pair, text))
            pair, text = pair[order], text[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(len(pair), 1), bool), (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]))))
            pairs.append(pair[first])
            counts.append(np.diff(np.concatenate((first, [len(pair)]))))
            widths.append(np.bincount(text[first], minlength=len(some)))
            ids += some
            entries += len(first)
            if entries >= BLOCK_ENTRIES:
                yield flush()
                block += 1
                ids, sizes, digests, pairs, counts, widths, entries = [], [], [], [], [], [], 0
        if ids:
            yield flush()

    return arrow_map(texts, run, fields)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, a, n): the block's documents that hold the pair linked."""
    fields = [("block", "bigint"), ("pair", "bigint"), ("n", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, column in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                distinct = np.frombuffer(pairs, "i8")
                held = np.bincount(np.frombuffer(column, "u4"), minlength=len(distinct))
                for lo in range(0, len(distinct), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    yield record_batch([np.full(len(distinct[part]), block), distinct[part], held[part]], fields)

    return arrow_map(blocks.select("block", "pairs", "column"), run, fields)


def align_corpus(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256."""
    blocks = written(blocks_of(docs, vocabulary, model), "alignment-blocks")
    pairs = block_pairs(blocks)
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = written(counts.withColumn("a", F.shiftright("pair", PAIR.bit_length() - 1)), "alignment-counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    counts = counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = pairs.join(counts, "pair").select("block", "pair", "count", "best")
    fields = [("doc_id", blocks.schema["doc_ids"].dataType.elementType.simpleString()), *OUT]

    def totals(block: pa.Table, found: pa.Table) -> pa.Table:
        parts = []
        order = np.argsort(found.column("pair").to_numpy())
        count, best = (np.asarray(found.column(c).to_numpy(zero_copy_only=False) if c == "best" else found.column(c).to_numpy(), "i8")[order]
                       for c in ("count", "best"))
        for b in block.to_pylist():
            start, column, value = (np.frombuffer(b[c], "u4").astype("i8") for c in ("start", "column", "value"))
            matrix = Csr(start, column, len(count), value)
            parts.append(record_batch([b["doc_ids"], *(b[c] for c in SIZES), matrix.times(best), matrix.times(count), b["groups_sha256"]], fields))
        return pa.Table.from_batches(parts, schema=record_batch([[] for _ in fields], fields).schema)

    return (blocks.select("block", "doc_ids", *SIZES, "groups_sha256", "start", "column", "value").groupBy("block")
            .cogroup(answers.groupBy("block")).applyInArrow(totals, ddl(fields)))
