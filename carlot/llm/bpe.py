"""Operator 2: byte-level BPE encoding and decoding.

Encoding cuts a text into pre-tokens, and merges the bytes of each by a priority queue of
merge ranks over a doubly linked list of symbols: the best pair is popped, entries whose
pair has changed meanwhile (stale ones) are skipped, and the neighbours of a merged symbol
are pushed. Decoding concatenates the vocabulary strings of the ids.

Vocabulary and merges come from a tokenizer file, which the driver reads and broadcasts
(1.5 MB, a fixed file, not data). Per-row work only: no shuffle, any table size.

Edge cases: NULL and empty texts give no ids; repeated rows give equal rows; an empty table
gives an empty result; very long texts and words cost n log n; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from carlot.llm.common import map_texts

assert sys.byteorder == "little" and array("I").itemsize == 4

FIELDS = [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]


def byte_characters() -> dict[int, str]:
    """Byte -> printable character of byte-level vocabularies: printable bytes stand for
    themselves, the others take the code points from 256 on, in byte order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    chars = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in chars)
    return chars | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PreTokens:
    """Cuts a text as byte-level tokenizers do.

    The library's character classes are older than those of ``regex``: characters that this
    Python's Unicode tables don't know are neither letters nor numbers there."""

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self._strict = None

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not self._unknown(text):
            return self.pattern.findall(text)
        # each unknown character is cut like a symbol, and put back afterwards
        stand_in = "".join("€" if unicodedata.category(c) == "Cn" else c for c in text)
        out, at = [], 0
        for piece in self.pattern.findall(stand_in):
            out.append(text[at:at + len(piece)])
            at += len(piece)
        return out

    @staticmethod
    def _unknown(text: str) -> bool:
        return any(unicodedata.category(c) == "Cn" for c in text if c > "Ԁ")


class Bounded(dict):
    """A dict that makes missing values. When it holds ``limit`` of them it starts anew, but
    values that are asked for again come back from the one before."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.before = self.copy()
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder over one tokenizer file (its JSON text)."""

    def __init__(self, spec: str, pattern: str = public_tokenizers.PATTERN, cached: int = 300_000):
        spec = json.loads(spec)
        model = spec["model"]
        vocab = model["vocab"]
        chars = byte_characters()
        of_char = {c: b for b, c in chars.items()}
        self.first = [vocab[chars[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(of_char[c] for c in s) for s, i in vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        #: (left id, right id) -> (rank, merged id)
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.cut = PreTokens(pattern).cut
        self.words = Bounded(self._word, cached)
        #: What stands between spaces and line breaks -> ids; None where they depend on neighbours.
        self.pieces = Bounded(self._piece, cached)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        symbols = [self.first[b] for b in data]
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        # an entry is rank * n + place, so that equal ranks leave the queue from left to right
        queue = [m[0] * n + i for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j < 0 or symbols[i] < 0 or (m := merges.get((symbols[i], symbols[j]))) is None or m[0] != rank:
                continue  # stale: one of the two symbols has been merged since
            symbols[i], symbols[j] = m[1], -1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if m := merges.get((symbols[i], symbols[k])):
                    heapq.heappush(queue, m[0] * n + i)
            h = before[i]
            if h >= 0 and (m := merges.get((symbols[h], symbols[i]))):
                heapq.heappush(queue, m[0] * n + h)
        return [s for s in symbols if s >= 0]

    def word_ids(self, word: str) -> list[int]:
        return self.merge(word.encode())

    def _word(self, word: str) -> bytes:
        return array("I", self.word_ids(word)).tobytes()

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a space and ``piece``; of ``piece`` alone if it begins with a line break."""
        if piece.isalpha():
            return self._word(" " + piece)
        if not piece or piece[-1].isspace():
            return None
        if piece[0] == "\n":
            line = piece[1:]
            if line.isalpha():
                return self.words["\n"] + self.words[line]
            return None if line[0].isspace() else self.words["\n"] + self._joined(self.cut(line))
        if piece[0].isspace():
            return None
        if piece[-1] in ",." and piece[:-1].isalpha():
            return (self.pieces.get(piece[:-1]) or self._word(" " + piece[:-1])) + self.words[piece[-1]]
        return self._joined(self.cut(" " + piece))

    def _joined(self, words: list[str]) -> bytes:
        return b"".join(map(self.words.__getitem__, words))

    def _plain(self, text: str) -> bytes:
        # no pre-token reaches over a lone space from the left, nor over a lone line break: what
        # stands between them is cut by itself
        if " \n" not in text:
            head, *pieces = text.replace("\n", " \n").split(" ")
            if not head[-1:].isspace():
                try:
                    return self._joined(self.cut(head)) + b"".join(map(self.pieces.__getitem__, pieces))
                except TypeError:
                    pass  # a piece of None: white space next to more of it
        return self._joined(self.cut(text))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(np.array([self.special[part]], "<u4").tobytes() if part in self.special else self._plain(part)
                        for part in self.split.split(text))

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join(map(strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_CODERS: dict[tuple, ByteBpe] = {}


def coder(spec: str) -> ByteBpe:
    """One coder a worker process, with its caches."""
    key = (len(spec), hash(spec))
    if key not in _CODERS:
        _CODERS[key] = ByteBpe(spec)
    return _CODERS[key]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids): the token ids of each text."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))

    def make():
        bpe = coder(spec.value)
        return lambda texts: [[np.frombuffer(bpe.encode(t), "<u4").astype("i8") for t in texts]]

    return map_texts(docs, make, [("ids", "array<bigint>")])


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the concatenated vocabulary strings."""
    from pyspark.sql import functions as F
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(vocabulary))

    @F.pandas_udf("string")
    def decode(ids):
        bpe = coder(spec.value)
        return ids.map(lambda x: bpe.decode(np.asarray(x if x is not None else [], "<u4").tobytes()))

    return encoded.select("doc_id", decode("ids").alias("text"))


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text they decode to."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))

    def make():
        bpe = coder(spec.value)

        def digests(texts: list[str]) -> list[list]:
            counts, of_ids, of_text = [], [], []
            for text in texts:
                ids = bpe.encode(text)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            return [counts, of_ids, of_text]

        return digests

    return map_texts(docs, make, FIELDS)
