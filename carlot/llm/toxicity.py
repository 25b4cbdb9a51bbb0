"""Operator 1: toxicity by a weighted lexicon.

Texts are folded: lower case, look-alike letters of other scripts to Latin ones, digits and signs
that stand for letters to those letters (so are i, l and 1 to one letter), anything else to single
spaces. An Aho-Corasick automaton finds all lexicon terms in one pass: whole words and beginnings of
words, each with a weight, and *exceptions*, words and phrases that hold a term but don't mean it;
a term inside an exception doesn't count. The weights found are normalised by the length of the
text, and a logistic function of both makes the score.

The lexicon is learned: a term's weight is its log-odds between toxic and other texts. Learning uses
at most ``TRAIN_ROWS`` labelled rows (those with the least hashes of doc_id; a bounded sample, fixed
by the ids alone), counted by Spark; the driver sees term counts above a support threshold and one
small row of features per sampled text, never texts. Scoring is per-row work over all documents.

Edge cases: NULL and empty texts have no terms and get the score of such; repeated rows get equal
scores; labels with a NULL are not used; without any usable label no term is learned and every
score is 0; an empty table gives an empty result; texts of any length are scored whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import arrow_map, id_and_text, map_texts, record_batch, written
from carlot.session import ship_package

TRAIN_ROWS = 20_000
#: Beginnings of words of this many letters may be terms.
SHORTEST, LONGEST = 3, 9
#: A term is in this share of the toxic texts at least, and in this many.
SUPPORT, LEAST = 0.004, 5
#: Least weight (log-odds) of a term, and the greatest one of an exception to it.
WEIGHT, EXCEPTION = 2.0, 0.7

# Letters of other scripts that look like Latin ones, and signs written for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "ս": "u", "օ": "o",
}
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e"}

_FOLD = str.maketrans(LOOK_ALIKES | WRITTEN_FOR | {"l": "i"} | {"ӏ": "i"})
_OTHER = re.compile(r"[\W_]+")
_WIDE = re.compile(r"[^\x00-ɏ]")


def fold(text: str) -> str:
    """Folded words, each between single spaces."""
    if _WIDE.search(text):
        text = unicodedata.normalize("NFKC", text)
    return f" {_OTHER.sub(' ', text.lower().translate(_FOLD)).strip()} "


def terms_of(folded: str) -> set[str]:
    """Candidate terms: ``" word "`` and ``" beginning"``, as they stand in a folded text."""
    words = set(folded.split())
    terms = {f" {w} " for w in words if len(w) >= SHORTEST}
    for w in words:
        terms.update(f" {w[:k]}" for k in range(SHORTEST, min(len(w), LONGEST + 1)))
    return terms


@dataclass
class Lexicon:
    """Terms with weights, exceptions, and the weights of the logistic function."""
    terms: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    logistic: tuple[float, ...] = (-3.0, 1.0, 1.0, 1.0)
    empty: bool = False

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the terms that count: the heaviest at each word, none inside an exception."""
        if not len(self.automaton):
            return []
        found: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (length, weight) in self.automaton.iter(folded):
            start = last - length + 1
            if weight is None:
                spared.append((start, last))
            elif start not in found or weight > found[start][1]:
                found[start] = (last, weight)
        out, reach = [], -1
        spared.sort(reverse=True)
        for a, (b, w) in sorted(found.items()):
            while spared and spared[-1][0] <= a:
                reach = max(reach, spared.pop()[1])
            if b > reach:
                out.append((a, b, w))
        return out

    def features(self, text: str) -> list[float]:
        """Weight found, weight per root of length, weight per word: none depends on length alone."""
        folded = fold(text)
        words = max(1, folded.count(" ") - 1)
        total = sum(w for _, _, w in self.hits(folded))
        return [float(np.log1p(total)), total / words**0.5, 10.0 * total / (words + 10.0)]

    def score(self, text: str) -> float:
        if self.lexicon.empty:
            return 0.0
        bias, *weights = self.lexicon.logistic
        z = bias + sum(w * x for w, x in zip(weights, self.features(text), strict=True))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


# --- learning ------------------------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """True for every fifth row by crc32 of the id's text; those rows are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents that are not held out."""
    label = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("label"))
    chosen = (label.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    # the sample is bounded by ``rows``, so it may be broadcast
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "label")


def counted(sample: DataFrame, candidates) -> DataFrame:
    """(term, toxic, other): sampled texts of either label with the term; summed in each task first."""
    fields = [("term", "string"), ("toxic", "bigint"), ("other", "bigint")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        find = candidates()

        def flush() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            out = record_batch([terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms]], fields)
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[1 if label else 0].update(find(text.as_py()))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield flush()
        yield flush()

    return arrow_map(sample.select("text", "label"), run, fields).groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_odds(toxic: int, other: int, n_toxic: int, n_other: int) -> float:
    return float(np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((other + 0.5) / (n_other + 1.0)))


def pruned(weights: dict[str, float]) -> dict[str, float]:
    """Without terms that add nothing to a shorter beginning of them."""
    kept: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t.rstrip()), t)):
        word = term.strip()
        shorter = [kept[f" {word[:k]}"] for k in range(SHORTEST, len(word) + 1) if f" {word[:k]}" in kept]
        if not shorter or weights[term] > max(shorter) + 0.7:
            kept[term] = weights[term]
    return kept


def exception_candidates(lexicon: Lexicon):
    """For texts: words with a term, longer beginnings of them, and the phrases with either neighbour."""

    def make():
        matcher = lexicon.matcher()

        def find(text: str) -> set[str]:
            folded = fold(text)
            out = set()
            for start, end, _ in matcher.hits(folded):
                stop = folded.index(" ", start + 1)
                word = folded[start + 1:stop]
                after = folded[stop + 1:folded.find(" ", stop + 1)] if stop + 1 < len(folded) else ""
                before = folded[folded.rfind(" ", 0, start) + 1:start] if start else ""
                out.add(f" {word} ")
                out.update(f" {word[:k]}" for k in range(end - start + 1, min(len(word), LONGEST + 3)))
                if after:
                    out.add(f" {word} {after} ")
                if before:
                    out.add(f" {before} {word} ")
            return out

        return find

    return make


def fit_logistic(features: np.ndarray, labels: np.ndarray, steps: int = 60, decay: float = 1e-3) -> tuple[float, ...]:
    """Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(features), 1)), features])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) / len(x) + decay * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + decay * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Lexicon:
    # a partition for each core, so that the counting is spread out
    cores = max(2, docs.sparkSession.sparkContext.defaultParallelism)
    sample = written(training_rows(docs, labels, rows).repartition(cores), "toxicity-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = sum(n for k, n in sizes.items() if k), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Lexicon({}, empty=True)
    least = max(LEAST, SUPPORT * n_toxic)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("other") + 0.5) / (n_other + 1.0))
    found = counted(sample, lambda: lambda text: terms_of(fold(text))).where((F.col("toxic") >= least) & (odds >= WEIGHT)).collect()
    weights = pruned({r["term"]: log_odds(r["toxic"], r["other"], n_toxic, n_other) for r in found})
    lexicon = Lexicon(weights)
    doubtful = (counted(sample, exception_candidates(lexicon))
                .where((F.col("other") >= LEAST) & (odds <= EXCEPTION)).select("term").collect())
    lexicon.exceptions = sorted(r["term"] for r in doubtful if r["term"] not in weights)
    table = np.array([[*r["f"], r["label"]] for r in sample_features(sample, lexicon).collect()])
    lexicon.logistic = fit_logistic(table[:, :-1], (table[:, -1] > 0).astype(float))
    return lexicon


def sample_features(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    @F.pandas_udf("array<double>")
    def features(texts):
        matcher = lexicon.matcher()
        return texts.map(matcher.features)

    return sample.select(features("text").alias("f"), "label")


def score_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample it was learned from

    def make():
        score = shared.value.matcher().score
        return lambda texts: [[score(t) for t in texts]]

    return map_texts(docs, make, [("score", "double")]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The rows of ``docs`` (all columns) with a score below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(shared.value.matcher().score).astype("float64")

    ship_package(docs.sparkSession)
    return docs.where(score(F.coalesce(docs["text"].cast("string"), F.lit(""))) < 0.5)
