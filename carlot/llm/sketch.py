"""Operator 5: document fingerprints by invertible Bloom lookup sketches (native operations only).

A fingerprint is a sketch of the set of a text's paragraph digests: 24 cells in three tables of
eight; each digest falls into one cell of each table, and a cell holds how many digests it got, their
xor, and the xor of their check values. Sketches subtract cell by cell, which cancels what two
versions share; *peeling* then recovers the rest: a cell of one digest is recognised by its count and
check value, gives that digest away, and taking it out of its other cells uncovers further ones.

If peeling gets stuck, the difference was too large for 24 cells: the pair is tried again with
larger sketches, one of 24 cells for about every six digests, which share the digests out by
another hash; pairs that fail again get twice as many, until every pair is decoded. So a likeness
(shared digests over all digests of both, as sets) is always the exact one.

A paragraph ends at a line break, and at a sentence end before a word that begins with a capital
vowel: a rule on the content alone, so that an edit changes only the paragraphs it touches.

Scale: texts are shuffled once, to meet their successor in id order (by ranges of ids, found by
quantiles; the last document of a range takes the first one of the next range). Sketches and
peeling are expressions inside a row; retries shuffle digests of failed pairs only. Documents with
very many paragraphs are spread over many small sketches.

Edge cases: NULL and empty texts have no paragraphs; two such texts are alike (1.0), one such text and
another are not (0.0); rows with equal ids follow each other in the order of their texts' hashes;
NULL ids come first; a single row is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carlot.llm.common import id_and_text, id_ranges, written

TABLES, CELLS = 3, 8
ROUNDS = 12
#: Digests for one sketch of 24 cells in retries.
SHARE = 6
PARAGRAPH_END = r"\n+|(?<=[.!?]) +(?=[AEIOUÀ-ÆÈ-ÏÒ-ÖÙ-Ü])"


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    paragraphs = F.filter(F.transform(F.split(text, PARAGRAPH_END), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(paragraphs, lambda p: F.xxhash64(p)))


def check_of(digest: Column) -> Column:
    return F.xxhash64(digest)


def cell_of(digest: Column, table: int, level: int) -> Column:
    """Cell of a digest in a table: three of its bits, other ones on each of seven levels."""
    return F.shiftrightunsigned(digest, 9 * (level % 7) + 3 * table).bitwiseAND(F.lit(CELLS - 1).cast("bigint"))


def cell(n: Column, k: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.alias("k"), check.alias("check"))


def xor_all(items: Column, value=lambda x: x) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseXOR(value(x)))


def is_empty(c: Column) -> Column:
    return (c["n"] == 0) & (c["k"] == 0) & (c["check"] == 0)


def dealt(items: Column, level: int, digest=lambda x: x) -> Column:
    """24 lists: the items by the cells that their digests fall into."""
    cells = F.sequence(F.lit(0).cast("bigint"), F.lit(CELLS - 1).cast("bigint"))

    def of(table: int) -> Column:
        return F.transform(cells, lambda i: F.filter(items, lambda x: cell_of(digest(x), table, level) == i))

    return F.concat(*map(of, range(TABLES)))


def sketch(digests: Column, level: int = 0) -> Column:
    """The 24 cells of a set of digests."""
    return F.transform(dealt(digests, level), lambda got: cell(F.size(got), xor_all(got), xor_all(got, check_of)))


def signed_sketch(items: Column, level: int) -> Column:
    """The difference of two sketches, from the digests ``d`` of both with their ``sign``."""
    return F.transform(dealt(items, level, lambda x: x["d"]), lambda got: cell(
        F.aggregate(got, F.lit(0), lambda n, x: n + x["sign"]),
        xor_all(got, lambda x: x["d"]), xor_all(got, lambda x: check_of(x["d"]))))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["check"].bitwiseXOR(y["check"])))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def peel(cells: Column, level: int = 0) -> Column:
    """struct(cells, found, stuck): what is left after peeling, and the number of digests recovered."""

    def own_cell(k: Column, place: Column) -> Column:
        """Does digest ``k`` fall into the cell at ``place``?"""
        index = (F.when(place < CELLS, cell_of(k, 0, level)).when(place < 2 * CELLS, cell_of(k, 1, level))
                 .otherwise(cell_of(k, 2, level)))
        return index == F.pmod(place, F.lit(CELLS))

    def is_single(c: Column, place: Column) -> Column:
        return (F.abs(c["n"]) == 1) & (c["check"] == check_of(c["k"])) & own_cell(c["k"], place)

    def without(state: Column, singles: Column) -> Column:
        left = F.transform(state["cells"], lambda c, place: F.aggregate(
            F.filter(singles, lambda s: own_cell(s["k"], place)), c,
            lambda rest, s: cell(rest["n"] - s["n"], rest["k"].bitwiseXOR(s["k"]), rest["check"].bitwiseXOR(s["check"]))))
        return F.struct(left.alias("cells"), (state["found"] + F.size(singles)).alias("found"), F.lit(False).alias("stuck"))

    def turn(state: Column, _: Column) -> Column:
        stuck = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("stuck"))
        return F.when(state["stuck"], state).otherwise(let(
            F.array_distinct(F.filter(state["cells"], is_single)),
            lambda singles: F.when(F.size(singles) == 0, stuck).otherwise(without(state, singles))))

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(False).alias("stuck"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def recovered(cells: Column, level: int = 0) -> Column:
    """How many digests the cells hold; NULL if they can't be peeled to the end."""
    return let(peel(cells, level), lambda s: F.when(F.forall(s["cells"], is_empty), s["found"]))


def shown(digests: Column) -> Column:
    """A fingerprint as text: number of digests, then count, xor and check value of each cell."""
    cells = F.transform(sketch(digests), lambda c: F.when(is_empty(c), F.lit("")).otherwise(F.concat(
        c["n"].cast("string"), F.lit("."), F.lower(F.hex(c["k"])), F.lit("."), F.lower(F.hex(c["check"])))))
    return F.concat(F.size(digests).cast("string"), F.lit(":"), F.array_join(cells, ","))


def likeness(a: Column, b: Column, different: Column) -> Column:
    shared = (a + b - different) / 2
    return F.when(a + b == 0, F.lit(1.0)).otherwise(shared / (shared + different))


# --- likeness of pairs ---------------------------------------------------------------------

def differences(rows: DataFrame, of: str, others: list[str]) -> DataFrame:
    """``rows`` (a unique column ``row``, arrays of digests): for each column in ``others`` the size of
    the symmetric difference to column ``of``, as (row, other, different); ``other`` is its place."""
    def pair(name: str, mine: Column) -> Column:
        return recovered(subtract(mine, sketch(F.col(name))))

    # the sketch of ``of`` is made once for all pairs
    first = let(sketch(F.col(of)), lambda mine: F.array(*[pair(name, mine) for name in others]))
    tried = written(rows.select("row", F.posexplode(first).alias("other", "different")), "sketch-pairs")
    done = tried.where("different is not null")
    failed, level = tried.where("different is null").select("row", "other"), 0
    while not failed.isEmpty():
        level += 1
        digests = F.element_at(F.array(*[F.col(name) for name in others]), F.col("other") + 1)
        left = rows.join(failed, "row").select("row", "other", F.col(of).alias("a"), digests.alias("b"))
        parts = F.ceil((F.size("a") + F.size("b")) / SHARE) * (1 << (level - 1))
        item = lambda sign: lambda d: F.struct(d.alias("d"), F.lit(sign).alias("sign"))
        signed = left.select("row", "other", parts.cast("bigint").alias("parts"), F.explode(F.concat(
            F.transform("a", item(1)), F.transform("b", item(-1)))).alias("s"))
        part = F.pmod(F.xxhash64("s.d", F.lit(level)), F.col("parts"))
        shares = signed.groupBy("row", "other", part.alias("part")).agg(F.collect_list("s").alias("s"))
        sizes = (shares.select("row", "other", recovered(signed_sketch(F.col("s"), level), level).alias("n"))
                 .groupBy("row", "other").agg(F.when(F.count("*") == F.count("n"), F.sum("n").cast("int")).alias("different")))
        sizes = written(sizes, "sketch-retry")
        done = done.unionByName(sizes.where("different is not null"))
        failed = sizes.where("different is null").select("row", "other")
    return done


# --- documents, their edits and successors -------------------------------------------------

def with_successor(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, text, digests, next): ``next`` is struct(text, digests) of the next document."""
    spark = docs.sparkSession
    if ranges is None:  # a few ranges a task, so that tasks get even shares
        ranges = 1 << (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    texts = id_and_text(docs)
    ranged = texts.select("doc_id", "text", F.xxhash64("text").alias("tie"), id_ranges(texts, ranges).alias("id_range"))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")
    firsts = written(ranged.groupBy("id_range").agg(F.min_by("text", order).alias("text")), "sketch-firsts")
    # which range follows (only ranges with rows; the last is followed by the first): a row a range
    ring = firsts.select("id_range")
    after = ring.select("id_range", F.coalesce(
        F.lead("id_range").over(Window.orderBy("id_range")),
        F.min("id_range").over(Window.orderBy("id_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    edge = (after.join(firsts.withColumnRenamed("id_range", "after"), "after")
            .select("id_range", F.struct(F.col("text"), paragraph_digests(F.col("text")).alias("digests")).alias("edge")))
    held = ranged.withColumn("digests", paragraph_digests(F.col("text")))
    in_order = Window.partitionBy("id_range").orderBy(F.col("doc_id").asc_nulls_first(), "tie")
    following = held.withColumn("following", F.lead(F.struct("text", "digests")).over(in_order))
    return following.join(edge, "id_range").select("doc_id", "text", "digests", F.coalesce("following", "edge").alias("next"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter replaced by the beginning of the next document."""
    whole = with_successor(docs)
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring(F.col("next.text"), F.lit(1), tail))
    rows = whole.select("doc_id", n.cast("bigint").alias("n_chars"), "digests", F.col("next.digests").alias("next_digests"), edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       "digests", paragraph_digests(F.col("edited")).alias("edited_digests"), "next_digests")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "sketch-rows")
    found = differences(rows, "digests", ["edited_digests", "next_digests"])
    both = found.groupBy("row").agg(F.max(F.when(F.col("other") == 0, F.col("different"))).alias("to_edited"),
                                    F.max(F.when(F.col("other") == 1, F.col("different"))).alias("to_next"))
    a, e, x = F.size("digests"), F.size("edited_digests"), F.col("next_size")
    slim = rows.select("row", "doc_id", "n_chars", "edited_sha256", "digests", "edited_digests", F.size("next_digests").alias("next_size"))
    return slim.join(both, "row").select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("digests")).alias("fingerprint"),
        shown(F.col("edited_digests")).alias("edited_fingerprint"),
        likeness(a, e, F.col("to_edited")).alias("near_edited"), likeness(a, x, F.col("to_next")).alias("near_next"))
