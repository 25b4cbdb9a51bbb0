"""Queries of the operators over the whole ``documents`` table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carlot.llm import alignment, bpe, decontaminate, hard_negatives, licenses, line_dedup, packing, secrets, simhash, sketch, suffix_dedup, token_files, toxicity
from carlot.llm.common import table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2

PIECE_MODEL = "piece_bpe_32k.model"

WORD_VOCABULARY = "word_bpe_49k.json"
WORD_END_ID = 0
SEQUENCE_TOKENS = 2048


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_texts(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"), depth=50)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_ID)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECE_MODEL))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), every=100, positives=5, negatives=10, shares=(30, 90),
                               scale=256, relabel=(7, 10))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), WORD_END_ID, SEQUENCE_TOKENS)


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)
), keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _spans_sql(kind: str, place: int, pattern: str, value_group: int, least: int) -> str:
    """Matches of one kind with their places: gap and match lengths add up to them."""
    whole = f"(?s)(.*?)({pattern})"
    return f"""
  SELECT doc_id, '{kind}' AS kind, {place} AS k, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS a, length(found[i]) AS n
  FROM (SELECT doc_id, gaps, found, vals, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '{whole}', 1) AS gaps, regexp_extract_all(text, '{whole}', 2) AS found,
           regexp_extract_all(text, '{whole}', {value_group + 1}) AS vals FROM d))
  WHERE length(vals[i]) >= {least}"""


# These tables hold no secret of the kinds with a checksum, so all spans are base spans.
_ASSIGN = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
SECRETS_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({_spans_sql("assign", 0, f"({_ASSIGN})[" + '"' + "'']?\\x20*[:=]\\x20*[" + '"' + "'']?([A-Za-z0-9+/_.=-]+)", 3, 12)}
  UNION ALL {_spans_sql("access", 1, "AKIA[A-Z0-9]+", 1, 18)}
  UNION ALL {_spans_sql("hex", 2, "[0-9a-f]+", 1, 16)}),
j AS (SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
             count(*) FILTER (WHERE k = 2) AS n_hex, string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) AS spans
      FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
"""


#: What Python counts as white space, in RE2's syntax.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _licenses_sql() -> str:
    """Known sentences of consecutive pieces, the longest first, then the rules over their identifiers."""
    known = []
    for sentence, name in licenses.IDENTIFIERS.items():
        words = sentence.split(" ")
        names = words.count("*")
        pattern = " ".join(f"[a-z0-9]+(?: [a-z0-9]+){{0,{licenses.NAME_WORDS - 1}}}" if w == "*" else w for w in words)
        known.append(f"('{words[0]}', '{pattern}', {len(words)}, {len(words) + names * (licenses.NAME_WORDS - 1)}, '{name}')")
    rules = [("".join(f"{i}," for i in sequence), name) for name, sequence in licenses.RULES]
    case = " ".join(f"WHEN '{sequence}' THEN '{name}'" for sequence, name in rules)
    pattern = "|".join([*(sequence.replace(".", "[.]") for sequence, _ in rules), "[^,]+,"])
    return f"""
WITH RECURSIVE known(word, pattern, least, most, name) AS (VALUES {", ".join(known)}),
d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
cut AS (SELECT r, unnest(range(1, len(parts) + 1)) AS i, parts FROM (
  SELECT r, string_split(regexp_replace(lower(text), '[.!?;:]({_SPACE})', chr(10) || '\\1', 'g'), chr(10)) AS parts FROM d)),
normal AS (SELECT r, i, trim(regexp_replace(regexp_replace(parts[i], '^[^a-z0-9]*[0-9a-z]\\)[ \\t]', ''), '[^a-z0-9]+', ' ', 'g')) AS p FROM cut),
piece AS (SELECT r, row_number() OVER (PARTITION BY r ORDER BY i) AS i, p, len(string_split(p, ' ')) AS n FROM normal WHERE p <> ''),
whole AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY i) AS upto FROM piece),
line AS (SELECT r, list(p ORDER BY i) AS ps FROM piece GROUP BY r),
may AS (SELECT a.r, a.i, b.i AS k, known.pattern, known.name FROM whole a JOIN known ON known.word = string_split(a.p, ' ')[1]
        JOIN whole b ON b.r = a.r AND b.i >= a.i AND b.upto - a.upto + a.n BETWEEN known.least AND known.most),
hit AS (SELECT may.r, may.i, max(may.k) AS k, arg_max(may.name, may.k) AS name FROM may JOIN line ON line.r = may.r
        WHERE regexp_full_match(array_to_string(ps[may.i:may.k], ' '), may.pattern) GROUP BY may.r, may.i),
after AS (SELECT h.r, h.i, h.k, h.name, min(g.i) AS next FROM hit h LEFT JOIN hit g ON g.r = h.r AND g.i > h.k GROUP BY ALL),
taken(r, i, name, next) AS (
  SELECT r, i, name, next FROM after WHERE (r, i) IN (SELECT (r, min(i)) FROM hit GROUP BY r)
  UNION ALL SELECT a.r, a.i, a.name, a.next FROM taken t JOIN after a ON a.r = t.r AND a.i = t.next),
seq AS (SELECT r, count(*) AS n, string_agg(name || ',', '' ORDER BY i) AS seq FROM taken GROUP BY r),
rule AS (SELECT r, k, CASE toks[k] {case} END AS name FROM (
        SELECT r, toks, unnest(range(1, len(toks) + 1)) AS k FROM (SELECT r, regexp_extract_all(seq, '{pattern}') AS toks FROM seq))),
first AS (SELECT r, name, min(k) AS k FROM rule WHERE name IS NOT NULL GROUP BY ALL),
named AS (SELECT r, string_agg(name, ';' ORDER BY k) AS licenses FROM first GROUP BY r),
loose AS (SELECT r, count(*) AS n_loose FROM rule WHERE name IS NULL GROUP BY r)
SELECT d.doc_id, coalesce(seq.n, 0) AS n_sentences, coalesce(loose.n_loose, 0) AS n_loose, coalesce(named.licenses, '') AS licenses,
       coalesce(rtrim(seq.seq, ','), '') AS sentence_ids
FROM d LEFT JOIN seq ON d.r = seq.r LEFT JOIN named ON d.r = named.r LEFT JOIN loose ON d.r = loose.r
"""


# Hex digits stand for bytes: place p begins at character 2 p + 1.
SUFFIX_DEDUP_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, CAST(2 * p + 1 AS INTEGER), 100) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)),
f AS (SELECT w, min(doc_id) AS first FROM w GROUP BY w HAVING min(doc_id) < max(doc_id)),
r AS (SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before FROM w JOIN f ON w.w = f.w WHERE w.doc_id > f.first),
g AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM r),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, span),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM spans),
kept AS (SELECT g.doc_id, sum(b - a) AS removed, count(*) AS n, string_agg(substr(h, CAST(2 * from_ + 1 AS INTEGER), CAST(2 * (a - from_) AS INTEGER)), '' ORDER BY a)
                || substr(any_value(h), CAST(2 * max(b) + 1 AS INTEGER)) AS h
         FROM gaps g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed, coalesce(k.n, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> p.anchor_label
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM n WHERE rank <= 10
"""

QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_bpe": (op2_bpe, None),
    "op3_licenses": (op3_licenses, _licenses_sql()),
    "op4_decontaminate": (op4_decontaminate, None),
    "op5_fingerprints": (op5_fingerprints, None),
    "op6_suffix_dedup": (op6_suffix_dedup, SUFFIX_DEDUP_SQL),
    "op7_simhash": (op7_simhash, None),
    "op8_line_dedup": (op8_line_dedup, LINE_DEDUP_SQL),
    "op9_secrets": (op9_secrets, SECRETS_SQL),
    "op10_token_files": (op10_token_files, None),
    "op11_alignment": (op11_alignment, None),
    "op12_hard_negatives": (op12_hard_negatives, HARD_NEGATIVES_SQL),
    "op13_best_fit_packing": (op13_best_fit_packing, None),
}
