"""Operator 9: secret scans.

An Aho-Corasick automaton finds the keywords of all keyword rules in one pass; a rule's
regular expression is tried only at (or shortly behind) a keyword, anchored there. Runs of
hex digits have no keyword and are found by one scan. Rules with an embedded checksum (or an
inner structure) accept a candidate only if it is valid:

* github, npm: the last six characters are the CRC-32 of the 30 before them, in base 62;
* wif: Base58Check private keys, double SHA-256 checksum;
* jwt: header and payload are Base64url of JSON objects, the header names an algorithm.

Spans count code points, end exclusive. Per-row work: no shuffle, any table size.

Edge cases: NULL and empty texts have no spans; repeated rows give equal rows; an empty table
gives an empty result; long texts are scanned whole, in linear time (a run in which a token fails is
not gone through again from the keywords inside it); columns other than ``doc_id`` and ``text`` are
ignored, whatever their names; letter case of keywords
means ASCII letters, so the Kelvin sign is no k.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from carlot.llm.common import map_texts

FIELDS = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")]

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
#: How far behind a keyword of the rule "wif", or behind the key before it in a list, a key may begin.
NEAR = 40


def crc_base62(secret: str) -> bool:
    """The six last characters are the CRC-32 of the rest behind the prefix, in base 62."""
    body, check = secret.rpartition("_")[2][:-6], secret[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == check


def base58_check(secret: str) -> bool:
    value = 0
    for c in secret:
        value = value * 58 + BASE58.index(c)
    try:
        data = value.to_bytes(38 if len(secret) == 52 else 37, "big")
    except OverflowError:
        return False
    return data[0] == 0x80 and hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def json_web_token(secret: str) -> bool:
    try:
        header, payload = (json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in secret.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header and isinstance(payload, dict)


@dataclass(frozen=True)
class Rule:
    """``pattern`` is tried where a keyword begins, or anywhere within ``near`` characters behind
    it and then behind each match; ``accept`` decides on a match. Matches that it drops still take their
    place. Where a pattern begins with a run that nothing but its end can fail, ``run`` is that run:
    behind a failure, keywords inside it are not tried again."""
    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    accept: Callable[[re.Match], bool]
    near: int = 0
    run: re.Pattern | None = None


#: In the order in which spans with equal starts are listed.
RULES = (
    Rule("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
         lambda m: len(m[2]) >= 12),
    Rule("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc_base62(m[0])),
    Rule("npm", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc_base62(m[0])),
    Rule("wif", ("wif", "private key", "private_key", "private-key", "privatekey", "privkey", "wallet"),
         re.compile(r"(?<![A-Za-z0-9])[5KL][1-9A-HJ-NP-Za-km-z]{50,51}(?![A-Za-z0-9])"), lambda m: base58_check(m[0]), NEAR),
    Rule("jwt", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+"),
         lambda m: json_web_token(m[0]), run=re.compile(r"[A-Za-z0-9_-]*+")),
)
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "github", "npm", "wif", "jwt")
BASE = KINDS[:3]
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def ascii_lower(text: str) -> str:
    """Lower case of A-Z alone, so that places stay as they are."""
    lower = text.lower()
    return lower if text.isascii() else text.translate(_ASCII_LOWER)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.automaton = ahocorasick.Automaton()
        at: dict[str, list[int]] = {}
        for k, rule in enumerate(rules):
            for word in rule.keywords:
                at.setdefault(word, []).append(k)
        for word, ks in at.items():
            self.automaton.add_word(word, (len(word), ks))
        self.automaton.make_automaton()

    def scan(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) of all spans, by start, then kind as listed."""
        hits: dict[int, list[int]] = {}
        for last, (length, ks) in self.automaton.iter(ascii_lower(text)):
            for k in ks:
                hits.setdefault(k, []).append(last - length + 1)
        found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        for k, starts in hits.items():
            rule, free = self.rules[k], 0
            for start in sorted(starts):
                if rule.near:
                    start = max(start, free)
                    m = rule.pattern.search(text, start, start + rule.near + 64)
                else:
                    m = rule.pattern.match(text, start) if start >= free else None
                    if not m and rule.run and start >= free:
                        free = rule.run.match(text, start).end()
                while m:
                    free = m.end()
                    if rule.accept(m):
                        found.append((m.start(), m.end(), rule.kind))
                    m = rule.pattern.search(text, free, free + rule.near + 64) if rule.near else None
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans."""

    def make():
        scanner = Scanner()

        def columns(texts: list[str]) -> list[list]:
            out: list[list] = [[], [], [], [], []]
            for text in texts:
                spans = scanner.scan(text)
                kinds = [kind for _, _, kind in spans]
                base = [s for s in spans if s[2] in BASE]
                for column, value in zip(out, [*(kinds.count(k) for k in BASE), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)], strict=True):
                    column.append(value)
            return out

        return columns

    return map_texts(docs, make, FIELDS)


def found_secrets(docs: DataFrame) -> DataFrame:
    """One row per span: doc_id, kind, start, end and the text there."""
    from pyspark.sql import functions as F

    def make():
        scanner = Scanner()
        return lambda texts: [[json.dumps([[kind, a, b, t[a:b]] for a, b, kind in scanner.scan(t)]) for t in texts]]

    spans = map_texts(docs, make, [("found", "string")])
    rows = spans.select("doc_id", F.explode(F.from_json("found", "array<array<string>>")).alias("s"))
    return rows.select("doc_id", F.col("s")[0].alias("kind"), F.col("s")[1].cast("bigint").alias("start"),
                       F.col("s")[2].cast("bigint").alias("end"), F.col("s")[3].alias("secret"))
