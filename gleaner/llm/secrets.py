"""Secret scans: keyword prefilter, anchored patterns near hits, embedded checksums.

An Aho-Corasick automaton over the keywords of all patterns passes once over a text. Only where a
keyword ends is a pattern tried, anchored at the keyword's start. Plain hexadecimal has no keyword:
the text's bytes are folded to two classes and a run of HEX_LEAST of the one class is the keyword.

Kinds, in their order:
  assign   name, separator and a value of six or more characters
  access   AKIA and capitals or digits, twenty or more characters
  hex      twenty-four or more lower-case hexadecimal digits
  github, npm   a prefix, 30 characters and their CRC-32 in six base-62 digits, which must agree
  extkey   an extended private key in base 58 whose four-byte double SHA-256 checksum must agree
Matches of a kind are the leftmost non-overlapping ones; kinds may overlap each other. Letters of
the names match in either case, ASCII only. Offsets count code points; ends are exclusive.

Defined results: a null or empty text has no spans; repeated rows are judged alike; further columns
are ignored. No shuffle; a text is held once, whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_SCHEMA, document_columns, map_batches, raw_texts, table

KINDS = ("assign", "access", "hex", "github", "npm", "extkey")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
HEX_LEAST = 24

_ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_EXTKEY = re.compile(rb"[xyztuv]prv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_HEX_FOLD = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def crc_digits(body: bytes) -> bytes:
    """CRC-32 of the body in six base-62 digits."""
    left, digits = zlib.crc32(body), []
    for _ in range(6):
        left, digit = divmod(left, 62)
        digits.append(_BASE62[digit])
    return bytes(reversed(digits))


def base58_checked(text: bytes) -> bool:
    """Whether base-58 text ends in the checksum of what comes before."""
    number = 0
    for char in text:
        number = number * 58 + _BASE58.index(char)
    data = number.to_bytes((number.bit_length() + 7) // 8, "big")
    body, check = data[:-4], data[-4:]
    return hashlib.sha256(hashlib.sha256(body).digest()).digest()[:4] == check


def _good(kind: str, match: re.Match[bytes]) -> bool:
    if kind == "assign":
        return len(match[1]) >= 6
    if kind == "access":
        return len(match[0]) >= 20
    if kind == "extkey":
        return base58_checked(match[0])
    return crc_digits(match[1]) == match[2]


@cache
def prefilter() -> ahocorasick.Automaton:
    """Keywords in lower case, each with its length, kind and pattern."""
    found = ahocorasick.Automaton()
    for name in NAMES:
        found.add_word(name, (len(name), "assign", _ASSIGN))
    found.add_word("akia", (4, "access", _ACCESS))
    for letter in "pousr":
        found.add_word(f"gh{letter}_", (4, "github", _GITHUB))
    found.add_word("npm_", (4, "npm", _NPM))
    for letter in "xyztuv":
        found.add_word(f"{letter}prv", (4, "extkey", _EXTKEY))
    found.make_automaton()
    return found


def byte_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of every secret, in bytes, sorted."""
    spans = []
    reached = dict.fromkeys(KINDS, 0)
    # One character a byte: offsets of the automaton are then byte offsets.
    for last, (size, kind, pattern) in prefilter().iter(text.lower().decode("latin-1")):
        start = last - size + 1
        if start < reached[kind]:
            continue
        if match := pattern.match(text, start):
            reached[kind] = match.end()
            if _good(kind, match):
                spans.append((start, KINDS.index(kind), match.end()))
    folded = text.translate(_HEX_FOLD)
    start = folded.find(b"x" * HEX_LEAST)
    while start >= 0:
        end = folded.find(b" ", start + HEX_LEAST)
        end = len(text) if end < 0 else end
        spans.append((start, KINDS.index("hex"), end))
        start = folded.find(b"x" * HEX_LEAST, end)
    return sorted(spans)


def secret_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) in code points."""
    spans = byte_spans(text)
    if not spans or text.isascii():
        return spans
    chars, at, places = 0, 0, {}
    for place in sorted({p for start, _, end in spans for p in (start, end)}):
        chars += len(text[at:place].decode())
        places[place], at = chars, place
    return [(places[start], kind, places[end]) for start, kind, end in spans]


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): every span as (kind, start, end), by start, then kind."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def work(batch: pa.RecordBatch):
        spans = [
            [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in secret_spans(text)]
            for text in raw_texts(batch.column(1))
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
        )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        work,
        "doc_id long, spans array<struct<kind:string,start:int,end:int>>",
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each secret as [kind]; overlapping ones become the first one's mark."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """documents with the secrets in their texts masked; n_chars follows. Others stay as they are."""

    def work(batch: pa.RecordBatch):
        texts, sizes = batch.column(1).to_pylist(), batch.column(4).to_pylist()
        for i, text in enumerate(raw_texts(batch.column(1))):
            if spans := secret_spans(text):
                texts[i] = masked(texts[i], spans)
                sizes[i] = len(texts[i])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(texts, pa.string()),
                batch.column(2),
                batch.column(3),
                pa.array(sizes, pa.int64()),
            ],
            ["doc_id", "text", "lang", "source", "n_chars"],
        )

    return map_batches(document_columns(docs), work, DOCUMENT_SCHEMA)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op4: the secrets of every document."""
    found = find_secrets(table(spark, folder, "documents"))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind):
        matching = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(matching).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def _oracle() -> str:
    """Places of matches out of the texts between them. The tables hold no checksummed token, which
    SQL cannot validate; those kinds are tested against a brute force."""
    patterns = {
        "assign": r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
    }
    good = {
        "assign": r"""length(regexp_replace(m, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?', '')) >= 6""",
        "access": "length(m) >= 20",
        "hex": "length(m) >= 24",
    }
    kinds = "\nUNION ALL ".join(
        f"""SELECT doc_id, '{kind}' AS kind, {place} AS place, m,
      (list_sum(list_transform(between[1:i], lambda x: length(x)))
       + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a
    FROM (SELECT doc_id, between, matches, unnest(matches) AS m, unnest(range(1, len(matches) + 1)) AS i
          FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS between,
                  regexp_extract_all(text, '{pattern}') AS matches FROM texts))
    WHERE {good[kind]}"""
        for place, (kind, pattern) in enumerate(patterns.items())
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({kinds}),
listed AS (
  SELECT doc_id, string_agg(concat(kind, ':', a, ':', a + length(m)), ',' ORDER BY a, place) AS spans,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex
  FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM texts t LEFT JOIN listed USING (doc_id)
"""


ORACLE = _oracle()
