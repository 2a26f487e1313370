"""Secrets in texts: three patterns, and random strings that a subword vocabulary needs many tokens for.

A vocabulary learnt from written language spells a random string in tokens of one or two characters, and words, paths
and names in longer ones. Runs of key characters whose characters per token stay under a threshold are reported,
unless they are known digests or identifiers.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from weblens.llm.common import fresh

# Kinds in the order in which spans with the same start are listed, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a longer run after AKIA is one match, so shorter ones hold no other match
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6

# What is no secret though random: digests (by length, or named), UUIDs, numbers with separators, account numbers (IBAN).
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
NAMED_DIGEST = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512))[-:=/\x20]{1,2}", re.ASCII | re.IGNORECASE)
HEX_RUN = re.compile(r"[0-9a-f]+|[0-9A-F]+")
IDENTIFIER = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9+/_=-]+|[a-z]{2}[0-9]{2}[a-z0-9]{11,30}", re.ASCII | re.IGNORECASE)

SLICE = 4096

SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
                              StructField("text", StringType()), StructField("chars_per_token", DoubleType())]))


@dataclass(frozen=True)
class Rule:
    """``path`` and ``pattern`` name a tiktoken vocabulary; runs of ``least_chars`` or more characters with fewer than
    ``ratio`` characters per token are random."""

    path: str
    pattern: str
    least_chars: int = 20
    ratio: float = 1.9


_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of this Python worker; it outlives a task."""
    if (path, pattern) not in _ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path, pattern] = tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path, pattern]


def chars_per_token(run: str, vocabulary: tiktoken.Encoding) -> float:
    """Characters per token; runs beyond SLICE characters are encoded in slices of that length."""
    return len(run) / sum(len(vocabulary.encode_ordinary(run[k:k + SLICE])) for k in range(0, len(run), SLICE))


def excluded(text: str, start: int, end: int) -> bool:
    """Whether the run is a digest or an identifier."""
    run = text[start:end]
    if end - start in DIGEST_LENGTHS and HEX_RUN.fullmatch(run):
        return True
    named = any(m.end() >= start for m in NAMED_DIGEST.finditer(text, max(0, start - 12), min(end, start + 12)))
    return named or bool(IDENTIFIER.fullmatch(run))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def scan(text: str, rule: Rule, runs: re.Pattern, vocabulary: tiktoken.Encoding) -> list[dict]:
    found = [(*span, None) for span in base_spans(text)]
    known = [span[:2] for span in found]
    for m in runs.finditer(text):
        start, end = m.span()
        if excluded(text, start, end) or any(a <= start and end <= b for a, b in known):
            continue
        ratio = chars_per_token(m[0], vocabulary)
        if ratio < rule.ratio:
            found.append((start, end, "random", ratio))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return [{"kind": k, "start": a, "end": b, "text": text[a:b], "chars_per_token": r} for a, b, k, r in found]


def scan_secrets(docs: DataFrame, rule: Rule, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: the spans (kind, start, end, text, chars_per_token) in every whole text, by start and kind.

    Positions are code points, ends exclusive. Kinds assign, access and hex are fixed patterns, non-overlapping
    within a kind; random are the other runs of ``rule`` that lie inside none of those spans, with their ratio. NULL
    and empty texts have an empty list; repeated rows keep theirs, other columns are left as they are, and a column
    named like ``out`` is replaced. Rows stay in their partitions: one pass, nothing is shuffled.
    """
    name = fresh(docs, "_spans")
    kept = [c for c in docs.columns if c != out]
    schema = StructType([*[f for f in docs.schema.fields if f.name in kept], StructField(name, SPANS)])
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()),
                                ("chars_per_token", pa.float64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoding(rule.path, rule.pattern)
        runs = re.compile(rf"[A-Za-z0-9+/_=-]{{{rule.least_chars},}}")
        for batch in batches:
            found = [scan(t.as_py() or "", rule, runs, vocabulary) for t in batch.column(batch.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns)], pa.array(found, spans)], [*batch.schema.names, name])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(each, schema).withColumnRenamed(name, out)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
