"""Secrets in texts: named patterns, and strings that a vocabulary of words cannot shorten.

Words and identifiers are made of pieces that a tokenizer's vocabulary holds, random strings are not: their
characters per token stay low. Long runs of key characters are encoded with a tiktoken vocabulary, and runs below
``MOST_PER_TOKEN`` are reported, unless they are of a known form: a digest by its length, a UUID, a number, or an identifier
made of words.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("assign", "access", "hex", "random")
MOST_PER_TOKEN = 2.1
LEAST_CHARS = 20

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
NAMES = ("passw", "secret", "token", "apikey", "api_key")
# Shorter runs than these fail, and no run begins inside another, so asking for the length at once finds the same.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)

# Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9TZ+/_=-]+")  # dates too
WORDY = re.compile(r"(?:[A-Z]?[a-z]{3,}+|[A-Z]{3,12}+|[0-9]{1,4}+|[+/_=-]++)++")

Span = tuple[str, int, int]


def known_form(run: str) -> bool:
    """Digests, UUIDs, numbers and dates, and identifiers of several words of three letters or more."""
    if len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run):
        return True
    if UUID.fullmatch(run) or NUMBER.fullmatch(run):
        return True
    one_word = run.isalpha() and (run.islower() or run.isupper())
    return not one_word and 4 * sum(map(str.isdigit, run)) <= len(run) and WORDY.fullmatch(run) is not None


@cache
def vocabulary(path: str, pattern: str):
    """The tiktoken encoding of a ranks file that every executor has; read once by a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("secret-scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns, leftmost and without overlap within a kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def spans(text: str, encoding) -> list[Span]:
    """All spans by start and kind; random runs are those that no pattern's match touches."""
    found = base_spans(text)
    taken = sorted((start, end) for _, start, end in found)
    at, reach = 0, 0
    for m in RUN.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][0] < end:
            reach, at = max(reach, taken[at][1]), at + 1
        if reach > start or known_form(m[0]):
            continue
        if len(m[0]) < MOST_PER_TOKEN * len(encoding.encode_ordinary(m[0])):
            found.append(("random", start, end))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, spans`` of every row; a span has its kind, start and end in code points, end exclusive.

    ``vocabulary_path`` is a tiktoken file of ranks at a place that every executor has, ``pattern`` its pre-tokenizer. Null
    and empty texts have no spans; texts are read whole, however long. Null ids and repeated rows are rows like any other,
    further columns are not read, an empty table gives no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = vocabulary(vocabulary_path, pattern)
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t, encoding)] for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "spans": found})

    # ids as text, since pandas has no null among whole numbers
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = rows.mapInPandas(run, "id string, spans array<struct<kind:string,start:int,end:int>>")
    return found.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "spans")


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the patterns' matches, a digest of their spans, and all spans as text."""
    base = KINDS[:3]
    counts = [F.size(_of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base]
    return found.select(
        id_col, *counts, F.sha2(_joined(_of(*base)), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
