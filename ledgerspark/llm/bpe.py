"""Byte-pair encoding and decoding with forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be joined, so
the text may be cut between the two. Each piece of the pre-tokenizer is cut at all such pairs, and the
fragments are encoded on their own; their ids in order are the ids of the text. Pieces repeat, so
the ids of those met lately are kept in a bounded cache in each worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

# The byte-level pre-tokenizer's pattern and its printable bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

CACHE = 200_000
LONG = 48
WIDTH = 1 << 20
NEVER = 1 << 62


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: itself, or one from 256 on."""
    hidden = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairCodec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = byte_names()
        vocabulary = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(names[c] for c in token) for token, i in vocabulary.items()}
        self.bytes_of |= {i: text.encode() for text, i in self.specials.items()}
        self.id_of_byte = {names[t]: i for t, i in vocabulary.items() if len(t) == 1}
        self.merges: dict[tuple[int, int], int] = {}  # rank and new id in one number, which sorts by rank
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocabulary[left], vocabulary[right]] = rank * WIDTH + vocabulary[left + right]
        self.joined = {
            (token[i], token[i + 1])
            for token in (self.bytes_of[i] for i in vocabulary.values())
            for i in range(len(token) - 1)
        }
        self.pieces = regex.compile(PATTERN)
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
            if self.specials
            else None
        )
        self._recent: dict[str, str] = {}
        self._older: dict[str, str] = {}

    def fragments(self, piece: bytes) -> list[bytes]:
        """``piece`` cut between every two bytes that no token holds side by side."""
        cuts = [i for i, p in enumerate(zip(piece, piece[1:], strict=False), 1) if p not in self.joined]
        if not cuts:
            return [piece]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def merged(self, fragment: bytes) -> list[int]:
        """Join the pair of lowest rank, the leftmost first, until none is left."""
        ids = [self.id_of_byte[b] for b in fragment]
        return self._merge_long(ids) if len(ids) > LONG else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        pairs = [get(p, NEVER) for p in zip(ids, ids[1:], strict=False)]
        while pairs and (best := min(pairs)) < NEVER:
            i, new = pairs.index(best), best % WIDTH
            ids[i : i + 2] = [new]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get((new, ids[i + 1]), NEVER)
            if i:
                pairs[i - 1] = get((ids[i - 1], new), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over a linked list: a long run costs n log n."""
        merges, n = self.merges, len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = best % WIDTH, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (p := (ids[a], ids[b])) in merges:
                    heapq.heappush(heap, (merges[p], a, p))
        return [i for i in ids if i is not None]

    def _piece(self, piece: str) -> str:
        """The ids of a piece, joined by commas.

        What was met among the last pieces is kept, in two generations of ``CACHE`` pieces.
        """
        known = self._older.get(piece)
        if known is None:
            ids = [i for f in self.fragments(piece.encode("utf-8", "replace")) for i in self.merged(f)]
            known = ",".join(map(str, ids))
        if len(piece) <= LONG:
            if len(self._recent) >= CACHE:
                self._older, self._recent = self._recent, {}
            self._recent[piece] = known
        return known

    def encode_text(self, text: str) -> tuple[str, int]:
        """All ids of ``text``, joined by commas, and their number."""
        parts: list[str] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.specials:
                parts.append(str(self.specials[part]))
            else:
                parts += [self._recent.get(p) or self._piece(p) for p in self.pieces.findall(part)]
        joined = ",".join(parts)
        return joined, joined.count(",") + 1 if joined else 0

    def encode(self, text: str) -> list[int]:
        joined, _ = self.encode_text(text)
        return [int(i) for i in joined.split(",")] if joined else []

    def decode(self, ids: list[int]) -> str:
        """Unknown ids are left out; bytes that are not UTF-8 become replacement characters."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")

    def decode_text(self, joined: str) -> str:
        table = self._bytes_of_name
        return b"".join([table[i] for i in joined.split(",")]).decode("utf-8", "replace") if joined else ""

    @property
    def _bytes_of_name(self) -> dict[str, bytes]:
        if not hasattr(self, "_names"):
            self._names = {str(i): b for i, b in self.bytes_of.items()}
        return self._names


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    """One codec for each worker process and vocabulary file."""
    return BytePairCodec(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids, decoded`` of every row; null text is empty and has no ids.

    ``path`` names the vocabulary file on every executor. Repeated rows and null ids are kept as
    they are, further columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                coded = [bpe.encode_text(t) for t in part["text"]]
                yield pd.DataFrame(
                    {
                        "id": part["id"],
                        "n_tokens": [n for _, n in coded],
                        "ids": [np.fromstring(j, dtype=np.int32, sep=",") for j, _ in coded],
                        "decoded": [bpe.decode_text(j) for j, _ in coded],
                    }
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    schema = f"id {kind}, n_tokens bigint, ids array<int>, decoded string"
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: the same encoding, carried as digests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch["text"]:
                joined, n = bpe.encode_text(text)
                counts.append(n)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode_text(joined).encode()).hexdigest())
            yield pd.DataFrame(
                {"id": batch["id"], "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded}
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInPandas(run, schema).withColumnRenamed("id", id_col)
