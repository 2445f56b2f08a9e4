"""Byte-level BPE encoding and decoding as a tree reduction.

A text is encoded as a tree: halves are encoded on their own, and neighbours are joined
by encoding a window around the boundary anew. Between a character that is no white
space and one that is, the pattern always ends a match whatever stands around, and
every match is encoded by itself, so tokens beyond such a place cannot change. The
window grows from the boundary until it reaches one on both sides or the node's end.
Decoding concatenates the bytes up the same tree. Encoding with this join is
associative: any tree over any cut of the text gives the same ids.

Defined cases: a null text is an empty one and has no ids; very long texts only deepen
the tree; rows that repeat are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F
from tiktoken import Encoding

from helixspan.llm.texts import SLICE, pick

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Characters of a leaf, ids of a leaf, and first width of a boundary window.
LEAF, ID_LEAF, WINDOW = 16384, 16384, 64
#: White space as the pattern knows it, after a character that is none.
STABLE = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoder(ranks: dict[bytes, int], pattern: str) -> Encoding:
    return Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def last_stable(text: str, window: int) -> int:
    """Start of the last stretch of ``text`` that a following text can change."""
    while True:
        start = max(0, len(text) - window)
        found = max((m.start() for m in STABLE.finditer(text, start)), default=0)
        if found > start or not start:
            return found
        window *= 2


def first_stable(text: str, window: int) -> int:
    """End of the first stretch of ``text`` that a preceding text can change."""
    while True:
        found = STABLE.search(text, 0, min(window, len(text)))
        if found and found.start() > 0:
            return found.start()
        if window >= len(text):
            return len(text)
        window *= 2


def join(enc: Encoding, left: tuple[str, list[int]], right: tuple[str, list[int]], window: int = WINDOW):
    """The node over two neighbouring nodes, each a (text, ids)."""
    (a, a_ids), (b, b_ids) = left, right
    if not a or not b:
        return (b, b_ids) if not a else (a, a_ids)
    p, q = last_stable(a, window), first_stable(b, window)
    head = len(a_ids) - len(enc.encode_ordinary(a[p:]))
    tail = len(enc.encode_ordinary(b[:q]))
    return a + b, a_ids[:head] + enc.encode_ordinary(a[p:] + b[:q]) + b_ids[tail:]


def encode(enc: Encoding, text: str, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
    def node(start: int, end: int) -> tuple[str, list[int]]:
        if end - start <= leaf:
            return text[start:end], enc.encode_ordinary(text[start:end])
        middle = (start + end) // 2
        return join(enc, node(start, middle), node(middle, end), window)

    return node(0, len(text))[1]


def decode(enc: Encoding, ids: list[int], leaf: int = ID_LEAF) -> bytes:
    def node(start: int, end: int) -> bytes:
        if end - start <= leaf:
            return enc.decode_bytes(ids[start:end])
        middle = (start + end) // 2
        return node(start, middle) + node(middle, end)

    return node(0, len(ids))


def encode_documents(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``ids``, token_ids per document.

    The rank file (about 1 MB, fixed) is read by the driver and broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        read_ranks(path or public_tokenizers.path(VOCABULARY))
    )
    pattern = public_tokenizers.PATTERN
    made = "n_tokens:bigint,ids_sha256:string,decoded_sha256:string"

    @F.pandas_udf(f"struct<{made}{',token_ids:array<int>' if ids else ''}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(shared.value, pattern)
        names = [str(i) for i in range(max(shared.value.values()) + 1)]
        columns = ["n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * ids]
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                yield pd.DataFrame([row(enc, names, text) for text in batch.iloc[at : at + SLICE]], columns=columns)

    def row(enc: Encoding, names: list[str], text) -> tuple:
        tokens = encode(enc, text) if isinstance(text, str) else []
        made = (
            len(tokens),
            hashlib.sha256(" ".join(map(names.__getitem__, tokens)).encode()).hexdigest(),
            hashlib.sha256(decode(enc, tokens)).hexdigest(),
        )
        # As an array the ids take four bytes each until they are sent back.
        return (*made, np.array(tokens, np.int32)) if ids else made

    return pick(docs, "doc_id", "text").select("doc_id", run("text").alias("made")).select(
        "doc_id", "made.*"
    )


def token_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Documents as ids, for training."""
    return encode_documents(docs, path, ids=True)
