"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit
per failed rule; a policy is a mask of the bits that reject, so that new versions and
ablations need bitwise operations on the ledger only, never the texts again.

Defined cases: a null text is an empty one; a document without words fails only
``few_words``; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from helixspan.llm.texts import WORD, per_text, pick

WORDS = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rule -> failure as an SQL condition on whole-number measurements. The position is the bit.
RULES = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 40 * n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 40 * n_words",
}
#: Versioned policies: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def mask(policy: str | Iterable[str]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    order = list(RULES)
    return sum(1 << order.index(name) for name in names)


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more.

    Windows are compared by two polynomials of 64 bits over the words' hashes.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    first = codes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03)
    first ^= first >> np.uint64(29)
    first *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total = total * np.uint64(0x94D049BB133111EB) + first[k : k + n]
        total ^= total >> np.uint64(31)
    order = np.argsort(total, kind="stable")
    same = total[order[1:]] == total[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORDS.findall(text)
    seen: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if WORDS.search(line):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        n_dup,
        n_lines,
        repeated_words(words),
    )


def measure_all(texts: list[str | None]) -> list[tuple[int, ...]]:
    return [measure(text) for text in texts]


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit i is set if rule i fails."""
    measured = per_text(lambda: measure_all, ", ".join(f"{m} bigint" for m in MEASURES))
    values = pick(docs, "doc_id", "text").select("doc_id", measured("text").alias("m")).select(
        "doc_id", "m.*"
    )
    bits = " + ".join(f"if({failure}, {1 << i}L, 0L)" for i, failure in enumerate(RULES.values()))
    return values.withColumn("failed", F.expr(bits))


def fails(policy: str | Iterable[str], failed: Column | str = "failed") -> Column:
    """True where the ledger's bits reject under the policy."""
    column = F.col(failed) if isinstance(failed, str) else failed
    return column.bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(entries: DataFrame, policy: str | Iterable[str] = "v1") -> DataFrame:
    """Per rule of the policy: rejected by it, and kept if only that rule were left out."""
    names = POLICIES[policy] if isinstance(policy, str) else tuple(policy)
    hit = F.col("failed").bitwiseAND(F.lit(mask(names)).cast("long"))
    sums = entries.agg(
        F.count(F.lit(1)).alias("docs"),
        *[F.count_if(hit.bitwiseAND(F.lit(mask([n])).cast("long")) != 0).alias(f"f_{n}") for n in names],
        *[F.count_if(hit == mask([n])).alias(f"o_{n}") for n in names],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                F.col(f"f_{n}").alias("failed"),
                F.col(f"o_{n}").alias("kept_without"),
                F.col("docs"),
            )
            for n in names
        ]
    )
    return sums.select(F.inline(rows))


def judge(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with the verdicts of the base rules and of a policy."""
    return ledger(docs).withColumns({"base_failed": fails("base"), "kept": ~fails(policy)})


#: DuckDB SQL for judge with policy v1.
ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), l AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM (
    SELECT r, line, count(*) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line) GROUP BY r
), g AS (
  SELECT r, i, words[i:i + 7] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), d AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1
), p AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT r, i, unnest(range(0, 8)) AS k FROM d) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines,
    coalesce(p.n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN l USING (r) LEFT JOIN p USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
       OR 100 * n_symbols > 40 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""
