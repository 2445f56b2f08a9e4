"""Fill-in-middle rearrangement of whole texts.

A text is a sequence of units: runs of ASCII letters, and every other code point by
itself. Two hashed unit counts cut it into prefix, middle and suffix. The code points lie
in blocks of fixed length; a Fenwick tree over the blocks holds how many units start in
them and how many code points they have. A cut after u units is found by descending the
tree along powers of two to the block where unit u + 1 starts; only that block is looked
at code point by code point. A run that goes on over several blocks starts in one of them.

Defined cases: a null text is an empty one, and empty texts or texts that contain a marker
stay plain; a null id is hashed as the empty string; rows with equal id and text are cut
alike; very long texts only add blocks; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from helixspan.llm.texts import parts_by_size, pick

#: The markers of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points of a block.
BLOCK = 1024
#: Of 100 texts stay so many plain, and of 100 others begin so many with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = 1


class BlockTree:
    """Fenwick tree over the blocks of a text, with units and code points per block."""

    def __init__(self, text: str, block: int = BLOCK):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = (points | 32) - np.uint32(97) < 26
        self.starts = ~letter
        self.starts[:1] = True
        self.starts[1:] |= ~letter[:-1]
        self.block = block
        self.points = len(points)
        blocks = -(-len(points) // block)
        edges = np.arange(0, blocks * block, block)
        units = np.add.reduceat(self.starts, edges, dtype=np.int64) if blocks else np.zeros(0, np.int64)
        sizes = np.minimum(block, len(points) - edges)
        self.units = int(units.sum())
        # Node i covers the blocks from i minus its lowest bit, so it is a difference of running sums.
        node = np.arange(1, blocks + 1)
        below = node - (node & -node)
        self.tree = []
        for values in (units, sizes):
            upto = np.concatenate([[0], np.cumsum(values)])
            self.tree.append([0, *(upto[node] - upto[below]).tolist()])

    def cut(self, units: int) -> int:
        """Code points before the end of so many units."""
        if units >= self.units:
            return self.points
        held, lengths = self.tree
        at, left, before = 0, units, 0
        step = 1 << ((len(held) - 1).bit_length() - 1)
        while step:
            to = at + step
            if to < len(held) and held[to] <= left:
                at, left, before = to, left - held[to], before + lengths[to]
            step >>= 1
        local = np.flatnonzero(self.starts[before : before + self.block])
        return before + int(local[left])


def hashes(doc_id, seed: int = SEED) -> list[int]:
    """Four unsigned numbers of 32 bits from the id."""
    key = f"{seed}:{'' if doc_id is None else int(doc_id)}"
    digest = hashlib.sha256(key.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def rearrange(doc_id, text: str, seed: int = SEED, block: int = BLOCK):
    """(units, form, prefix_chars, middle_chars, output) of a text."""
    tree = BlockTree(text, block)
    h1, h2, h3, h4 = hashes(doc_id, seed)
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not text or marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        return tree.units, "plain", None, None, text
    low, high = sorted((h1 % (tree.units + 1), h2 % (tree.units + 1)))
    a, b = tree.cut(low), tree.cut(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_PERCENT:
        form, output = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, output = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return tree.units, form, a, b - a, output


def rebuild(output: str, form: str) -> str:
    """The text from output and form alone; the parts contain no marker."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    first, _, rest = output[len(PREFIX) :].partition(second)
    other, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (first, other) if form == "psm" else (other, first)
    return prefix + middle + suffix


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def rearranged(docs: DataFrame, seed: int, names: str, finish) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and what ``finish`` makes of output and form."""
    fields = "n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint," + names
    columns = [part.split(":")[0] for part in fields.split(",")]

    @F.pandas_udf(f"struct<{fields}>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            rows = []
            for part in parts_by_size(texts):
                for i in part:
                    text = texts.iat[i] if isinstance(texts.iat[i], str) else ""
                    doc_id = ids.iat[i]
                    *head, output = rearrange(None if doc_id == "" else doc_id, text, seed)
                    rows.append((*head, *finish(output, head[1])))
            made = pd.DataFrame(rows, columns=columns)
            for c in ("n", "prefix_chars", "middle_chars"):
                made[c] = made[c].astype("Int64")
            yield made

    # As text, because a null would turn long ids into doubles in pandas.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    taken = pick(docs, "doc_id", "text")
    return taken.select("doc_id", run(key, F.col("text")).alias("made")).select("doc_id", "made.*")


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output per document."""
    return rearranged(docs, seed, "output:string", lambda output, form: (output,))


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` with column text, rebuilt from the columns output and form."""

    @F.pandas_udf("string")
    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([rebuild(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return rows.withColumn("text", run("output", "form"))


def digest_table(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Digests of output and rebuilt text instead of the texts themselves."""

    def both(output: str, form: str) -> tuple[str, str]:
        return sha256(output), sha256(rebuild(output, form))

    return rearranged(docs, seed, "output_sha256:string,restored_sha256:string", both)


#: DuckDB SQL for digest_table with the default parameters.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x
  FROM documents
), h AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
    CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high
  FROM h
), p AS (
  SELECT *, array_to_string(list_slice(u, 1, low), '') AS prefix,
    array_to_string(list_slice(u, low + 1, high), '') AS middle,
    array_to_string(list_slice(u, high + 1, n), '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
