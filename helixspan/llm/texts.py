"""Helpers that the operators on whole texts share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Word pattern of the contracts: everything between ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts that one call of a text function gets; the result of a slice is small.
SLICE = 512
#: Characters of the texts that are worked off together, where slices go by size.
SLICE_CHARS = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this name, also if others differ from it by case only."""
    same = [c for c in df.columns if c.lower() == name.lower()]
    if same == [name]:
        return df[name]
    if same.count(name) != 1:
        raise ValueError(f"one column named {name} is needed, found {same}")
    position = df.columns.index(name)
    # Names that differ by case only are ambiguous, positions are not.
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return renamed[f"c{position}"]


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns; safe with extra columns whose names differ by case only."""
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[df[n] for n in names])
    places = [df.columns.index(n) for n in names]
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return renamed.select(*[renamed[f"c{p}"].alias(n) for p, n in zip(places, names, strict=True)])


def boxed(df: DataFrame, box: str = "row") -> DataFrame:
    """All columns inside one struct, so that added columns cannot clash with them."""
    fields = [f"c{i}" for i in range(len(df.columns))]
    renamed = df.toDF(*fields)
    return renamed.select(F.struct(*[renamed[f] for f in fields]).alias(box))


def in_box(names: list[str], name: str, box: str = "row") -> Column:
    return F.col(f"{box}.c{names.index(name)}")


def unboxed(
    df: DataFrame, names: list[str], box: str = "row", new: dict[str, Column] | None = None
) -> DataFrame:
    """The columns of the struct under their own names again; ``new`` replaces some."""
    new = new or {}
    return df.select(
        *[new.get(n, F.col(f"{box}.c{i}")).alias(n) for i, n in enumerate(names)]
    )


def smallest(df: DataFrame, order: str, n: int, rows: int) -> DataFrame:
    """The ``n`` rows with the smallest hash ``order``, a uniform long, of about ``rows`` rows.

    Hashes that are too large to be among them with any likelihood are left out before the
    tasks send their smallest ones, so the driver sees about 4 n rows however many tasks
    there are.
    """
    share = min(1.0, (4.0 * n + 1000) / max(1, rows))
    bar = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    return df.where(F.col(order) <= bar).orderBy(order).limit(n)


def parts_by_size(texts: pd.Series, chars: int = SLICE_CHARS) -> Iterator[range]:
    """Positions of consecutive texts of about ``chars`` characters, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) if isinstance(text, str) else 0
        if size >= chars:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def per_text(
    make: Callable[[], Callable[[list[str | None]], list[tuple]]], schema: str
) -> Callable[..., Column]:
    """A column function from text to a struct.

    ``make`` runs once per task and returns a function from a list of texts to a list
    of tuples in the order of ``schema``. Spark bounds the bytes of an Arrow batch; a
    batch is worked off in slices so that only one slice is held as Python objects.
    """
    fields = [part.strip().split(" ")[0] for part in split_ddl(schema)]

    @F.pandas_udf(f"struct<{', '.join(':'.join(p.split(' ', 1)) for p in split_ddl(schema))}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = make()
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, len(batch), SLICE):
                part = batch.iloc[at : at + SLICE]
                rows += work([x if isinstance(x, str) else None for x in part])
            yield pd.DataFrame(rows, columns=fields)

    return run


def split_ddl(schema: str) -> list[str]:
    """Fields of a flat DDL string; commas inside <> do not split."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(schema[start:i].strip())
            start = i + 1
    return [*parts, schema[start:].strip()]
