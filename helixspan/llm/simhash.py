"""Near-duplicate components of SimHash fingerprints.

A bit of a fingerprint is set if it is set in more than half of the hashes of a text's
shingles of three words. Fingerprints are mapped to points: every two bits are a segment,
and their number of set bits a coordinate. The Manhattan distance of two points never
exceeds the number of bits in which the fingerprints differ, so points further apart than
``DISTANCE`` need no test.

The points meet in a grid. Of two points within three steps one half of the coordinates
is at most one step apart, so each half is a grid of its own, whose cells are the points
of that half. A fingerprint has its home cell and the cells one step up; a pair with one
step between them meets in the home of the higher one. Whatever meets is tested bit by
bit.

Copies are one fingerprint. In every cell the members are first linked to the one with the
most documents; cells with a single component are then done. In the others the members
outside the largest component meet the members of other components. Where these are many,
they are also dealt by the number of set bits in the four bytes of the other half, one of
which must agree. So a large group of near copies is no list of all its pairs, and no link
between components is lost.

Defined cases: a null text is an empty one; a text without words has fingerprint zero and
is linked like any other; one of fewer than three words is one shingle; a null id never
names a component unless no document of it has one (then null); repeated rows are copies;
an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from helixspan.llm.components import connected_components
from helixspan.llm.texts import parts_by_size, pick
from helixspan.session import hand_over

SHINGLE = 3
SEED = 42
#: Bits in which linked fingerprints may differ. The grid below is made for this number.
DISTANCE = 3
#: Hashes whose bits are counted at once.
HASHES = 1 << 16
#: Segments of a half of the bits, bytes of a half, and the low bits of its segments.
SEGMENTS, BYTES, LOW = 16, 4, 0x55555555
#: Tests in a cell from which on its members are dealt by the other half as well.
WIDE = 1 << 16

LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def hashes(text: str) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, in blocks. Blanks are the six of ASCII, as ``bytes.split`` has them."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return
    line = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(SHINGLE, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES):
        block = zip(starts[at : at + HASHES], ends[at : at + HASHES], strict=True)
        yield np.array([digest(line[a:b], SEED) for a, b in block], np.uint64)


def fingerprint(text: str | None) -> int:
    """As a signed number of 64 bits."""
    total, ones = 0, np.zeros(64, np.int64)
    for found in hashes(text or ""):
        total += len(found)
        bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    made = [fingerprint(texts.iat[i]) for part in parts_by_size(texts) for i in part]
    return pd.Series(made, dtype="int64")


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def half_points(value: str) -> list[Column]:
    """Coordinates of both halves, two bits each: a segment's bits minus its upper bit."""
    low = F.lit(0xFFFFFFFF)
    halves = [F.col(value).bitwiseAND(low), F.shiftrightunsigned(value, 32).bitwiseAND(low)]
    return [h - F.shiftrightunsigned(h, 1).bitwiseAND(F.lit(LOW)) for h in halves]


def grid(prints: DataFrame) -> DataFrame:
    """(cell, home) besides the columns of ``prints``: own cells, and those one step up.

    ``cell`` is a half's number above its coordinates.
    """
    one = F.lit(1).cast("long")
    rows = []
    for i, point in enumerate(half_points("print")):
        mark = F.lit(i << 32).cast("long")
        rows.append(F.struct((mark + point).alias("cell"), F.lit(True).alias("home")))
        for s in range(SEGMENTS):
            room = F.shiftrightunsigned(point, 2 * s).bitwiseAND(F.lit(3)) < 2
            up = mark + point + F.shiftleft(one, 2 * s)
            row = F.struct(up.alias("cell"), F.lit(False).alias("home"))
            rows.append(F.when(room, row))
    return prints.select("*", F.inline(F.array_compact(F.array(*rows))))


def met_in_cells(prints: DataFrame) -> DataFrame:
    """The grid without cells in which nobody meets, written down."""
    cells = hand_over(grid(prints), "grid")
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("used"))
    return hand_over(cells.join(hand_over(shared.where("n > 1 AND used").select("cell"), "shared"), "cell"), "cells")


def star_links(cells: DataFrame) -> DataFrame:
    """Links (a, b) between the members of a cell and its home member with the most documents."""
    weight = F.struct("n_docs", "print")
    pivots = hand_over(cells.where("home").groupBy("cell").agg(F.max(weight).alias("pivot")), "pivots")
    near = cells.join(pivots, "cell").select("print", F.col("pivot.print").alias("pivot"))
    return near.where((F.col("print") != F.col("pivot")) & (differing("print", "pivot") <= DISTANCE)).select(
        F.col("pivot").alias("a"), F.col("print").alias("b")
    )


def cross_links(cells: DataFrame, labels: DataFrame, wide: int = WIDE) -> DataFrame:
    """All links between members of different components, as far as they share a cell."""
    placed = hand_over(
        cells.join(labels, cells["print"] == labels["node"], "left").select(
            "cell", "home", "print", F.coalesce("component", "print").alias("component")
        ),
        "placed",
    )
    sizes = placed.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("cell").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"))
    tests = (F.col("all") - F.col("main.n")).cast("double") * F.col("all")
    open_ = main.where("main.n < all").select(
        "cell", F.col("main.component").alias("main"), (tests > wide).alias("wide")
    )
    rows = placed.join(hand_over(open_, "open"), "cell").withColumn("outside", F.col("component") != F.col("main"))
    rows = hand_over(rows.select("cell", "home", "print", "component", "outside", "wide"), "members")
    first, second = half_points("print")
    rest = F.when(F.col("cell") < 1 << 32, second).otherwise(first)
    ones = [F.shiftrightunsigned(rest, 8 * g).bitwiseAND(F.lit(255)) for g in range(BYTES)]
    dealt = rows.where("wide").select("*", F.posexplode(F.array(*ones)).alias("byte", "ones"))
    keys = ["cell", "byte", "ones"]
    narrow = links_between(rows.where("NOT wide"), keys[:1])
    return narrow.unionByName(links_between(hand_over(dealt, "dealt"), keys)).distinct()


def links_between(members: DataFrame, keys: list[str]) -> DataFrame:
    """Links (a, b) of members outside their cell's largest component with other components."""
    one, other = members.where("outside").alias("o"), members.alias("m")
    meet = (
        (F.col("o.component") != F.col("m.component"))
        & (F.col("o.home") | F.col("m.home"))
        & (~F.col("m.outside") | (F.col("o.print") < F.col("m.print")))
        & (differing("o.print", "m.print") <= DISTANCE)
    )
    for key in keys:
        meet = (F.col(f"o.{key}") == F.col(f"m.{key}")) & meet
    return one.join(other, meet).select(F.col("o.print").alias("a"), F.col("m.print").alias("b"))


def print_components(prints: DataFrame, wide: int = WIDE) -> DataFrame:
    """(node, component) of all fingerprints with a link; ``prints`` has print (distinct), n_docs."""
    cells = met_in_cells(prints)
    links = hand_over(star_links(cells).distinct(), "links")
    labels = hand_over(connected_components(links, "a", "b"), "labels")
    more = hand_over(cross_links(cells, labels, wide), "links")
    return hand_over(connected_components(links.unionByName(more), "a", "b"), "labels")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id per document."""
    made = pick(docs, "doc_id", "text").select("doc_id", fingerprints("text").alias("print"))
    rows = hand_over(made, "fingerprints")
    prints = hand_over(
        rows.groupBy("print").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first")), "prints"
    )
    labels = print_components(prints.select("print", "n_docs"))
    placed = hand_over(
        prints.join(labels, prints["print"] == labels["node"], "left").select(
            "print", "first", F.coalesce("component", "print").alias("component")
        ),
        "placed",
    )
    least = hand_over(placed.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    named = hand_over(placed.join(least, "component").select("print", "component_id"), "named")
    digits = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return rows.join(named, "print").select("doc_id", digits, "component_id")
