"""Medians over sections against the plain definition."""

import math
import random
from statistics import median

import pytest

from helixspan.operators import genes, quantiles


def found(df, group=("g",)):
    return {tuple(r[c] for c in group): r["median"] for r in quantiles.medians(df, list(group), "v").collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_the_plain_median(table, seed):
    rng = random.Random(seed)
    rows = [("hot", rng.randrange(10**6)) for _ in range(2000 + seed)]
    rows += [(f"g{rng.randrange(40)}", rng.choice([1, 1, 1, 2, 9])) for _ in range(1000)]
    groups = {}
    for g, v in rows:
        groups.setdefault((g,), []).append(v)
    assert found(table(rows, "g string, v long")) == {g: float(median(v)) for g, v in groups.items()}


def test_a_hot_group_is_cut_into_sections(spark, table):
    """All rows in one group: several sections, none with most of the values."""
    rows = [("hot", i * 7919 % 100003) for i in range(20000)]
    df = table(rows, "g string, v long")
    from helixspan.operators.ordered import range_sections

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in range_sections(df, ["g"], ["v"]).groupBy("_section").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 10000
        assert found(df) == {("hot",): float(median(v for _, v in rows))}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_one_value_repeated_is_one_row_before_the_shuffle_by_range(table):
    assert found(table([("a", 5)] * 5000 + [("a", 1), ("a", 9)], "g string, v long")) == {("a",): 5.0}


def test_nulls_nan_ties_and_no_rows(table):
    rows = [("a", None), (None, 2.0), (None, 4.0), ("b", math.nan), ("b", 1.0), ("b", 1.0), ("c", -0.5)]
    assert found(table(rows, "g string, v double")) == {(None,): 3.0, ("b",): 1.0, ("c",): -0.5}
    assert found(table([], "g string, v double")) == {}


def test_over_the_whole_table_and_clashing_names(table):
    df = table([("a", 3), ("b", 1), ("c", 2)], "g string, v long")
    assert [r["median"] for r in quantiles.medians(df, [], "v").collect()] == [2.0]
    with pytest.raises(ValueError):
        quantiles.medians(df, ["v"], "v")


def test_summary_and_pivot_use_them(table):
    counts = table(
        [("d1", "eQTL", "t", 1), ("d2", "eQTL", "t", 4), ("d3", "sQTL", "t", 10), ("d3", "sQTL", None, 7)],
        "dataset string, type string, threshold string, count long",
    )
    summary = {r["threshold"]: (r["total_count"], r["median_count"]) for r in genes.threshold_summary(counts).collect()}
    assert summary == {"t": (15, 4.0), None: (7, 7.0)}
    wide = {r["threshold"]: (r["eQTL"], r["sQTL"]) for r in genes.pivot_by_type(counts, "median").collect()}
    assert wide == {"t": (2.5, 10.0), None: (None, 7.0)}
