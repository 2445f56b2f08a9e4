"""Key comparison shared by operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def same_keys(
    left: str, right: str, columns: Sequence[str], required: Sequence[str] = ()
) -> Column:
    """Equality of the named columns of two aliases, usable as hash join keys.

    Nulls match nulls (GWAS rows have no phenotype or tissue, and belong together),
    except in ``required`` columns.
    """
    matches = []
    for name in columns:
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        matches.append(a == b if name in required else a.eqNullSafe(b))
    return reduce(lambda x, y: x & y, matches)
