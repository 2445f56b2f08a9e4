"""Column functions for sample descriptions and formatted numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Pattern to look for and label to report, in reporting order.
ANCESTRIES = [
    ("African", "African"),
    ("Caribbean", "Caribbean"),
    ("South Asian", "South Asian"),
    ("Asian", "Asian"),
    ("Chinese", "Chinese"),
    ("French", "French"),
    ("German", "German"),
    ("Sardinian", "Sardinian"),
    ("Hispanic", "Hispanic"),
    ("Latin", "Latino"),
    ("Korean", "Korean"),
    ("Japanese", "Japanese"),
    ("Native American", "Native American"),
    ("Finnish", "Finnish"),
    ("British", "British"),
    ("Scottish", "Scottish"),
    ("European", "European"),
]
# A label that is left out when the other one applies.
SHADOWED_BY = {"Asian": "South Asian"}


def whole_number(text: Column) -> Column:
    """'1,234' as an integer, null when it is none."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("int")


def sample_sizes(description: Column) -> dict[str, Column]:
    """Cases, controls and other samples named in a free-text description.

    Every comma-separated part gives its first number to one of the three sums;
    'cases' is looked for before 'controls'. Sums of zero are null.
    """
    parts = F.split(description, ", ")

    def total(belongs) -> Column:
        numbers = F.transform(
            F.filter(parts, belongs),
            lambda part: whole_number(F.regexp_extract(part, "([0-9,]+)", 1)),
        )
        summed = F.aggregate(numbers, F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0)))
        return F.nullif(summed, F.lit(0))

    return {
        "n_cases": total(lambda part: part.contains("cases")),
        "n_controls": total(
            lambda part: part.contains("controls") & ~part.contains("cases")
        ),
        "n_quant": total(lambda part: ~part.contains("controls") & ~part.contains("cases")),
    }


def ancestries(description: Column) -> Column:
    """Comma-joined ancestry labels found in a description ('' when none)."""
    labels = []
    for pattern, label in ANCESTRIES:
        found = description.contains(pattern)
        if label in SHADOWED_BY:
            found = found & ~description.contains(SHADOWED_BY[label])
        labels.append(F.when(found, F.lit(label)))
    return F.concat_ws(",", *labels)


def sum_of_listed(text: Column, separator: str = ";", missing: str = "-") -> Column:
    """Sum of separated integers, leaving out the missing marker."""
    numbers = F.filter(F.split(text, separator), lambda item: item != missing)
    return F.aggregate(numbers, F.lit(0), lambda acc, item: acc + item.try_cast("int"))


def total_ignoring_nulls(*counts: Column) -> Column:
    total = F.lit(0)
    for count in counts:
        total = total + F.coalesce(count, F.lit(0))
    return total
