"""Tables dealt into buckets by variant, so that joins on the variant need no shuffle.

The panel is written once in this form; a delivery that is written with the same keys and
number of buckets then meets it bucket by bucket. The bucket layout is part of a table's
entry in the catalog, which may not outlive a session, so it is also kept in a small file
beside the data and entered again where the table is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from helixspan.operators.harmonise import VARIANT
from helixspan.session import scratch_path

LAYOUT = "ddl string, keys array<string>, buckets int"


def write_bucketed(df: DataFrame, path: str, buckets: int, keys: Sequence[str] = VARIANT) -> None:
    """One sorted file per bucket. Take so many buckets that one fits into a task's memory."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the entry only; the data have their own path
    layout = [(df._jdf.schema().toDDL(), list(keys), buckets)]
    spark.createDataFrame(layout, LAYOUT).coalesce(1).write.mode("overwrite").json(f"{path}.layout")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    layout = spark.read.schema(LAYOUT).json(f"{path}.layout").first()
    name = f"bucketed_{uuid.uuid4().hex}"
    keys = ", ".join(f"`{k}`" for k in layout["keys"])
    spark.sql(
        f"CREATE TABLE {name} ({layout['ddl']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def alike_bucketed(df: DataFrame, like: str, label: str = "bucketed") -> DataFrame:
    """``df`` written down in the layout of the table at ``like`` and read again."""
    spark = df.sparkSession
    layout = spark.read.schema(LAYOUT).json(f"{like}.layout").first()
    path = scratch_path(spark, label)
    write_bucketed(df, path, layout["buckets"], layout["keys"])
    return read_bucketed(spark, path)


def rows_per_bucket(df: DataFrame, buckets: int, keys: Sequence[str] = VARIANT) -> DataFrame:
    """(bucket, n_rows) as ``write_bucketed`` would deal them, to choose a number."""
    return df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))
