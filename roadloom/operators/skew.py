"""Joins for keys of which one may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.storage import Scratch


def relay_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Column, fan: int = 64) -> DataFrame:
    """Left outer join of ``left``, where a key may be very frequent, to ``right``, which has one row per key.

    The rows of a key are spread over ``fan`` salts by ``spread``. The distinct (key, salt) pairs, at most ``fan`` per
    key and formed in part before the shuffle, fetch the right row; the left rows then meet it by (key, salt). No task
    sees more than 1/fan of a key, and the right side is copied only to salts that occur. A null key matches nothing.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(fan)).cast("int"))
    relays = salted.select(*keys, "_salt").where(F.expr(" and ".join(f"`{k}` is not null" for k in keys))).distinct()
    carried = relays.join(right, list(keys), "inner")
    return salted.join(carried, [*keys, "_salt"], "left").drop("_salt")


def numbered(df: DataFrame, scope: str, order: Sequence[str | Column], name: str) -> DataFrame:
    """Adds ``name``: 1, 2, 3 ... within each scope by ``order``, though one scope may hold a large part of all rows.

    Rows are put in ranges of (scope, order), so that a large scope is several ranges; each range numbers its own rows, and
    is shifted by the sizes of the scope's ranges before it. The ranges are written first, since they must not change
    between counting and numbering. Rows that tie in ``order`` take any order among them; null scopes are one scope.
    """
    store = Scratch(df.sparkSession, "numbered")
    ranges = store.save(df.repartitionByRange(F.col(scope), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy(scope, "_range").agg(F.count("*").alias("_n"))
    shift = sizes.select(F.col(scope).alias("_scope"), F.col("_range").alias("_of"), (F.sum("_n").over(Window.partitionBy(scope).orderBy("_range")) - F.col("_n")).alias("_shift"))
    own = ranges.withColumn(name, F.row_number().over(Window.partitionBy(scope, "_range").orderBy(*order)))
    own = own.join(shift, F.col(scope).eqNullSafe(F.col("_scope")) & (F.col("_range") == F.col("_of")))
    return own.withColumn(name, (F.col(name) + F.col("_shift")).cast("bigint")).drop("_range", "_scope", "_of", "_shift")
