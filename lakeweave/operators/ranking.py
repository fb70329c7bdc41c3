"""Top-N per group, e.g. the best-selling products of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .gold import product_units

SALTS = 16


def top_n(df: DataFrame, group: list[str], value: str, ties: list[str], n: int, salts: int = SALTS) -> DataFrame:
    """The ``n`` rows of each ``group`` with the greatest ``value`` (NULL
    last; ties by ``ties``, ascending, NULL first), with their ``rank`` from 1.

    A top-n of parts merges into the top-n of the whole, so rows are cut down
    twice: within (group, salt), where Spark already drops what is beyond n
    in every map task before the shuffle (``WindowGroupLimit``), then within
    the group, over at most n rows a salt.  No task sorts a whole group.
    """
    order = [F.col(value).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*ties), F.lit(salts)).cast("int"))
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    few = salted.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= n).drop("_rank", "_salt")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= n)


def top_products(silver_orders: DataFrame, duration: str, n: int = 10, exclude_status: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` products sold most in each window (ties by product id and name).
    On an update log: ``top_n(current_state(log), ...)``."""
    units = product_units(silver_orders, duration, exclude_status=exclude_status)
    return top_n(units, ["window_start", "window_end"], "total_quantity_sold", ["product_id", "product_name"], n)
