"""Values at exact ranks of large groups, without sorting a group in one place.

Values are counted by map-side aggregation, then by coarse buckets, of which each group has a bounded number; only the buckets that hold a
wanted rank are looked into.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets to a factor of e.
FINE = 64


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """keys, n (values that aren't null) and, for each name, the value at rank ranks[name](n), counted from 0 in ascending order.

    Null keys are a group of their own; a group without values has no row; a rank that isn't there gives null.
    """
    known = [F.col(k).alias(f"_{k}") for k in keys]
    v = F.col(value).cast("double")
    counted = df.where(v.isNotNull()).groupBy(*known, v.alias("_v")).agg(F.count("*").alias("_c"))
    place = F.signum("_v") * F.floor(F.log(F.abs("_v") + F.lit(1e-12)) * FINE + F.lit(40.0 * FINE))
    counted = counted.withColumn("_b", F.when(F.col("_v") == 0, 0).otherwise(place).cast("long"))
    group = [f"_{k}" for k in keys]
    buckets = counted.groupBy(*group, "_b").agg(F.sum("_c").alias("_m"))
    w = Window.partitionBy(*group)
    buckets = buckets.withColumns({"_before": F.coalesce(F.sum("_m").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "n": F.sum("_m").over(w)})
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), f(F.col("n")).cast("long").alias("rank")) for name, f in ranks.items()]))
    picked = buckets.withColumn("_w", wanted).where((F.col("_w.rank") >= F.col("_before")) & (F.col("_w.rank") < F.col("_before") + F.col("_m")))
    picked = picked.select(*[F.col(g).alias(f"{g}_") for g in group], F.col("_b").alias("_b_"), "n", F.col("_w.name").alias("_name"), (F.col("_w.rank") - F.col("_before")).alias("_rank"))
    same = F.col("_b") == F.col("_b_")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_"))
    inner = counted.join(picked, same)
    inside = Window.partitionBy(*group, "_name").orderBy("_v")
    inner = inner.withColumn("_to", F.sum("_c").over(inside))
    hit = inner.where((F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("_c")))
    found = hit.groupBy(*group, "n").agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])
    return found.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], "n", *ranks)


def between(share: float) -> dict[str, Callable[[Column], Column]]:
    """The two ranks around a share of the way from the first to the last value, named for interpolated()."""
    name = f"q{share}".replace(".", "_")
    return {f"{name}_a": lambda n: F.floor((n - 1) * share), f"{name}_b": lambda n: F.ceil((n - 1) * share)}


def interpolated(share: float) -> Column:
    """The linear interpolation between the values that at_ranks found for between(share)."""
    name = f"q{share}".replace(".", "_")
    a, b, at = F.col(f"{name}_a"), F.col(f"{name}_b"), (F.col("n") - 1) * share
    return a + (b - a) * (at - F.floor(at))
