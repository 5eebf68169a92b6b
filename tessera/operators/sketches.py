"""Quantile sketches kept as files: one for each group and part, merged when they are asked.

A sketch (Karnin, Lang and Liberty's, by Spark's own functions) has a size that does not grow with what
it saw. Its ranks are off by at most about 2.3 / size of the count at 99 % confidence, and by nothing
while it saw fewer values than its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialise


def write(rows: DataFrame, by: list[str], value: str, part: str, folder: str, size: int = 1024) -> None:
    """Append (by, part, n, total, sketch) of each group and part to folder; nulls and NaN are left out."""
    v = F.col(value).cast("double")
    found = rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*by, part)
    table = found.agg(F.count("*").alias("n"), F.sum(v).alias("total"), F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))
    table.write.mode("append").option("compression", "zstd").parquet(folder)


def merged(parts: DataFrame, by: list[str], size: int | None = None) -> DataFrame:
    """(by, n, total, sketch) over all parts: sketches merge in tasks before they are shuffled."""
    merge = F.kll_merge_agg_double("sketch", F.lit(size)) if size else F.kll_merge_agg_double("sketch")
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), merge.alias("sketch"))


def quantiles(parts: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """(by, n, mean, one column a point) from stored sketches."""
    at = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name) for name, q in points.items()]
    return merged(parts, by).select(*by, "n", F.round(F.col("total") / F.col("n"), 6).alias("mean"), *at)


def exact_quantiles(rows: DataFrame, parts: DataFrame, by: list[str], value: str, points: dict[str, float], size: int, spare: float = 3.0) -> DataFrame:
    """(by, n, mean, one column a point): the least value v of each group (not null) for which n * point values
    or more are at most v. rows are those that the stored sketches saw.

    Each sketch gives a value below and one above the point by `spare` / size of the count, more than its
    error. One pass over rows counts what is below them, and the values between by their own; running
    sums of those find the place. A place outside the bounds, which the error allows for once in a great
    many points, makes the group be counted in full.
    """
    v, error = F.col(value).cast("double"), spare / size
    sound = rows.where(v.isNotNull() & ~F.isnan(v)).select(*by, v.alias("__v"))
    at = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, p))))
    bound = lambda p, edge, least: F.lit(edge) if p == least else at(p)
    place = lambda p: F.greatest(F.lit(1), F.ceil(F.round(F.col("n") * F.lit(p), 6)))
    asked = [F.struct(F.lit(name).alias("point"), place(p).cast("long").alias("place"), bound(max(0.0, p - error), float("-inf"), 0.0).alias("low"), bound(min(1.0, p + error), float("inf"), 1.0).alias("high")) for name, p in points.items()]
    known = materialise(merged(parts, by).select(*by, "n", "total", F.explode(F.array(*asked)).alias("a")).select(*by, "n", "total", "a.*"), "bounds")  # a row a group and point

    def settled(bounds: DataFrame) -> DataFrame:
        met = sound.join(F.broadcast(bounds), by).where(F.col("__v") <= F.col("high"))  # groups are few, as their sketches are
        counts = met.groupBy(*by, "point", "place", F.when(F.col("__v") >= F.col("low"), F.col("__v")).alias("__v")).agg(F.count("*").alias("c"))
        upto = F.sum("c").over(Window.partitionBy(*by, "point").orderBy(F.asc_nulls_first("__v")))
        reached = counts.withColumn("upto", upto).where("upto >= place")
        return reached.groupBy(*by, "point").agg(F.min_by("__v", "upto").alias("q"))

    first = materialise(settled(known), "settled")
    missed = known.join(first.where("q IS NOT NULL").select(*by, "point"), [*by, "point"], "left_anti").withColumns({"low": F.lit(float("-inf")), "high": F.lit(float("inf"))})
    missed = materialise(missed, "missed")
    found = first.where("q IS NOT NULL") if missed.isEmpty() else first.where("q IS NOT NULL").unionByName(settled(missed))
    wide = known.join(found, [*by, "point"]).groupBy(*by, "n", "total").agg(*[F.max(F.when(F.col("point") == name, F.col("q"))).alias(name) for name in points])
    return wide.select(*by, "n", F.round(F.col("total") / F.col("n"), 6).alias("mean"), *points)
