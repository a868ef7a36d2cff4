"""Pixel tables (x, y, channel, value): channel normalisation, composites and downsampling as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise(pixels: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """``pixels`` with scaled: per channel 0..1 between two percentiles of its positive values."""
    r = pixels.where("value > 0").groupBy("channel").agg(F.percentile("value", [low, high]).alias("r"))
    # a row per channel
    met = pixels.join(F.broadcast(r), "channel")
    lo, hi = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    return met.withColumn("scaled", F.least(F.greatest(F.coalesce(F.try_divide(F.col("value") - lo, hi - lo), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).drop("r")


def composite(scaled: DataFrame, roles: dict[str, str]) -> DataFrame:
    """(x, y, red, green, blue) from scaled channels by role; a colour without a channel is 0."""
    value = lambda colour: F.coalesce(F.max(F.when(F.col("channel") == roles.get(colour), F.col("scaled"))), F.lit(0.0))
    return scaled.groupBy("x", "y").agg(*[F.round(255 * value(c)).cast("int").alias(c) for c in ("red", "green", "blue")])


def downsample(pixels: DataFrame, factor: int) -> DataFrame:
    """Means of square blocks."""
    at = lambda c: F.floor(F.col(c) / factor)
    return pixels.groupBy(at("x").alias("x"), at("y").alias("y"), "channel").agg(F.avg("value").alias("value"))


def warp(pixels: DataFrame, m: list[list[float]], width: int, height: int, fill: float = 255.0) -> DataFrame:
    """Every channel on a grid of ``width`` times ``height`` pixels: (x, y, channel, value), whole numbers from below.

    ``m`` takes a pixel of the new grid to a place in ``pixels`` (the inverse of the alignment, scaled to both grids). The value there is linear between the four pixels around, which
    are met by equal (channel, x, y); a pixel that is not there counts as ``fill``, white. New rows are made in tasks, and only these and their corners are shuffled.
    """
    grid = pixels.sparkSession.range(width * height).select((F.col("id") % width).alias("x"), F.floor(F.col("id") / width).alias("y"))
    at = lambda row: row[0] * F.col("x") + row[1] * F.col("y") + row[2]
    # coordinates that are whole but for rounding count as whole
    grid = grid.select("x", "y", F.round(at(m[0]), 9).alias("sx"), F.round(at(m[1]), 9).alias("sy"))
    fx, fy = F.col("sx") - F.floor("sx"), F.col("sy") - F.floor("sy")

    def corner(i: int, j: int) -> Column:
        w = (fx if i else 1 - fx) * (fy if j else 1 - fy)
        return F.struct((F.floor("sx") + i).alias("px"), (F.floor("sy") + j).alias("py"), w.alias("w"))

    near = grid.select("x", "y", F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])).alias("c")).select("x", "y", "c.*").where("w > 0")
    # a row per channel
    near = near.crossJoin(F.broadcast(pixels.select("channel").distinct()))
    seen = pixels.select("channel", F.col("x").cast("long").alias("px"), F.col("y").cast("long").alias("py"), F.col("value").alias("v"))
    met = near.join(seen, ["channel", "px", "py"], "left")
    mixed = met.groupBy("x", "y", "channel").agg(F.sum(F.col("w") * F.coalesce("v", F.lit(float(fill)))).alias("v"))
    return mixed.select("x", "y", "channel", F.floor(F.round("v", 6)).alias("value"))
