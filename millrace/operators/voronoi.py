"""Cells of seeds on a pixel grid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.nearest import knn_join


def voronoi_cells(seeds: DataFrame, width: int, height: int) -> DataFrame:
    """``(px, py, owner)``: nearest seed ``(id, x, y)``, ties to the lower id.

    A pixel with no seed closer than the grid diagonal gets -1.
    """
    pixels = seeds.sparkSession.range(width * height).select(
        "id", F.array((F.col("id") % width).cast("double"), F.floor(F.col("id") / width).cast("double")).alias("x"))
    points = seeds.select("id", F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("x"))
    near = knn_join(pixels, points, 1)
    diagonal = math.hypot(width - 1, height - 1)
    return near.select(
        (F.col("qid") % width).cast("int").alias("px"), F.floor(F.col("qid") / width).cast("int").alias("py"),
        F.when(F.col("dist") < diagonal, F.col("cid")).otherwise(-1).alias("owner"))


def cell_areas(cells: DataFrame) -> DataFrame:
    return cells.groupBy("owner").agg(F.count(F.lit(1)).alias("area"))


def voronoi_neighbours(cells: DataFrame) -> DataFrame:
    """``(a, b, border)``: owners of pixels side by side, with the number of shared edges."""
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (0, 1))])
    here = cells.select("owner", "px", "py", F.explode(steps).alias("s")).select(
        F.col("owner").alias("o"), (F.col("px") + F.col("s.dx")).alias("px"), (F.col("py") + F.col("s.dy")).alias("py"))
    met = here.join(cells, ["px", "py"]).where(F.col("o") != F.col("owner"))
    return met.groupBy(F.least("o", "owner").alias("a"), F.greatest("o", "owner").alias("b")).agg(
        F.count(F.lit(1)).alias("border"))
