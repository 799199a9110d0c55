"""Joins. Sides are broadcast by AQE from measured sizes, never by guess."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import double_array
from millrace.session import cut

WIDE = 8   # coordinates from which on distances are loops


def join_inner(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "inner")


def join_left(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left")


def semi_join_in_set(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti_join_unseen(df: DataFrame, seen: DataFrame, on: list[str]) -> DataFrame:
    return df.join(seen, on, "left_anti")


def attach_group_count(df: DataFrame, by: list[str], out: str = "group_size") -> DataFrame:
    """Size of the row's group as a column.

    Counts are combined before the shuffle and joined back; a window would bring a
    hot group into one task.
    """
    return df.join(df.groupBy(*by).agg(F.count(F.lit(1)).alias(out)), by)


def nearest_center(centers: list[list[float]], coords: list[str]) -> Column:
    """Struct ``(d2, idx)`` of the nearest centre, ties to the lowest index.

    ``centers`` is a model held on the driver, so rows are not shuffled.
    """
    options = []
    for i, center in enumerate(centers):
        if len(coords) > WIDE:
            # a loop over the coordinates; spelt out, so many terms would not compile
            gaps = F.transform(F.zip_with(F.array(*coords), double_array(center), lambda x, m: x - m), lambda g: g * g)
            options.append(F.struct(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g).alias("d2"), F.lit(i).alias("idx")))
        else:
            gaps = [f"(`{c}` - double('{float(v)!r}'))" for c, v in zip(coords, center)]
            d2 = " + ".join(["0D", *[f"{g} * {g}" for g in gaps]])
            options.append(F.expr(f"struct({d2} AS d2, {i} AS idx)"))
    return F.array_min(F.array(*options))


def nearest_center_join(df: DataFrame, centers: list[list[float]], coords: list[str]) -> DataFrame:
    return df.withColumn("_near", nearest_center(centers, coords)).select(
        *df.columns, F.col("_near.idx").alias("center"), F.sqrt("_near.d2").alias("dist"))


def grid_cell(coords: list[str], side: float) -> Column:
    return F.expr("array(" + ", ".join(f"CAST(floor(`{c}` / double('{float(side)!r}')) AS BIGINT)" for c in coords) + ")")


def neighbour_cells(cell: str, dims: int, reach: int = 1, skip_own: bool = False) -> Column:
    """The cells at most ``reach`` steps away in every dimension, as an array of cells."""
    offsets = [o for o in itertools.product(range(-reach, reach + 1), repeat=dims) if not (skip_own and not any(o))]
    cells = ("array(" + ", ".join(f"{cell}[{i}] + {o[i]}L" for i in range(dims)) + ")" for o in offsets)
    return F.expr(f"array({', '.join(cells)})")


def euclid(left: str, right: str, coords: list[str]) -> Column:
    gaps = [f"({left}.`{c}` - {right}.`{c}`)" for c in coords]
    return F.expr("sqrt(" + " + ".join(["0D", *[f"{g} * {g}" for g in gaps]]) + ")")


def epsilon_range_join(df: DataFrame, key: str, coords: list[str], eps: float, cell_rows: int = 4_000) -> DataFrame:
    """Pairs ``(a, b, dist)`` with ``a < b`` at most ``eps`` apart, for up to three dimensions.

    Points meet through grid cells of side eps: one side goes to its own cell, the
    other to the surrounding ones. Every cell is cut by its own counts: into as many parts as it has ``cell_rows`` points on
    either side, so a part of points meets a part of surrounding points, and only the rows of full cells are copied.
    """
    if len(coords) > 3:
        raise ValueError("grid cells serve up to 3 dimensions; use nearest.pairs_within")
    placed = df.select(key, *coords).withColumn("_cell", grid_cell(coords, eps))
    # cells without points of their own meet nobody
    inside = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    near = placed.withColumn("_cell", F.explode(neighbour_cells("_cell", len(coords))))
    around = inside.withColumn("_from", F.explode(neighbour_cells("_cell", len(coords)))).join(
        inside.select(F.col("_cell").alias("_from"), F.col("_n").alias("_m")), "_from").groupBy("_cell", "_n").agg(F.sum("_m").alias("_m"))
    parts = cut(around.select("_cell", F.ceil(F.col("_n") / cell_rows).cast("int").alias("_ls"), F.ceil(F.col("_m") / cell_rows).cast("int").alias("_rs")))

    def dealt(rows: DataFrame, mine: str, other: str) -> DataFrame:
        return rows.join(parts, "_cell").withColumns({f"{mine}": F.pmod(F.xxhash64(key), F.col(f"{mine}s")).cast("int")}).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).drop("_ls", "_rs")

    joined = dealt(placed, "_l", "_r").alias("l").join(dealt(near, "_r", "_l").alias("r"), on=[
        F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("_cell", "_l", "_r")] + [F.col(f"l.{key}") < F.col(f"r.{key}")])
    return joined.select(F.col(f"l.{key}").alias("a"), F.col(f"r.{key}").alias("b"),
                         euclid("l", "r", coords).alias("dist")).where(F.col("dist") <= eps)
