"""Areas bounded by polygons: rings of vertices, holes included, and the points inside.

An area is rows (area, ring, vertices), ``vertices`` an array of structs (x, y); a ring closes
itself. A point is inside if a ray to the right of it crosses the area's edges an odd number of times, so
inner rings are holes. An edge counts from its lower end up to, but not with, its upper one:
areas that share a border share no point of it, and a horizontal edge counts nowhere.

Each area is covered with square cells, a sixty-fourth of its longer side or so. Cells that no edge
enters lie inside or outside as a whole; the inner ones and those with edges are kept, so a long
thin area has few cells, however large the box around it. A point meets the areas that have its
cell: in an inner cell it is inside, in a cell with edges its ray is cast against the edges
that pass its row of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.session import settle

# Rows of cells that an area is cut into, as a power of two.
FINER = 6


def ring_faults(rings: DataFrame) -> DataFrame:
    """(area, ring, fault) of rings that bound nothing: ``empty``, ``not finite`` or fewer than three ``corners``."""
    v = F.col("vertices")
    bad = F.exists(v, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull() | ~_finite(p["x"]) | ~_finite(p["y"]))
    fault = F.when(v.isNull() | (F.size(v) == 0), "empty").when(bad, "not finite").when(
        F.size(F.array_distinct(v)) < 3, "corners"
    )
    return rings.select("area", "ring", fault.alias("fault")).where("fault IS NOT NULL")


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def edges_of(rings: DataFrame) -> DataFrame:
    """(area, x1, y1, x2, y2): edges that are not horizontal, lower end first; rings with faults have none."""
    v = F.col("vertices")
    sound = F.forall(v, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & _finite(p["x"]) & _finite(p["y"]))
    pairs = F.zip_with(v, F.concat(F.slice(v, 2, F.size(v) - 1), F.slice(v, 1, 1)), lambda a, b: F.struct(
        F.when(a["y"] <= b["y"], a).otherwise(b).alias("low"), F.when(a["y"] <= b["y"], b).otherwise(a).alias("high")
    ))
    good = rings.where(v.isNotNull() & (F.size(F.array_distinct(v)) >= 3)).where(sound)
    return good.select("area", F.explode(pairs).alias("e")).where("e.low.y < e.high.y").select(
        "area",
        *[F.col(f"e.{end}.{axis}").cast("double").alias(f"{axis}{i}") for i, end in ((1, "low"), (2, "high")) for axis in ("x", "y")],
    )


def crosses(px: Column, py: Column) -> Column:
    """1 if the ray to the right of a point crosses the edge of the row."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    reach = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    return F.when((y1 <= py) & (py < y2) & (px < reach), 1).otherwise(0)


def _cell(value: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), F.col("scale"))).cast("bigint")


def row_edges(edges: DataFrame) -> DataFrame:
    """The edges with the scale of their area's cells, once for each row of cells (cy) they pass."""
    sides = edges.groupBy(F.col("area").alias("_area")).agg(
        F.greatest(
            F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max("y2") - F.min("y1"), F.lit(2.0**-30)
        ).alias("side")
    )
    scaled = edges.join(sides, F.col("area") == F.col("_area")).withColumn("scale", F.ceil(F.log2("side")).cast("int") - FINER)
    return scaled.withColumn("cy", F.explode(F.sequence(_cell(F.col("y1")), _cell(F.col("y2"))))).drop("_area", "side")


def cell_cover(rows: DataFrame) -> DataFrame:
    """(area, scale, cx, cy, whole): the cells of each area; ``whole`` ones lie inside, the others hold edges."""
    size = F.pow(F.lit(2.0), F.col("scale"))
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))

    def at(y: Column) -> Column:
        return F.least(F.greatest((x2 - x1) * (y - y1) / (y2 - y1) + x1, F.least(x1, x2)), F.greatest(x1, x2))

    low, high = F.greatest(y1, F.col("cy") * size), F.least(y2, (F.col("cy") + 1) * size)
    # One cell more on both sides: rounding may not leave out a cell that an edge touches.
    ends = [F.least(at(low), at(high)), F.greatest(at(low), at(high))]
    entered = rows.withColumn("cx", F.explode(F.sequence(_cell(ends[0]) - 1, _cell(ends[1]) + 1)))
    entered = settle(entered.select("area", "scale", "cx", "cy").distinct(), "entered")
    # Of the cells between an area's outermost ones in a row, those without edges are inside if their middle is.
    spans = entered.groupBy("area", "scale", "cy").agg(F.sort_array(F.collect_set("cx")).alias("have"))
    gaps = spans.select("area", "scale", "cy", F.explode(
        F.array_except(F.sequence(F.col("have")[0], F.element_at("have", -1)), F.col("have"))
    ).alias("cx"))
    px, py = (F.col("cx") + 0.5) * size, (F.col("cy") + 0.5) * size
    cast = gaps.join(rows.select("area", "cy", "x1", "y1", "x2", "y2"), ["area", "cy"])
    inner = cast.groupBy("area", "scale", "cx", "cy").agg(F.sum(crosses(px, py)).alias("n")).where("n % 2 = 1")
    return entered.withColumn("whole", F.lit(False)).unionByName(inner.drop("n").withColumn("whole", F.lit(True)))


def in_areas(points: DataFrame, rings: DataFrame, x: str = "lon", y: str = "lat") -> DataFrame:
    """The points joined to every ``area`` that contains them; points that are null or not finite are in none.

    ``points`` keeps its columns and gets ``area``; rows that repeat stay repeated.
    """
    rows = settle(row_edges(edges_of(rings)), "row-edges")
    cover = settle(cell_cover(rows), "cells")
    scales = cover.agg(F.collect_set("scale")).scalar()
    numbered = points.where(_finite(F.col(x)) & _finite(F.col(y))).withColumn("_row", F.monotonically_increasing_id())
    numbered = settle(numbered, "points")
    placed = numbered.select("_row", F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py"), F.explode(scales).alias("scale"))
    placed = placed.withColumns({"cx": _cell(F.col("_px")), "cy": _cell(F.col("_py"))})
    met = settle(placed.join(cover, ["scale", "cx", "cy"]).select("_row", "_px", "_py", "area", "cy", "whole"), "met")
    cast = met.where("NOT whole").join(rows.select("area", "cy", "x1", "y1", "x2", "y2"), ["area", "cy"])
    odd = cast.groupBy("_row", "area").agg(F.sum(crosses(F.col("_px"), F.col("_py"))).alias("n")).where("n % 2 = 1")
    inside = met.where("whole").select("_row", "area").unionByName(odd.select("_row", "area"))
    return numbered.join(inside, "_row").drop("_row")
