"""Points in polygons with holes and parts, by a cover of classified cells.

A feature is a set of rings, and a point is in it if it lies within an odd number of them: holes, parts and islands in holes
need no names. Cells wholly inside give a hit by equality of the cell. Cells that an edge enters keep the edges that enter
them and whether their reference point is inside; a point of such a cell is compared with these edges only, on a path within
the cell to the reference point. So no ring is ever shipped, and no feature is a hot key, whatever its number of corners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where in its cell the reference point lies: not where corners of drawn shapes do.
REF_X, REF_Y = 0.487136, 0.513719


def rings_of(polygons: DataFrame, ring: str) -> Column:
    """The rings of a feature: an array of rings, or one ring."""
    return F.col(ring) if isinstance(polygons.schema[ring].dataType.elementType, T.ArrayType) else F.array(ring)


def ring_edges(polygons: DataFrame, polygon_id: str, ring: str = "ring") -> DataFrame:
    """(pid, x1, y1, x2, y2): the edges of all rings of three corners or more, closed; edges without length go."""
    rings = polygons.select(F.col(polygon_id).alias("pid"), F.explode(rings_of(polygons, ring)).alias("r")).where(F.size("r") >= 3)
    to = lambda i: F.element_at("r", (i + 1) % F.size("r") + 1)
    edges = F.transform("r", lambda p, i: F.struct(p["x"].cast("double").alias("x1"), p["y"].cast("double").alias("y1"), to(i)["x"].cast("double").alias("x2"), to(i)["y"].cast("double").alias("y2")))
    return rings.select("pid", F.inline(edges)).where("x1 <> x2 OR y1 <> y2")


def cell_cover(polygons: DataFrame, polygon_id: str, *, ring: str = "ring", cell: float = 1.0) -> DataFrame:
    """(pid, cx, cy, edges, ref_in) of every cell that meets a feature: edges null for cells wholly inside, else those of the
    cell, and whether the cell's reference point is in the feature.

    Edges are dealt to rows of cells one by one; a row's crossings with its middle line, in order, tell inside from outside.
    """
    x_at = lambda y: (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    floor = lambda v: F.floor(v / cell).cast("long")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = ring_edges(polygons, polygon_id, ring).withColumn("cy", F.explode(F.sequence(floor(low), floor(high))))
    middle = (F.col("cy") + REF_Y) * cell
    crosses = (F.col("y1") > middle) != (F.col("y2") > middle)
    flat = F.col("y1") == F.col("y2")
    within = lambda y: F.when(flat, F.lit(None)).otherwise(x_at(y))
    ends = [within(F.greatest(low, F.col("cy") * cell)), within(F.least(high, (F.col("cy") + 1) * cell))]
    slack = F.lit(cell * 1e-9) + F.greatest(F.abs("x1"), F.abs("x2")) * 1e-14
    left = F.greatest(F.coalesce(F.least(*ends), F.least("x1", "x2")) - slack, F.least("x1", "x2"))
    right = F.least(F.coalesce(F.greatest(*ends), F.greatest("x1", "x2")) + slack, F.greatest("x1", "x2"))
    rows = rows.withColumns({"cut": F.when(crosses, x_at(middle)), "from": floor(left), "to": floor(right)})

    cuts = rows.where("cut IS NOT NULL").groupBy("pid", "cy").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
    entered = rows.withColumn("cx", F.explode(F.sequence("from", F.greatest("from", "to")))).groupBy("pid", "cx", "cy")
    border = entered.agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")).join(cuts, ["pid", "cy"], "left")
    ref = (F.col("cx") + REF_X) * cell
    beyond = F.coalesce(F.size(F.filter("cuts", lambda x: x > ref)), F.lit(0))
    border = border.select("pid", "cx", "cy", "edges", (beyond % 2 == 1).alias("ref_in"))
    first = lambda x: F.ceil(x / cell - REF_X).cast("long")  # noqa: E731  (the first cell whose reference point is not before x)
    spans = F.transform(F.sequence(F.lit(0), F.size("cuts") - 2, F.lit(2)), lambda i: F.struct(first(F.get("cuts", i)).alias("a"), (first(F.get("cuts", i + 1)) - 1).alias("b")))
    inner = cuts.where(F.size("cuts") >= 2).select("pid", "cy", F.inline(spans)).where("a <= b").withColumn("cx", F.explode(F.sequence("a", "b")))
    inner = inner.join(border.select("pid", "cx", "cy"), ["pid", "cx", "cy"], "left_anti")
    return border.unionByName(inner.select("pid", "cx", "cy", F.lit(None).cast(border.schema["edges"].dataType).alias("edges"), F.lit(True).alias("ref_in")))


def _in_cell(x: Column, y: Column, cell: float, touching: bool) -> Column:
    """Whether a point of a border cell is inside: the reference point's side, turned by every edge between it and the point.

    The path goes along y to the reference point's x, then along x; ends of edges count on one side, as in ray casting.
    """
    rx, ry = (F.col("cx") + REF_X) * cell, (F.col("cy") + REF_Y) * cell

    def turns(e: Column) -> Column:
        x_at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"]
        y_at = (e["y2"] - e["y1"]) * (rx - e["x1"]) / F.when(e["x2"] != e["x1"], e["x2"] - e["x1"]) + e["y1"]
        along_x = ((e["y1"] > y) != (e["y2"] > y)) & ((x_at > x) != (x_at > rx))
        along_y = ((e["x1"] > rx) != (e["x2"] > rx)) & ((y_at > y) != (y_at > ry))
        return F.coalesce(along_x, F.lit(False)).cast("int") + F.coalesce(along_y, F.lit(False)).cast("int")

    odd = F.aggregate("edges", F.lit(0), lambda s, e: s + turns(e)) % 2 == 1
    cross = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    on = F.exists("edges", lambda e: (F.abs(cross(e)) <= 1e-12) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))
    inside = F.col("ref_in") != odd
    return (inside | on) if touching else (inside & ~on)


def in_polygon(points: DataFrame, polygons: DataFrame, polygon_id: str, *, ring: str = "ring", cell: float = 1.0, edges: bool = False) -> DataFrame:
    """points x polygon_id, for every feature that holds the point.

    ring: an array of struct(x = lon, y = lat), or an array of such rings, of which an odd number must hold the point. Points
    on an edge count only if edges. A point in several features gives several rows; choose with `one_polygon` or
    `with_severity`. Points without coordinates are in none. cell, in degrees: a cell's edges of one feature are one row, and
    a feature has as many rows as it has cells.
    """
    cover = cell_cover(polygons, polygon_id, ring=ring, cell=cell)
    floor = lambda c: F.floor(F.col(c) / cell).cast("long")
    near = points.select(F.struct(*points.columns).alias("p"), F.col("lon").cast("double").alias("x"), F.col("lat").cast("double").alias("y"), floor("lon").alias("cx"), floor("lat").alias("cy"))
    hits = near.join(cover, ["cx", "cy"]).where(F.col("edges").isNull() | _in_cell(F.col("x"), F.col("y"), cell, edges))
    return hits.select("p.*", F.col("pid").alias(polygon_id))
