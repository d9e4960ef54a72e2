"""Spatial joins as equi-joins on grid cells: within a radius, radius sums; `nearest` is in pyramid.py, `in_polygon` in cover.py.

Points live in square cells of a size in degrees. The side that has to look around explodes into the cells that it can
reach, so that Spark joins on cells by hash, and the exact distance is a filter after the join. Longitudes wrap at 180
degrees, and cells widen towards the poles. `hot_salt` deals the points of a crowded cell over that many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, haversine_km
from .cover import in_polygon
from .pyramid import nearest

__all__ = ["dbscan", "in_polygon", "nearest", "nearest_by_category", "nearest_pivot", "one_polygon", "radius_sums", "with_severity", "within_radius"]


def _cell(lat: Column, lon: Column, size: float, columns: int) -> tuple[Column, Column]:
    """Row of a height of size degrees, and one of the columns of equal width: so no column at 180 degrees is a mere rest."""
    col = F.floor(F.pmod(lon + 180, F.lit(360.0)) * (columns / 360)).cast("long")
    return F.floor((lat + 90) / size).cast("long"), F.least(col, F.lit(columns - 1).cast("long"))


def within_radius(left: DataFrame, right: DataFrame, km: float, *, left_at: tuple[str, str] = ("lat", "lon"), right_at: tuple[str, str] = ("lat", "lon"), how: str = "inner", distance: str = "km", hot_salt: int = 1, shuffled: bool = False) -> DataFrame:
    """All pairs at most km apart, with columns l.* and r.* as structs `l` and `r`, and the distance.

    how: inner, or left (rows of left without a partner have null r). Rows without coordinates have no partner. The
    smaller side should be left: its rows are copied to the cells around them. shuffled: no side is broadcast, whatever its
    files' size; few bytes of Parquet can be many rows.
    """
    size = max(km / KM_PER_DEGREE, 1e-6)
    l = left.select(F.struct(*left.columns).alias("l"), F.col(left_at[0]).cast("double").alias("la"), F.col(left_at[1]).cast("double").alias("lo"))
    r = right.select(F.struct(*right.columns).alias("r"), F.col(right_at[0]).cast("double").alias("ra"), F.col(right_at[1]).cast("double").alias("ro"))
    columns = max(1, int(360.0 // size))
    reach = F.ceil(F.lit(size) / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("la")) + size, F.lit(90.0)))), F.lit(1e-9)) * (columns / 360) + 1e-9)
    row, col = _cell(F.col("la"), F.col("lo"), size, columns)
    # near the poles a circle can reach every column: one copy for each column at most
    around = F.when(2 * reach + 1 >= columns, F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))).otherwise(F.transform(F.sequence(-reach, reach), lambda k: F.pmod(col + k, F.lit(columns))))
    around = F.array_distinct(around)
    near = l.where("la IS NOT NULL AND lo IS NOT NULL").withColumn("row", F.explode(F.sequence(row - 1, row + 1))).withColumn("col", F.explode(around))
    rrow, rcol = _cell(F.col("ra"), F.col("ro"), size, columns)
    there = r.where("ra IS NOT NULL AND ro IS NOT NULL").withColumns({"row": rrow, "col": rcol})
    keys = ["row", "col"]
    if hot_salt > 1:
        near = near.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(hot_salt - 1))))
        there = there.withColumn("salt", F.pmod(F.xxhash64("r"), F.lit(hot_salt)).cast("int"))
        keys.append("salt")
    km_apart = haversine_km(F.col("la"), F.col("lo"), F.col("ra"), F.col("ro"))
    pairs = near.join(there.hint("merge") if shuffled else there, keys).withColumn(distance, km_apart).where(F.col(distance) <= km).select("l", "r", distance)
    if how == "inner":
        return pairs
    lonely = l.select("l").join(pairs.select(F.col("l").alias("found")).distinct(), F.col("l").eqNullSafe(F.col("found")), "left_anti")
    return pairs.unionByName(lonely, allowMissingColumns=True)


def radius_sums(centres: DataFrame, points: DataFrame, centre_id: str, value: str | None, radii: Sequence[float], *, exclude_self: str | None = None, prefix: str = "within", hot_salt: int = 1) -> DataFrame:
    """(centre_id, within_<r>...): the sum of value (number of points if None) within each radius; 0 where there is none.

    Points of one place are summed up before they meet, and centres of one place meet them once, so that pairs grow with the
    places. With exclude_self (an id of points that a centre's own id leaves out) rows meet one by one.
    """
    name = lambda r: f"{prefix}_{r:g}".replace(".", "_")
    sums_of = lambda amount: [F.sum(F.when(F.col("km") <= r, amount)).alias(name(r)) for r in radii]
    if exclude_self:
        pairs = within_radius(centres, points, max(radii), hot_salt=hot_salt).where(F.col(f"l.{centre_id}") != F.col(f"r.{exclude_self}"))
        sums = pairs.groupBy(F.col(f"l.{centre_id}").alias(centre_id)).agg(*sums_of(F.col(f"r.{value}") if value else F.lit(1)))
        return centres.select(centre_id).join(sums, centre_id, "left").fillna(0, [name(r) for r in radii])
    known = lambda df: df.where("lat IS NOT NULL AND lon IS NOT NULL")
    places = known(points).groupBy("lat", "lon").agg((F.sum(value) if value else F.count(F.lit(1))).alias("__v"))
    pairs = within_radius(known(centres).select("lat", "lon").distinct(), places, max(radii), hot_salt=hot_salt)
    sums = pairs.groupBy(F.col("l.lat").alias("lat"), F.col("l.lon").alias("lon")).agg(*sums_of(F.col("r.__v")))
    return centres.select(centre_id, "lat", "lon").join(sums, ["lat", "lon"], "left").select(centre_id, *[name(r) for r in radii]).fillna(0, [name(r) for r in radii])


def nearest_by_category(left: DataFrame, right: DataFrame, left_id: str, right_id: str, category: str, categories: Sequence[str], **options) -> DataFrame:
    """(left_id, km_<category>..., km_other): the distance to the nearest of each category but the row's own, and their least."""
    out = left.select(left_id, category)
    for c in categories:
        found = nearest(left.where(F.col(category) != c), right.where(F.col(category) == c), left_id, right_id, **options)
        out = out.join(found.select(left_id, F.col("km").alias(f"km_{c}")), left_id, "left")
    cols = [f"km_{c}" for c in categories]
    return out.withColumn("km_other", F.least(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0]))


def with_severity(points: DataFrame, hits: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, severity: str, default: float) -> DataFrame:
    """(point_id, severity) of every point: the largest of the polygons that hold it, `default` for none."""
    most = hits.select(point_id, polygon_id).join(polygons.select(polygon_id, severity), polygon_id).groupBy(point_id).agg(F.max(severity).alias("__s"))
    return points.select(point_id).join(most, point_id, "left").select(point_id, F.coalesce("__s", F.lit(default)).alias(severity))


def one_polygon(hits: DataFrame, polygons: DataFrame, point_id: str, polygon_id: str, order: Column) -> DataFrame:
    """(point_id, polygon_id): of the polygons that hold a point the first by order (over columns of polygons), then by id."""
    ranked = hits.select(point_id, polygon_id).join(polygons.select(polygon_id, order.alias("__o")), polygon_id)
    return ranked.groupBy(point_id).agg(F.min(F.struct("__o", polygon_id)).alias("b")).select(point_id, F.col(f"b.{polygon_id}").alias(polygon_id))


def dbscan(points: DataFrame, id_col: str, eps_km: float, min_points: int, components) -> DataFrame:
    """(id, cluster, core): density clusters; cluster is the smallest core id of it, -1 for noise.

    A point is core if at least min_points points, itself included, lie within eps_km. Border points join the cluster of
    their nearest core point. components: a function from (u, v) edges to (node, component). All tables here can have a row
    for each point, so none is broadcast.
    """
    pairs = within_radius(points, points, eps_km, shuffled=True).select(F.col(f"l.{id_col}").alias("u"), F.col(f"r.{id_col}").alias("v"), "km")
    core = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_points).select(F.col("u").alias("c")).hint("merge")
    reach = pairs.join(core, F.col("v") == F.col("c")).drop("c")
    edges = reach.join(core, F.col("u") == F.col("c"), "left_semi")
    labels = components(edges.select("u", "v"))
    own = reach.groupBy("u").agg(F.min(F.struct("km", "v")).alias("b")).select("u", F.col("b.v").alias("via"))
    labelled = own.join(labels.hint("merge"), F.col("via") == F.col("node"), "left").select("u", F.coalesce("component", "via").alias("cluster"))
    out = points.select(id_col).join(labelled.hint("merge"), F.col(id_col) == F.col("u"), "left").join(core, F.col(id_col) == F.col("c"), "left")
    return out.select(id_col, F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.col("c").isNotNull().alias("core"))


def nearest_pivot(found: DataFrame, left_id: str, names: Mapping[int, str]) -> DataFrame:
    """One row for each left_id, with the distances of the named ranks as columns."""
    return found.groupBy(left_id).agg(*[F.max(F.when(F.col("rank") == r, F.col("km"))).alias(name) for r, name in names.items()])
