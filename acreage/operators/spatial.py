"""Nearest-station distance by equi-joins on grid cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from acreage.functions.geo import flat_distance
from acreage.operators.joins import lookup_join
from acreage.session import keep, stage

# Each level of the station grid splits a cell into FAN x FAN; FAN is 2 to the power FAN_BITS.
_FAN_BITS = 3
_FAN = 1 << _FAN_BITS
_LIST_ROWS = 256


def _cell(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(side))


def _square(gap: Column) -> Column:
    return gap * gap


def _box_bounds(a: str, b: str) -> tuple[Column, Column]:
    """Squared smallest and largest distance between a point of box `a` and one of box `b`."""
    low, high = F.lit(0.0), F.lit(0.0)
    for axis in ("lat", "lon"):
        a0, a1 = F.col(f"{a}_{axis}0"), F.col(f"{a}_{axis}1")
        b0, b1 = F.col(f"{b}_{axis}0"), F.col(f"{b}_{axis}1")
        low = low + _square(F.greatest(F.lit(0.0), b0 - a1, a0 - b1))
        high = high + _square(F.greatest(b1 - a0, a1 - b0))
    return low, high


def _boxes(points: DataFrame, lat: str, lon: str, keys: dict[str, Column], prefix: str) -> DataFrame:
    return points.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.min(lat).alias(f"{prefix}_lat0"), F.max(lat).alias(f"{prefix}_lat1"),
        F.min(lon).alias(f"{prefix}_lon0"), F.max(lon).alias(f"{prefix}_lon1"),
        F.count("*").alias(f"{prefix}_n"),
    )


def _descend(cells: DataFrame, stations: DataFrame, side: float, bounds: tuple, n: int) -> DataFrame:
    """Pair every property cell with the station cells that may hold a nearest station.

    `bounds` are the least and largest latitude and longitude of the `n` stations. From the at most
    four cells of the coarsest grid down, a pair survives if its smallest possible distance does
    not exceed the best largest distance of that property cell. Pairs per cell stay few.
    """
    lat0, lat1, lon0, lon1 = bounds
    extent = max(lat1 - lat0, lon1 - lon0)
    levels = max(1, math.ceil(math.log(max(extent / side, 1.0), _FAN)))

    def coarsest(value: float) -> int:
        return math.floor(value / side) // _FAN**levels

    starts = F.array(*[
        F.struct(F.lit(i).cast("long").alias("pi"), F.lit(j).cast("long").alias("pj"))
        for i in range(coarsest(lat0), coarsest(lat1) + 1) for j in range(coarsest(lon0), coarsest(lon1) + 1)
    ])
    here = Window.partitionBy("ci", "cj")
    frontier = cells.withColumn("_start", F.explode(starts)).select(*cells.columns, "_start.*")
    for level in range(levels, -1, -1):
        up = 0 if level == levels else _FAN_BITS
        nodes = _boxes(stations, "slat", "slon", {
            k: F.shiftright(F.col(k), _FAN_BITS * level) for k in ("si", "sj")
        }, "s").withColumns({"pi": F.shiftright("si", up), "pj": F.shiftright("sj", up)})
        low, high = _box_bounds("c", "s")
        paired = lookup_join(frontier, nodes, ["pi", "pj"], "inner", known_rows=n)
        frontier = (
            paired.withColumns({"_low": low, "_best": F.min(high).over(here)})
            .filter(F.col("_low") <= F.col("_best") * F.lit(1 + 1e-9))
            .drop("_low", "_best", "pi", "pj")
        )
        if level:
            frontier = frontier.select(*cells.columns, F.col("si").alias("pi"), F.col("sj").alias("pj"))
    return frontier


def nearest_station_distance(
    df: DataFrame, stations: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE",
    station_lat: str = "latitude", station_lon: str = "longitude", name: str = "DIST_NEAREST_SUBWAY",
) -> DataFrame:
    """Add the exact distance to the nearest station, straight in radian space; null without one.

    Property cells, not properties, look for candidates: stations sit on a pyramid of grids whose
    finest cells hold about one station each, and `_descend` keeps per property cell the station
    cells that can matter. A property then reads the short list of its cell. Cells whose list
    would be long, because stations crowd there, are cut into smaller cells and tried again.
    """
    spots = keep(
        stations.select(F.col(station_lat).cast("double").alias("slat"),
                        F.col(station_lon).cast("double").alias("slon"))
        .dropna().dropDuplicates()
    )
    n, lat0, lat1, lon0, lon1 = spots.agg(
        F.count("*"), F.min("slat"), F.max("slat"), F.min("slon"), F.max("slon")
    ).first()
    if n == 0:
        return df.withColumn(name, F.lit(None).cast("double"))
    bounds = (lat0, lat1, lon0, lon1)
    side = max(lat1 - lat0, lon1 - lon0, 1e-9) / math.sqrt(n)

    cells_of = {"ci": lambda w: _cell(F.col(lat), w), "cj": lambda w: _cell(F.col(lon), w)}
    nearest = F.array_min(F.transform(
        "_near", lambda s: flat_distance(F.col(lat), F.col(lon), s["slat"], s["slon"])
    ))
    out, pending = None, stage(df, "places")
    while True:
        grid = {k: cell(side) for k, cell in cells_of.items()}
        located = spots.withColumns({"si": _cell(F.col("slat"), side), "sj": _cell(F.col("slon"), side)})
        cells = _boxes(pending.dropna(subset=[lat, lon]), lat, lon, grid, "c")
        frontier = keep(_descend(cells, located, side, bounds, n).select("ci", "cj", "si", "sj", "s_n"))
        load = frontier.groupBy("ci", "cj").agg(F.sum("s_n").alias("_load"))
        # a cell of one spot cannot be cut further; its list holds the stations at equal distance
        spot = cells.filter((F.col("c_lat0") == F.col("c_lat1")) & (F.col("c_lon0") == F.col("c_lon1"))).select("ci", "cj")
        crowded = keep(load.filter(F.col("_load") > _LIST_ROWS).select("ci", "cj").join(spot, ["ci", "cj"], "left_anti"))
        done = crowded.isEmpty()
        listed = frontier if done else frontier.join(crowded, ["ci", "cj"], "left_anti")
        lists = (
            listed.join(located, ["si", "sj"])
            .groupBy("ci", "cj").agg(F.collect_list(F.struct("slat", "slon")).alias("_near"))
        )
        placed = pending.withColumns(grid)
        settled = placed if done else placed.join(crowded, ["ci", "cj"], "left_anti")
        part = lookup_join(settled, lists, ["ci", "cj"]).select(*df.columns, nearest.alias(name))
        out = part if out is None else out.unionByName(part)
        if done:
            return out
        pending = stage(placed.join(crowded, ["ci", "cj"], "left_semi").select(*df.columns), "places")
        side /= _FAN
