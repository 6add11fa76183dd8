"""Province and city of a coordinate, from a table of bounding boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import left_join


#: Cells of level l are WIDEST / 2^l degrees wide; a box's cells are not smaller than it.
WIDEST, LEVELS = 360.0, 24


def _width(level: Column | int) -> Column:
    return F.lit(WIDEST) / F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)


def _levelled(regions: DataFrame) -> DataFrame:
    """Boxes with the finest level whose cells are at least as wide and high as the box."""
    extent = F.greatest(F.col("lon_max") - F.col("lon_min"), F.col("lat_max") - F.col("lat_min"))
    level = F.floor(F.log2(F.lit(WIDEST) / extent)).cast("int")
    boxes = regions.where("lon_min < lon_max AND lat_min < lat_max")
    return boxes.withColumn("_level", F.greatest(F.lit(0), F.least(F.lit(LEVELS), level)))


def _laid_out(regions: DataFrame) -> DataFrame:
    """One row per box and cell of its level that it touches: four at most.

    Boxes wider than the widest cell, and those smaller than the finest, are laid out too;
    the first touch some more cells.
    """
    laid_out = _levelled(regions)
    for axis in ("lon", "lat"):
        width = _width(F.col("_level"))
        cells = F.sequence(
            F.floor(F.col(f"{axis}_min") / width).cast("int"),
            F.greatest(
                F.floor(F.col(f"{axis}_min") / width),
                F.ceil(F.col(f"{axis}_max") / width) - 1,
            ).cast("int"),
        )
        laid_out = laid_out.withColumn(f"_{axis}", F.explode(cells))
    return laid_out


def _cells_of(level: Column | int) -> dict[str, Column]:
    """The cell of that level which holds an event's point."""
    return {
        f"_{axis}": F.floor(F.col(column) / _width(level)).cast("int")
        for axis, column in (("lon", "longitude"), ("lat", "latitude"))
    }


def _levels_in_use(regions: DataFrame) -> list[int]:
    # At most LEVELS + 1 numbers, however many boxes.
    return sorted(r[0] for r in _levelled(regions).select("_level").distinct().collect())


def _holds(box: Column) -> Column:
    return (
        (F.col("longitude") >= box["lon_min"])
        & (F.col("longitude") < box["lon_max"])
        & (F.col("latitude") >= box["lat_min"])
        & (F.col("latitude") < box["lat_max"])
    )


def enrich_location(events: DataFrame, regions: DataFrame) -> DataFrame:
    """Set ``province`` and ``city``; null where no box holds the point.

    ``regions`` has ``lon_min, lon_max, lat_min, lat_max`` (upper bounds
    exclusive), ``province`` and ``city``. Boxes are laid out on grids of several levels,
    each on cells of about its own size, so that a city shares no cell with all cities of
    its continent, and the joins are on equal cells and not on ranges. There is a join for
    each level in use, with one row per cell, the boxes that touch it. A point in several
    boxes takes the first by province and city; every event appears once.
    """
    boxes = _laid_out(regions)
    box = F.struct("province", "city", "lon_min", "lon_max", "lat_min", "lat_max")
    cells = boxes.groupBy("_level", "_lon", "_lat").agg(F.array_sort(F.collect_list(box)).alias("_boxes"))
    found, places = events, [F.lit(None).cast("struct<province:string,city:string>")]
    for level in _levels_in_use(regions):
        at_level = cells.where(F.col("_level") == level).drop("_level")
        met = left_join(found.withColumns(_cells_of(level)), at_level, ["_lon", "_lat"])
        first = F.try_element_at(F.filter("_boxes", _holds), F.lit(1))
        place = F.when(first.isNotNull(), F.struct(first["province"].alias("province"), first["city"].alias("city")))
        found = met.withColumn(f"_place{level}", place).drop("_boxes", "_lon", "_lat")
        places.append(F.col(f"_place{level}"))
    # The least of structs skips those that are null.
    place = F.least(*places, places[0])
    placed = found.withColumn("_place", place)
    placed = placed.withColumns({"province": F.col("_place.province"), "city": F.col("_place.city")})
    return placed.drop("_place", *[c for c in placed.columns if c.startswith("_place")])


def join_locations(events: DataFrame, regions: DataFrame, key: str = "id") -> DataFrame:
    """:func:`enrich_location` for large region tables, on rows that ``key`` names.

    Boxes and events meet by level and cell, one row per cell and box, so no row holds a
    list however many boxes a cell has. The first box of each event by province and
    city comes from an aggregate and joins back by ``key``.
    """
    box = F.struct("lon_min", "lon_max", "lat_min", "lat_max")
    boxes = _laid_out(regions).select(
        "_level", "_lon", "_lat", box.alias("_box"), F.struct("province", "city").alias("_place")
    )
    levels = F.array(*[F.lit(level) for level in _levels_in_use(regions)]).cast("array<int>")
    points = events.select(key, "longitude", "latitude", F.explode(levels).alias("_level"))
    points = points.withColumns(_cells_of(F.col("_level")))
    met = points.join(boxes, ["_level", "_lon", "_lat"]).where(_holds(F.col("_box")))
    first = met.groupBy(key).agg(F.min("_place").alias("_place"))
    placed = left_join(events, first, [key])
    return placed.withColumns(
        {"province": F.col("_place.province"), "city": F.col("_place.city")}
    ).drop("_place")
