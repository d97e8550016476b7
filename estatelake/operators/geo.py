"""Distances to places as equi-joins on grid cells, and look-ups of streets and towns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.columns import fold, haversine_m, rounded
from estatelake.operators.streets import street_candidates, street_mention, street_of  # noqa: F401

#: A little less than there are, so that degrees reach as far as metres do.
METRES_PER_DEGREE = 111_194.9
#: Points of a part of a cell; the places around a cell go to each of its parts.
CELL_POINTS = 1_000
#: Fixed values of the amenity score: (count, weight, count at which it is full).
SCORE = [("transport_500m", 0.30, 8), ("grocery_500m", 0.20, 5), ("schools_1km", 0.10, 5), ("parks_1km", 0.10, 3), ("restaurants_1km", 0.15, 15), ("healthcare_1km", 0.15, 8)]


def _bands(lat: F.Column, high: float) -> F.Column:
    """Number of the band of latitudes, from the south pole on."""
    known = F.when(F.abs(lat) > 90, F.raise_error(F.concat(F.lit("no such latitude: "), lat.cast("string"))).cast("double")).otherwise(lat)
    return F.floor((known + 90) / F.lit(high)).cast("long")


def _columns(band: F.Column, high: float, radius_deg: float) -> F.Column:
    """How many cells a band has round the earth: as wide as the radius reaches anywhere in it or its neighbours; one where it reaches a pole."""
    edge = F.greatest(F.abs((band - 1) * high - 90), F.abs((band + 2) * high - 90))  # the latitude that is nearest to a pole
    reach = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(math.radians(radius_deg))) / F.cos(F.radians(edge)))))
    return F.when(edge + radius_deg >= 90, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360 / reach))).cast("long")


def _column(lon: F.Column, columns: F.Column) -> F.Column:
    return F.least(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * columns).cast("long"), columns - 1)


def near_places(points: DataFrame, places: DataFrame, radius_m: float, cell_points: int = CELL_POINTS) -> DataFrame:
    """points (point_id, lat, lon) x places (place_id, category, lat, lon) within the radius, with ``distance_m``.

    The grid's level follows the radius: bands of latitude a little higher than it,
    each with as many cells round the earth as its own latitude needs, so that cells
    close at the date line and the bands of the poles are one cell. A point lies in
    one cell; a place is sent to its cell and those around it. A cell of more than
    ``cell_points`` points is dealt into as many parts as its count asks for, and
    what is sent there is sent to each. Parts are dealt to as many tasks as a shuffle
    has, also where rows are few, as pairs are many more than rows. Nulls meet nothing; latitudes beyond 90 raise.
    """
    reach = radius_m / METRES_PER_DEGREE
    high = reach * (1 + 1e-9)
    asked = points.withColumn("cy", _bands(F.col("lat"), high))
    asked = asked.withColumn("cx", _column(F.col("lon"), _columns(F.col("cy"), high, reach))).filter("cx IS NOT NULL")
    crowded = asked.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_points).select("cy", "cx", F.ceil(F.col("n") / cell_points).alias("parts"))
    asked = asked.join(crowded, ["cy", "cx"], "left").withColumn("part", F.pmod(F.xxhash64("point_id"), F.coalesce("parts", F.lit(1)))).drop("parts")
    asked = asked.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cy", "cx", "part")
    held = places.select("place_id", "category", *[c for c in ("name", "n_places") if c in places.columns], F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    held = held.withColumn("cy", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: _bands(F.col("p_lat"), high) + d)))
    n = _columns(F.col("cy"), high, reach)
    around = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(_column(F.col("p_lon"), n) + d, n)))
    held = held.withColumn("cx", F.explode(around)).join(crowded, ["cy", "cx"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    met = asked.join(held, ["cy", "cx", "part"]).withColumn("distance_m", haversine_m(F.col("lat"), F.col("lon"), F.col("p_lat"), F.col("p_lon")))
    return met.filter(F.col("distance_m") <= radius_m).select(*points.columns, *[c for c in held.columns if c in ("place_id", "category", "name", "n_places")], "distance_m")


def _spots(points: DataFrame) -> DataFrame:
    """Each pair of coordinates once; point_id is the pair. What a spot meets is found once, however many points lie there."""
    return points.filter("lat IS NOT NULL AND lon IS NOT NULL").select("lat", "lon").distinct().withColumn("point_id", F.struct("lat", "lon"))


def place_counts(points: DataFrame, places: DataFrame, wanted: list[tuple[str, str, float]]) -> DataFrame:
    """wanted: (column, category, radius). Each radius is a join of its own, on its own grid, with the categories that it counts; points without a place count 0.

    Points and places of equal coordinates meet once: work grows with the pairs of
    different coordinates, and with the rows.
    """
    spots = _spots(points)
    held = places.groupBy("category", "lat", "lon").agg(F.min("place_id").alias("place_id"), F.count(F.lit(1)).alias("n_places"))
    found = None
    for radius in sorted({r for _, _, r in wanted}):
        here = [(n, c) for n, c, r in wanted if r == radius]
        near = near_places(spots, held.filter(F.col("category").isin(*{c for _, c in here})), radius)
        counts = near.groupBy("lat", "lon").agg(*[F.coalesce(F.sum(F.when(F.col("category") == c, F.col("n_places"))), F.lit(0)).alias(n) for n, c in here])
        found = counts if found is None else found.unionByName(counts, allowMissingColumns=True)
    names = [n for n, _, _ in wanted]
    summed = found.groupBy("lat", "lon").agg(*[F.sum(n).alias(n) for n in names])
    return points.join(summed, ["lat", "lon"], "left").select(*points.columns, *names).na.fill(0, names)


def nearest_place(points: DataFrame, places: DataFrame, radius_m: float) -> DataFrame:
    """The nearest named place of each category within the radius, ties to the smaller id; places without a name don't count, if there is a column ``name``.

    It is found once for each pair of coordinates; of places with equal ones only the first by id takes part.
    """
    if "name" in places.columns:
        places = places.filter(F.trim("name") != "")
    names = ["place_id", *[c for c in ("name",) if c in places.columns]]
    first = F.min_by(F.struct(*names), "place_id").alias("_p")
    near = near_places(_spots(points), places.groupBy("category", "lat", "lon").agg(first).select("category", "lat", "lon", "_p.*"), radius_m)
    nearest = near.groupBy("lat", "lon", "category").agg(F.min_by(F.struct(*names, "distance_m"), F.struct("distance_m", "place_id")).alias("_p"))
    return points.join(nearest, ["lat", "lon"]).select("point_id", "category", "_p.*")


def location_score() -> F.Column:
    """0 to 100: how far each count is towards its full number, weighted; one digit."""
    total = sum(F.lit(w) * F.least(F.col(c) / F.lit(float(full)), F.lit(1.0)) for c, w, full in SCORE)
    return rounded(total * 100 / sum(w for _, w, _ in SCORE), 1)


def poi_category(tags: F.Column) -> F.Column:
    """Category of a place from its tags (fixed values); null if none."""
    a, s, h, r, p = (tags[k] for k in ("amenity", "shop", "highway", "railway", "leisure"))
    return (
        F.when((h == "bus_stop") | r.isin("tram_stop", "station", "halt", "subway_entrance"), "transport").when(s.isin("supermarket", "convenience", "greengrocer"), "grocery").when(a.isin("school", "kindergarten"), "schools")
        .when(p == "park", "parks").when(a.isin("restaurant", "cafe", "fast_food"), "restaurants").when(a.isin("doctors", "pharmacy", "clinic", "hospital"), "healthcare")
    )


def with_region(listings: DataFrame, towns: DataFrame, town_col: str, aliases: DataFrame | None = None) -> DataFrame:
    """towns: (town, district, region, lat, lon), a small dimension. Met regardless of case and accents; ``town_`` columns are null if unknown.

    aliases: (alias, town), other names of towns; a town's own name goes before.
    """
    dim = towns.select(fold(F.col("town")).alias("_town"), F.lit(0).alias("_n"), F.col("district").alias("town_district"), F.col("region").alias("town_region"), F.col("lat").alias("town_lat"), F.col("lon").alias("town_lon"))
    if aliases is not None:
        named = aliases.select(fold(F.col("alias")).alias("_alias"), fold(F.col("town")).alias("_town"))
        dim = dim.unionByName(named.join(dim.drop("_n"), "_town").drop("_town").withColumnRenamed("_alias", "_town").withColumn("_n", F.lit(1)))
    rest = [c for c in dim.columns if c not in ("_town", "_n")]
    one = dim.groupBy("_town").agg(F.min_by(F.struct(*rest), F.struct("_n", *rest)).alias("_r")).select("_town", "_r.*")
    return listings.withColumn("_town", fold(F.col(town_col))).join(one, "_town", "left").drop("_town")


#: Degrees that a found street may lie in (least and greatest latitude, longitude), and kilometres a degree.
BOX, KM_PER_DEGREE = (47.7, 49.65, 16.8, 22.6), 111.0


def plausible(lat: F.Column, lon: F.Column, town_lat: F.Column, town_lon: F.Column, max_km: float, box: tuple[float, float, float, float] | None) -> F.Column:
    """In the box, and within max_km of the town; a town without a point rules nothing out."""
    north, east = (lat - town_lat) * KM_PER_DEGREE, (lon - town_lon) * KM_PER_DEGREE * F.cos(F.radians(town_lat))
    near = F.coalesce(F.sqrt(north * north + east * east) <= max_km, F.lit(True))
    return near if box is None else near & lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def geocode_streets(mentions: DataFrame, gazetteer: DataFrame, max_km: float = 25.0, box: tuple[float, float, float, float] | None = BOX) -> DataFrame:
    """The first plausible spelling of a mention that the town's gazetteer has; the house itself goes before its street.

    mentions: (id, candidates, town, town_lat, town_lon) and house_number, if there
    is one. gazetteer: (street, town, lat, lon) and number, null for a street as a
    whole. Adds ``geo_precision`` ('street', null for a miss) and ``matched`` (house
    or street); a miss keeps the first spelling as its street.
    """
    none = F.lit(None).cast("string")
    number = lambda df, c: F.lower(F.nullif(F.trim(F.col(c)), F.lit(""))) if c in df.columns else none
    # Equal questions are asked once, equal gazetteer rows met once, and only those of the house or of the street as a whole.
    of = ["candidates", "_n", "town", "town_lat", "town_lon"]
    named = mentions.withColumn("_n", number(mentions, "house_number"))
    houses = F.explode(F.array_distinct(F.array(F.lit(""), F.coalesce("_n", F.lit("")))))
    asked = named.select(*of).distinct().select("*", F.posexplode("candidates").alias("nth", "candidate")).withColumn("_s", fold(F.col("candidate"))).withColumn("_t", fold(F.col("town"))).withColumn("_h", houses)
    held = gazetteer.select(fold(F.col("street")).alias("_s"), fold(F.col("town")).alias("_t"), F.coalesce(number(gazetteer, "number"), F.lit("")).alias("_h"), F.col("lat").alias("geo_lat"), F.col("lon").alias("geo_lon")).distinct()
    met = asked.join(held, ["_s", "_t", "_h"]).filter(plausible(F.col("geo_lat"), F.col("geo_lon"), F.col("town_lat"), F.col("town_lon"), max_km, box))
    whole = F.col("_h") == ""
    found = F.struct("candidate", "geo_lat", "geo_lon", F.lit("street").alias("geo_precision"), F.when(whole, "street").otherwise("house").alias("matched"))
    best = met.groupBy(*of).agg(F.min_by(found, F.struct("nth", whole.alias("whole"), "geo_lat", "geo_lon")).alias("g"))
    best = best.select(*[F.col(c).alias(f"_of_{c}") for c in of], F.col("g.candidate").alias("street"), "g.geo_lat", "g.geo_lon", "g.geo_precision", "g.matched")
    out = named.join(best, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in of], "left").drop("_n", *[f"_of_{c}" for c in of])
    return out.withColumn("street", F.coalesce("street", F.get("candidates", F.lit(0))))


def geocode_batch(listings: DataFrame, gazetteer: DataFrame, now, max_km: float = 25.0, box: tuple[float, float, float, float] | None = BOX) -> tuple[DataFrame, DataFrame]:
    """listings: (id, name, content, city, locality, lat, lon), those to geocode. Returns (results, counters).

    results: (id, street, geo_lat, geo_lon, geo_precision, geocoded_at); a miss is
    a row too, with the first spelling as its street. counters: one row.
    """
    asked = listings.withColumn("_s", street_of(F.col("name"), F.col("content"))).withColumn("town", F.coalesce("city", "locality"))
    named = asked.filter(F.col("_s").isNotNull() & F.col("town").isNotNull())
    met = geocode_streets(named.select("id", "_s.candidates", "_s.house_number", "town", F.col("lat").alias("town_lat"), F.col("lon").alias("town_lon")), gazetteer, max_km, box)
    out = listings.select("id").join(met.select("id", "street", "geo_lat", "geo_lon", "geo_precision"), "id", "left").withColumn("geocoded_at", F.lit(now).cast("timestamp"))
    return out, out.agg(F.count(F.lit(1)).alias("processed"), F.count("street").alias("with_street"), F.count("geo_precision").alias("geocoded"))


def location_batch(listings: DataFrame, scores: DataFrame, places: DataFrame, wanted: list[tuple[str, str, float]]) -> tuple[DataFrame, DataFrame]:
    """Scores of active listings with coordinates and none yet, merged into ``scores`` (id, counts, location_score); and one row of counters."""
    from estatelake.operators.merge import merge_location_scores
    from estatelake.operators.search import pending_location_score

    pending = pending_location_score(listings, scores).select(F.col("id").alias("point_id"), "lat", "lon")
    made = place_counts(pending, places, wanted).withColumn("location_score", location_score()).withColumnRenamed("point_id", "id").select(*scores.columns)
    return merge_location_scores(scores, made), made.agg(F.count(F.lit(1)).alias("scored"))


def index_region(listings: DataFrame, regions: DataFrame, national: str = "SR", towns: DataFrame | None = None) -> DataFrame:
    """regions: (name, region), districts, a small dimension; towns: (town, district). The region of the district, or of the town that the district names; else of the city, likewise; else the nation."""
    known = regions.select(fold(F.col("name")).alias("_name"), F.col("region").alias("_region"), F.lit(0).alias("_n"))
    if towns is not None:
        in_district = towns.select(fold(F.col("town")).alias("_town"), fold(F.col("district")).alias("_name")).join(known.drop("_n"), "_name")
        known = known.unionByName(in_district.select(F.col("_town").alias("_name"), "_region", F.lit(1).alias("_n")))
    one = known.groupBy("_name").agg(F.min_by("_region", F.struct("_n", "_region")).alias("_region"))
    out = listings
    for c in ("district", "city"):
        out = out.withColumn("_name", fold(F.col(c))).join(one.withColumnRenamed("_region", f"_r_{c}"), "_name", "left").drop("_name")
    return out.withColumn("index_region", F.coalesce("_r_district", "_r_city", F.lit(national))).drop("_r_district", "_r_city")


def administrative_district(listings: DataFrame, areas: DataFrame) -> DataFrame:
    """areas: (area, district). 'Praha - Karlín' by its last part; what is a district already stays."""
    last = F.trim(F.element_at(F.split("district", "-"), -1))
    dim = areas.select(fold(F.col("area")).alias("_area"), F.col("district").alias("_to")).dropDuplicates(["_area"])
    met = listings.withColumn("_area", fold(last)).join(dim, "_area", "left")
    known = F.col("district").rlike(r"^Praha \d+$")
    return met.withColumn("admin_district", F.when(known, F.col("district")).otherwise(F.col("_to"))).drop("_area", "_to")
