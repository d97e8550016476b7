"""One nested valuation document for every listing, in one job.

What several blocks need is made once and written to the shared folder: the
listings with their price per m2 and index region, what their pools of comparables
say with the best of these, and the distributions of segments. Each block is then a struct of
columns, joined back by the listing's id; the joins share that one partitioning.
Texts are codes, which a template puts into words.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm, rounded
from estatelake.operators import geo, market, photos, valuation
from estatelake.sources.shared import keep

#: Labelled counts of the places block.
FACILITIES = [("transport_500m", "Public transport (500 m)"), ("grocery_500m", "Groceries (500 m)"), ("schools_1km", "Schools (1 km)"), ("parks_1km", "Parks (1 km)"), ("restaurants_1km", "Restaurants (1 km)"), ("healthcare_1km", "Healthcare (1 km)")]
YEARS, MORTGAGE, LOAN, INFLATION, RETURN = 30, 4.0, 80.0, 2.5, 5.0


@dataclass
class Options:
    """What is the same in all documents."""

    generated_at: datetime
    language: str = "en"
    template: str = "standard"
    title: str = "Property Valuation Report"
    country: str = "Slovakia"
    currency: str = "EUR"
    index_source: str = "Regional price index"
    index_note: str = "All residential, average transaction prices"
    growth_period: str = "long-run average"
    model_version: str = "comparables"
    quarters: int = 9


def _block(name: str, **columns: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in columns.items()]).alias(name)


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def prepared(listings: DataFrame, regions: DataFrame, growth: DataFrame, towns: DataFrame | None = None) -> DataFrame:
    """Listings with ``sqm``, ``index_region`` and ``growth_pct``. growth: (region, growth_pct), with the nation's under 'SR'."""
    placed = geo.index_region(listings.withColumn("sqm", per_sqm(F.col("price"), F.col("area"))), regions, towns=towns)
    return placed.join(growth.withColumnRenamed("region", "index_region"), "index_region", "left")


def pools(listings: DataFrame) -> DataFrame:
    """``valuation.pool_summaries``: comparables of the district, widened by the city's where few are strong; the best with locality and URL."""
    return valuation.pool_summaries(listings, also=("locality", "url"))


def property_block(rows: DataFrame, options: Options) -> Column:
    """The card image goes first if the gallery lacks it; days on the market end when the listing was last seen."""
    gallery = F.coalesce("images", F.array().cast("array<string>"))
    images = F.when(F.col("image_url").isNotNull() & ~F.array_contains(gallery, F.col("image_url")), F.concat(F.array("image_url"), gallery)).otherwise(gallery)
    until = F.coalesce(F.col("last_seen_at"), F.lit(options.generated_at).cast(rows.schema["first_seen_at"].dataType))
    return _block(
        "property", title=F.col("title"), deal_type=F.when(F.col("deal_type") == "rent", "rent").when(F.col("deal_type").isNotNull(), "sale"), property_type=F.col("category"), layout=F.col("layout"), address=F.col("locality"), locality=F.col("locality"), city=F.col("city"), country=F.lit(options.country),
        latitude=F.col("lat"), longitude=F.col("lon"), floor_area=F.col("area").cast("double"), land_area=F.col("land_area").cast("double"), source=F.col("source"), source_url=F.col("url"),
        first_seen_at=F.date_format("first_seen_at", "yyyy-MM-dd"), last_seen_at=F.date_format("last_seen_at", "yyyy-MM-dd"), days_on_market=days_on_market(until), images=images,
    )


def days_on_market(until: Column) -> Column:
    """Whole days since a listing was first seen; null if that is unknown."""
    return F.when(F.col("first_seen_at").isNotNull(), F.greatest(F.floor((F.unix_micros(until.cast("timestamp")) - F.unix_micros(F.col("first_seen_at").cast("timestamp"))) / 86_400_000_000), F.lit(0))).cast("long")


def explanation(difference_pct: Column, sqm: Column, median_sqm: Column, wide: Column) -> Column:
    """Codes: the price against the estimate at 1 %, the price per m2 against the median at 1 %, and whether the pool was widened."""
    off = (sqm - median_sqm) / F.nullif(median_sqm, F.lit(0.0)) * 100
    against = lambda x, name: F.when(x <= -1, f"{name}_below").when(x >= 1, f"{name}_above").when(x.isNotNull(), f"{name}_inline")
    return F.when(difference_pct.isNull(), F.array(F.lit("none"))).otherwise(F.array_compact(F.array(against(difference_pct, "price"), F.when(F.nullif(sqm, F.lit(0.0)).isNotNull(), against(off, "sqm")), F.when(wide, "widened"))))


def _compared(label: Column, rows: dict[str, Column], subject: bool = False, median: bool = False) -> Column:
    kinds = {"locality": "string", "layout": "string", "floor_area": "double", "price": "double", "price_per_sqm": "double", "price_difference_vs_subject": "double", "similarity_score": "int", "source_url": "string"}
    return F.struct(label.alias("label"), *[rows.get(c, F.lit(None)).cast(k).alias(c) for c, k in kinds.items()], F.lit(subject).alias("is_subject"), F.lit(median).alias("is_median"))


def best_rows() -> Column:
    """A listing's best comparables in order, two at most."""
    row = lambda o, i: _compared(F.format_string("best_%d", i + 1), {"locality": o["o_locality"], "layout": o["o_layout"], "floor_area": o["o_area"], "price": o["o_price"], "price_per_sqm": o["o_sqm"], "price_difference_vs_subject": rounded(F.nullif(o["o_price"], F.lit(0)) - F.col("price")), "similarity_score": o["similarity"], "source_url": o["o_url"]})
    return F.transform("best", row).alias("best")


def comparables_block() -> Column:
    """The listing, the median of its pool, and its best; the median's price per m2 is its own price over its own area."""
    subject = _compared(F.lit("subject"), {"locality": F.col("locality"), "layout": F.col("layout"), "floor_area": F.col("area"), "price": F.col("price"), "price_per_sqm": F.col("sqm"), "similarity_score": F.lit(100)}, subject=True)
    area = valuation.whole(F.nullif("median_area", F.lit(0.0)))
    sqm = F.coalesce(valuation.whole(F.col("median_price") / F.nullif(area, F.lit(0.0))), F.col("median_sqm"))
    median = _compared(F.lit("median"), {"locality": F.coalesce("district", "locality"), "layout": F.col("layout"), "floor_area": area, "price": F.col("median_price"), "price_per_sqm": sqm, "price_difference_vs_subject": rounded(F.col("median_price") - F.col("price"))}, median=True)
    return F.concat(F.array(subject), F.when(F.col("median_price").isNotNull(), F.array(median)).otherwise(F.slice(F.array(median), 1, 0)), F.coalesce("best", F.slice(F.array(median), 1, 0))).alias("comparables")


def index_by_region(index: DataFrame, quarters: int) -> DataFrame:
    """index: (region, year, quarter, period, value). (region, latest, latest_period, yoy, series): a row for each region, its last quarters oldest first."""
    every = index.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("year", "quarter", "period", "value"))).alias("s"))
    last, before = F.get("s", F.size("s") - 1), F.get("s", F.size("s") - 5)
    yoy = F.when(F.size("s") >= 5, rounded((last["value"] - before["value"]) / F.nullif(before["value"], F.lit(0.0)) * 100, 1))
    points = F.transform(F.slice("s", F.greatest(F.size("s") - (quarters - 1), F.lit(1)), quarters), lambda x: F.struct(x["period"].alias("period"), x["value"].alias("value")))
    return every.select("region", last["value"].alias("latest"), last["period"].alias("latest_period"), yoy.alias("yoy"), points.alias("series"))


def market_block(options: Options) -> Column:
    distribution = _block("distribution", scope=F.concat(F.lit("Active "), F.coalesce("category", F.lit("listings")), F.lit(" listings, "), F.coalesce("district", F.lit("local market"))), min_price_per_sqm=F.col("low_sqm"), p25_price_per_sqm=F.col("p25"), median_price_per_sqm=F.col("p50"), p75_price_per_sqm=F.col("p75"), max_price_per_sqm=F.col("high_sqm"), sample_size=F.col("n_sqm"))
    return _block(
        "market_statistics", region=F.col("index_region"), country=F.lit(options.country), scope_note=F.lit(options.index_note), source=F.concat_ws(", ", F.lit(options.index_source), "latest_period"), period=F.col("latest_period"), average_price_per_sqm=F.col("latest"), yoy_change=F.col("yoy"), series=F.col("series"),
        subject_price_per_sqm=F.col("sqm"), distribution=F.when(F.col("n_sqm") > 0, distribution),
    )


def benchmarks_block(options: Options) -> Column:
    entry = lambda name, kind, value, source: F.struct(name.alias("name"), F.lit(kind).alias("benchmark_type"), value.alias("value_per_sqm"), source.alias("source"))
    local = entry(F.lit("Local listing median"), "listing_asking", F.col("median_sqm"), F.lit("Listing index"))
    regional = entry(F.concat(F.lit("Price index, "), F.col("index_region")), "realized_sale", F.col("latest"), F.concat_ws(", ", F.lit(options.index_source), "latest_period"))
    return F.array_compact(F.array(F.when(F.nullif("median_sqm", F.lit(0.0)).isNotNull(), local), F.when(~F.coalesce(F.col("deal_type") == "rent", F.lit(False)) & F.col("latest").isNotNull(), regional))).alias("benchmarks")


def wealth_block(options: Options) -> Column:
    """Null for rentals, and where price, area, rents or the region's growth are unknown."""
    whole = lambda c: F.col(c).cast("long")
    points = F.transform("path", lambda x: F.struct(x["year"].alias("year"), x["buyer"].cast("long").alias("buyer"), x["renter"].cast("long").alias("renter")))
    assumed = _block("assumptions", property_price=F.col("price").cast("double"), monthly_rent=F.col("rent"), rent_source=F.concat(F.lit("Active rent-listing median, "), F.coalesce("district", F.lit("local market"))), mortgage_rate_pct=F.lit(MORTGAGE), ltv_pct=F.lit(LOAN), term_years=F.lit(YEARS), inflation_pct=F.lit(INFLATION), investment_return_pct=F.lit(RETURN), property_growth_pct=F.col("growth_pct"), growth_source=F.concat_ws(", ", F.lit(options.index_source), "index_region", F.lit(options.growth_period)))
    block = _block("buy_vs_rent", horizon_years=F.lit(YEARS), assumptions=assumed, down_payment=whole("down_payment"), monthly_payment=whole("payment"), series=points, buyer_final=whole("buyer_final"), renter_final=whole("renter_final"), breakeven_year=F.col("break_even_year"))
    return F.when(F.col("can_project"), block).alias("buy_vs_rent")


def with_projection(rows: DataFrame) -> DataFrame:
    """Rows with ``rent`` (the segment's rent per m2 times the area, whole) and the columns of ``valuation.buy_vs_rent``."""
    rent = valuation.whole(F.col("rent_sqm") * F.col("area"))
    sale = ~F.coalesce(F.col("deal_type") == "rent", F.lit(False)) & (F.col("price") > 0) & (F.col("area") > 0) & F.col("growth_pct").isNotNull()
    rows = rows.withColumn("rent", rent).withColumn("can_project", F.coalesce(sale & (F.col("rent") > 0), F.lit(False)))
    return valuation.buy_vs_rent(rows, years=YEARS, down=1 - LOAN / 100, rate=MORTGAGE / 100, invest=RETURN / 100, inflation=INFLATION / 100)


def photos_block() -> Column:
    shown = lambda c: F.when(F.col("photos_known"), c)
    return _block("vision_analysis", available=F.coalesce("photos_known", F.lit(False)), summary=shown(F.col("observations")), photo_quality=shown(F.col("quality")), brightness=shown(F.col("brightness")), sharpness=shown(F.col("sharpness")), gallery_size=shown(F.col("gallery_size").cast("int")), images=shown(F.slice(F.col("property")["images"], 1, 3)))


def places_block() -> Column:
    counted = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(label).alias("category"), F.col(c).cast("long").alias("count"))) for c, label in FACILITIES]))
    return _block("location_facilities", available=F.size(counted) > 0, map_image_url=_none(), facilities=counted)


def valuation_reports(listings: DataFrame, index: DataFrame, regions: DataFrame, growth: DataFrame, scores: DataFrame, places: DataFrame, options: Options, towns: DataFrame | None = None) -> DataFrame:
    """(id, the blocks): a row for each listing, active or not, priced or not.

    listings: id, source, title, category, deal_type, layout, locality, district,
    city, lat, lon, area, land_area, price, url, image_url, images, active,
    first_seen_at, last_seen_at. index: (region, year, quarter, period, value), the
    nation as 'SR'. regions: (name, region). growth: (region, growth_pct). scores:
    photo scores as ``photos.photo_section`` takes them, with dark_image_ratio.
    places: (id, counts) as of ``geo.place_counts``.
    """
    rows = keep(prepared(listings, regions, growth, towns), "report-listings")
    values = keep(valuation.valued(pools(rows.select("id", "layout", "area", "price", "active", "city", *valuation.SEGMENT, "locality", "url")), "wide", best_rows()), "report-pools")
    spread = keep(market.price_distribution(rows, ["district", "deal_type"]), "report-segments")
    segment = spread.select(F.col("district").alias("_d"), F.col("deal_type").alias("_t"), F.col("category").alias("_c"), F.col("n").alias("n_sqm"), F.col("low").alias("low_sqm"), "p25", "p50", "p75", F.col("high").alias("high_sqm"))
    rents = spread.filter("deal_type = 'rent'").select(F.col("district").alias("_d"), F.col("category").alias("_c"), F.col("p50").alias("rent_sqm"))
    poor = (F.coalesce("blurry_image_ratio", F.lit(0.0)) >= 0.5) | (F.coalesce("dark_image_ratio", F.lit(0.0)) >= 0.5)
    seen = photos.photo_section(scores, "gallery_size", poor.alias("poor_photos")).withColumnRenamed("available", "photos_known")

    met = rows.join(index_by_region(index, options.quarters).withColumnRenamed("region", "index_region"), "index_region", "left")
    met = met.join(segment, (F.col("district") == F.col("_d")) & (F.col("deal_type") == F.col("_t")) & F.col("category").eqNullSafe(F.col("_c")), "left").drop("_d", "_t", "_c")
    met = met.join(rents, (F.col("district") == F.col("_d")) & F.col("category").eqNullSafe(F.col("_c")), "left").drop("_d", "_c")
    met = with_projection(met)
    for part in (values, seen, places):
        met = met.join(part, "id", "left")
    met = met.withColumn("property", property_block(met, options))
    codes = valuation.recommendation_codes(F.col("label"), F.col("property")["days_on_market"], F.col("photos_known"), F.col("poor_photos"))
    whole = lambda c: F.col(c).cast("long")
    value = _block(
        "valuation", estimated_value=whole("estimate"), estimated_price_per_sqm=valuation.whole(F.col("estimate") / F.nullif("area", F.lit(0))).cast("long"), recommended_price_range=_block("range", low=whole("low"), mid=whole("estimate"), high=whole("high")), local_median_price=whole("median_price"), local_median_price_per_sqm=whole("median_sqm"),
        price_difference=F.col("difference"), price_difference_percent=F.col("difference_pct"), sample_size=F.coalesce("sample_size", F.lit(0)), why_this_estimate=explanation(F.col("difference_pct"), F.col("sqm"), F.col("median_sqm"), F.coalesce("wide", F.lit(False))),
    )
    day = F.lit(options.generated_at.isoformat())
    return met.select(
        "id", F.lit(options.title).alias("report_title"), day.alias("generated_at"), "property", _block("pricing", currency=F.lit(options.currency), list_price=F.col("price").cast("double"), price_per_sqm=F.col("sqm")), value, comparables_block(), market_block(options), benchmarks_block(options), wealth_block(options), photos_block(), places_block(),
        _block("summary", headline=codes["verdict"], recommendation=F.concat(F.lit("priced_"), F.coalesce("label", F.lit("none"))), strengths=codes["strengths"], risks=codes["risks"], next_steps=codes["steps"]),
        _block("methodology", valuation_date=day, model_version=F.lit(options.model_version), data_freshness_note=F.lit("Comparables as stored when the job ran.")), _block("options", template=F.lit(options.template), language=F.lit(options.language)),
    )
