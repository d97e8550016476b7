"""Valuation documents of listings that lack what a document shows."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from estatelake.operators import report

LISTING = "id long, source string, title string, category string, deal_type string, layout string, locality string, district string, city string, lat double, lon double, area double, land_area double, price double, url string, image_url string, images array<string>, active boolean, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz"
SCORES = "id long, model_provider string, image_quality double, photo_quality double, brightness double, sharpness double, exposure_quality double, resolution_quality double, blurry_image_ratio double, dark_image_ratio double, gallery_size int"
OPTIONS = report.Options(datetime(2026, 1, 31, tzinfo=UTC), language="sk")


def at(day, hour=0):
    return datetime(2026, 1, day, hour)


def listing(i, price=100.0, area=50.0, **more):
    row = {"source": "s", "title": f"T{i}", "category": "house", "deal_type": "buy", "layout": "2+kk", "locality": "L", "district": "D", "city": "C", "lat": 48.0, "lon": 17.0, "land_area": None, "url": f"u{i}", "image_url": None, "images": None, "active": True, "first_seen_at": at(1), "last_seen_at": at(15, 23)} | {"price": price, "area": area} | more
    return (i, *(row[c.split()[0]] for c in LISTING.split(", ")[1:]))


@pytest.fixture(scope="module")
def documents(spark):
    rows = [
        listing(1), listing(2, 110.0), listing(3, 90.0, 45.0), listing(4, None), listing(5, 130.0, active=False),
        listing(6, 1.0, deal_type="rent"), listing(7, 1.2, 40.0, deal_type="rent"),
        listing(8, None, None, source=None, title=None, category=None, deal_type=None, layout=None, locality=None, district=None, city=None, lat=None, lon=None, url=None, active=None, first_seen_at=None, last_seen_at=None),
        listing(9, 120.0, images=["a", "b", "c", "d"], image_url="c", last_seen_at=None), listing(10, 100.0, images=["a"], image_url="card", first_seen_at=at(15), last_seen_at=at(15)),
        listing(11, 500.0, district="E"),
    ]
    make = lambda r: spark.createDataFrame(r, LISTING)
    index = spark.createDataFrame([(x, 2024 + q // 4, q % 4 + 1, f"{2024 + q // 4}_Q{q % 4 + 1}", 1000.0 + 10 * q + k) for k, x in enumerate(("R", "SR")) for q in range(8 if x == "SR" else 4)], "region string, year int, quarter int, period string, value double")
    regions, growth = spark.createDataFrame([("d", "R")], "name string, region string"), spark.createDataFrame([("R", 3.0), ("SR", 7.0)], "region string, growth_pct double")
    scores = spark.createDataFrame([(1, None, 0.5, None, 60.0, 0.3, 80.0, 70.0, 0.0, 0.9, 4), (2, "mock", 0.9, None, 60.0, 0.3, 80.0, 70.0, 0.0, 0.0, 4)], SCORES)
    counted = ", ".join(f"{c} long" for c, _ in report.FACILITIES)
    places = spark.createDataFrame([(1, 1, 2, None, 0, 4, 5)], f"id long, {counted}")
    run = lambda r: report.valuation_reports(make(r), index, regions, growth, scores, places, OPTIONS)
    assert run([]).count() == 0
    return {r["id"]: r.asDict(recursive=True) for r in run(rows).collect()}


def test_every_listing_has_a_document(documents):
    assert sorted(documents) == list(range(1, 12))
    assert set(documents[1]) == {"id", "report_title", "generated_at", "property", "pricing", "valuation", "comparables", "market_statistics", "benchmarks", "buy_vs_rent", "vision_analysis", "location_facilities", "summary", "methodology", "options"}


def test_values_and_comparables(documents):
    one = documents[1]
    # Others of listing 1: 2 (2.2 a m2), 3 (2.0), 9 (2.4), 10 (2.0), of the city also 11 only where few are strong.
    assert one["valuation"]["sample_size"] == 4 and one["valuation"]["local_median_price"] == 105 and one["valuation"]["local_median_price_per_sqm"] == 2
    assert one["valuation"]["recommended_price_range"] == {"low": 95, "mid": 100, "high": 105} and one["valuation"]["why_this_estimate"] == ["price_inline", "sqm_inline"]
    assert [c["label"] for c in one["comparables"]] == ["subject", "median", "best_1", "best_2"] and [c["is_subject"] for c in one["comparables"]] == [True, False, False, False]
    assert one["comparables"][1]["price_difference_vs_subject"] == 5.0
    assert documents[4]["valuation"]["estimated_value"] == 100 and documents[4]["valuation"]["price_difference"] is None and documents[4]["summary"]["headline"] == "verdict_none" and documents[4]["valuation"]["why_this_estimate"] == ["none"]
    assert documents[11]["valuation"]["why_this_estimate"][-1] == "widened" and documents[11]["summary"]["strengths"] == ["recent"] and documents[11]["summary"]["risks"][0] == "above"


def test_blocks_without_facts(documents):
    bare = documents[8]
    assert bare["valuation"]["sample_size"] == 0 and bare["valuation"]["estimated_value"] is None and [c["label"] for c in bare["comparables"]] == ["subject"]
    assert bare["buy_vs_rent"] is None and bare["location_facilities"] == {"available": False, "map_image_url": None, "facilities": []} and not bare["vision_analysis"]["available"]
    assert bare["market_statistics"]["region"] == "SR" and bare["market_statistics"]["distribution"] is None and bare["property"]["days_on_market"] is None and bare["property"]["images"] == []
    assert bare["options"] == {"template": "standard", "language": "sk"}


def test_property_photos_places_and_index(documents):
    assert documents[9]["property"]["images"] == ["a", "b", "c", "d"] and documents[10]["property"]["images"] == ["card", "a"]
    assert [documents[i]["property"]["days_on_market"] for i in (1, 9, 10)] == [14, 30, 0]
    assert "recent" in documents[1]["summary"]["strengths"] and documents[1]["summary"]["risks"] == ["photo_only", "poor_photos"] and documents[2]["summary"]["risks"] == ["above", "no_photos"]
    assert documents[1]["vision_analysis"]["photo_quality"] == 50.0 and not documents[2]["vision_analysis"]["available"]
    assert [f["count"] for f in documents[1]["location_facilities"]["facilities"]] == [1, 2, 0, 4, 5]
    here, nation = documents[1]["market_statistics"], documents[11]["market_statistics"]
    assert (here["region"], len(here["series"]), here["yoy_change"], here["average_price_per_sqm"]) == ("R", 4, None, 1030.0)
    assert (nation["region"], len(nation["series"]), nation["yoy_change"], nation["period"]) == ("SR", 8, 3.9, "2025_Q4")


def test_projection_needs_rents_and_a_sale(documents):
    rent = documents[1]["buy_vs_rent"]
    # Rents of 0.02 and 0.03 a m2: the median of 0.025 (rounded to 0.03) x 50.
    assert rent["assumptions"]["monthly_rent"] == 2.0 and rent["assumptions"]["property_growth_pct"] == 3.0 and len(rent["series"]) == 31 and rent["down_payment"] == 20
    assert documents[6]["buy_vs_rent"] is None and documents[11]["buy_vs_rent"] is None and documents[4]["buy_vs_rent"] is None
    assert [b["benchmark_type"] for b in documents[6]["benchmarks"]] == [] and [b["benchmark_type"] for b in documents[1]["benchmarks"]] == ["listing_asking", "realized_sale"]


def test_shared_results_are_made_once(spark, monkeypatch):
    made = []
    real = report.keep
    monkeypatch.setattr(report, "keep", lambda df, name: made.append(name) or real(df, name))
    empty = lambda schema: spark.createDataFrame([], schema)
    report.valuation_reports(empty(LISTING), empty("region string, year int, quarter int, period string, value double"), empty("name string, region string"), empty("region string, growth_pct double"), empty(SCORES), empty("id long, " + ", ".join(f"{c} long" for c, _ in report.FACILITIES)), OPTIONS).filter(F.lit(True)).count()
    assert made == ["report-listings", "report-pools", "report-segments"]
