"""Literal cases of the listing jobs."""

import hashlib
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from estatelake.operators import features, geo, history, market, merge, normalize, photos, search, valuation
from estatelake.sources import io
from estatelake.streaming import listings as streams

RUN = datetime(2026, 6, 19, 6)


def one(spark, **columns):
    """The values of column expressions on one row."""
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def normal(spark, *items):
    good, bad = normalize.normalize_listings(spark.createDataFrame([(json.dumps(i, ensure_ascii=False),) for i in items], "raw string"), RUN)
    return good.collect(), bad.collect()


def test_normalize_all_shapes(spark):
    sreality = {"listingId": "711", "url": "https://www.sreality.cz/p/711", "dealType": "Prodej", "propertyType": "Byty", "title": "Svetlý byt", "locality": "Praha 8", "city": "Praha", "district": "Libeň", "rooms": "3+1", "areaSqm": 80, "latitude": 50.11, "longitude": None, "price": 6400000, "currency": "CZK", "images": ["x1", "x2", "x1", ""], "scrapedAt": "2025-11-02T10:20:30.500Z"}
    flat = {"id": "9", "source": "bezrealitky", "category": "domy", "name": "Dom", "price": "24000", "pricePerSqm": "300", "locality": "Prague 9", "layout": "DISP_5_KK", "floorArea": "80", "landArea": None, "lat": "50.13", "lon": "0", "imageUrl": "i9", "url": "https://www.bezrealitky.cz/nemovitosti-byty-domy/90210-nabidka-pronajem-domu"}
    rich = {"id": "4", "url": "https://www.bezrealitky.cz/4040-y", "estateType": "POZEMEK", "offerType": "PRODEJ", "disposition": "DISP_4_1", "address": "Polní, Prague - Čakovice", "surface": 64, "surfaceLand": 0, "price": 3200000, "currency": "EUR", "coordinates": {"lat": 50.15, "lng": 14.52}, "mainImage": {"id": "c", "url": "card"}, "publicImages": [{"url": "g1"}, {"url": "g2"}], "scrapedAt": "2025-11-02T10:20:30Z"}
    bazos = {"id": 5005, "title": "Prenájom 2-izbový byt", "priceRaw": "1 250 €", "locationName": "Trnava", "url": "https://reality.bazos.sk/inzerat/5005", "content": "tichá ulica, výmera 48,5 m2, predaj aj prenájom", "imageUrl": "b5"}
    good, bad = normal(spark, sreality, flat, rich, bazos, {"x": 1}, {"source": "bezrealitky", "url": "https://www.bezrealitky.cz/"})
    s, f, r, b = good
    assert (s["price_per_sqm"], s["district"], s["images"], s["deal_type"], s["lon"]) == (80000.0, "Libeň", ["x1", "x2"], "buy", None) and s["scraped_at"] == datetime(2025, 11, 2, 10, 20, 30, 500000)
    assert (f["source_listing_id"], f["deal_type"], f["category"], f["lon"], f["price_per_sqm"], f["layout"], f["scraped_at"]) == ("90210", "rent", "house", None, 300.0, "5+kk", RUN)
    assert (r["layout"], r["land_area"], r["district"], r["images"], r["image_url"], r["deal_type"], r["category"]) == ("4+1", None, "Praha - Čakovice", ["g1", "g2"], "card", "buy", "land") and r["url"] == "https://www.bezrealitky.cz/nemovitosti-byty-domy/4040-y"
    assert (b["deal_type"], b["category"], b["layout"], b["floor_area"], b["price"], b["currency"], b["price_per_sqm"]) == ("rent", "apartment", "2-izb", 48.5, 1250, "EUR", 25.77)
    assert [x["reason"] for x in bad] == ["unknown source", "no id"]


def test_text_rules(spark):
    got = one(spark, a=normalize.price_in_text(F.lit("2 345 €")), b=normalize.price_in_text(F.lit("Dohodou")), c=normalize.price_in_text(F.lit("9 €")), d=normalize.category_in_text(F.lit("nebytový priestor"), F.lit("")), e=normalize.deal_type_in_text(F.lit("Prenájom bytu"), F.lit("predaj a prenájom"), F.lit(200000)), f=normalize.layout_of(F.lit("GARSONIERA")), g=normalize.layout_of(F.lit("OSTATNI")))
    assert tuple(got) == (2345, None, None, "commercial", "rent", "1+kk", None)


def observations(spark, rows):
    return spark.createDataFrame(rows, "source string, listing_id long, scraped_at timestamp_ntz, event_id long, price double").withColumn("day", F.to_date("scraped_at"))


def test_history(spark):
    day = lambda d, h=0: datetime(2026, 1, d, h)
    obs = observations(spark, [("s", 1, day(1), 1, 99.0), ("s", 1, day(1, 5), 2, 100.0), ("s", 1, day(2), 3, None), ("s", 1, day(3), 4, 90.0), ("s", 2, day(1), 5, 0.0), ("s", 2, day(2), 6, 5.0)])
    got = {(r["listing_id"], r["day"]): tuple(r)[3:] for r in history.price_changes(history.day_snapshots(obs)).collect()}
    assert got == {(1, date(2026, 1, 3)): (100.0, 90.0, -10.0, -10.0), (2, date(2026, 1, 2)): (0.0, 5.0, 5.0, 0.0)}
    active = {r["listing_id"]: r["active"] for r in history.mark_inactive(history.current_listings(obs), day(6), 3).collect()}
    assert active == {1: True, 2: False}


def test_merge(spark):
    old = spark.createDataFrame([(1, "a", 10, "x"), (2, None, 20, "y")], "k int, p string, seen int, first string")
    new = spark.createDataFrame([(2, "b", 15, "z"), (3, "c", 30, "w")], "k int, p string, seen int, first string")
    policies = {"seen": "greatest", "first": "keep_old"}
    once = merge.merge_by_key(old, new, ["k"], policies)
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10, "x", "kept"), (2, "b", 20, "y", "updated"), (3, "c", 30, "w", "inserted")]
    again = merge.merge_by_key(once.drop("merge_action"), new, ["k"], policies)
    assert again.drop("merge_action").exceptAll(once.drop("merge_action")).count() == 0
    events = spark.createDataFrame([(1, 1, "pro", None), (1, 2, None, "active"), (1, 3, None, "canceled")], "u int, ts int, plan string, status string")
    assert tuple(merge.fold_partial_updates(events, ["u"], "ts", ["plan", "status"]).first()) == (1, "pro", "canceled")


def test_entitled_plan(spark):
    rows = [("user", False, s) for s in ("none", "canceled", "active", "trialing", "past_due")] + [("admin", False, "none"), ("user", True, "none")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, role string, o boolean, s string")
    got = df.select("i", search.entitled_plan(F.col("role"), F.col("o"), F.col("s"), F.lit(None).cast("string")).alias("p")).orderBy("i").collect()
    assert [r["p"] for r in got] == ["basic", "basic", "pro", "pro", "pro", "pro", "pro"]


@pytest.mark.parametrize(("a", "b", "want"), [(("x", 80, 50), ("x", 60, 40), 86), (("x", 80, 50), ("y", 60, 40), 46), ((None, 80, 50), (None, 60, 40), 46), (("x", None, 50), ("x", 60, 40), 91), (("x", 80, 50), ("x", 200, 40), 64)])
def test_similarity(spark, a, b, want):
    row = spark.createDataFrame([tuple(float(x) if isinstance(x, int) else x for x in (*a, *b))], "l1 string, a1 double, s1 double, l2 string, a2 double, s2 double")
    assert row.select(valuation.similarity(*map(F.col, ("l1", "l2", "a1", "a2", "s1", "s2")))).first()[0] == want


def test_comparables_keep_the_first_others(spark):
    rows = [(i, "d", "c", "buy", "2+kk", 50.0, 100.0 + i) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, district string, category string, deal_type string, layout string, area double, price double")
    got = {}
    for r in valuation.comparables(df, cap=5).select("id", "o_id").collect():
        got.setdefault(r["id"], []).append(r["o_id"])
    assert {i: sorted(o) for i, o in got.items()} == {i: [x for x in range(30) if x != i][:5] for i in range(30)}


def test_thinning_and_year_on_year(spark):
    series = spark.createDataFrame([("a", i) for i in range(20)] + [("b", i) for i in range(3)], "k string, t int")
    got = market.thinned(series, "k", "t").collect()
    assert sorted(r["t"] for r in got if r["k"] == "a") == [0, 1, 3, 4, 5, 6, 8, 9, 10, 11, 13, 14, 15, 16, 18, 19] and sum(r["k"] == "b" for r in got) == 3
    q = spark.createDataFrame([("a", 2025 + i // 4, i % 4 + 1, 100.0 + i) for i in range(5)], "place string, year int, quarter int, value double")
    assert [r["yoy"] for r in market.year_on_year(q, "place").orderBy("year", "quarter").collect()] == [None] * 4 + [4.0]


def test_near_places_is_brute_force(spark):
    import math
    import random

    rng = random.Random(1)
    pts = [(i, 48 + rng.random() / 10, 17 + rng.random() / 10) for i in range(60)]
    pois = [(i, rng.choice("ab"), 48 + rng.random() / 10, 17 + rng.random() / 10) for i in range(80)]

    def metres(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    p = spark.createDataFrame(pts, "point_id int, lat double, lon double")
    s = spark.createDataFrame(pois, "place_id int, category string, lat double, lon double")
    want = {(i, j) for i, a, b in pts for j, _, c, d in pois if metres(a, b, c, d) <= 2000}
    for parts in (1000, 5):
        got = [(r["point_id"], r["place_id"]) for r in geo.near_places(p, s, 2000, cell_points=parts).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_location_score(spark):
    names = [c for c, _, _ in geo.SCORE]
    df = spark.createDataFrame([(0, 0, 0, 0, 0, 0), (99, 99, 99, 99, 99, 99), (2, 5, 0, 3, 3, 2), (8, 1, 1, 0, 30, 0)], ", ".join(f"{n} int" for n in names))
    assert [r[0] for r in df.select(geo.location_score()).collect()] == [0.0, 100.0, 44.3, 51.0]


def test_streets_and_towns(spark):
    got = one(spark, a=geo.street_mention(F.lit("chata s terasou, ulica Jabloňová 5b")), b=geo.street_mention(F.lit("pekný byt bez adresy")), c=geo.street_mention(F.lit("Jabloňová ulica, tiché miesto")))
    assert tuple(got) == ("Jabloňová", None, "Jabloňová")
    towns = spark.createDataFrame([("Zvolen", "Zvolen", "BB", 48.57, 19.12)], "town string, district string, region string, lat double, lon double")
    met = geo.with_region(spark.createDataFrame([("zvolén",), ("ŽIAR",)], "t string"), towns, "t").orderBy("t").collect()
    assert [r["town_district"] for r in met] == ["Zvolen", None]
    ask = spark.createDataFrame([(1, ["Nikde", "Orechova"], "Zvolen", 48.57, 19.12), (2, ["Far"], "Zvolen", 48.57, 19.12)], "id int, candidates array<string>, town string, town_lat double, town_lon double")
    held = spark.createDataFrame([("orechova", "zvolen", 48.58, 19.13), ("Far", "Zvolen", 50.0, 14.0)], "street string, town string, lat double, lon double")
    out = {r["id"]: (r["street"], r["geo_precision"]) for r in geo.geocode_streets(ask, held).collect()}
    assert out == {1: ("Orechova", "street"), 2: ("Far", None)}


def test_photos(spark):
    hash_ = spark.createDataFrame([(["p/1", "p/2"],)], "i array<string>").select(photos.gallery_hash(F.col("i"))).first()[0]
    assert hash_ == hashlib.sha256(b"p/1\np/2").hexdigest()
    stored = spark.createDataFrame([(1, hash_, "v2", None), (3, "stale", "v2", None), (4, hash_, "v1", None), (5, hash_, "v2", datetime(2026, 1, 9))], "id long, gallery string, version string, failed_at timestamp")
    items = spark.createDataFrame([(i, ["p/1", "p/2"]) for i in (1, 2, 3, 4, 5)], "id long, images array<string>")
    assert [r["id"] for r in photos.pending_galleries(items, stored, datetime(2026, 1, 10), "v2").collect()] in ([2, 3, 4], [2, 4, 3], [4, 2, 3], [3, 2, 4], [3, 4, 2], [4, 3, 2])
    results = spark.createDataFrame([(1, "g", "v3", 0), (9, "g", "v3", 0), (8, "g", "v3", 2)], "id long, gallery string, version string, n_images int")
    out = {r["id"]: (r["version"], r["failed_at"]) for r in photos.merge_scores(stored, results, RUN).collect()}
    assert out[1] == ("v2", RUN) and 9 not in out and out[8] == ("v3", None)


def test_sources(spark, folder):
    with open(f"{folder}/actor_2026-06-18_05-00-00.json", "w") as f:
        f.write('[{"a": 1}, {"a": "x"}]')
    with open(f"{folder}/other_2026-06-18_06-00-00.json", "w") as f:
        f.write('{"a": 3}')
    got = io.read_dumps(spark, f"{folder}/*.json").collect()
    assert sorted((r["actor"], json.loads(r["raw"])["a"]) for r in got if r["actor"] == "other") == [("other", 3)] and len(got) == 3 and all(r["landed_at"] for r in got)
    with open(f"{folder}/b.csv", "w") as f:
        f.write("source,year,value,extra\nx,12.0,,y\n")
    row = io.read_benchmarks(spark, f"{folder}/b.csv").first()
    assert (row["source"], row["year"], row["value"], row["city"]) == ("x", 12, None, None)
    with pytest.raises(ValueError, match="extra"):
        io.read_benchmarks(spark, f"{folder}/b.csv", strict=True)
    wide = spark.createDataFrame([("1Q 2026", 1.0, 2.0)], "q string, BA double, SR double")
    assert sorted(map(tuple, io.melt_index(wide, "q", "SR").collect())) == [("city", "SR", "2026_Q1", 2026, 1, 2.0), ("district", "BA", "2026_Q1", 2026, 1, 1.0)]
    assert io.export_csv(wide, f"{folder}/out") == 1


def test_buy_vs_rent(spark):
    df = spark.createDataFrame([(240000.0, 1100.0, 5.0)], "price double, rent double, growth_pct double")
    r = valuation.buy_vs_rent(df).first()
    assert 910 <= r["payment"] <= 920 and len(r["path"]) == 31 and r["path"][0]["buyer"] == 48000 and r["break_even_year"] == 1


def test_train_and_score(spark):
    rows = [("s", "c", f"d{i % 3}", float(20 + i), 5.0, 100.0, 2.0, 1000.0 * (20 + i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "source string, category string, district string, area double, n double, median_price double, median_sqm double, target double")
    model, metrics = features.train(frame, rounds=10)
    out = features.score(model, frame.withColumn("district", F.lit("new")))
    assert metrics["r2"] > 0.5 and out.count() == 60 and out.filter("predicted > 0").count() == 60
    with pytest.raises(ValueError, match="5 rows"):
        features.train(frame.limit(4))


def test_streams_match_batch(spark, folder):
    day = lambda d: datetime(2026, 1, d)
    obs = observations(spark, [("s", k, day(1 + i), 10 * k + i, float(100 + (i * k) % 7)) for k in range(1, 6) for i in range(9)])
    obs.repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(obs.schema).parquet(f"{folder}/in")
    streams.price_changes(stream).writeStream.format("memory").queryName("changes").outputMode("append").option("checkpointLocation", f"{folder}/c1").trigger(availableNow=True).start().awaitTermination()
    batch = history.price_changes(history.day_snapshots(obs)).select("source", "listing_id", "day", "old_price", "new_price")
    assert sorted(map(tuple, spark.table("changes").collect())) == sorted(map(tuple, batch.collect()))
    timed = stream.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")).withColumn("content_hash", F.lit("h"))
    streams.daily_medians(timed).writeStream.format("memory").queryName("medians").outputMode("complete").option("checkpointLocation", f"{folder}/c2").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("medians").count() == 9
    seen = []
    streams.ingest(streams.without_repeats(timed), lambda df, i: seen.append(df.count()), f"{folder}/c3").awaitTermination()
    assert sum(seen) == 45


def test_backfills(spark):
    url = "https://www.bezrealitky.cz/77-x"
    got = one(spark, a=normalize.repaired_url(F.lit(url)), b=normalize.repaired_url(normalize.repaired_url(F.lit(url))), c=normalize.backfilled_deal_type(F.lit(None).cast("string"), F.lit("http://x/na-predaj"), F.lit("{}")), d=normalize.backfilled_deal_type(F.lit(None).cast("string"), F.lit("http://x"), F.lit('{"offerType": "PRONAJEM"}')), e=normalize.backfilled_deal_type(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    fixed = "https://www.bezrealitky.cz/nemovitosti-byty-domy/77-x"
    assert tuple(got) == (fixed, fixed, "buy", "rent", "buy")
    target = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    source = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "y", 1)], "k int, v string, ts int")
    assert sorted(map(tuple, merge.backfill(target, source, ["k"], ["v"], "ts").collect())) == [(1, "new"), (2, "x")]
    assert normalize.universal_log(target, source).columns == ["k", "v", "ts"]


def test_regions_and_streets(spark):
    regions = spark.createDataFrame([("Levice", "NR"), ("Nitra", "NR")], "name string, region string")
    asked = spark.createDataFrame([(1, "Levice", None), (2, None, "Nitra"), (3, "Atlantis", None)], "i int, district string, city string")
    assert {r["i"]: r["index_region"] for r in geo.index_region(asked, regions).collect()} == {1: "NR", 2: "NR", 3: "SR"}
    areas = spark.createDataFrame([("Čakovice", "Praha 18")], "area string, district string")
    named = spark.createDataFrame([("Praha - Čakovice",), ("Praha 7",), ("Brno",)], "district string")
    assert {r["district"]: r["admin_district"] for r in geo.administrative_district(named, areas).collect()} == {"Praha - Čakovice": "Praha 18", "Praha 7": "Praha 7", "Brno": None}
    got = [r[0] for r in spark.createDataFrame([("Tatranskej",), ("Orechova",), (None,)], "s string").select(geo.street_candidates(F.col("s"))).collect()]
    assert "Tatranská" in got[0] and got[0][-1] == "Tatranskej" and got[1:] == [["Orechova"], None]


def test_report_parts(spark):
    entries = spark.createDataFrame([("buy", 3100.0, 2050.5), ("rent", 9.5, 2050.5)], "d string, l double, r double")
    assert [len(r[0]) for r in entries.select(valuation.benchmark_entries(F.col("d"), F.col("l"), F.col("r"))).collect()] == [2, 1]
    listings = spark.createDataFrame([(1, "buy", "card", ["a", "card"], datetime(2026, 1, 1))], "id long, deal_type string, image_url string, images array<string>, first_seen_at timestamp")
    assert tuple(valuation.property_facts(listings, datetime(2026, 1, 11)).first()) == (1, ["card", "a"], 10, "sale")
    counts = spark.createDataFrame([(3, None)], "a int, b int")
    assert [x["label"] for x in counts.select(valuation.location_facts(["a", "b"])).first()[0]] == ["a"]
    ordered = search.in_given_order(spark.range(5), [3, 9, 1, 3]).collect()
    assert [r["id"] for r in ordered] == [3, 1]
    merged = merge.merge_by_key(spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"])
    assert tuple(merge.run_summary(merged, spark.range(1), spark.range(0)).first()) == (1, 1, 1, 0, "succeeded")
