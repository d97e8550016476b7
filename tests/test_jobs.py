"""Jobs without SQL: models, counters, stores, limits."""

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from estatelake.operators import features, geo, history, market, merge, normalize, photos, search, valuation
from estatelake.sources import io, shared
from estatelake.streaming import listings as streams

NOW = datetime(2026, 1, 10)


def frame(spark, n, districts):
    rows = [(i, "s", "buy", ["flat", "house"][i % 2], f"street {i % 7}", f"d{i % districts}", ["2+kk", "3+1", None][i % 3], float(20 + i % 90), 5, 100.0, 2.0, None if i % 4 else i / n, 1000.0 * (20 + i % 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "snapshot_id long, source string, deal_type string, category string, locality string, district string, layout string, area double, n int, median_price double, median_sqm double, photo_brightness double, target double")
    return df.withColumn("layout_code", features.layout_code(F.col("layout"))).withColumn("land_area", F.lit(None).cast("double"))


def test_training_with_many_districts(spark, folder):
    df = frame(spark, 700, 400)
    model, metrics = features.train(df, rounds=3)
    assert set(metrics) == {"mae", "rmse", "r2"}
    assert model.stages[3].getInputCols() == [f"{c}_order" for c in features.CATEGORICAL] + [f"{c}_filled" for c in ("layout_code", "area", "n", "median_price", "median_sqm")]
    odd = df.limit(3).withColumn("district", F.lit("nowhere"))
    assert {r["district_order"] for r in model.transform(odd).collect()} == {-1.0}
    about = features.save_model(model, metrics, folder, "m", "1", "sale_price", 700).first()
    again, stored = features.load_model(spark, folder, "m", "1")
    assert stored.first() == about and about["target"] == "sale_price" and "area" in about["numeric"] and about["categorical"] == features.CATEGORICAL
    one, two = (sorted(r["predicted"] for r in features.score(x, odd.drop("layout_code"), "sale_price").collect()) for x in (model, again))
    assert one == two and all(isinstance(x, int) for x in one)
    assert all(round(r["predicted"], 2) == r["predicted"] for r in features.score(model, odd, "sale_price_per_sqm").collect())
    with pytest.raises(ValueError, match="no model"):
        features.score(None, odd, "rent_price")


def test_photo_columns_are_a_choice(spark):
    df = frame(spark, 60, 3)
    without, with_ = (features.train(df, rounds=1, photos=x)[0].stages[3].getInputCols() for x in (False, True))
    assert set(with_) - set(without) == {"photo_brightness_filled"}  # the other photo columns aren't there


@pytest.mark.parametrize("target", ["sale_price", "rent_price_per_sqm"])
def test_targets(spark, target):
    kind, value = features.target_value(target)
    got = spark.createDataFrame([(100.0, 4.0)], "price double, area double").select(value).first()[0]
    assert (kind, got) == (("buy", 100.0) if target == "sale_price" else ("rent", 25.0))
    with pytest.raises(ValueError, match="no such target"):
        features.target_value("swap_price")


def test_marking_stale_counts(spark):
    rows = spark.createDataFrame([(1, True, datetime(2026, 1, 9)), (2, True, datetime(2026, 1, 1)), (3, False, datetime(2026, 1, 9)), (4, None, datetime(2026, 1, 9))], "id int, active boolean, last_seen_at timestamp_ntz")
    seen = Observation()
    got = {r["id"]: r["active"] for r in history.mark_inactive(rows, NOW, 3, seen).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False} and seen.get["n_marked"] == 1


def test_buy_or_rent_by_a_loop(spark):
    cases = [(90_000.0, 1_900.0, 2.0), (210_000.0, 640.0, 6.0), (0.0, 100.0, 1.0), (50_000.0, 0.0, 8.0)]
    got = valuation.buy_vs_rent(spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, price double, rent double, growth_pct double")).orderBy("i").collect()
    for (price, rent, growth), r in zip(cases, got, strict=True):
        debt, value, buyer, renter = price * 0.8, price, 0.0, price - price * 0.8
        pay = debt * (0.04 / 12) / (1 - (1 + 0.04 / 12) ** -360)
        path = [(0, round(value - debt), round(renter))]
        for m in range(1, 361):
            renter, buyer, gap = renter * 1.05 ** (1 / 12), buyer * 1.05 ** (1 / 12), pay - rent
            renter, buyer = renter + max(gap, 0), buyer + max(-gap, 0)
            debt = max(0.0, debt * (1 + 0.04 / 12) - pay)
            value, rent = value * (1 + growth / 100) ** (1 / 12), rent * 1.025 ** (1 / 12)
            if m % 12 == 0:
                path.append((m // 12, round(value - debt + buyer), round(renter)))
        assert [tuple(p) for p in r["path"]] == [pytest.approx(p, abs=1) for p in path]
        first = next((y for y, b, t in path[1:] if b >= t), None)
        assert r["break_even_year"] == first and r["buyer_final"] == pytest.approx(path[-1][1], abs=1)


def test_comparables_of_unknown_facts_and_inactive_ones(spark):
    rows = [(1, "d", "c", "buy", 50.0, 100.0, True), (2, "d", "c", "rent", 50.0, 100.0, True), (3, "d", None, "buy", 50.0, 100.0, True), (4, "d", "c", "buy", 50.0, 100.0, False), (5, "d", "c", "buy", None, 100.0, True), (6, "e", "c", "buy", 50.0, 100.0, True), (7, "d", "x", None, 50.0, 90.0, True)]
    df = spark.createDataFrame(rows, "id long, district string, category string, deal_type string, area double, price double, active boolean").withColumn("layout", F.lit("2+kk"))
    got = {}
    for r in valuation.comparables(df).collect():
        got.setdefault(r["id"], set()).add(r["o_id"])
    # 3 has no category: any; 7 no deal type; 4 is inactive and 5 has no price per m2, so they are no one's comparables.
    assert got == {3: {1}, 4: {1}, 5: {1}} | {k: v for k, v in got.items() if k in (1, 2, 7)} and got.get(1) is None and got.get(2) is None and got.get(7) is None


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * 6_371_000 * math.asin(math.sqrt(min(1.0, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


@pytest.mark.parametrize("radius", [500, 3000, 60_000])
def test_places_at_the_poles_and_the_date_line(spark, radius):
    """At 80 degrees, across 180 degrees, round both poles and on the equator, with crowded cells: brute force."""
    rng, near = random.Random(radius), radius / 111_194.9
    centres = [(80.0, 179.9999), (-80.0, 20.0), (0.0, -180.0), (48.2, 17.1), (90.0, 0.0), (-89.999, 77.0), (89.99, -120.0), (-16.5, 180.0)]

    def around():
        lat, lon = rng.choice(centres)
        lat = max(-90.0, min(90.0, lat + rng.uniform(-1.5, 1.5) * near))
        lon += rng.uniform(-1.5, 1.5) * near / max(math.cos(math.radians(lat)), 0.001)
        return lat, (lon + 180) % 360 - 180

    points = [(i, *around()) for i in range(150)] + [(500, None, 1.0), (501, 1.0, None)]
    held = [(i, rng.choice("ab"), *around()) for i in range(150)] + [(500, "a", None, 1.0)]
    p = spark.createDataFrame(points, "point_id int, lat double, lon double")
    s = spark.createDataFrame(held, "place_id int, category string, lat double, lon double")
    want = sorted((i, j) for i, a, b in points for j, _, c, d in held if None not in (a, b, c, d) and metres(a, b, c, d) <= radius)
    for cell_points in (10_000, 3):
        assert sorted((r["point_id"], r["place_id"]) for r in geo.near_places(p, s, radius, cell_points=cell_points).collect()) == want
    assert len(want) > 300


def test_half_of_all_points_in_one_cell(spark):
    p = spark.createDataFrame([(i, 48.0 + (0.3 if i % 2 else i / 1e7), 17.0) for i in range(2000)], "point_id int, lat double, lon double")
    s = spark.createDataFrame([(1, "a", "x", 48.0, 17.0), (2, "a", None, 48.0, 17.0), (3, "a", " ", 48.0001, 17.0)], "place_id int, category string, name string, lat double, lon double")
    got = geo.nearest_place(p, s, 500.0).collect()
    assert len(got) == 1000 and {(r["place_id"], r["name"]) for r in got} == {(1, "x")}
    sizes = geo.near_places(p, s, 500.0, cell_points=100).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 3000


def test_copies_of_coordinates_meet_once(spark):
    """F1, F3 to F5: 2,000 points at two spots and 3,000 places at three made 6,000,000 pairs."""
    p = spark.createDataFrame([(i, 48.0 + i % 2 / 1000, 17.0) for i in range(2000)] + [(5000, None, 17.0)], "point_id int, lat double, lon double")
    s = spark.createDataFrame([(i, "ab"[i % 3 // 2], f"n{i}", 48.0 + i % 3 / 1000, 17.0) for i in range(2999, -1, -1)], "place_id int, category string, name string, lat double, lon double")
    met, plain = [], geo.near_places
    try:
        geo.near_places = lambda *a: met.append(plain(*a)) or met[-1]
        counts, nearest = geo.place_counts(p, s, [("a_50m", "a", 50.0), ("b_500m", "b", 500.0)]).collect(), geo.nearest_place(p, s, 500.0).collect()
    finally:
        geo.near_places = plain
    assert {(r["point_id"] % 2, r["a_50m"], r["b_500m"]) for r in counts if r["lat"] is not None} == {(0, 1000, 1000), (1, 1000, 1000)} and len(counts) == 2001
    assert [(r["a_50m"], r["b_500m"]) for r in counts if r["lat"] is None] == [(0, 0)]
    assert {(r["point_id"] % 2, r["category"], r["place_id"], r["name"]) for r in nearest} == {(0, "a", 0, "n0"), (1, "a", 1, "n1"), (0, "b", 2, "n2"), (1, "b", 2, "n2")} and len(nearest) == 4000
    assert len(met) == 3 and sum(x.count() for x in met) <= 15


def test_sql_of_comparables_with_prices_of_zero(spark, folder):
    """F6 to F9: others have a price per m2, so a price of 0 is no comparable; the SQL took it for one."""
    import duckdb

    import __spark_entry__ as entry

    for name in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    i = F.col("id")
    spark.range(1200).select(i.alias("event_id"), F.timestamp_seconds(1704067200 + i * 60).alias("ts"), i.alias("user_id"), F.lit("view").alias("event_type"), F.when(i % 7 == 0, 0.0).otherwise(i % 90 + 0.5).alias("value"), F.format_string('{"k": %d}', i % 40).alias("props")).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    for name in ("nation", "region", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    for name in ("a7_value_listings", "r2_comparable_rows", "u1_widened_pool", "w5_best_comparables"):
        got, want = entry.queries()[name](spark, folder).toPandas(), con.execute(entry.oracle_sql()[name]).df()[entry.queries()[name](spark, folder).columns]
        texts = lambda df: sorted(["" if x is None or x != x else str(float(x)) if isinstance(x, (int, float)) else str(x) for x in row] for row in df.astype(object).to_numpy().tolist())
        assert texts(got) == texts(want), name


def test_an_item_is_parsed_once(spark):
    """the filters of good and bad items parsed each item anew for every field that they look at."""
    import contextlib
    import io

    from estatelake.operators import normalize

    raw = spark.createDataFrame([('{"id": 1, "url": "https://reality.bazos.sk/1"}',), ('{"foo": 1}',)], "raw string")
    for part in normalize.normalize_listings(raw, datetime(2026, 6, 19)):
        assert part.count() == 1
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            part.explain()
        assert plan.getvalue().count("from_json(StructField(url") == 1


def test_latitudes_that_do_not_exist_raise(spark):
    p = spark.createDataFrame([(1, 90.5, 17.0)], "point_id int, lat double, lon double")
    s = spark.createDataFrame([(1, "a", 48.0, 17.0)], "place_id int, category string, lat double, lon double")
    with pytest.raises(Exception, match="no such latitude"):
        geo.near_places(p, s, 500).collect()


def test_comparables_of_a_listing_without_a_price(spark):
    rows = [(1, "d", "c", "buy", 50.0, None), (2, "d", "c", "buy", 50.0, 100.0), (3, "d", "c", "buy", 40.0, 101.0), (4, "d", "c", "buy", 60.0, None)]
    df = spark.createDataFrame(rows, "id long, district string, category string, deal_type string, area double, price double").withColumn("layout", F.lit("2+kk"))
    pairs = valuation.comparables(df)
    assert sorted((r["id"], r["o_id"]) for r in pairs.collect()) == [(1, 2), (1, 3), (2, 3), (3, 2), (4, 2), (4, 3)]
    got = {r["id"]: r for r in valuation.value_listings(pairs).collect()}
    # The medians are 100.5 and (2.0 + 2.53) / 2 = 2.265: 100 and 2, so the estimates are 2 x area.
    assert [(i, got[i]["median_price"], got[i]["median_sqm"], got[i]["estimate"], got[i]["difference"], got[i]["label"]) for i in (1, 4)] == [(1, 100.0, 2.0, 100.0, None, None), (4, 100.0, 2.0, 120.0, None, None)]
    assert (got[2]["estimate"], got[2]["difference"], got[2]["difference_pct"], got[2]["label"]) == (150.0, -50.0, -33.3, "undervalued")


def test_partitions_that_no_update_names_stay(spark, folder):
    schema, keys = "k int, day date, v int", ["k", "day"]
    first = spark.createDataFrame([(1, datetime(2026, 1, 1), 1), (2, datetime(2026, 1, 2), 2)], schema)
    path = f"file://{folder}/t"
    merge.upsert_partitions(spark, path, first, keys, "day")
    first_day = lambda: {f for f in spark.read.parquet(path).inputFiles() if "day=2026-01-01" in f}
    old = first_day()
    more = spark.createDataFrame([(2, datetime(2026, 1, 2), 5), (3, datetime(2026, 1, 2), 3)], schema)
    for _ in range(2):
        merge.upsert_partitions(spark, path, more, keys, "day")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 5), (3, 3)]
    assert old == first_day() and old


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())


def test_file_names_and_towns(spark):
    assert io.index_file_name("buy", "house", "Nové Mesto 3") == "market-index-buy-house-nov-mesto-3.csv" and io.index_file_name("rent", "house", "ů") == "market-index-rent-house-district.csv"
    towns = spark.createDataFrame([("Nitra", "Nitra", "NR", 48.3, 18.1)], "town string, district string, region string, lat double, lon double")
    alias = spark.createDataFrame([("Nitra mesto", "nitra")], "alias string, town string")
    got = geo.with_region(spark.createDataFrame([("NITRA MESTO",), ("nitra",), ("x",)], "t string"), towns, "t", alias).orderBy("t").collect()
    assert [r["town_region"] for r in got] == ["NR", "NR", None]


def test_normalising_hostile_items(spark):
    items = ["{", "[]", '"x"', "", None, "{}", '{"listingId": ""}', '{"listingId": 1, "images": [{"url": "a"}, "b", {"url": "a"}], "price": "1e3"}', '{"listingId": 2, "images": "no list"}']
    good, bad = normalize.normalize_listings(spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, raw string"), NOW)
    rows = {r["i"]: r for r in good.collect()}
    assert set(rows) == {7, 8} and rows[7]["images"] == ["a", "b"] and rows[7]["price"] == 1000 and rows[8]["images"] == []
    assert {r["i"]: r["reason"] for r in bad.collect()} == dict.fromkeys(range(7), "unknown source")


def test_photo_scale_and_buckets(spark):
    got = spark.createDataFrame([(0.5,), (7.0,), (55.0,), (500.0,), (None,)], "s double").select(photos.to_100(F.col("s")).alias("x"), market.bucket(F.lit("domy")).alias("b")).collect()
    assert [r["x"] for r in got] == [50.0, 70.0, 55.0, 100.0, None] and got[0]["b"] == "house"


def test_stale_listing_seen_again(spark, folder):
    day = lambda d: datetime(2026, 1, d)
    for rows in [[("s", 1, day(1)), ("s", 2, day(1))], [("s", 2, day(3)), ("s", 3, day(6))], [("s", 1, day(7))], [("s", 3, day(20))]]:
        spark.createDataFrame(rows, "source string, listing_id long, scraped_at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        out = streams.stale_listings(spark.readStream.schema("source string, listing_id long, scraped_at timestamp").parquet(f"{folder}/in"), 3)
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["listing_id"], r["last_seen_at"].day) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [(1, 1), (1, 7), (2, 3), (3, 6)]


def test_picked_list_drops_the_subject(spark):
    assert [r["id"] for r in search.in_given_order(spark.range(5), [3, 2, 9, 1], subject=2).collect()] == [3, 1]


def test_training_makes_its_rows_once_and_deals_them_to_all_cores(spark):
    made, df = spark.sparkContext.accumulator(0), frame(spark, 90, 4)

    def sized(i):
        made.add(1)
        return float(20 + i % 90)

    features.train(df.withColumn("area", F.udf(sized, "double").asNondeterministic()("snapshot_id")), rounds=1, depth=2)
    assert made.value == 90
    assert [features.training_parts(n, 12) for n in (90, 200_000, 3_200_000, 19_400_000, 100_000_000)] == [1, 4, 12, 12, 36]
