"""Comparables, value and wealth projections for all listings at once."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake.functions.columns import per_sqm, rounded

SEGMENT = ["district", "category", "deal_type"]


def similarity(layout_a, layout_b, area_a, area_b, sqm_a, sqm_b) -> F.Column:
    """0 to 100: layout 40 (always counted), area 30 and price per m2 30 (counted if both are there and positive)."""
    close = lambda a, b: F.greatest(F.lit(0.0), 1 - F.abs(a - b) / a)
    both = lambda a, b: F.coalesce((a > 0) & (b > 0), F.lit(False))
    got = F.when(layout_a == layout_b, 40.0).otherwise(0.0) + F.when(both(area_a, area_b), 30 * close(area_a, area_b)).otherwise(0.0) + F.when(both(sqm_a, sqm_b), 30 * close(sqm_a, sqm_b)).otherwise(0.0)
    most = F.lit(40.0) + F.when(both(area_a, area_b), 30.0).otherwise(0.0) + F.when(both(sqm_a, sqm_b), 30.0).otherwise(0.0)
    return F.bround(got / most * 100, 0).cast("int")


#: In a segment's key: a listing without this fact is compared with all.
ANY = "\0any"
SALTS = 8
#: Listings of one part, about, that are held against their pools; and listings of one matrix.
PART_LISTINGS, BLOCK = 5_000, 500
#: What a pool says about each other listing.
POOLED = ["id", "layout", "area", "price", "sqm"]


def _others(facts: DataFrame) -> DataFrame:
    """Listings that may be others, with each _c and _d that they are met under."""
    held = (facts.filter("active") if "active" in facts.columns else facts).filter(F.col("price").isNotNull() & F.col("sqm").isNotNull())
    either = lambda c: F.array_compact(F.array(F.col(c), F.lit(ANY)))
    return held.withColumn("_c", F.explode(either("category"))).withColumn("_d", F.explode(either("deal_type")))


def _segment_others(facts: DataFrame, cap: int, also: tuple[str, ...] = ()) -> DataFrame:
    """(district, _c, _d, _pool): a segment's first cap + 1 others by id in one row, with the columns ``also``; they are cut before the shuffle."""
    held = _others(facts)
    nth = F.row_number().over(Window.partitionBy("district", "_c", "_d").orderBy("id"))
    few = held.withColumn("_n", nth).filter(F.col("_n") <= cap + 1)
    return few.groupBy("district", "_c", "_d").agg(F.array_sort(F.collect_list(F.struct(*POOLED, *also))).alias("_pool"))


def _salted(pool: DataFrame) -> DataFrame:
    return pool.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def _asked(facts: DataFrame, *places: str) -> DataFrame:
    return facts.select(*POOLED, *places).withColumns({"_c": F.coalesce("category", F.lit(ANY)), "_d": F.coalesce("deal_type", F.lit(ANY)), "_salt": F.pmod(F.xxhash64("id"), F.lit(SALTS))})


def comparables(listings: DataFrame, cap: int = 200) -> DataFrame:
    """Pairs (id, other) of a segment with their similarity; ``cap`` others of each segment, by id, as the rule has it.

    Others are active (if there is a column ``active``) and have a price and a
    price per m2; a listing that has none itself meets them all the same. One
    without a category or deal type meets those of any.
    listings: id, SEGMENT, layout, area, price.

    A segment's first cap + 1 others are one row, whatever its size; they are cut
    before the shuffle, and a listing takes cap of them. A segment's row is sent
    to SALTS places, so that a large segment's listings are in several tasks.
    """
    facts = listings.withColumn("sqm", per_sqm(F.col("price"), F.col("area")))
    others = F.slice(F.filter("_pool", lambda o: o["id"] != F.col("id")), 1, cap)
    met = _asked(facts, *SEGMENT).join(_salted(_segment_others(facts, cap)), ["district", "_c", "_d", "_salt"]).select(*SEGMENT, *POOLED, F.explode(others).alias("_o"))
    met = met.select(*SEGMENT, *POOLED, *[F.col("_o")[c].alias(f"o_{c}") for c in POOLED])
    return met.withColumn("similarity", similarity(F.col("layout"), F.col("o_layout"), F.col("area"), F.col("o_area"), F.col("sqm"), F.col("o_sqm")))


def _likeness(a: list, b: list):
    """``similarity`` of each row of a with each of b, both as (layout's number, area, price per m2) arrays; unknown numbers are NaN, unknown layouts below 0. b may have a line for each row of a."""
    import numpy as np

    got = np.where((a[0][:, None] == b[0]) & (a[0] >= 0)[:, None], 40.0, 0.0)
    most = np.full(got.shape, 40.0)
    for x, y in zip(a[1:], b[1:], strict=True):
        both = (x > 0)[:, None] & (y > 0)
        base = np.where(x > 0, x, 1.0)[:, None]
        got += np.where(both, 30 * np.maximum(0.0, 1 - np.abs(base - y) / base), 0.0)
        most += np.where(both, 30.0, 0.0)
    return np.rint(got / most * 100)


def _told_pools(asked, pools, cap: int, floor: int, min_strong: int, k: int):
    """The rows of ``pool_summaries`` for a part of the listings that share their pools, by matrices of listings and others."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def listed(name):
        value = pools[name].combine_chunks()
        return value.flatten().slice(0, 0) if not value[0].is_valid else value.flatten()

    own, wide = listed("_pool"), listed("_wide")
    others, n_own = pa.concat_arrays([own, wide]), len(own)
    number = lambda x: np.asarray(x.cast("double").to_numpy(zero_copy_only=False), float)
    layouts = pa.concat_arrays([x.cast("string") for x in (others.field("layout"), asked["layout"].combine_chunks())]).dictionary_encode().indices.fill_null(-1).to_numpy()
    known = np.unique(others.field("id").to_numpy(zero_copy_only=False), return_inverse=True)[1]  # in the order of ids
    place_of = {x: {r: j for j, r in enumerate(known[at])} for x, at in (("own", slice(0, n_own)), ("wide", slice(n_own, None)))}
    same = np.array([place_of["own"].get(r, -1) for r in known[n_own:]], int)  # where an other of the city is in the district's pool
    facts = [layouts[: len(others)], number(others.field("area")), number(others.field("sqm"))]
    said = [number(others.field(c)) for c in ("price", "sqm", "area")]
    ids = asked["id"].combine_chunks()
    mine = pc.index_in(ids, others.field("id")).fill_null(-1).to_numpy()
    mine = np.where(mine < 0, -1, known[mine]) if len(known) else mine  # -1: in no pool
    theirs = [layouts[len(others) :], number(asked["area"].combine_chunks()), number(asked["sqm"].combine_chunks())]
    of_pool = {}

    def told(me, weak):
        """Which others a listing has, and the medians of what they say: one answer for all listings that are in no pool."""
        if (me, weak) not in of_pool:
            held = np.zeros(len(others), bool)
            held[:n_own][[j for j in range(n_own) if known[j] != me][:cap]] = True
            if weak:
                held[n_own:][[j for j in range(len(same)) if known[n_own + j] != me][:cap]] = True
                held[n_own:] &= ~((same >= 0) & held[:n_own][same]) if n_own else True
            values, n = [np.sort(x[held]) for x in said], int(held.sum())
            medians = [0.5 * x[(n - 1) // 2] + 0.5 * x[n // 2] if n else np.nan for x in values]
            of_pool[me, weak] = held, medians, n, bool(held[n_own:].any())
        return of_pool[me, weak]

    parts = []
    for at in range(0, len(ids), BLOCK):
        me, block = mine[at : at + BLOCK], [x[at : at + BLOCK] for x in theirs]
        alike = _likeness(block, facts)
        held = np.array([told(m, False)[0] for m in me])
        weak = ((alike >= floor) & held).sum(1) < min_strong
        answers = [told(m, w) for m, w in zip(me, weak, strict=True)]
        held = np.array([x[0] for x in answers])
        # The best come first by likeness, then by id.
        order, best = np.where(held & (alike >= floor), (101 - alike) * (len(known) + 1) + known, np.inf), []
        for _ in range(min(k, len(others))):
            first = order.argmin(1)
            best.append(np.where(np.isfinite(order[np.arange(len(me)), first]), first, -1))
            order[np.arange(len(me)), first] = np.inf
        best = np.array(best, np.int64).reshape(-1, len(me)).T
        found = best >= 0
        picked = best[found]
        rows = others.take(pa.array(picked))
        alikes = np.take_along_axis(alike, np.where(found, best, 0), 1)[found].astype(np.int32) if found.size else np.array([], np.int32)
        row = pa.StructArray.from_arrays([*[rows.field(i) for i in range(rows.type.num_fields)], pa.array(alikes)], [*[f"o_{rows.type.field(i).name}" for i in range(rows.type.num_fields)], "similarity"])
        medians, sizes = np.array([x[1] for x in answers]).reshape(-1, 3), np.array([x[2] for x in answers], np.int64)
        columns = {c: pa.array(medians[:, i]) for i, c in enumerate(("median_price", "median_sqm", "median_area"))} | {"sample_size": pa.array(sizes), "wide": pa.array([x[3] for x in answers], pa.bool_())}
        columns["best"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], found.sum(1).cumsum()]).astype(np.int32)), row)
        part = asked.slice(at, len(me)).select(["id", "price", "area"])
        for c, x in columns.items():
            part = part.append_column(c, x)
        parts.append(part.filter(pa.array(sizes > 0)))
    return pa.concat_tables(parts)


def pool_summaries(listings: DataFrame, only: F.Column | None = None, cap: int = 200, floor: int = 60, min_strong: int = 3, k: int = 2, also: tuple[str, ...] = ()) -> DataFrame:
    """What ``valued`` needs of each listing's comparables, widened by those of its city where few are strong, and the k best; no pair is a row.

    (id, price, area, median_price, median_sqm, median_area, sample_size, wide,
    best: an array of others as ``best_comparables`` has them, with the columns
    ``also``). Listings as for ``comparables``, with city; ``only``: which of them to
    value, against all others. Listings without others have no row.

    Both pools of a segment and city are one row. Listings that share it are dealt
    into parts of about PART_LISTINGS by their count, each of which gets the row: a
    task compares a part with its pools by matrices. Listings that are in no pool
    share the pool's medians, so these are made once.
    """
    facts = listings.withColumn("sqm", per_sqm(F.col("price"), F.col("area")))
    asked = _asked(facts if only is None else facts.filter(only), "city", *SEGMENT).drop("_salt")
    place, segment = ["district", "city", "_c", "_d"], ["_c", "_d"]
    city = _segment_others(facts.withColumn("district", F.col("city")), cap, also).withColumnsRenamed({"district": "city", "_pool": "_wide"})
    counts = asked.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / PART_LISTINGS).alias("_parts"))
    both = counts.join(_segment_others(facts, cap, also), ["district", *segment], "left").join(city, ["city", *segment], "left")
    of = {c: f"_of{c}" for c in place}
    pools = both.withColumn("_of_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).withColumnsRenamed(of).select(*of.values(), "_of_part", "_pool", "_wide")
    parts = counts.withColumnsRenamed(of)
    dealt = asked.join(parts, [F.col(c).eqNullSafe(F.col(o)) for c, o in of.items()]).withColumn("_part", F.pmod(F.xxhash64("id"), "_parts")).select(*POOLED, *place, "_part")
    kinds = {f.name: f.dataType for f in facts.schema}
    other = T.StructType([*[T.StructField(f"o_{c}", kinds[c]) for c in [*POOLED, *also]], T.StructField("similarity", T.IntegerType())])
    out = T.StructType([T.StructField(c, kinds[c]) for c in ("id", "price", "area")]).add("median_price", "double").add("median_sqm", "double").add("median_area", "double").add("sample_size", "long").add("wide", "boolean").add("best", T.ArrayType(other))

    def told(asked, pools):
        return _told_pools(asked, pools, cap, floor, min_strong, k)

    met = dealt.groupBy(*place, "_part").cogroup(pools.groupBy(*of.values(), "_of_part")).applyInArrow(told, out)
    return met.withColumns({c: whole(F.col(c)) for c in ("median_price", "median_sqm")})


def best_comparables(pairs: DataFrame, floor: int = 60, k: int = 2) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.desc("similarity"), "o_id")
    return pairs.filter(F.col("similarity") >= floor).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def picked_comparables(picks: DataFrame, listings: DataFrame, most: int = 20) -> DataFrame:
    """picks: (id, ids). The listings that someone chose for a listing, in their order, with their similarity; no floor and no number k."""
    from estatelake.operators.search import picked_lists

    names = ["id", "layout", "area", "price", "sqm"]
    facts = listings.withColumn("sqm", per_sqm(F.col("price"), F.col("area"))).select(*names)
    chosen = picked_lists(picks.withColumnRenamed("id", "subject"), facts, most).select("subject", (F.col("nth") + 1).alias("rank"), *[F.col(c).alias(f"o_{c}") for c in names])
    met = chosen.join(facts, chosen["subject"] == facts["id"]).drop("subject")
    return met.withColumn("similarity", similarity(F.col("layout"), F.col("o_layout"), F.col("area"), F.col("o_area"), F.col("sqm"), F.col("o_sqm")))


def comparable_rows(listings: DataFrame, pool: DataFrame, best: DataFrame) -> DataFrame:
    """The rows of a listing's table of comparables: itself, the median of its pool (``comparables.pool_medians``), and its best.

    Whole numbers in the median row; its price per m2 is its price over its area,
    or the pool's median where no area is known. ``difference``: against the listing.
    """
    own = listings.select("id", "layout", "area", "price", per_sqm(F.col("price"), F.col("area")).alias("sqm"))
    number = lambda c: F.col(c).cast("double").alias(c)
    shape = lambda df, kind: df.select("id", F.lit(kind).alias("kind"), "rank", "o_id", "layout", number("area"), number("price"), number("sqm"), number("difference"), F.col("similarity").cast("int").alias("similarity"))
    none = F.lit(None)
    subject = own.withColumns({"rank": F.lit(0), "o_id": none.cast("long"), "difference": none.cast("double"), "similarity": F.lit(100)})
    pool = pool.withColumn("sqm", F.coalesce(F.bround(F.col("price") / F.nullif("area", F.lit(0.0)), 0), "sqm")).join(own.select("id", "layout", F.col("price").alias("_own")), "id")
    median = pool.withColumns({"rank": F.lit(0), "o_id": none.cast("long"), "difference": rounded(F.col("price") - F.col("_own")), "similarity": none.cast("int")})
    top = best.select("id", "rank", "o_id", F.col("o_layout").alias("layout"), F.col("o_area").alias("area"), F.col("o_price").alias("price"), F.col("o_sqm").alias("sqm"), rounded(F.col("o_price") - F.col("price")).alias("difference"), "similarity")
    return shape(subject, "subject").unionByName(shape(median, "median")).unionByName(shape(top, "best"))


def whole(c: F.Column) -> F.Column:
    """The nearest whole number, halves to the even one."""
    return F.bround(c.cast("double"), 0)


def value_listings(pairs: DataFrame) -> DataFrame:
    """What a listing's pool says about its value; all amounts but the median area are whole numbers.

    The estimate is the median price per m2, rounded, times the area; without
    either, the median price. ``low`` and ``high`` are 5 % off. ``difference`` is
    the price less the estimate, null for a listing without a price, as are
    ``difference_pct`` (one digit) and the label, which changes at -5 and +5.
    """
    pool = pairs.groupBy("id", "price", "area").agg(whole(F.percentile("o_price", 0.5)).alias("median_price"), whole(F.percentile("o_sqm", 0.5)).alias("median_sqm"), F.percentile("o_area", 0.5).alias("median_area"), F.count(F.lit(1)).alias("sample_size"))
    return valued(pool)


def valued(pool: DataFrame, *also: F.Column | str) -> DataFrame:
    """pool: (id, price, area, median_price, median_sqm, median_area, sample_size), and what the columns ``also`` read."""
    by_area = whole(F.nullif("median_sqm", F.lit(0.0)) * F.nullif(F.col("area").cast("double"), F.lit(0.0)))
    out = pool.withColumn("estimate", F.coalesce(by_area, F.nullif("median_price", F.lit(0.0))))
    out = out.withColumn("difference", rounded(F.col("price") - F.col("estimate")))
    out = out.withColumn("difference_pct", rounded(F.col("difference") / F.nullif("estimate", F.lit(0.0)) * 100, 1))
    label = F.when(F.col("difference_pct") <= -5, "undervalued").when(F.col("difference_pct") >= 5, "overpriced").when(F.col("difference_pct").isNotNull(), "fair")
    return out.select("id", "median_price", "median_sqm", "median_area", "sample_size", "estimate", whole(F.col("estimate") * 0.95).alias("low"), whole(F.col("estimate") * 1.05).alias("high"), "difference", "difference_pct", label.alias("label"), *also)


def segment_rents(listings: DataFrame) -> DataFrame:
    """(_d, _c, rent_sqm): the median rent per m2 of active listings by district and category, and of all categories (null)."""
    from estatelake.operators.market import price_distribution

    return price_distribution(listings.filter("deal_type = 'rent'"), ["district"]).select(F.col("district").alias("_d"), F.col("category").alias("_c"), F.col("p50").alias("rent_sqm"))


def rent_estimates(sales: DataFrame, listings: DataFrame) -> DataFrame:
    """Sales with ``rent_sqm``, the median rent per m2 of active listings of their district and category, and ``rent`` for their area; null without such listings."""
    rents = segment_rents(listings).filter("_c IS NOT NULL").withColumnsRenamed({"_d": "district", "_c": "category"})
    return sales.join(rents, ["district", "category"], "left").withColumn("rent", F.bround(F.col("rent_sqm") * F.col("area"), 0))


def recommendation_codes(label: F.Column, days_on_market: F.Column, photos: F.Column, poor_photos: F.Column) -> F.Column:
    """(verdict, strengths, risks, steps) as codes. photos: whether there is a photo analysis; poor_photos: half of them blurred or dark."""
    codes = lambda *c: F.array_compact(F.array(*c))
    has = F.coalesce(photos, F.lit(False))
    return F.struct(
        F.concat(F.lit("verdict_"), F.coalesce(label, F.lit("none"))).alias("verdict"),
        codes(F.when(label == "undervalued", "below").when(label == "fair", "inline"), F.when(days_on_market <= 14, "recent")).alias("strengths"),
        codes(F.when(label == "overpriced", "above"), F.when(has, "photo_only").otherwise("no_photos"), F.when(has & F.coalesce(poor_photos, F.lit(False)), "poor_photos"), F.when(days_on_market >= 60, "days")).alias("risks"),
        F.array(*map(F.lit, ("viewing", "building", "benchmark"))).alias("steps"),
    )


def buy_vs_rent(listings: DataFrame, price: str = "price", rent: str = "rent", growth: str = "growth_pct", years: int = 30, down: float = 0.2, rate: float = 0.04, invest: float = 0.05, inflation: float = 0.025) -> DataFrame:
    """Yearly wealth of a buyer and a renter who spend the same each month, their final wealth, and the first year the buyer is ahead.

    The buyer has the value less the debt, and what is invested while rent is more than the payment; the renter has the invested down payment, and what is invested while rent is less. Rent grows by a twelfth of the inflation each month, the value by the growth.

    Rent only grows, so it passes the payment once: the renter invests in the first
    ``turn`` months and the buyer afterwards. What either has at a year's end is
    then a difference of sums of powers, so a year costs one expression and the
    months aren't walked through.
    """
    months, month = 12 * years, rate / 12
    cost, first_rent = F.greatest(F.col(price).cast("double"), F.lit(0.0)), F.greatest(F.col(rent).cast("double"), F.lit(0.0))
    loan, pay = cost * (1 - down), cost * (1 - down) * month / (1 - (1 + month) ** -months)
    dearer, yields = (1 + inflation) ** (1 / 12), (1 + invest) ** (1 / 12)
    # Months whose rent is below the payment.
    turn = F.when(first_rent <= 0, F.lit(float(months))).when(pay <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(float(months)), F.ceil(F.log(pay / first_rent) / math.log(dearer)).cast("double"))))
    told = listings.withColumns({"_cost": cost, "_rent": first_rent, "_loan": loan, "_pay": pay, "_turn": turn, "_rises": 1 + F.col(growth) / 100})

    def paid(n):
        """One a month for n months, worth at the start."""
        return (1 - F.pow(F.lit(yields), -n)) / (yields - 1)

    def rents(n):
        """A rent that begins with one, for n months, worth at the start."""
        return n / yields if dearer == yields else (1 - F.pow(F.lit(dearer / yields), n)) / (yields - dearer)

    def point(year):
        n = year * 12.0
        until = F.least(n, F.col("_turn"))
        grown, owed = F.pow(F.lit(yields), n), F.pow(F.lit(1 + month), n)
        renter = grown * (F.col("_cost") - F.col("_loan") + F.col("_pay") * paid(until) - F.col("_rent") * rents(until))
        aside = grown * (F.col("_rent") * (rents(n) - rents(until)) - F.col("_pay") * (paid(n) - paid(until)))
        debt = F.greatest(F.lit(0.0), F.col("_loan") * owed - F.col("_pay") * (owed - 1) / month)
        buyer = F.col("_cost") * F.pow(F.col("_rises"), year.cast("double")) - debt + aside
        return F.struct(year.alias("year"), F.round(buyer, 0).alias("buyer"), F.round(renter, 0).alias("renter"))

    path = F.when(F.col("_rent").isNotNull() & F.col("_cost").isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(years)), point))
    ahead = F.filter(F.col("path"), lambda x: (x["year"] > 0) & (x["buyer"] >= x["renter"]))
    out = told.withColumn("down_payment", F.round(F.col("_cost") - F.col("_loan"), 0)).withColumn("payment", F.round("_pay", 0)).withColumn("path", path).drop("_cost", "_rent", "_loan", "_pay", "_turn", "_rises")
    return out.withColumns({"break_even_year": F.get(ahead, F.lit(0))["year"], "buyer_final": F.element_at("path", -1)["buyer"], "renter_final": F.element_at("path", -1)["renter"]})


def widened(pairs: DataFrame, wide: DataFrame, floor: int = 60, min_strong: int = 3) -> DataFrame:
    """Pairs of the segment; where fewer than min_strong are strong, also those of a wider area that aren't there yet."""
    strong = pairs.groupBy("id").agg(F.count_if(F.col("similarity") >= floor).alias("_strong"))
    weak = wide.join(strong, "id", "left").filter(F.coalesce("_strong", F.lit(0)) < min_strong).drop("_strong")
    return pairs.withColumn("widened", F.lit(False)).unionByName(weak.join(pairs.select("id", "o_id"), ["id", "o_id"], "left_anti").withColumn("widened", F.lit(True)))


def index_source(external: DataFrame, own: DataFrame, market: DataFrame, least: int = 3) -> DataFrame:
    """Series of (district, period, value): the external one if it has ``least`` points, else the district's own, else the market's; ``kind`` says which."""
    every = external.withColumn("kind", F.lit(0)).unionByName(own.withColumn("kind", F.lit(1))).unionByName(market.withColumn("kind", F.lit(2)))
    counts = every.groupBy("district", "kind").agg(F.count("value").alias("_n")).filter(F.col("_n") >= least)
    chosen = counts.groupBy("district").agg(F.min("kind").alias("kind"))
    names = F.element_at(F.array(F.lit("external"), F.lit("district"), F.lit("market")), F.col("kind") + 1)
    return every.join(chosen, ["district", "kind"]).withColumn("kind", names)


def market_codes(price: F.Column, estimate: F.Column, sqm: F.Column, median_sqm: F.Column, wide: F.Column) -> F.Column:
    """Codes: below, above or in line with the estimate at 1 %, the same for the price per m2, and whether the search was widened."""
    near = lambda a, b: F.when(a < b * 0.99, "below").when(a > b * 1.01, "above").when(b.isNotNull(), "inline")
    return F.array_compact(F.array(F.concat(F.lit("price_"), near(price, estimate)), F.concat(F.lit("sqm_"), near(sqm, median_sqm)), F.when(wide, "widened")))


def benchmark_entries(deal_type: F.Column, local: F.Column, regional: F.Column) -> F.Column:
    """The local median, and for sales the region's index."""
    return F.array_compact(F.array(F.when(local.isNotNull(), F.struct(F.lit("local_median").alias("kind"), local.alias("value"))), F.when((deal_type != "rent") & regional.isNotNull(), F.struct(F.lit("region_index").alias("kind"), regional.alias("value")))))


def property_facts(listings: DataFrame, now) -> DataFrame:
    """Images with the card image first, days on the market, sale or rent."""
    images = F.array_distinct(F.array_compact(F.concat(F.array("image_url"), F.coalesce("images", F.array().cast("array<string>")))))
    return listings.select("id", images.alias("images"), F.greatest(F.date_diff(F.lit(now).cast("date"), F.to_date("first_seen_at")), F.lit(0)).alias("days_on_market"), F.when(F.col("deal_type") == "rent", "rent").otherwise("sale").alias("deal"))


def location_facts(counts: list[str]) -> F.Column:
    """Labelled counts that are known; an empty array means none is."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("label"), F.col(c).cast("long").alias("count"))) for c in counts]))


def valuation_block(values: DataFrame, area: F.Column) -> DataFrame:
    """(id, valuation): value, value per m2, range and sample size."""
    return values.select("id", F.struct(F.round("estimate", 0).cast("long").alias("value"), F.round(F.col("estimate") / F.nullif(area, F.lit(0)), 0).cast("long").alias("value_per_sqm"), F.struct("low", F.col("estimate").alias("mid"), "high").alias("range"), "sample_size").alias("valuation"))
