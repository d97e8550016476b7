"""Read queries: listing search, price drops, users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Fixed names of a deal type as stored, and the words for it in URLs.
DEALS = {"buy": (("buy", "sale"), ("prodej", "predaj")), "rent": (("rent",), ("pronajem", "pronájem", "prenajom"))}
DEALS["sale"] = DEALS["buy"]


#: Rows of a page at most: of listings, drops and raw items, and of users.
MOST_ROWS, MOST_USERS = 500, 200


def page(df: DataFrame, order: list, limit: int = 50, offset: int = 0, most: int = MOST_ROWS) -> DataFrame:
    """A page of 1 to ``most`` rows; other sizes raise."""
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"a page has 1 to {most} rows from 0 on, not {limit} from {offset} on")
    return df.orderBy(*order).offset(offset).limit(limit)


def search_listings(listings: DataFrame, source=None, category=None, deal_type=None, region=None, district=None, active=None, min_price=None, max_price=None) -> DataFrame:
    """Priced listings that meet each given argument; an argument of None adds no predicate.

    A deal type of buy (or sale) or rent is the stored one, or where none is stored, the URL's if there is a column ``url``.
    """
    out = listings.filter(F.col("price").isNotNull())
    if deal_type is not None:
        names, slugs = DEALS.get(deal_type, ((deal_type,), ()))
        met = F.col("deal_type").isin(*names)
        if slugs and "url" in listings.columns:
            linked = F.lower("url").rlike("|".join(slugs))
            met = met | (F.col("deal_type").isNull() & F.coalesce(linked, F.lit(False)))
        out = out.filter(met)
    for name, value in (("source", source), ("category", category), ("region", region), ("district", district), ("active", active)):
        if value is not None:
            out = out.filter(F.col(name) == value)
    if min_price is not None:
        out = out.filter(F.col("price") >= min_price)
    if max_price is not None:
        out = out.filter(F.col("price") <= max_price)
    return out


def price_drops(changes: DataFrame, listings: DataFrame, now, since_days: int | None, deal_type=None, category=None, district=None) -> DataFrame:
    """Falls of the last days (since_days None: all) with the listing's facts. now: a date, or a table of one row with a column ``now``."""
    falls = changes.filter(F.col("absolute_change") < 0)
    if isinstance(now, DataFrame):
        falls = falls.crossJoin(F.broadcast(now.select(F.col("now").cast("date").alias("_now"))))  # one row
    elif since_days is not None:
        falls = falls.withColumn("_now", F.lit(now).cast("date"))
    if since_days is not None:
        falls = falls.filter(F.col("day") >= F.date_sub("_now", since_days))
    falls = falls.drop("_now")
    facts = search_listings(listings, deal_type=deal_type, category=category, district=district).select("source", "listing_id", "deal_type", "category", "district", "region")
    return falls.join(facts, ["source", "listing_id"])


def drops_page(changes: DataFrame, listings: DataFrame, now, since_days: int | None = None, deal_type: str | None = None, category: str | None = None, district: str | None = None, active_only: bool = True, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of the falls in price of the last days, newest first, with the listing's facts and the ``total`` of all pages.

    deal_type: sale or rent, by the words in the listing's URL.
    """
    falls = changes.filter("absolute_change < 0")
    if since_days is not None:
        falls = falls.filter(F.col("day") >= F.date_sub(F.lit(now).cast("date"), since_days))
    facts = listings.filter("active") if active_only else listings
    if deal_type is not None:
        facts = facts.filter(F.lower("url").rlike({"sale": "prodej", "rent": "pronajem|pronájem"}[deal_type]))
    for name, value in (("category", category), ("district", district)):
        if value is not None:
            facts = facts.filter(F.col(name) == value)
    met = falls.join(facts.select("source", "listing_id", "url", "category", "district", "layout", F.col("price").alias("current_price"), "active"), ["source", "listing_id"])
    total = met.agg(F.count(F.lit(1)).alias("total"))  # one row
    return page(met, [F.desc("day"), F.desc("source"), F.desc("listing_id")], limit, offset).crossJoin(F.broadcast(total))


def in_regions(listings: DataFrame, districts: DataFrame, regions: list[str]) -> DataFrame:
    """districts: (district, region), a small dimension. Listings in a district of the regions; an unknown region has none."""
    wanted = districts.filter(F.col("region").isin(*regions)).select("district")
    return listings.join(wanted, "district", "left_semi")


def with_latest(parents: DataFrame, children: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """Parents with ``value`` of their newest child by ``order``, null without one; children are combined before the shuffle."""
    newest = children.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))
    return parents.join(newest, key, "left")


def raw_log_page(log: DataFrame, source: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """The newest rows of the raw log, of one source or of all."""
    own = log if source is None else log.filter(F.col("source") == source)
    return page(own, [F.desc_nulls_last("scraped_at"), F.desc("id")], limit, offset)


def source_counts(log: DataFrame) -> DataFrame:
    """Rows of each source, and of all (source null)."""
    return log.rollup("source").agg(F.count(F.lit(1)).alias("n"))


def by_keys(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in a table of keys; nulls meet none."""
    return df.join(wanted, wanted.columns, "left_semi")


def entitled_plan(role: F.Column, override: F.Column, status: F.Column, plan: F.Column) -> F.Column:
    """Active, trialing and past_due count as paid."""
    return F.when((role == "admin") | F.coalesce(override, F.lit(False)), "pro").when(status.isin("active", "trialing", "past_due"), F.coalesce(plan, F.lit("pro"))).otherwise("basic")


def user_directory(users: DataFrame, subscriptions: DataFrame, key: str, q: str | None = None, name: str = "name", email: str | None = None, newest: list[str] | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Users with their subscription, if any; q is searched in the name, and the e-mail if there is one, regardless of case.

    ``total`` counts what is found on all pages. ``newest``: columns to order by, each descending; a page needs them.
    A page's size is brought into 1 to MOST_USERS.
    """
    found = users
    if q:
        met = F.coalesce(F.col(name).ilike(f"%{q}%"), F.lit(False))
        found = users.filter(met | F.coalesce(F.col(email).ilike(f"%{q}%"), F.lit(False)) if email else met)
    total = found.agg(F.count(F.lit(1)).alias("total"))  # one row
    order = [F.desc_nulls_last(c) for c in newest or []]
    if limit is not None or offset:
        if not order:
            raise ValueError("a page needs an order")
        found = found.orderBy(*order).offset(max(offset, 0))
        found = found if limit is None else found.limit(max(1, min(limit, MOST_USERS)))
    out = found.join(subscriptions, key, "left").crossJoin(F.broadcast(total))
    return out.orderBy(*order) if order else out


def listing_projection(listings: DataFrame) -> DataFrame:
    """What a reader of listings sees: the geocoded point where both its coordinates are there, else the town's; text id; sale or rent."""
    exact = F.col("geo_lat").isNotNull() & F.col("geo_lon").isNotNull()
    return listings.select(
        F.col("id").cast("string").alias("id"), F.when(F.col("deal_type") == "rent", "rent").otherwise("sale").alias("dealType"), "category", "district", "region", F.col("price").cast("double").alias("price"),
        F.when(exact, F.col("geo_lat")).otherwise(F.col("lat")).alias("lat"), F.when(exact, F.col("geo_lon")).otherwise(F.col("lon")).alias("lon"), F.when(exact, "street").when(F.col("lat").isNotNull(), "town").alias("geoPrecision"),
    )


def pending_geocode(listings: DataFrame, limit: int | None = None, retry_misses: bool = False) -> DataFrame:
    """Listings never geocoded, or with retry_misses those tried in vain; by id."""
    tried = F.col("geocoded_at").isNotNull()
    out = listings.filter((tried & F.col("geo_precision").isNull()) if retry_misses else ~tried)
    return out.orderBy("id").limit(limit) if limit else out


def pending_location_score(listings: DataFrame, scores: DataFrame) -> DataFrame:
    """Active listings with coordinates and without a score."""
    return listings.filter(F.col("active") & F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(scores.select("id"), "id", "left_anti")


def single_photo(listings: DataFrame, source: str | None = None) -> DataFrame:
    """Listings, of a source if one is given, with one photo or none."""
    own = listings if source is None else listings.filter(F.col("source") == source)
    return own.filter(F.coalesce(F.when(F.col("images").isNotNull(), F.size("images")), F.lit(0)) <= 1)


def benchmark_rows(bench: DataFrame, period: str | None = None, granularity: str | None = None, segment: str | None = None, metric: str | None = None, city: str | None = None) -> DataFrame:
    """Rows of a period (default: the latest) that meet each given argument, by granularity, district (nulls first) and segment, where there are such columns."""
    if period is None:
        newest = bench.agg(F.max_by("period", F.struct("year", "quarter", "period")).alias("period"))  # one row
        bench = bench.join(F.broadcast(newest), "period")
    else:
        bench = bench.filter(F.col("period") == period)
    for name, value in (("granularity", granularity), ("segment", segment), ("metric", metric), ("city", city)):
        if value is not None:
            bench = bench.filter(F.col(name) == value)
    order = [c for c in ("granularity", "district", "segment") if c in bench.columns]
    return bench.orderBy(*[F.asc_nulls_first(c) for c in order]) if order else bench


#: Fixed names of a benchmark's columns as its readers see them.
BENCHMARK_NAMES = {"source": "source", "source_name": "sourceName", "source_url": "sourceUrl", "period": "period", "year": "year", "quarter": "quarter", "country": "country", "city": "city", "district": "district", "locality": "locality", "property_type": "propertyType", "segment": "segment", "metric": "metric", "value": "value", "change_percent": "changePercent", "transaction_count": "transactionCount", "transaction_volume": "transactionVolume", "granularity": "granularity", "notes": "notes"}


def benchmark_projection(bench: DataFrame) -> DataFrame:
    """Benchmarks as their readers see them: text id, numbers as doubles, names in camel case."""
    numbers = ("value", "change_percent", "transaction_volume")
    return bench.select(F.col("id").cast("string").alias("id"), *[(F.col(c).cast("double") if c in numbers else F.col(c)).alias(to) for c, to in BENCHMARK_NAMES.items() if c in bench.columns])


def saved_listings(saved: DataFrame, listings: DataFrame, user) -> DataFrame:
    """saved: (user_id, id, saved_at). The listings that a user has saved, newest first."""
    own = saved.filter(F.col("user_id") == user).select("id", "saved_at")
    return listings.join(own, "id").orderBy(F.desc("saved_at"), F.desc("id"))


def in_given_order(df: DataFrame, ids: list[int], most: int = 20, subject: int | None = None) -> DataFrame:
    """The rows of a list of ids in its order; the subject, unknown ids and repeats drop out. The list is a request's, so it is short."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(i, n) for n, i in enumerate(dict.fromkeys(i for i in ids if i != subject))], "id long, nth int")
    return df.join(F.broadcast(wanted), "id").orderBy("nth").limit(most)



def picked_lists(picks: DataFrame, listings: DataFrame, most: int = 20) -> DataFrame:
    """picks: (subject, ids), a list for each subject. (subject, nth, id, ...) of its first ``most`` others, in the list's order; unknown ids drop out."""
    asked = picks.select("subject", F.slice(F.array_distinct(F.array_except(F.array_compact("ids"), F.array("subject"))), 1, most).alias("ids")).select("subject", F.posexplode("ids").alias("nth", "id"))
    return asked.join(listings, "id")


def user_facts(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """What may be shown of users, with the plan that they are entitled to."""
    met = users.join(subscriptions.select(F.col("user_id").alias("id"), "status", F.col("plan").alias("_plan")), "id", "left")
    return met.select("id", "email", F.coalesce("role", F.lit("user")).alias("role"), F.col("google_sub").isNotNull().alias("has_google"), F.col("password_hash").isNotNull().alias("has_password"), entitled_plan(F.col("role"), F.col("pro_override"), F.col("status"), F.col("_plan")).alias("plan"), "status")
