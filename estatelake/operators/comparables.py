"""Comparables among all others of a segment, whatever its size: each listing's best, and the medians of its pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelake.functions.columns import per_sqm
from estatelake.operators.valuation import POOLED, SEGMENT, _asked, _likeness, _others, _salted, whole
from estatelake.sources.shared import keep

#: Others of one tile; listings of one part, about, that are held against a tile; and listings of one matrix.
TILE, PART, BLOCK = 1_024, 5_000, 500
PLACE = ["district", "_c", "_d"]
#: Listings that agree in these ask the same question.
QUESTION = [*PLACE, "layout", "area", "sqm"]


def _with_sqm(listings: DataFrame) -> DataFrame:
    return listings.withColumn("sqm", per_sqm(F.col("price"), F.col("area")))


def _places(facts: DataFrame, *also: str) -> DataFrame:
    """Listings with the place whose others they meet; one without a district meets none."""
    return _asked(facts, *SEGMENT, *also).filter(F.col("district").isNotNull())


def _held(facts: DataFrame) -> DataFrame:
    """The others of all places that a listing asks for."""
    return _others(facts).select(*POOLED, *PLACE).join(_places(facts).select(*PLACE).distinct(), PLACE, "left_semi")


def _along(area: Column, sqm: Column) -> Column:
    """A number near for areas and prices per m2 that are near, both in proportion: the bits of their logarithms in turn."""

    def spread(x):
        x = F.least(F.lit(0xFFFF), F.greatest(F.lit(0), F.coalesce(F.floor((F.ln(F.when(x > 0, x).cast("double")) + 5) * 256), F.lit(0)))).cast("long")
        for by, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, by)).bitwiseAND(F.lit(mask).cast("long"))
        return x

    return spread(area).bitwiseOR(F.shiftleft(spread(sqm), 1))


def _tiles(rest: DataFrame) -> DataFrame:
    """(PLACE, _tile, _pool, and the tile's outline): at most TILE others in a row, neighbours by layout, area and price per m2."""
    along = [*PLACE, "layout", "_along", "area", "sqm", "id"]
    dealt = rest.withColumn("_along", _along(F.col("area"), F.col("sqm"))).repartitionByRange(*along).sortWithinPartitions(*along).withColumn("_tile", F.expr(f"monotonically_increasing_id() div {TILE}"))
    ends = [end(c).alias(f"{name}_{c}") for c in ("layout", "area", "sqm") for name, end in (("least", F.min), ("most", F.max))]
    return dealt.groupBy(*PLACE, "_tile").agg(F.array_sort(F.collect_list(F.struct(*POOLED))).alias("_pool"), F.min("id").alias("id"), *ends)


def _met(asked, pools, most: int, floor: int):
    """``asked`` with ``found``, the ``most`` best of the pool, and ``todo``, the tiles that may hold better ones, the most promising first."""
    import numpy as np
    import pyarrow as pa

    flat = lambda name: pools[name].combine_chunks().flatten()
    number = lambda x: np.asarray(x.cast("double").to_numpy(zero_copy_only=False), float)
    others, tiles = flat("_pool"), flat("_tiles")
    column = lambda name: asked[name].combine_chunks()
    texts = [x.cast("string").to_pylist() for x in (others.field("layout"), column("layout"), tiles.field("least_layout"), tiles.field("most_layout"))]
    code = {t: i for i, t in enumerate(sorted({t for x in texts for t in x if t is not None}))}
    layouts, theirs, least, last = (np.array([code.get(t, -1) for t in x], int) for x in texts)
    facts, asks = ([codes, number(of("area")), number(of("sqm"))] for codes, of in ((layouts, others.field), (theirs, column)))
    boxes = [(number(tiles.field(f"least_{c}")), number(tiles.field(f"most_{c}"))) for c in ("area", "sqm")]
    odd = ~((boxes[0][0] > 0) & (boxes[1][0] > 0))  # such others count with other weights
    ids = np.concatenate([x.field("id").to_numpy(zero_copy_only=False) for x in (others, tiles)])
    rank = np.unique(ids, return_inverse=True)[1]
    n, kind = len(others), [f.name for f in others.type]
    parts = []
    for at in range(0, asked.num_rows, BLOCK):
        block = [x[at : at + BLOCK] for x in asks]
        lines = np.arange(len(block[0]))
        alike, best = _likeness(block, facts), []
        order = np.where(alike >= floor, (100 - alike) * n + np.arange(n), np.inf)  # others are in the order of ids
        for _ in range(min(most, n)):
            first = order.argmin(1)
            best.append(np.where(np.isfinite(order[lines, first]), first, -1))
            order[lines, first] = np.inf
        best = np.array(best, np.int64).T
        got = best >= 0
        off = (100 - np.take_along_axis(alike, np.where(got, best, 0), 1)[got]).astype(np.int32)
        rows = others.take(pa.array(best[got]))
        found = pa.StructArray.from_arrays([pa.array(off), *[rows.field(i) for i in range(len(kind))]], ["off", *kind])
        # No other of a tile is more alike than its outline's nearest point would be.
        nearest = [np.clip(x[:, None], *box) for x, box in zip(block[1:], boxes, strict=True)]
        within = (least <= block[0][:, None]) & (block[0][:, None] <= last)
        bound = np.where(odd, 100.0, _likeness(block, [np.where(within, block[0][:, None], -1), *nearest]))
        may = bound >= floor
        if n >= most:
            end = best[:, most - 1]
            worst, by = alike[lines, end][:, None], rank[end][:, None]
            may &= (end < 0)[:, None] | (bound > worst) | ((bound == worst) & (rank[n:] < by))
        who, which = np.nonzero(may)
        sort = np.lexsort((rank[n:][which], -bound[who, which], who))
        who, which = who[sort], which[sort]
        todo = pa.StructArray.from_arrays([pa.array((100 - bound[who, which]).astype(np.int32)), tiles.field("id").take(pa.array(which)), tiles.field("_tile").take(pa.array(which))], ["off", "id", "tile"])
        lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], counts.cumsum()]).astype(np.int32)), x) for counts, x in ((got.sum(1), found), (may.sum(1), todo))]
        parts.append(asked.slice(at, BLOCK).append_column("found", lists[0]).append_column("todo", lists[1]))
    return pa.concat_tables(parts)


def _visited(asked: DataFrame, pools: DataFrame, key: list[str], most: int, floor: int) -> DataFrame:
    """Questions with what they find in the pool of their key; those of a key are dealt into parts by their count."""
    kinds = {f.name: f.dataType for f in asked.schema} | {f.name: f.dataType for f in pools.schema["_pool"].dataType.elementType}
    found = T.StructType([T.StructField("off", T.IntegerType()), *[T.StructField(c, kinds[c]) for c in POOLED]])
    todo = T.StructType([T.StructField("off", T.IntegerType()), T.StructField("id", kinds["id"]), T.StructField("tile", T.LongType())])
    out = T.StructType([*[f for f in asked.schema if f.name != "_tile"]]).add("found", T.ArrayType(found)).add("todo", T.ArrayType(todo))
    counts = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / PART).alias("_parts"))
    dealt = asked.join(counts, key).withColumn("_part", F.pmod(F.xxhash64(*QUESTION), "_parts"))
    parted = pools.join(counts, key).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).select(*key, "_part", "_pool", "_tiles")
    names = [f.name for f in out][:-2]

    def met(asked, pools):
        asked = asked.select(names)
        if asked.num_rows and pools.num_rows:
            return _met(asked, pools, most, floor)
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(out).empty_table()

    return dealt.groupBy(*key, "_part").cogroup(parted.groupBy(*key, "_part")).applyInArrow(met, out)


def best_of_all(listings: DataFrame, floor: int = 60, k: int = 2) -> DataFrame:
    """A listing's k best comparables among all others of its segment, as ``valuation.best_comparables`` has them of pairs.

    Others and segments as for ``valuation.comparables``, without its cap. Listings
    that agree in all that counts ask once. Of others that agree, the k + 1 smallest
    ids are enough, since ties go to the smaller id and only the listing itself is left out.

    Others lie in tiles: a segment's TILE smallest ids, and then neighbours by layout,
    area and price per m2. A question meets the first tile, then the tile whose
    outline promises most, then each tile that may still hold a better other; what is
    left out is proved worse. So tasks hold parts of about PART questions and one tile.
    """
    facts, most = _with_sqm(listings), k + 1
    same = F.row_number().over(Window.partitionBy(*QUESTION).orderBy("id"))
    points = keep(_held(facts).withColumn("_n", same).filter(F.col("_n") <= most).drop("_n"), "points")
    questions = _places(facts).select(*QUESTION).distinct()
    early = points.withColumn("_n", F.row_number().over(Window.partitionBy(*PLACE).orderBy("id"))).filter(F.col("_n") <= TILE)
    first = keep(early.groupBy(*PLACE).agg(F.array_sort(F.collect_list(F.struct(*POOLED))).alias("_pool"), F.max("id").alias("_upto")), "first")
    full = first.filter(F.size("_pool") >= TILE).select(*PLACE, "_upto")
    crowded = not full.isEmpty()
    tiles = _tiles(points.join(full, PLACE).filter(F.col("id") > F.col("_upto")) if crowded else points.limit(0))
    tiles = keep(tiles, "tiles") if crowded else tiles
    outline = F.struct("_tile", *[c for c in tiles.columns if c not in (*PLACE, "_tile", "_pool")])
    outlines = tiles.groupBy(*PLACE).agg(F.collect_list(outline).alias("_tiles"))
    none = F.array().cast(outlines.schema["_tiles"].dataType)
    first = first.join(outlines, PLACE, "left").withColumn("_tiles", F.coalesce("_tiles", none)) if crowded else first.withColumn("_tiles", none)
    seen = _visited(questions, first, PLACE, most, floor)
    answers = seen.select(*QUESTION, F.col("found").alias("best"))
    if crowded:
        seen, pools, key = keep(seen, "seen"), tiles.withColumn("_tiles", none), [*PLACE, "_tile"]
        ahead = seen.filter(F.size("todo") > 0).select(*QUESTION, F.col("found").alias("best"), F.slice("todo", F.lit(2), F.size("todo")).alias("later"), F.col("todo")[0]["tile"].alias("_tile"))
        best = F.slice(F.array_sort(F.concat("best", "found")), 1, most)
        again = keep(_visited(ahead, pools, key, most, floor).withColumn("best", best), "again")
        end = F.get("best", F.lit(most - 1))
        better = F.filter("later", lambda t: end.isNull() | (F.struct(t["off"], t["id"]) < F.struct(end["off"], end["id"])))
        others = _visited(again.select(*QUESTION, F.explode(F.transform(better, lambda t: t["tile"])).alias("_tile")), pools, key, most, floor)
        every = seen.filter(F.size("todo") == 0).select(*QUESTION, F.col("found").alias("best")).unionByName(again.select(*QUESTION, "best")).unionByName(others.select(*QUESTION, F.col("found").alias("best")))
        answers = every.groupBy(*QUESTION).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, most).alias("best"))
    of = {c: f"_of{c}" for c in QUESTION}
    met = _places(facts).join(answers.withColumnsRenamed(of), [F.col(c).eqNullSafe(F.col(o)) for c, o in of.items()])
    others = F.slice(F.filter("best", lambda o: o["id"] != F.col("id")), 1, k)
    ranked = met.select(*POOLED, F.posexplode(others).alias("_n", "_o"))
    return ranked.select(*POOLED, *[F.col("_o")[c].alias(f"o_{c}") for c in POOLED], (100 - F.col("_o")["off"]).alias("similarity"), (F.col("_n") + 1).alias("rank"))


def pool_medians(listings: DataFrame) -> DataFrame:
    """(id, price, area, sqm): the medians of all others of a listing's segment, as whole numbers; listings without others have no row.

    Others and segments as for ``valuation.comparables``, without its cap. A
    segment's values are counted before they are sorted. Leaving a listing out moves the
    middle by one place at most, so a segment's three middle values are all it needs.
    """
    facts, said = _with_sqm(listings), ("price", "area", "sqm")
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("double").alias("value")) for c in said]))
    held = _held(facts)
    counted = held.select(*PLACE, values.alias("_v")).groupBy(*PLACE, "_v.what", "_v.value").agg(F.count(F.lit(1)).alias("_here"))
    upto = F.sum("_here").over(Window.partitionBy(*PLACE, "what").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    sizes = held.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("_size"))
    half = F.floor(F.col("_size") / 2)
    middle = counted.withColumn("_upto", upto).join(sizes, PLACE).filter((F.col("_upto") > half - 1) & (F.col("_upto") - F.col("_here") <= half + 1))
    middles = middle.groupBy(*PLACE, "_size").agg(*[F.array_sort(F.collect_list(F.when(F.col("what") == c, F.struct("_upto", "value")))).alias(f"_{c}") for c in said])
    own = F.col("price").isNotNull() & F.col("sqm").isNotNull() & (F.coalesce("active", F.lit(False)) if "active" in facts.columns else F.lit(True))
    met = _places(facts.withColumn("_own", own), "_own").join(_salted(middles), [*PLACE, "_salt"]).filter(F.col("_size") - F.col("_own").cast("int") > 0)
    at = lambda c, rank: F.get(F.filter(f"_{c}", lambda x: x["_upto"] > rank), F.lit(0))["value"]

    def median(c):
        low, mid, high, mine = at(c, half - 1), at(c, half), at(c, half + 1), F.col(c).cast("double")
        odd = F.col("_size") % 2 == 1
        first = F.when(~F.col("_own"), F.when(odd, mid).otherwise(low)).when(odd, F.when(mine >= mid, low).otherwise(mid)).when(mine >= mid, low).otherwise(mid)
        last = F.when(~F.col("_own"), mid).when(odd, F.when(mine > mid, mid).otherwise(high)).when(mine >= mid, low).otherwise(mid)
        return whole(0.5 * first + 0.5 * last).alias(c)

    return met.select("id", *map(median, said))
