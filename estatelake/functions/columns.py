"""Column rules that several jobs share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = "áäčďéěíĺľňóôöőŕřšťúůüűýžÁÄČĎÉĚÍĹĽŇÓÔÖŐŔŘŠŤÚŮÜŰÝŽ"
_PLAIN = "aacdeeillnoooorrstuuuuyzAACDEEILLNOOOORRSTUUUUYZ"
EARTH_M = 6_371_000.0


def fold(c: Column) -> Column:
    """Lower case without Czech and Slovak accents, trimmed: for look-ups by name."""
    return F.trim(F.lower(F.translate(c, _ACCENTED, _PLAIN)))


def rounded(c: Column, digits: int = 2) -> Column:
    """Half-up through DECIMAL(18,6), so that engines agree; a double again."""
    return F.round(c.cast("decimal(18,6)"), digits).cast("double")


def number(c: Column) -> Column:
    """A number or null; blank and garbage are null."""
    return F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("double")


def whole(c: Column) -> Column:
    return number(c).cast("long")


def per_sqm(price: Column, area: Column) -> Column:
    """Null where either is null or zero."""
    return F.when((price != 0) & (area != 0), rounded(price.cast("double") / area.cast("double")))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def deal_type_of(value: Column, url: Column) -> Column:
    """Fixed words: buy, sale, prodej; rent, pronajem, pronájem; and prodej, predaj, pronajem, prenajom in URLs."""
    v, u = F.lower(F.trim(value)), F.lower(url)
    named = F.when(v.isin("buy", "sale", "prodej"), "buy").when(v.isin("rent", "pronajem", "pronájem"), "rent")
    linked = F.when(u.rlike("pronajem|pronájem|prenajom"), "rent").when(u.rlike("prodej|predaj"), "buy")
    return F.coalesce(named, linked)
