"""Scoring of a single event: country weights, importance, buzz, severity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of a country in the oil market by ISO 3166 alpha-3 code;
# any other country weighs 1.
ISO3_WEIGHT = {
    "SAU": 6, "RUS": 6, "IRN": 6, "IRQ": 6,
    "USA": 4,
    "ARE": 3, "KWT": 3, "CAN": 3, "NOR": 3, "KAZ": 3, "BRA": 3, "VEN": 3, "LBY": 3,
    "NGA": 3, "AGO": 3,
    "CHN": 2, "IND": 2, "MEX": 2, "EGY": 2, "TUR": 2, "PAN": 2, "YEM": 2, "JPN": 2,
    "KOR": 2, "DEU": 2, "FRA": 2, "GBR": 2,
}

# FIPS 10-4 two-letter code to ISO3 for the same countries.
FIPS2_TO_ISO3 = {
    "SA": "SAU", "RS": "RUS", "IR": "IRN", "IZ": "IRQ",
    "US": "USA",
    "AE": "ARE", "KU": "KWT", "CA": "CAN", "NO": "NOR", "KZ": "KAZ", "BR": "BRA",
    "VE": "VEN", "LY": "LBY", "NI": "NGA", "AO": "AGO",
    "CH": "CHN", "IN": "IND", "MX": "MEX", "EG": "EGY", "TU": "TUR", "PM": "PAN",
    "YM": "YEM", "JA": "JPN", "KS": "KOR", "GM": "DEU", "FR": "FRA", "UK": "GBR",
}

FIPS2_WEIGHT = {fips: ISO3_WEIGHT[iso] for fips, iso in FIPS2_TO_ISO3.items()}

# Labels of the four event classes.
QUAD_LABELS = {1: "Verbal Coop", 2: "Material Coop", 3: "Verbal Conflict", 4: "Material Conflict"}


def lookup(key: Column | str, table: dict) -> Column:
    """Value of ``key`` in a small literal table; null when absent."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, F.col(key) if isinstance(key, str) else key)


def country_weight(code: Column | str, table: dict[str, int] = ISO3_WEIGHT) -> Column:
    return F.coalesce(lookup(code, table), F.lit(1))


def iso3(code: Column | str, keep_unknown: bool) -> Column:
    """ISO3 form of a FIPS2 code; other codes pass through or turn null."""
    code = F.col(code) if isinstance(code, str) else code
    mapped = lookup(code, FIPS2_TO_ISO3)
    return F.coalesce(mapped, code) if keep_unknown else mapped


def clip01(x: Column) -> Column:
    """Limit to [0, 1]. ``least`` skips nulls, so a null comes out as 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def importance(*weights: Column) -> Column:
    """Heaviest country, plus half a point per unit above 1 of the others."""
    top = F.greatest(*weights)
    total = reduce(Column.__add__, weights)
    others_above_one = total - top - (len(weights) - 1)
    return top.cast("double") + others_above_one.cast("double") * 0.5


def buzz(articles: Column | str) -> Column:
    return F.log1p(F.col(articles) if isinstance(articles, str) else articles)


def severity(goldstein: Column | str, tone: Column | str, null_tone: float | None = None) -> Column:
    """1 to 3.5: conflict intensity weighs 1.5, hostile tone 1.

    A missing tone counts as the most hostile one unless ``null_tone`` gives the
    tone to assume.
    """
    goldstein = F.col(goldstein) if isinstance(goldstein, str) else goldstein
    tone = F.col(tone) if isinstance(tone, str) else tone
    if null_tone is not None:
        tone = F.coalesce(tone, F.lit(float(null_tone)))
    return 1.0 + clip01(-goldstein / 10.0) * 1.5 + clip01(-tone / 100.0)


def raw_score(i: Column, b: Column, s: Column) -> Column:
    return i * i * b * s


def involved_countries(place: Column | str, actor1: Column | str, actor2: Column | str) -> Column:
    """Distinct ISO3 codes of place and actors, in that order, without nulls."""
    codes = F.array(iso3(place, False), iso3(actor1, True), iso3(actor2, True))
    return F.array_distinct(F.array_compact(codes))


def weighted_gravity(goldstein: Column | str, tone: Column | str) -> Column:
    """The exploratory alternative to ``severity``: grows with conflict and hostility."""
    goldstein = F.col(goldstein) if isinstance(goldstein, str) else goldstein
    tone = F.col(tone) if isinstance(tone, str) else tone
    return (10.0 - goldstein) * (1.0 + (100.0 - tone) / 50.0)


def quad_label(code: Column | str) -> Column:
    """Label of an event class; an unknown class keeps its code as text."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(lookup(code, QUAD_LABELS), code.cast("string"))
