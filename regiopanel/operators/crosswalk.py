"""Crosswalk between regional codes and region keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import int_div
from regiopanel.operators.quality import duplicate_keys, unmatched_keys
from regiopanel.operators.spine import present


def region_pairs(regions: DataFrame, code: str = "nuts", geo: str = "geo") -> DataFrame:
    """Distinct code and key pairs of the regions that carry a code."""
    return present(regions.select(code, geo), code, geo).distinct()


def postal_regions(postal_keys: DataFrame, postal: str = "plz", community: str = "ags") -> DataFrame:
    """Distinct postal code and region pairs; the region is the community key without three digits."""
    pairs = postal_keys.select(
        F.col(postal).try_cast("int").alias("postal"), int_div(community, 1_000).cast("int").alias("geo")
    )
    return present(pairs, "postal", "geo").distinct()


def postal_codes(postal_nuts: DataFrame, code: str = "nuts3", postal: str = "code") -> DataFrame:
    """Distinct code and postal code pairs."""
    pairs = postal_nuts.select(F.col(code).alias("nuts"), F.col(postal).try_cast("int").alias("postal"))
    return present(pairs, "nuts", "postal").distinct()


def pairs_by_postal(codes: DataFrame, regions: DataFrame) -> DataFrame:
    """Code and region pairs that share a postal code."""
    return codes.join(regions, "postal").select("nuts", "geo").distinct()


def city_pairs(codes: DataFrame, regions_by_postal: DataFrame, lo: int, hi: int) -> DataFrame:
    """Pairs of the region keys ``lo <= key < hi`` found through postal codes."""
    inside = (F.col("geo") >= lo) & (F.col("geo") < hi)
    return pairs_by_postal(codes, regions_by_postal.filter(inside))


def district_pairs(regions: DataFrame, city: DataFrame, lo: int, hi: int, strict: bool = False) -> DataFrame:
    """Give every district of the city the city's code.

    ``strict`` makes the job fail when the city has several codes; otherwise the
    smallest is used.
    """
    code = city.select("nuts").distinct().scalar() if strict else city.agg(F.min("nuts")).scalar()
    inside = (F.col("geo") >= lo) & (F.col("geo") < hi)
    return present(regions.filter(inside).select(code.alias("nuts"), "geo"), "nuts").distinct()


def build_crosswalk(
    regions: DataFrame,
    codes: DataFrame,
    regions_by_postal: DataFrame,
    needed: DataFrame,
    city_range: tuple[int, int],
    strict: bool = False,
) -> DataFrame:
    """All (nuts, geo) pairs, each once.

    The regions' own codes come first; the city and its districts, which carry none,
    get theirs through postal codes, and so does every code in ``needed`` that is still
    without a region.
    """
    lo, hi = city_range
    own = region_pairs(regions)
    city = city_pairs(codes, regions_by_postal, lo, hi)
    known = own.unionByName(city).unionByName(district_pairs(regions, city, lo, hi, strict)).distinct()
    open_codes = unmatched_keys(needed.select("nuts").distinct(), known, "nuts")
    repaired = pairs_by_postal(codes.join(open_codes, "nuts", "left_semi"), regions_by_postal)
    return known.unionByName(repaired)


def one_code_each(
    crosswalk: DataFrame, own: DataFrame, codes: DataFrame, regions_by_postal: DataFrame
) -> DataFrame:
    """(nuts, geo, n_shared) with one code for each region, so that a join keeps the number of rows.

    Of several codes a region takes its own, else the one it shares most postal codes with, else the smallest.
    """
    shared = codes.join(regions_by_postal, "postal").groupBy("nuts", "geo").agg(F.count("*").alias("n_shared"))
    kept = own.select("nuts", "geo").distinct().withColumn("_own", F.lit(True))
    found = crosswalk.join(shared, ["nuts", "geo"], "left").join(kept, ["nuts", "geo"], "left")
    weight = F.coalesce("n_shared", F.lit(0).cast("bigint"))
    first = F.min(F.struct(F.col("_own").isNull().alias("other"), (-weight).alias("less"), "nuts"))
    best = found.groupBy("geo").agg(first.alias("_best"))
    return best.select("_best.nuts", "geo", (-F.col("_best.less")).alias("n_shared"))


def crosswalk_report(crosswalk: DataFrame, needed: DataFrame) -> dict[str, DataFrame]:
    """Regions with several codes, codes with several regions, and codes still without one."""
    return {
        "regions_with_several_codes": duplicate_keys(crosswalk, "geo"),
        "codes_with_several_regions": duplicate_keys(crosswalk, "nuts"),
        "codes_without_region": unmatched_keys(needed.select("nuts").distinct(), crosswalk, "nuts"),
    }
