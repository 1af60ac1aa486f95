"""Domain A: traffic between places.

Input frame ("traffic table"): ORIGIN_COUNTRY_NAME, DEST_COUNTRY_NAME,
COUNT long, YEAR int -- one row per (origin, destination, year).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORIGIN = "ORIGIN_COUNTRY_NAME"
DEST = "DEST_COUNTRY_NAME"


def rows_per_year(traffic: DataFrame) -> DataFrame:
    """Row count per YEAR (sanity check after a union of yearly files)."""
    return traffic.groupBy("YEAR").agg(F.count(F.lit(1)).alias("count"))


def domestic_routes(traffic: DataFrame, home: str) -> DataFrame:
    """Routes that start and end in ``home``."""
    return traffic.filter((F.col(ORIGIN) == home) & (F.col(DEST) == home))


def outwardness(traffic: DataFrame, home: str, how: str = "inner") -> DataFrame:
    """Share of home->X traffic vs X->home traffic per country X.

    DEST_FREQUENCY   = % of home's outbound traffic going to X
    ORIGIN_FREQUENCY = % of home's inbound traffic coming from X
    OUTWARDNESS      = DEST_FREQUENCY - ORIGIN_FREQUENCY
    Self routes (home->home) are excluded. ``how="inner"`` keeps only
    countries with traffic both ways (the reference behaviour); ``"full"``
    keeps one-way countries with a null on the missing side.

    Each direction is a branch of its own, filtered to ``home`` on one end: a
    condition on either end cannot be pushed below the join that built the
    traffic table, two plain ones can. The totals are windows over the
    per-country aggregate, whose size is bounded by the number of countries:
    no scalar round trip through the driver and no cross join.
    """
    if how not in ("inner", "full"):
        raise ValueError("how must be 'inner' or 'full'")
    none = F.lit(None).cast("long")
    outbound = (traffic.filter((F.col(ORIGIN) == home) & (F.col(DEST) != home))
                .groupBy(F.col(DEST).alias("COUNTRY_NAME"))
                .agg(F.sum("COUNT").alias("_out")).withColumn("_in", none))
    inbound = (traffic.filter((F.col(DEST) == home) & (F.col(ORIGIN) != home))
               .groupBy(F.col(ORIGIN).alias("COUNTRY_NAME"))
               .agg(F.sum("COUNT").alias("_in")).withColumn("_out", none))
    per_country = (outbound.unionByName(inbound).groupBy("COUNTRY_NAME")
                   .agg(F.sum("_out").alias("_out"), F.sum("_in").alias("_in")))
    everyone = Window.partitionBy()

    def share(c):
        return F.col(c).cast("double") / F.sum(c).over(everyone).cast("double") * F.lit(100.0)

    shares = per_country.select("COUNTRY_NAME", share("_out").alias("DEST_FREQUENCY"),
                                share("_in").alias("ORIGIN_FREQUENCY"))
    if how == "inner":
        shares = shares.filter(F.col("DEST_FREQUENCY").isNotNull()
                               & F.col("ORIGIN_FREQUENCY").isNotNull())
    return (shares.select("COUNTRY_NAME", "DEST_FREQUENCY", "ORIGIN_FREQUENCY",
                          (F.col("DEST_FREQUENCY") - F.col("ORIGIN_FREQUENCY"))
                          .alias("OUTWARDNESS"))
            .orderBy(F.col("DEST_FREQUENCY").desc()))


def key_zone_pivot(traffic: DataFrame, home: str, countries: Sequence[str]) -> DataFrame:
    """YEAR x destination pivot of outbound traffic for a fixed country list.

    Pivot values are passed explicitly: no extra distinct job, and listed
    countries without traffic still get a (null) column, in list order.
    """
    countries = list(countries)
    return (traffic.filter((F.col(ORIGIN) == home) & F.col(DEST).isin(countries))
            .groupBy("YEAR").pivot(DEST, countries).agg(F.sum("COUNT"))
            .select("YEAR", *[F.col(f"`{c}`") for c in countries])
            .orderBy("YEAR"))
