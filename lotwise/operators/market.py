"""Seller functions of the marketplace as grouped joins: one pass for all sellers instead of a query per seller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.money import mean_rounded, money


def average_rating(sellers: DataFrame, seller: str, reviews: DataFrame, reviewed: str, rating: str) -> DataFrame:
    """(seller, avg_rating), 0 without reviews."""
    means = reviews.groupBy(F.col(reviewed).alias("_of")).agg(mean_rounded(rating).alias("_mean"))
    joined = sellers.join(means, F.col(seller) == F.col("_of"), "left")
    return joined.select(seller, F.coalesce("_mean", F.lit(0.0)).alias("avg_rating"))


def active_ads(sellers: DataFrame, seller: str, ads: DataFrame, owner: str, active: Column, price: str) -> DataFrame:
    """(seller, active_ads, total_price) over active ads, zeros without any."""
    sums = ads.where(active).groupBy(F.col(owner).alias("_of")).agg(
        F.count("*").alias("_n"), F.sum(money(price)).alias("_sum")
    )
    joined = sellers.join(sums, F.col(seller) == F.col("_of"), "left")
    return joined.select(
        seller,
        F.coalesce("_n", F.lit(0)).alias("active_ads"),
        F.coalesce("_sum", F.lit(0)).cast("decimal(28,2)").alias("total_price"),
    )


def vehicle_text(brand: Column, model: Column, year: Column, colour: Column, vin: Column) -> Column:
    """One line about a vehicle; missing parts are skipped, a missing colour is named."""
    return F.concat_ws(
        "", brand, F.lit(" "), model, F.lit(" "), year.cast("string"), F.lit(", "),
        F.coalesce(colour, F.lit("no colour")), F.lit(", VIN: "), vin,
    )
