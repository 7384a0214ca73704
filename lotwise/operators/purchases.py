"""Batches of requests against the ads table: validated by joins, one choice per ad."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.operators.change import keep_one
from lotwise.operators.quality import first_failure


def check_requests(requests: DataFrame, ads: DataFrame, users: DataFrame) -> DataFrame:
    """Adds ``code``: the first rule each purchase request breaks, or ``ok``.

    ``requests`` has (request_id, ad_id, buyer_id, amount), ``ads`` (ad_id, seller_id, status), ``users`` (user_id).
    """
    known_ads = ads.select(F.col("ad_id").alias("_ad"), "seller_id", F.col("status").alias("_status"))
    known_users = users.select(F.col("user_id").alias("_user"))
    joined = requests.join(known_ads, F.col("ad_id") == F.col("_ad"), "left").join(
        known_users, F.col("buyer_id") == F.col("_user"), "left"
    )
    code = first_failure(
        [
            ("unknown ad", F.col("_ad").isNull()),
            ("ad not active", F.col("_status") != "active"),
            ("unknown buyer", F.col("_user").isNull()),
            ("amount not positive", F.coalesce(F.col("amount") <= 0, F.lit(True))),
        ]
    )
    return joined.withColumn("code", code).drop("_ad", "_status", "_user")


def purchase(requests: DataFrame, ads: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new contracts, ads afterwards): of the valid requests for one ad the lowest request id wins, the ad is sold."""
    valid = check_requests(requests, ads, users).where("code = 'ok'")
    winners = keep_one(valid, ["ad_id"], [F.col("request_id")])
    contracts = winners.select(
        "request_id", "ad_id", "seller_id", F.col("buyer_id"), "amount", F.lit("closed").alias("status")
    )
    sold = contracts.select(F.col("ad_id").alias("_sold"))
    marked = ads.join(sold, F.col("ad_id") == F.col("_sold"), "left")
    status = F.when(F.col("_sold").isNotNull(), "sold").otherwise(F.col("status"))
    return contracts, marked.withColumn("status", status).select(*ads.columns)


def hand_over(ownerships: DataFrame, sales: DataFrame) -> DataFrame:
    """Closes the open interval of every sold vehicle and opens one for its buyer.

    ``ownerships`` has (vehicle_id, owner_id, purchase_date, sale_date, note), ``sales`` one row per vehicle with
    (vehicle_id, buyer_id, sold_on).
    """
    sold = sales.select(F.col("vehicle_id").alias("_vehicle"), "sold_on")
    joined = ownerships.join(sold, F.col("vehicle_id") == F.col("_vehicle"), "left")
    closed = joined.withColumn("sale_date", F.coalesce("sale_date", "sold_on")).select(*ownerships.columns)
    opened = sales.select(
        "vehicle_id",
        F.col("buyer_id").alias("owner_id"),
        F.col("sold_on").alias("purchase_date"),
        F.lit(None).cast(ownerships.schema["sale_date"].dataType).alias("sale_date"),
        F.lit("bought on the platform").alias("note"),
    )
    return closed.unionByName(opened)


def publish(drafts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drafts (ad_id, vehicle struct, header, price, photos array) to (vehicles, ads, photos); the first photo is primary."""
    vehicles = drafts.select(F.col("ad_id").alias("vehicle_id"), "vehicle.*")
    ads = drafts.select("ad_id", F.col("ad_id").alias("vehicle_id"), "header", "price")
    photos = drafts.select("ad_id", F.posexplode("photos").alias("position", "url"))
    return vehicles, ads, photos.select("ad_id", "url", (F.col("position") == 0).alias("is_primary"))


def discount_first(ads: DataFrame, percent: int, count: int = 10) -> DataFrame:
    """Integer discount on the first ``count`` active, priced ads of every seller.

    ``ads`` has (ad_id, seller_id, status, price bigint). Spark keeps at most ``count`` rows per seller and map task
    before the shuffle.
    """
    place = Window.partitionBy("seller_id").orderBy("ad_id")
    first = (
        ads.where("status = 'active' AND price > 0")
        .select("ad_id", "seller_id")
        .withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") <= count)
        .select(F.col("ad_id").alias("_chosen"))
    )
    joined = ads.join(first, F.col("ad_id") == F.col("_chosen"), "left")
    reduced = F.expr(f"price - (price * {percent}) div 100")
    return joined.withColumn("price", F.when(F.col("_chosen").isNotNull(), reduced).otherwise(F.col("price"))).select(
        *ads.columns
    )
