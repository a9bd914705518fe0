"""Order enrichment: date parts, first-order flag, province, user and product attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions import clock
from tillstream.operators.keyed import look_up


def with_create_parts(orders: DataFrame) -> DataFrame:
    day, hour = clock.create_parts(F.col("create_time"))
    return orders.withColumns({"create_date": day, "create_hour": hour})


def first_order_flag(orders: DataFrame, user_state: DataFrame) -> DataFrame:
    """Add ``if_first_order``: "1" on the earliest order of a user not known to have ordered.

    Only one row per user meets the state table, and the flag travels back on the unique
    order id, so no step gathers the orders of a busy user. Orders without a user are nobody's
    first; of an order sent several times one copy is kept.
    """
    orders = orders.dropDuplicates(["id"])
    firsts = (orders.where(F.col("user_id").isNotNull()).groupBy("user_id")
              .agg(F.min(F.struct("create_time", "id")).alias("_first")))
    consumed = (user_state.where(F.col("if_consumed") == "1")
                          .select(F.col("user_id").try_cast("bigint").alias("user_id")))
    fresh = (firsts.join(consumed, "user_id", "left_anti")
                   .select(F.col("_first.id").alias("_first_id")))
    flagged = orders.join(fresh, orders["id"] == fresh["_first_id"], "left")
    return (flagged.withColumn("if_first_order",
                               F.when(F.col("_first_id").isNotNull(), "1").otherwise("0"))
                   .drop("_first_id"))


def with_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    """Province name, area code and ISO code by ``province_id``; NULL where unknown."""
    dim = provinces.select(
        F.col("id").try_cast("bigint").alias("_province"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"))
    return look_up(orders, dim, "province_id", "_province").drop("_province")


def age_group(age: Column) -> Column:
    """Decade label of an age in years."""
    decade = (F.floor(age / 10) * 10).cast("string")
    return (F.when(age < 20, "under 20").when(age >= 60, "60 and over")
             .when(age.isNotNull(), F.concat(decade, F.lit("s"))))


def with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Gender, and age group at the time of the order."""
    dim = users.select(F.col("id").alias("_user"), F.col("gender").alias("user_gender"),
                       F.substring("birthday", 1, 4).try_cast("int").alias("_born"))
    year = F.substring("create_time", 1, 4).try_cast("int")
    joined = look_up(orders, dim, "user_id", "_user")
    return (joined.withColumn("user_age_group", age_group(year - F.col("_born")))
                  .drop("_user", "_born"))


def with_sku_dims(details: DataFrame, skus: DataFrame, spus: DataFrame, trademarks: DataFrame,
                  categories: DataFrame) -> DataFrame:
    """Product attributes of a detail: sku to spu, trademark and category, ids and names."""
    bare = details.drop("spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                        "category3_name")
    sku = skus.select(F.col("id").alias("_sku"), "spu_id", "tm_id", "category3_id")
    spu = spus.select(F.col("id").alias("_spu"), "spu_name")
    tm = trademarks.select(F.col("id").alias("_tm"), "tm_name")
    c3 = categories.select(F.col("id").alias("_c3"), F.col("name").alias("category3_name"))
    # The dimension tables are joined among themselves first: the details are joined once.
    product = look_up(sku, spu, "spu_id", "_spu")
    product = look_up(product, tm, "tm_id", "_tm")
    product = look_up(product, c3, "category3_id", "_c3")
    return look_up(bare, product, "sku_id", "_sku").drop("_sku", "_spu", "_tm", "_c3")
