"""Browse-log statistics (AGG12, AGG13, JN4, PRJ9).

Statistics over the browse fact (area, device, category, user, day) and the
region dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def browse_stats(fact: DataFrame) -> DataFrame:
    """Per area/os/network/category/day: non-null ``user_id`` count (not
    distinct) and view count."""
    return (fact.groupBy("area_code", "os", "network_type",
                         F.col("category_id").alias("category"), "bdp_day")
            .agg(F.count("user_id").alias("user_count"), F.count(F.lit(1)).alias("view_count"))
            .select("area_code", "os", "network_type", "category", "user_count",
                    "view_count", "bdp_day"))


def browse_region_stats(fact: DataFrame, region: DataFrame) -> DataFrame:
    """Left join to the region dimension (unmatched areas group under NULL
    province/city), then distinct users and views per province/city/day.
    The dimension is joined by the planner's size-checked broadcast
    (``autoBroadcastJoinThreshold``) or a shuffle join beyond it."""
    j = fact.join(region, fact["area_code"] == region["region_code"], "left")
    return (j.groupBy(F.col("region_province_desc").alias("region_province"),
                      F.col("region_city_desc").alias("region_city"), "bdp_day")
            .agg(F.count_distinct("user_id").alias("user_count"),
                 F.count(F.lit(1)).alias("view_count"))
            .select("region_province", "region_city", "user_count", "view_count", "bdp_day"))
