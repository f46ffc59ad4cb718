"""Identifier bookkeeping used when new batches are appended (AG18, AG19,
STR3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail import schemas as S
from adtrail.functions.parsing import strip_prefix
from adtrail.session import scratch_folder

FIRST_CLIENT_NUMBER = 101  # fixed value: numbering starts at C101
CLIENT_PREFIX = "C"  # fixed value


def next_client_number(clients: DataFrame) -> DataFrame:
    """One row: max numeric part of ``client_id`` + 1 (AG18).

    Falls back to 101 when there are no clients or when any id does not
    parse once the prefix is removed, like an all-or-nothing integer
    conversion. One global aggregate; partial results per task.
    """
    num = strip_prefix("client_id", CLIENT_PREFIX).try_cast("bigint")
    stats = clients.agg(F.max(num).alias("_max"),
                        F.count_if(num.isNull()).alias("_bad"),
                        F.count(F.lit(1)).alias("_n"))
    ok = (F.col("_n") > 0) & (F.col("_bad") == 0)
    return stats.select(F.when(ok, F.col("_max") + 1).otherwise(F.lit(FIRST_CLIENT_NUMBER))
                        .cast("bigint").alias("next_client_number"))


def number_new_clients(new_clients: DataFrame, existing: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``new_clients`` with the next ``client_id``s, without gaps, in the order
    of ``order_by`` (AG18 with SNK5). An id column they bring is replaced.

    The rows are put in order by range partitions and written to the shared folder
    with their place, so a task that runs again finds the same places. Each
    partition's rows are counted, the counts before it add up to its offset (one row
    a partition), and number = next number + offset + place: no row passes a single task.
    """
    spark = new_clients.sparkSession
    first = next_client_number(existing).first()[0]
    rows = new_clients.drop("client_id")
    path = scratch_folder(spark, "new-clients")
    (rows.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    # the id's upper bits number the partition, the lower 33 the row in it
    placed = (spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
              .withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    number = F.lit(first) + F.col("_offset") + F.col("_at")
    return (placed.join(offsets, "_part")
            .select(F.concat(F.lit(CLIENT_PREFIX), number.cast("string")).alias("client_id"), *[F.col(f"`{c}`") for c in rows.columns]))


# fixed values: platforms whose campaign ids are tracked for reuse
CAMPAIGN_PLATFORMS = [S.GOOGLE_ADS, S.FACEBOOK_ADS, S.EMAIL_CAMPAIGNS]


def campaigns_per_client(facts: DataFrame) -> DataFrame:
    """Distinct (client_id, platform, campaign_id) of the campaign
    platforms (AG19), as rows rather than one array per client, so a
    client with very many campaigns never becomes one oversized row."""
    keyed = facts.where(F.col("platform").isin(CAMPAIGN_PLATFORMS)
                        & F.col("client_id").isNotNull() & F.col("campaign_id").isNotNull())
    return keyed.select("client_id", "platform", "campaign_id").distinct()


def campaign_counts(facts: DataFrame) -> DataFrame:
    """(client_id, platform) -> number of distinct campaigns."""
    return (campaigns_per_client(facts).groupBy("client_id", "platform")
            .agg(F.count(F.lit(1)).alias("campaigns")))
