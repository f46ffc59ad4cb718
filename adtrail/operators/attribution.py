"""Daily channel revenue attached to touchpoints (ATT1-ATT3, AG1, MAP1,
JN4).

Rule: every touchpoint of a client on a day whose platform maps to a
revenue channel receives that client's *full* revenue for the day and
channel; nothing is split between touchpoints. The model column is a
constant 0.0 placeholder.

Revenue is aggregated once per (client, day, channel) *before* the join, so
the join cannot multiply rows and its build side is bounded by the number of
distinct keys, not by raw revenue rows. The aggregate is partial-then-final
(map-side combine), so a hot client is pre-summed in every task before the
shuffle. The batch sends only touchpoints of platforms that have a channel
through the join (see ``plans.batch.build_final``).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail.functions.channels import channel_for_platform
from adtrail.functions.metrics import money_sum
from adtrail.functions.parsing import to_key, to_number, to_timestamp_ntz
from adtrail.operators.cleaning import is_blank
from adtrail.operators.joins import salted_left_join

log = logging.getLogger(__name__)

REVENUE_KEYS = ["client_id", "date", "channel"]


def usable_revenue(revenue: DataFrame | None) -> bool:
    """Whether there is a revenue source to attribute from; without one (missing, an
    empty-file marker, no amount column) attributed revenue is 0.0 everywhere (ATT2, ATT3).
    A zero-row source is usable: nothing matches it."""
    if revenue is None or is_blank(revenue):
        log.warning("no revenue data; attributed revenue is 0.0")
        return False
    if "attributed_revenue_usd" not in revenue.columns:
        log.error("revenue lacks attributed_revenue_usd; attributed revenue is 0.0")
        return False
    return True


def daily_channel_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue per (client_id, date, channel) from cleaned revenue rows (AG1):
    keys as text and timestamp, rows without a key left out, amounts that are
    NULL or do not parse count 0.0 (NUL6)."""
    types = {f.name: f.dataType for f in revenue.schema.fields}
    amount = F.coalesce(to_number("attributed_revenue_usd", types["attributed_revenue_usd"]), F.lit(0.0))
    rows = revenue.select(to_key("client_id").alias("client_id"), to_timestamp_ntz("date", types.get("date")).alias("date"),
                          F.col("channel").cast("string").alias("channel"), amount.alias("_amount"))
    return rows.dropna(subset=REVENUE_KEYS).groupBy(*REVENUE_KEYS).agg(money_sum("_amount").alias(S.ATTRIBUTED_REVENUE_COL))


def attach_revenue(touchpoints: DataFrame, daily_revenue: DataFrame, salt_buckets: int = 0) -> DataFrame:
    """Each touchpoint with the whole revenue of its client, day and channel; no match
    -> 0.0 (JN4). A pre-existing attributed column is recomputed (D11).

    Touchpoints whose platform has no channel (e.g. the revenue rows
    themselves) match nothing, nor do those without a client or a date.
    These get a key of their own instead of a channel, so that they do not
    all meet in one partition; as only mapped channels' revenue is read, no
    such key can match. ``salt_buckets > 1``
    salts the join explicitly for a hot (client, day, channel); by default
    AQE's skew-join splitting handles it.
    """
    types = {f.name: f.dataType for f in touchpoints.schema.fields}
    keep = [c for c in touchpoints.columns if c != S.ATTRIBUTED_REVENUE_COL]
    proj = []
    for c in keep:
        if c == "client_id":
            proj.append(to_key(c).alias(c))
        elif c == "date":
            proj.append(to_timestamp_ntz(c, types[c]).alias(c))
        else:
            proj.append(F.col(f"`{c}`"))
    t = touchpoints.select(*proj)
    channel = channel_for_platform("platform")
    unmatched = F.col("client_id").isNull() | F.col("date").isNull() | channel.isNull()
    spread = F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in t.columns]))
    t = t.withColumn("_channel_key", F.when(unmatched, spread).otherwise(channel))
    r = daily_revenue.where(F.col("channel").isin(sorted(set(S.PLATFORM_TO_CHANNEL.values())))).select(
        F.col("client_id").alias("_rev_client_id"), F.col("date").alias("_rev_date"),
        F.col("channel").alias("_rev_channel"), F.col(S.ATTRIBUTED_REVENUE_COL))
    def cond(a: DataFrame, b: DataFrame) -> list:
        return [a["client_id"] == b["_rev_client_id"], a["date"] == b["_rev_date"],
                a["_channel_key"] == b["_rev_channel"]]

    if salt_buckets > 1:
        joined = salted_left_join(t, r, cond, salt_buckets)
    else:
        # revenue has one short row a key, so its side of a partition is small however skewed the touchpoints
        # are: a hash of it spares sorting (and, as range partitioning samples, sorting twice) the wide rows
        joined = t.join(r.hint("shuffle_hash"), on=cond(t, r), how="left")
    out = [F.col(f"`{c}`") for c in keep]
    out.append(F.coalesce(F.col(S.ATTRIBUTED_REVENUE_COL), F.lit(0.0)).alias(S.ATTRIBUTED_REVENUE_COL))
    if S.ATTRIBUTED_MODEL_COL not in keep:
        out.append(F.lit(0.0).alias(S.ATTRIBUTED_MODEL_COL))
    return joined.select(*out)


def perform_attribution(touchpoints: DataFrame, revenue: DataFrame | None,
                        salt_buckets: int = 0) -> DataFrame:
    """ATT1: both attribution columns, from the revenue source when it is
    usable; else 0.0, and columns that exist already are kept (ATT3)."""
    if usable_revenue(revenue):
        return attach_revenue(touchpoints, daily_channel_revenue(revenue), salt_buckets)
    zeros = {c: F.lit(0.0) for c in (S.ATTRIBUTED_REVENUE_COL, S.ATTRIBUTED_MODEL_COL) if c not in touchpoints.columns}
    return touchpoints.withColumns(zeros) if zeros else touchpoints
