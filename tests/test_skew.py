"""A client holding a third of all facts: the shuffle join splits it."""

from pyspark.sql import functions as F

from adtrail import schemas as S
from adtrail.operators.joins import join_with_clients

N = 60_000


def skewed_facts(spark):
    # a third of the rows belong to one client, the rest spread over 2,000
    client = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 2000).cast("string")))
    return spark.range(N).select(client.alias("client_id"), F.col("id").alias("n"))


def dimension(spark):
    ids = spark.range(2000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("client_id"))
    hot = spark.range(1).select(F.lit("HOT").alias("client_id"))
    return ids.unionByName(hot).select(
        "client_id", F.concat(F.lit("name-"), F.col("client_id")).alias("name"),
        F.lit("x").alias("industry"), F.lit("m").alias("account_manager"),
        F.lit(None).cast("timestamp_ntz").alias("signup_date"))


def test_hot_client_is_split_by_aqe(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = join_with_clients(skewed_facts(spark), dimension(spark))
        rows = out.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r.name: r.n for r in rows}
        assert sum(counts.values()) == N  # whole result: nothing dropped or duplicated
        assert counts["name-HOT"] == N // 3
        plan = out.groupBy("name").count()
        plan.collect()
        executed = plan._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in executed  # the hot partition was split into several tasks
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_client_salted_join_is_whole(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_with_clients(skewed_facts(spark), dimension(spark), salt_buckets=8)
        assert out.count() == N
        assert out.where(F.col("name") == "name-HOT").count() == N // 3
        assert out.columns == ["client_id", "n"] + S.CLIENT_ATTRIBUTE_COLUMNS
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_revenue_key_is_whole(spark):
    from adtrail.operators.attribution import perform_attribution
    # one (client, day, channel) holds a third of the touchpoints
    tp = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("client_id"),
        F.lit("2024-01-01").alias("date"), F.lit("google_ads").alias("platform"), F.col("id").alias("n"))
    rev = spark.createDataFrame([("HOT", "2024-01-01", "google_ads", 5.0), ("7", "2024-01-01", "google_ads", 1.0)],
                                "client_id string, date string, channel string, attributed_revenue_usd double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for salt in (0, 8):
            out = perform_attribution(tp, rev, salt_buckets=salt)
            got = out.groupBy(S.ATTRIBUTED_REVENUE_COL).count().collect()
            assert {r[0]: r[1] for r in got} == {5.0: 10_000, 1.0: 40, 0.0: 19_960}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_salted_build_equals_plain_build(spark):
    import os
    import pytest
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    from adtrail.operators.cleaning import clean_sources
    from adtrail.plans.batch import build_final
    from adtrail.sources.bindings import ingested_sources
    cleaned = clean_sources(ingested_sources(spark, sf))
    plain = build_final(cleaned)
    salted = build_final(cleaned, salt_buckets=4)
    assert salted.columns == plain.columns == S.FINAL_COLUMNS
    diff = plain.exceptAll(salted).count() + salted.exceptAll(plain).count()
    assert diff == 0 and salted.count() == plain.count()
