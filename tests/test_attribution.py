from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail import schemas as S
from adtrail.operators.attribution import perform_attribution
from tests.conftest import ts

TOUCH_SCHEMA = ("client_id string, date string, platform string, clicks bigint, impressions bigint, "
                "spend_usd double")


# three clients on two days: each platform's touchpoint, and revenue on some channels
DAYS = ("2023-05-08", "2023-05-09")
REVENUE = [("N1", DAYS[0], "google_ads", 12.5), ("N1", DAYS[1], "organic", 31.0), ("N2", DAYS[1], "email", 8.25),
           ("N9", DAYS[0], "facebook", 99.0), ("N2", DAYS[0], "offline", 55.0)]


def touchpoints(spark):
    rows = [(client, day, platform, 2, 50, 1.75) for client in ("N1", "N2", "N3") for day in DAYS
            for platform in ("google_ads", "web_traffic", "email_campaigns")]
    return spark.createDataFrame(rows, TOUCH_SCHEMA)


def revenue(spark):
    return spark.createDataFrame(REVENUE, "client_id string, date string, channel string, attributed_revenue_usd double")


def total(df):
    return sum(r[0] for r in df.select(S.ATTRIBUTED_REVENUE_COL).collect())


def test_revenue_lands_on_matching_channel(spark):
    out = perform_attribution(touchpoints(spark), revenue(spark))
    assert S.ATTRIBUTED_REVENUE_COL in out.columns and S.ATTRIBUTED_MODEL_COL in out.columns
    assert total(out) == 12.5 + 31.0 + 8.25  # the other revenue has no touchpoint
    paid = {(r.client_id, r.platform): r[S.ATTRIBUTED_REVENUE_COL] for r in out.where(f"{S.ATTRIBUTED_REVENUE_COL} > 0").collect()}
    assert paid == {("N1", "google_ads"): 12.5, ("N1", "web_traffic"): 31.0, ("N2", "email_campaigns"): 8.25}
    assert out.columns[-2:] == [S.ATTRIBUTED_REVENUE_COL, S.ATTRIBUTED_MODEL_COL]


def test_absent_revenue_gives_zero(spark):
    out = perform_attribution(touchpoints(spark), None)
    assert total(out) == 0.0 and S.ATTRIBUTED_MODEL_COL in out.columns


def test_empty_revenue_gives_zero(spark):
    for empty in (spark.createDataFrame([], T.StructType([])),
                  revenue(spark).limit(0)):
        out = perform_attribution(touchpoints(spark), empty)
        assert total(out) == 0.0 and out.count() == 18


def test_missing_revenue_column_defaults(spark):
    broken = spark.createDataFrame([("C1", "2024-01-01", "google_ads")],
                                   "client_id string, date string, channel string")
    assert total(perform_attribution(touchpoints(spark), broken)) == 0.0


def test_full_revenue_repeated_on_each_touchpoint(spark):
    tp = spark.createDataFrame([("N1", DAYS[0], "google_ads", 5, 9, 0.5),
                                ("N1", DAYS[0], "google_ads", 6, 8, 0.25)], TOUCH_SCHEMA)
    out = perform_attribution(tp, revenue(spark))
    assert [r[0] for r in out.select(S.ATTRIBUTED_REVENUE_COL).collect()] == [12.5, 12.5]


def test_revenue_summed_per_key_and_null_keys_dropped(spark):
    rev = spark.createDataFrame([("N3", DAYS[1], "google_ads", 6.5), ("N3", DAYS[1], "google_ads", 11.25),
                                 ("N3", DAYS[1], None, 480.0), ("N3", "no day", "google_ads", 2.0)],
                                "client_id string, date string, channel string, attributed_revenue_usd double")
    tp = touchpoints(spark).where("platform = 'google_ads'")
    assert total(perform_attribution(tp, rev)) == 17.75


def test_existing_attribution_column_is_recomputed(spark):
    tp = touchpoints(spark).withColumn(S.ATTRIBUTED_REVENUE_COL, F.lit(7.0))
    out = perform_attribution(tp, revenue(spark))
    assert total(out) == 51.75


def test_salted_attribution_matches(spark):
    plain = perform_attribution(touchpoints(spark), revenue(spark))
    salted = perform_attribution(touchpoints(spark), revenue(spark), salt_buckets=4)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    assert salted.columns == plain.columns


def test_rows_without_key_get_nothing_and_are_spread(spark):
    tp = spark.createDataFrame([(None, ts("2024-03-01"), "google_ads", n) for n in range(50)]
                               + [("K9", None, "google_ads", 50), ("K9", ts("2024-03-01"), "google_ads", 51)],
                               "client_id string, date timestamp_ntz, platform string, n int")
    rev = spark.createDataFrame([("K9", ts("2024-03-01"), "google", 4.5), (None, ts("2024-03-01"), "google", 9.0)],
                                "client_id string, date timestamp_ntz, channel string, attributed_revenue_usd double")
    channel = S.PLATFORM_TO_CHANNEL["google_ads"]
    out = perform_attribution(tp, rev.withColumn("channel", F.lit(channel)))
    paid = {r["n"]: r[S.ATTRIBUTED_REVENUE_COL] for r in out.collect()}
    assert paid == {**dict.fromkeys(range(51), 0.0), 51: 4.5}
