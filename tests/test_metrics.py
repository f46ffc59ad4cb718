import math
import random

import pytest

from adtrail.functions import metrics as M
from adtrail.operators.metrics import add_key_metrics, summarize_metrics
from tests.conftest import ts


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_ratios_match_plain_arithmetic(spark):
    rng = random.Random(11)
    tops = [rng.choice([None, 0.0, rng.uniform(0.01, 900.0)]) for _ in range(60)]
    bottoms = [rng.choice([None, 0, -3, rng.randint(1, 7000)]) for _ in range(60)]
    df = spark.createDataFrame(list(zip(tops, bottoms)), "top double, bottom bigint").coalesce(1)
    for ratio, scale in ((M.ctr, 100.0), (M.cpc, 1.0), (M.cpm, 1000.0)):
        for value, (x, y) in zip(col_values(df, ratio("top", "bottom")), zip(tops, bottoms)):
            if y is None or y <= 0:
                assert value == 0.0
            elif x is not None:
                assert value == pytest.approx(x / y * scale)


def test_interactions_add_up(spark):
    rng = random.Random(12)
    rows = [tuple(rng.randrange(4000) for _ in range(3)) for _ in range(25)]
    df = spark.createDataFrame(rows, "clicks bigint, emails_sent bigint, sessions bigint").coalesce(1)
    assert col_values(df, M.total_interactions()) == [sum(r) for r in rows]


def test_add_key_metrics_order_and_missing_inputs(spark):
    df = spark.createDataFrame([("C1", ts("2024-01-01"), 10, 100, 5.0)],
                               "client_id string, date timestamp_ntz, clicks bigint, impressions bigint, spend_usd double")
    out = add_key_metrics(df)
    assert out.columns == ["client_id", "date", "clicks", "impressions", "spend_usd", "emails_sent", "sessions",
                           "ctr", "cpc_usd", "cpm_usd", "open_rate", "click_rate", "bounce_rate",
                           "total_interactions"]
    r = out.first()
    assert (r.ctr, r.cpc_usd, r.cpm_usd, r.total_interactions) == (10.0, 0.5, 50.0, 10)
    assert (r.emails_sent, r.sessions, r.open_rate) == (0, 0, 0.0)


def test_add_key_metrics_nulls_become_zero(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "clicks bigint, impressions bigint, spend_usd double, emails_sent bigint, sessions bigint")
    r = add_key_metrics(df).first()
    assert (r.clicks, r.spend_usd, r.ctr, r.cpc_usd, r.total_interactions) == (0, 0.0, 0.0, 0.0, 0)


SUMMARY_SCHEMA = ("ctr double, cpc_usd double, cpm_usd double, open_rate double, click_rate double, "
                  "bounce_rate double, total_interactions bigint")


def test_summary_means(spark):
    df = spark.createDataFrame([(10.0, 2.0, 20.0, 0.2, 0.1, 0.5, 100), (20.0, 4.0, 40.0, 0.4, 0.3, 0.7, 300)],
                               SUMMARY_SCHEMA)
    r = summarize_metrics(df).first().asDict()
    assert r["avg_ctr"] == 15.0 and r["avg_cpc_usd"] == 3.0 and r["avg_total_interactions"] == 200.0
    assert r["avg_open_rate"] == pytest.approx(0.3)


def test_summary_means_empty_is_null(spark):
    r = summarize_metrics(spark.createDataFrame([], SUMMARY_SCHEMA)).first()
    assert all(v is None for v in r)


def test_summary_means_skip_nan(spark):
    df = spark.createDataFrame([(float("nan"), 2.0, 20.0, 0.2, 0.1, 0.5, 100), (20.0, float("nan"), 40.0, 0.4,
                                0.3, 0.7, 300)], SUMMARY_SCHEMA)
    r = summarize_metrics(df).first()
    assert r.avg_ctr == 20.0 and r.avg_cpc_usd == 2.0 and not math.isnan(r.avg_cpm_usd)


def test_summary_requires_columns(spark):
    with pytest.raises(ValueError):
        summarize_metrics(spark.createDataFrame([(1.0,)], "ctr double"))


def test_money_sum_and_interactions_do_not_overflow(spark):
    df = spark.createDataFrame([(1e40, 9223372036854775807, 1, 1), (2.5, 0, 0, 0)],
                               "spend_usd double, clicks bigint, emails_sent bigint, sessions bigint")
    assert df.select(M.money_sum("spend_usd")).first()[0] == 1e40  # beyond the decimal type: the plain sum, no error
    assert [r[0] for r in df.select(M.total_interactions()).collect()] == [None, 0]
