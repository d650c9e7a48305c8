"""Random series against pandas, and against plain Python where that is clearer."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from quotemill.operators import aggregates as A
from quotemill.operators import combine as U
from quotemill.operators import profiling as R
from quotemill.operators import shares as S
from quotemill.operators import timegrid as G

DAY0 = dt.date(2023, 12, 20)


def random_series(seed, n=120, span=500):
    rng = random.Random(seed)
    return [
        (
            DAY0 + dt.timedelta(days=rng.randrange(span)) if rng.random() > 0.05 else None,
            rng.choice(["Oficial", "Blue", "Otro", None]),
            round(rng.uniform(1, 900), 2) if rng.random() > 0.2 else None,
        )
        for _ in range(n)
    ]


def spark_frame(spark, data):
    return spark.createDataFrame(data, "date date, source string, value_sell double").repartition(3)


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_monthly_mean(spark, seed):
    data = random_series(seed, n=25)
    dated = pd.DataFrame([(d, v) for d, _, v in data if d], columns=["d", "v"])
    month = pd.PeriodIndex(pd.to_datetime(dated["d"]), freq="M")
    means = dated["v"].groupby(month).mean()
    expected = means.reindex(pd.period_range(month.min(), month.max(), freq="M"))
    got = rows(G.monthly_mean(spark_frame(spark, data), "value_sell", "mean"))
    assert [d for d, _ in got] == [p.end_time.date() for p in expected.index]
    for (_, mean), want in zip(got, expected):
        assert close(mean, None if np.isnan(want) else want)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_rates(spark, seed):
    data = random_series(seed, n=60)
    daily = defaultdict(lambda: defaultdict(list))
    for d, source, v in data:
        if d and source in ("Oficial", "Blue") and v is not None:
            daily[d][source].append(v)
    monthly = defaultdict(lambda: defaultdict(list))
    for d, quotes in daily.items():
        for source, values in quotes.items():
            monthly[(d.year, d.month)][source].append(sum(values) / len(values))
    got = rows(A.monthly_rates(spark_frame(spark, data)))
    first, last = min(monthly), max(monthly)
    assert len(got) == (last[0] - first[0]) * 12 + last[1] - first[1] + 1
    for d, official, blue, gap in got:
        means = {
            s: sum(v) / len(v) for s, v in monthly.get((d.year, d.month), {}).items()
        }
        assert close(official, means.get("Oficial")) and close(blue, means.get("Blue"))
        both = official is not None and blue is not None
        assert close(gap, (blue / official - 1) * 100 if both else None) or math.isclose(
            gap, (blue / official - 1) * 100, abs_tol=1e-7
        )


@pytest.mark.parametrize("seed", [7, 8])
def test_business_days_and_gaps(spark, seed):
    data = random_series(seed, n=150, span=200)
    df = spark_frame(spark, data)
    days = sorted(d for d, _, _ in data if d)
    wanted = set(pd.bdate_range(days[0], days[-1]).date) - set(days)
    assert rows(G.missing_business_days(df)) == [(d,) for d in sorted(wanted)]
    coverage = G.business_day_coverage(df).first()
    assert coverage["missing_days"] == len(wanted)
    assert coverage["expected_days"] == len(pd.bdate_range(days[0], days[-1]))
    gaps = Counter((b - a).days for a, b in zip(days, days[1:]))
    assert rows(G.gap_distribution(df)) == sorted(gaps.items())


@pytest.mark.parametrize("seed", [9, 10])
def test_shares_and_profile(spark, seed):
    data = random_series(seed)
    df = spark_frame(spark, data)
    totals = defaultdict(float)
    for d, _, v in data:
        totals[d] += v or 0.0
    for d, _, v, share in S.market_share_rows(
        df, group_by=["date", "source"], volume="value_sell"
    ).collect():
        whole = totals[d] if d else None
        assert close(share, v / whole * 100 if v is not None and whole else None)
    frame = pd.DataFrame(data, columns=["d", "s", "v"])
    assert dict(rows(R.null_counts(df))) == dict(
        zip(["date", "source", "value_sell"], frame.isna().sum().tolist())
    )
    assert R.duplicate_count(df, ["date"]).first()[0] == int(frame["d"].duplicated().sum())
    assert dict(rows(R.value_counts(df, "source"))) == frame["s"].value_counts().to_dict()


@pytest.mark.parametrize("seed", [11, 12])
def test_accumulation_of_random_batches(spark, seed):
    rng = random.Random(seed)

    def batch(n):
        return [(rng.choice("abc"), rng.choice([1, 2, None])) for _ in range(n)]

    old, new = batch(6), [batch(5), batch(1)]
    frames = [spark.createDataFrame(b, "k string, n int") for b in (old, *new)]
    union = set(old).union(*new)
    key = str
    assert sorted(rows(U.accumulate(frames[0], frames[1:])), key=key) == sorted(union, key=key)
    unseen = rows(U.unseen_rows(frames[0], frames[1:]))
    assert sorted(unseen, key=key) == sorted(union - set(old), key=key)
