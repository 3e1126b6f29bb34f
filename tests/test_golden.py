"""Fixed numbers of the fixture, computed independently of this library."""

import pytest
from pyspark.sql import functions as F

from chamberlens.operators.align import left_align
from chamberlens.operators.clean import TRIPLETS, clean_sensors, cleaning_audit, normalize
from chamberlens.operators.sample import holdout
from chamberlens.operators.stats import correlation_matrix, numeric_summary
from chamberlens.plans.flows import aligned_exact, aligned_hourly, prepare
from chamberlens.sources.event_sensors import sensor_and_quality

GOLDEN = {
    "sf0.001": dict(
        raw=1000, clean=985, total=5746863, exact=197, exact_q=6244.805545, hourly=200, hourly_q=6370.86201,
        hourly_std=8824.787833, r_target=0.095690318, r_pair=-0.002120594, test=40, train=157,
        flags=(69, 68, 69, 69, 69), q1=16.628386, median=32.59878, mean=31.85431,
    ),
    "sf0.01": dict(
        raw=10000, clean=9855, total=57559895, exact=1971, exact_q=57250.466165, hourly=2000, hourly_q=58086.404707,
        hourly_std=106211.975598, r_target=0.15791644, r_pair=0.001276533, test=402, train=1569,
        flags=(743, 737, 746, 748, 746), q1=18.636809, median=29.089899, mean=29.043202,
    ),
}


@pytest.fixture(params=list(GOLDEN))
def case(request, spark):
    x, y = sensor_and_quality(spark, f"/root/testdata/{request.param}")
    return x, y, GOLDEN[request.param]


def test_cleaning(case):
    x, _, want = case
    audit = cleaning_audit(x).first()
    assert (audit.rows_before, audit.rows_after, audit.rows_removed) == (want["raw"], want["clean"], want["raw"] - want["clean"])
    assert tuple(audit[f"flags_chamber_{i}"] for i in range(1, 6)) == want["flags"]
    probes = [F.col(p) for t in TRIPLETS for p in t]
    assert clean_sensors(x).agg(F.sum(sum(probes, F.lit(0)))).first()[0] == want["total"]


def test_joins(case):
    x, y, want = case
    n, q = aligned_exact(x, y).agg(F.count("*"), F.sum("quality")).first()
    assert (n, q) == (want["exact"], pytest.approx(want["exact_q"], abs=1e-5))
    n, q, s = aligned_hourly(x, y).agg(F.count("*"), F.sum("quality"), F.sum("T_data_3_1_std")).first()
    assert (n, q, s) == (want["hourly"], pytest.approx(want["hourly_q"], abs=1e-5), pytest.approx(want["hourly_std"], abs=1e-5))


def test_correlation(case):
    x, y, want = case
    r = {(p.var_i, p.var_j): p.r for p in correlation_matrix(left_align(*prepare(x, y))).collect()}
    assert len(r) == 17 * 17
    assert r["T_data_3_1", "quality"] == pytest.approx(want["r_target"], abs=1e-8)
    assert r["T_data_3_1", "T_data_2_3"] == pytest.approx(want["r_pair"], abs=1e-8)
    assert all(-1 <= v <= 1 and r[b, a] == v for (a, b), v in r.items())


def test_split_and_summary(case):
    x, y, want = case
    train, test = holdout(aligned_exact(x, y), "date_time", seed=None, exact=False)
    assert (test.count(), train.count()) == (want["test"], want["train"])
    summary = {r.statistic: r.value for r in numeric_summary(normalize(y), "quality").collect()}
    assert summary["25%"] == pytest.approx(want["q1"], abs=1e-5)
    assert summary["50%"] == pytest.approx(want["median"], abs=1e-5)
    assert summary["mean"] == pytest.approx(want["mean"], abs=1e-5)
