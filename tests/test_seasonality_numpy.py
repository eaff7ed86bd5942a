"""W3 against a plain numpy restatement of the classical additive decomposition."""

import numpy as np
from pyspark.sql import functions as F

from jobscope.operators.aggregates import daily_mean
from jobscope.operators.seasonality import seasonality
from jobscope.sources.fixtures import Estate


def _numpy_decompose(x, period=7):
    n = len(x)
    half = period // 2
    trend = np.full(n, np.nan)
    for i in range(half, n - half):
        trend[i] = x[i - half:i + half + 1].mean()
    detr = x - trend
    phase_means = np.array([np.nanmean(detr[p::period]) for p in range(period)])
    seasonal = np.tile(phase_means - phase_means.mean(), n // period + 1)[:n]
    resid = detr - seasonal
    v = lambda a: np.nanvar(a, ddof=1)
    return v(seasonal), v(trend), v(resid), v(x)


def test_seasonality_matches_numpy(spark):
    sf = "/root/testdata/sf0.01"
    runs = Estate(spark, sf).runs
    got = {r.job_name: r for r in seasonality(runs, min_runs=0, excluded_prefixes=()).collect()}
    series = {}
    for r in daily_mean(runs).orderBy("job_name", "d").collect():
        series.setdefault(r.job_name, []).append(r.x)
    checked = 0
    for job, xs in series.items():
        x = np.array(xs)
        if len(x) < 14:
            assert job not in got
            continue
        vs, vt, vr, vx = _numpy_decompose(x)
        g = got[job]
        for mine, ref in [(g.variancia_sazonal, vs), (g.variancia_tendencia, vt), (g.variancia_ruido, vr),
                          (g.variancia_total, vx)]:
            assert abs(mine - ref) <= 0.005 + 1e-9 * abs(ref), (job, mine, ref)
        pct = vs / vx * 100
        assert g.tipo == ("Sazonal" if pct > 20 else "Linear")
        checked += 1
    assert checked == len(got) and checked > 100
