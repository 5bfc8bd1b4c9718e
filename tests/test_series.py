"""Series operators against plain loops on random series."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.config import TECHNIQUE, TRANSFER
from cadenza.operators import episodes as E
from cadenza.operators import series as S
from cadenza.streaming.latches import latch_step

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def data():
    return {f"s{k}": [None if RNG.random() < 0.2 else float(v) for v in RNG.random(n)] for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 20, 60, 60, 60])}


@pytest.fixture(scope="module")
def rows(spark, data):
    return spark.createDataFrame([(k, i, v) for k, vs in data.items() for i, v in enumerate(vs)], "k string, i int, x double").persist()


def out(df, col):
    found = {}
    for r in df.select("k", "i", F.col(col).alias("v")).collect():
        found.setdefault(r.k, {})[r.i] = r.v
    return {k: [v[i] for i in sorted(v)] for k, v in found.items()}


def test_fill_gaps(rows, data):
    for k, got in out(S.fill_gaps(rows, ["k"], "x"), "x").items():
        at = [i for i, v in enumerate(data[k]) if v is not None]
        want = np.interp(range(len(data[k])), at, [data[k][i] for i in at]) if len(at) > 1 else None
        assert all(v is None for v in got) if want is None else np.allclose(got, want)


def test_smooth(rows, data):
    filled = {k: [0.5 if v is None else v for v in vs] for k, vs in data.items()}
    for k, got in out(S.smooth(rows.fillna(0.5, ["x"]), ["k"], "x"), "x").items():
        x, n = np.array(filled[k]), len(filled[k])
        w = min(9, n if n % 2 else n - 1)
        want = x.copy()
        if w >= 5:
            for i in range(n):
                low = min(max(i - w // 2, 0), n - w)
                want[i] = np.polyval(np.polyfit(np.arange(w), x[low : low + w], 2), i - low)
        assert np.allclose(got, want)
    assert np.allclose(S.hat(9)[4] * 231, [-21, 14, 39, 54, 59, 54, 39, 14, -21])


def test_a_series_without_values_becomes_zero(spark):
    df = spark.createDataFrame([("a", i, None) for i in range(12)], "k string, i int, x double")
    assert out(S.smooth(S.fill_gaps(df, ["k"], "x"), ["k"], "x"), "x")["a"] == [0.0] * 12


def mirrored(x, i):
    n = len(x)
    return x[-i - 1] if i < 0 else x[2 * n - 1 - i] if i >= n else x[i]


def test_median_and_boxcar(rows, data):
    full = rows.fillna(0.3, ["x"])
    values = {k: [0.3 if v is None else v for v in vs] for k, vs in data.items()}
    for k, got in out(full.withColumn("m", S.median5(["k"], F.col("x"))), "m").items():
        if len(values[k]) >= 2:
            assert got == [float(np.median([mirrored(values[k], i + d) for d in range(-2, 3)])) for i in range(len(values[k]))]
    for k, got in out(full.withColumn("m", S.boxcar(["k"], F.col("x") > 0.4, 9)), "m").items():
        if len(values[k]) >= 5:
            assert got == [sum(mirrored(values[k], i + d) > 0.4 for d in range(-4, 5)) / 9 > 0.6 for i in range(len(values[k]))]


def test_latch_equals_the_counting_machine(rows, data):
    got = out(rows.withColumn("on", S.latch(["k"], F.coalesce("x", F.lit(99.0)) < 0.55, F.coalesce("x", F.lit(99.0)) > 0.6, 4, 3)), "on")
    for k, vs in data.items():
        state, want = (False, 0), []
        for v in vs:
            state = latch_step(state, v, 0.55, 0.6, 4, 3)
            want.append(state[0])
        assert got[k] == want


def test_set_reset(rows, data):
    got = out(rows.withColumn("on", S.set_reset(["k"], F.col("x") < 0.3, F.col("x") < 0.6)), "on")
    for k, vs in data.items():
        on, want = False, []
        for v in vs:
            on = (v is not None and v < 0.3) or (on and not (v is not None and v < 0.6))
            want.append(on)
        assert got[k] == want


def test_gradient_speed_and_mean(rows, data):
    full = rows.fillna(0.3, ["x"])
    got = out(full.withColumn("g", S.gradient(["k"], F.col("x"))), "g")
    mean = out(full.withColumn("g", S.mean5(["k"], F.col("x"))), "g")
    speed = out(full.withColumn("y", F.lit(0.0)).withColumn("g", S.speed(["k"], "x", "y", F.lit(30.0), F.lit(2.0))), "g")
    for k, vs in data.items():
        x = np.array([0.3 if v is None else v for v in vs])
        n = len(x)
        if n > 1:
            assert np.allclose(got[k], np.gradient(x))
            lo, hi = np.maximum(np.arange(n) - 5, 0), np.minimum(np.arange(n) + 5, n - 1)
            assert np.allclose(speed[k], np.abs(x[hi] - x[lo]) / ((hi - lo) / 30) / 2)
        padded = np.concatenate([[0, 0], x, [0, 0]])
        assert np.allclose(mean[k], [padded[i : i + 5].sum() / 5 for i in range(n)])


def test_runs_and_longest_tolerant_run(rows, data):
    got = {(r.k, r.a, r.b) for r in S.runs(rows.withColumn("m", F.coalesce(F.col("x") > 0.25, F.lit(False))), ["k"], "m", 3).collect()}
    best = {r.k: (r.a, r.b) for r in S.longest_run(rows.withColumn("m", F.coalesce(F.col("x") > 0.6, F.lit(False))), ["k"], "m", 2).collect()}
    want, longest = set(), {}
    for k, vs in data.items():
        run = [i for i, v in enumerate(vs) if v is not None and v > 0.25]
        for i in run:
            if i - 1 not in run:
                j = i
                while j + 1 in run:
                    j += 1
                if j - i >= 2:
                    want.add((k, i, j))
        on = [i for i, v in enumerate(vs) if v is not None and v > 0.6]
        spans = []
        for i in on:
            if spans and i - spans[-1][1] - 1 <= 2:
                spans[-1][1] = i
            else:
                spans.append([i, i])
        if spans:
            longest[k] = tuple(max(spans, key=lambda s: (s[1] - s[0], -s[0])))
    assert got == want and best == longest


def walk(on, conf, fps, frames):
    """Episodes by a scan from left to right."""
    found, i, n = [], 1, len(on)
    while i < n:
        if on[i - 1] and not on[i] and sum(on[max(0, i - conf.pre) : i]) >= conf.pre_on:
            land = next((j for j in range(i, min(n, i + int(conf.gap_s * fps))) if on[j] and sum(on[j : j + conf.land]) >= conf.land_on), None)
            if land is not None and ((land - i >= int(conf.least_s * fps)) if frames else ((land - i) / fps >= conf.least_s)):
                found.append((i, land))
            i = (land or i) + 1
        else:
            i += 1
    return found


@pytest.mark.parametrize(("conf", "frames"), [(TRANSFER, True), (TECHNIQUE, False)])
def test_episodes_equal_a_scan(spark, conf, frames):
    rng = np.random.default_rng(4)
    series = {f"c{k}": (rng.random(150) < 0.8 if k % 2 else np.repeat(rng.random(40) < 0.6, 4)[:150]).tolist() for k in range(30)}
    series["flicker"] = [True] * 8 + [False, False, True, True, True, False, False, True, True, True, True, True] + [False] * 30 + [True] * 6
    limbs = spark.createDataFrame([(k, i, 12.0, "lh", 0, bool(v)) for k, vs in series.items() for i, v in enumerate(vs)], "clip_id string, i int, fps double, limb string, rank int, on boolean")
    got = {}
    for r in E.episodes(limbs, conf, frames).collect():
        got.setdefault(r.clip_id, []).append((r.a, r.b))
    assert {k: sorted(v) for k, v in got.items()} == {k: w for k, vs in series.items() if (w := walk(vs, conf, 12.0, frames))}
    assert got


def test_merge_is_strict(spark):
    spans = spark.createDataFrame([("c", "lh", 0, 10, 20), ("c", "rf", 3, 15, 25), ("c", "lf", 2, 25, 30), ("c", "rh", 1, 10, 12)], "clip_id string, limb string, rank int, a int, b int")
    assert sorted((r.a, r.b, tuple(r.limbs)) for r in E.merge_overlaps(spans).collect()) == [(10, 25, ("lh", "rh", "rf")), (25, 30, ("lf",))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0, 1), max_size=40))
def test_latch_step_is_causal(values):
    state, seen = (False, 0), []
    for v in values:
        state = latch_step(state, v, 0.3, 0.7, 4, 3)
        seen.append(state[0])
    state = (False, 0)
    for k, v in enumerate(values):
        state = latch_step(state, v, 0.3, 0.7, 4, 3)
        assert state[0] == seen[k]


def test_occlusion_windows(spark):
    occ = [None, *[True] * 5, None, *[False] * 3, True, *[False] * 8, *[True] * 9]
    df = spark.createDataFrame([("c", i, v) for i, v in enumerate(occ)], "clip_id string, i int, occ boolean")
    got = S.occlusion_windows(df, ["clip_id"], "occ", F.lit(10.0), F.lit(len(occ) / 10), 0.4, 0.6, 0.3, 10.0)
    # on at the fourth true (frame 4), off at the sixth false in a row (frame 16); on again at 22, open to the end
    assert sorted((r.t0, r.t1) for r in got.collect()) == [(0.0, 1.3), (1.5, 2.8)]
