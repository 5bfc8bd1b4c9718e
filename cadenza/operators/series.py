"""Operators on ordered series: one row per place ``i`` = 0, 1, ... of a series ``by``.

All of them are window expressions over one partitioning and order, so that Spark sorts a
table once for a chain of them.  Nulls mean missing; no NaN is ever made.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

By = list[str]


def span(by: By, low: int | None = None, high: int | None = None):
    """Rows from low to high around the current one (None: to the end)."""
    w = Window.partitionBy(*by).orderBy("i")
    return w.rowsBetween(Window.unboundedPreceding if low is None else low, Window.unboundedFollowing if high is None else high)


def onward(by: By):
    """From the current row to the end, walked from the end: Spark works out a frame that ends at the end anew for each row, which takes the square of the rows."""
    return Window.partitionBy(*by).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)


def order(by: By):
    return Window.partitionBy(*by).orderBy("i")


def number(df: DataFrame, by: By, *keys: str) -> DataFrame:
    """Place ``i`` of each row in the order of ``keys``."""
    return df.withColumn("i", (F.row_number().over(Window.partitionBy(*by).orderBy(*keys)) - 1).cast("int"))


def fill_gaps(df: DataFrame, by: By, *cols: str, least: int = 2) -> DataFrame:
    """Linear interpolation of nulls over ``i``, flat beyond the ends; a series of fewer than ``least`` values becomes null."""
    filled = {}
    for c in cols:
        here = F.when(F.col(c).isNotNull(), F.struct("i", F.col(c).cast("double").alias("v")))
        before, after = F.last(here, ignorenulls=True).over(span(by, None, 0)), F.last(here, ignorenulls=True).over(onward(by))
        lerp = before["v"] + (after["v"] - before["v"]) * (F.col("i") - before["i"]) / (after["i"] - before["i"])
        value = F.when(before.isNull(), after["v"]).when(after.isNull() | (before["i"] == after["i"]), before["v"]).otherwise(lerp)
        filled[c] = F.when(F.count(c).over(Window.partitionBy(*by)) >= least, value)
    return df.withColumns(filled)


def fill_gaps_each(df: DataFrame, by: By, v: str, size: int, least: int = 2) -> DataFrame:
    """The same for each element of the arrays of ``size`` in column ``v``: a row for a place, whatever the number of series."""
    own = [F.get(v, F.lit(k)).cast("double") for k in range(size)]
    known = lambda w: (F.array(*[F.last(c, ignorenulls=True).over(w) for c in own]), F.array(*[F.last(F.when(c.isNotNull(), F.col("i")), ignorenulls=True).over(w) for c in own]))
    before, at = known(span(by, None, 0))
    after, then = known(onward(by))
    n = F.array(*[F.count(c).over(Window.partitionBy(*by)) for c in own])
    x = df.withColumns({"__before": before, "__at": at, "__n": n}).withColumns({"__after": after, "__then": then})

    def value(z):
        lerp = z["before"] + (z["after"] - z["before"]) * (F.col("i") - z["at"]) / (z["then"] - z["at"])
        return F.when(z["n"] < least, F.lit(None)).when(z["own"].isNotNull(), z["own"]).when(z["at"].isNull(), z["after"]).when(z["then"].isNull(), z["before"]).otherwise(lerp)

    # an array named within the lambda would be built anew for each element
    zipped = F.arrays_zip(F.col(v).cast("array<double>").alias("own"), *[F.col(f"__{c}").alias(c) for c in ("before", "at", "after", "then", "n")])
    return x.withColumn(v, F.transform(zipped, value)).drop("__before", "__at", "__after", "__then", "__n")


def hat(w: int, degree: int = 2) -> np.ndarray:
    """Row r gives the value at r of the polynomial fitted to w equally spaced values."""
    x = np.vander(np.arange(w) - (w - 1) / 2, degree + 1)
    return x @ np.linalg.pinv(x)


def smooth(df: DataFrame, by: By, *cols: str, window: int = 9) -> DataFrame:
    """Local quadratic smoothing over an odd window (Savitzky-Golay); the ends take the fit of the first and last window.

    A shorter series uses the largest odd window it holds, from 5 on; a series that is
    null throughout becomes 0, other nulls the median.
    """
    whole = Window.partitionBy(*by)
    given = [F.coalesce(F.col(c).cast("double"), F.percentile(F.col(c).cast("double"), 0.5).over(whole), F.lit(0.0)) for c in cols]
    out = smooth_each(df.withColumn("__v", F.array(*given)), by, "__v", window)
    return out.withColumns({c: F.get("__v", F.lit(k)) for k, c in enumerate(cols)}).drop("__v")


def smooth_each(df: DataFrame, by: By, v: str, window: int = 9) -> DataFrame:
    """The same for each element of the arrays in column ``v``, all of one length and without nulls: a row for a place, whatever the number of series."""
    n, ordered = F.count("*").over(Window.partitionBy(*by)), order(by)
    reach = window - 1
    near = {k: f"__v{k + reach}" for k in range(-reach, reach + 1)}
    shifted = {near[k]: F.lead(v, k).over(ordered) if k > 0 else F.lag(v, -k).over(ordered) if k < 0 else F.col(v) for k in near}
    x = df.withColumns(shifted | {"__n": n})
    n, i = F.col("__n"), F.col("i")
    w = F.least(F.lit(window), F.when(n % 2 == 1, n).otherwise(n - 1)).cast("int")
    table = F.lit(None)
    for s in range(5, window + 1, 2):
        table = F.when(w == s, F.array(*[F.array(*[F.lit(float(t)) for t in row]) for row in hat(s)])).otherwise(table)
    half = window // 2
    weights = [float(t) for t in hat(window)[half]]

    def middle(_, c):
        parts = [F.get(near[k - half], c) * F.lit(t) for k, t in enumerate(weights)]
        total = F.lit(0.0)
        for part in parts:
            total = total + part
        return total

    low = F.greatest(F.least(i - (w / 2).cast("int"), n - w), F.lit(0)).cast("int")
    row = F.get(table, (i - low).cast("int"))
    rows = F.slice(F.array(*near.values()), (low - i + reach + 1).cast("int"), w)
    ends = F.transform(v, lambda _, c: F.aggregate(F.zip_with(rows, row, lambda a, t: F.get(a, c) * t), F.lit(0.0), lambda s, t: s + t))
    inside = (i >= half) & (i < n - half) & (w == window)
    return x.withColumn(v, F.when(inside, F.transform(v, middle)).when(w >= 5, ends).otherwise(F.col(v))).drop(*[c for c in shifted if c != v], "__n")


def clamped(df_by: By, c: Column, k: int) -> Column:
    """The value k rows away, or at the end of the series."""
    w = order(df_by)
    return F.coalesce(F.lead(c, k).over(w), F.last(c).over(span(df_by))) if k > 0 else F.coalesce(F.lag(c, -k).over(w), F.first(c).over(span(df_by)))


def speed(by: By, x: str, y: str, fps: Column, scale: Column, reach: int = 5) -> Column:
    """Distance from ``reach`` rows before to as many after, a second, in units of ``scale``."""
    place = F.col("i").cast("double")
    seconds = (clamped(by, place, reach) - clamped(by, place, -reach)) / fps
    moved = F.hypot(clamped(by, F.col(x), reach) - clamped(by, F.col(x), -reach), clamped(by, F.col(y), reach) - clamped(by, F.col(y), -reach))
    return F.try_divide(moved, seconds) / F.greatest(scale, F.lit(1e-6))


def median5(by: By, c: Column) -> Column:
    """Median of five around each row; beyond an end the series is mirrored, the end value first."""
    w = order(by)
    lag, lead = [F.lag(c, k).over(w) for k in (1, 2)], [F.lead(c, k).over(w) for k in (1, 2)]
    a1, b1 = F.coalesce(lag[0], c), F.coalesce(lead[0], c)
    a2, b2 = F.coalesce(lag[1], F.when(lag[0].isNull(), b1).otherwise(a1)), F.coalesce(lead[1], F.when(lead[0].isNull(), a1).otherwise(b1))
    return F.get(F.array_sort(F.array(a2, a1, c, b1, b2)), F.lit(2))


def latch(by: By, on: Column, off: Column, on_rows: int, off_rows: int) -> Column:
    """On after ``on_rows`` rows of ``on``, off after ``off_rows`` rows of ``off``; between, the last state holds.

    Equal to a machine with run counters as long as no row is both.
    """

    def full(c: Column, k: int) -> Column:
        w = span(by, 1 - k, 0)
        return (F.count("*").over(w) == k) & F.coalesce(F.min(F.coalesce(c, F.lit(False))).over(w), F.lit(False))

    change = F.when(full(on, on_rows), True).when(full(off, off_rows), False)
    return F.coalesce(F.last(change, ignorenulls=True).over(span(by, None, 0)), F.lit(False))


def set_reset(by: By, enter: Column, leave: Column) -> Column:
    """On by ``enter``, off by ``leave``; on wins."""
    change = F.when(F.coalesce(enter, F.lit(False)), True).when(F.coalesce(leave, F.lit(False)), False)
    return F.coalesce(F.last(change, ignorenulls=True).over(span(by, None, 0)), F.lit(False))


def boxcar_width(fps: float, seconds: float = 0.27) -> int:
    return max(3, int(seconds * fps) | 1)


def boxcar(by: By, mask: Column, width: int, share: float = 0.6) -> Column:
    """Whether more than ``share`` of ``width`` rows are true; beyond an end the series is mirrored, the end value first."""
    k = width // 2
    bits = F.collect_list(F.when(mask, 1).otherwise(0)).over(span(by, -k, k))
    n = F.count("*").over(Window.partitionBy(*by))
    left, right = F.greatest(F.lit(0), k - F.col("i")), F.greatest(F.lit(0), F.col("i") + k - (n - 1)).cast("int")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, v: s + v)
    ones = total(bits) + total(F.slice(bits, F.lit(1), left)) + total(F.slice(F.reverse(bits), F.lit(1), right))
    return ones / F.lit(width) > share


def boxcars(df: DataFrame, by: By, bits: str, size: int, width: int, share: float = 0.6) -> DataFrame:
    """The same for ``size`` masks in the bits of a long, which becomes the smoothed masks' bits."""
    k = width // 2
    x = df.withColumn("__near", F.collect_list(bits).over(span(by, -k, k))).withColumn("__n", F.count("*").over(Window.partitionBy(*by)))
    near = F.col("__near")
    left, right = F.greatest(F.lit(0), k - F.col("i")).cast("int"), F.greatest(F.lit(0), F.col("i") + k - (F.col("__n") - 1)).cast("int")
    x = x.withColumn("__near", F.when((left > 0) | (right > 0), F.concat(near, F.slice(near, F.lit(1), left), F.slice(F.reverse(near), F.lit(1), right))).otherwise(near))
    least = next(m for m in range(width + 2) if m / width > share)
    ones = lambda mask: F.size(F.filter("__near", lambda v: v.bitwiseAND(F.lit(mask)) != 0))
    smoothed = F.lit(0).cast("long")
    for mask in (1 << b for b in range(size)):
        smoothed = smoothed.bitwiseOR(F.when(ones(mask) >= least, F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    none = F.aggregate("__near", F.lit(0).cast("long"), lambda s, v: s.bitwiseOR(v)) == 0
    return x.withColumn(bits, F.when(none, F.lit(0).cast("long")).otherwise(smoothed)).drop("__near", "__n")


def islands(df: DataFrame, by: By, mask: str) -> DataFrame:
    """Runs of true rows: a, b (first and last place) and rows, by series."""
    some = df.filter(F.col(mask)).withColumn("__run", F.col("i") - F.row_number().over(order(by)))
    return some.groupBy(*by, "__run").agg(F.min("i").alias("a"), F.max("i").alias("b"), F.count("*").alias("rows")).drop("__run")


def runs(df: DataFrame, by: By, mask: str, least: Column | int) -> DataFrame:
    """Runs of at least ``least`` rows that survive a three-wide opening (so three rows at least)."""
    return islands(df, by, mask).filter((F.col("rows") >= 3) & (F.col("rows") >= least))


def gradient(by: By, c: Column) -> Column:
    """Central difference; one-sided at the ends; 0 for one row."""
    w = order(by)
    before, after = F.lag(c).over(w), F.lead(c).over(w)
    return F.when(before.isNull(), F.coalesce(after - c, F.lit(0.0))).when(after.isNull(), c - before).otherwise((after - before) / 2)


def mean5(by: By, c: Column) -> Column:
    """Sum of five rows over five; rows beyond the ends count as 0."""
    return F.sum(F.coalesce(c, F.lit(0.0))).over(span(by, -2, 2)) / 5


def since(by: By, c: Column, fps: Column) -> Column:
    """Time at which the value of ``c`` began."""
    changed = ~c.eqNullSafe(F.lag(c).over(order(by))) | (F.col("i") == 0)
    return F.last(F.when(changed, F.col("i") / fps), ignorenulls=True).over(span(by, None, 0))


def debounce(by: By, c: Column, fps: Column, hold: float = 0.25) -> Column:
    """The last value that had lasted ``hold`` seconds (at first the first value)."""
    age = F.col("i") / fps - since(by, c, fps)
    return F.coalesce(F.last(F.when(age >= hold, c), ignorenulls=True).over(span(by, None, 0)), F.first(c).over(span(by, None, 0)))


def trail(by: By, c: Column, rows: int) -> Column:
    """The last ``rows`` values up to here, without nulls."""
    return F.collect_list(c).over(span(by, 1 - rows, 0))


def tolerant_runs(df: DataFrame, by: By, mask: str, gap: Column | int) -> DataFrame:
    """Runs of true rows that bridge up to ``gap`` others: a, b by series."""
    some = df.filter(F.col(mask)).withColumn("__new", F.coalesce((F.col("i") - F.lag("i").over(order(by)) - 1 > gap).cast("int"), F.lit(0)))
    some = some.withColumn("__run", F.sum("__new").over(span(by, None, 0)))
    return some.groupBy(*by, "__run").agg(F.min("i").alias("a"), F.max("i").alias("b")).drop("__run")


def longest_run(df: DataFrame, by: By, mask: str, gap: Column | int) -> DataFrame:
    """The longest of the tolerant runs (the earliest of equals)."""
    best = F.max_by(F.struct("a", "b"), F.struct((F.col("b") - F.col("a")).alias("n"), (-F.col("a")).alias("first")))
    return tolerant_runs(df, by, mask, gap).groupBy(*by).agg(best.alias("r")).select(*by, "r.a", "r.b")


def occlusion_windows(df: DataFrame, by: By, occupied: str, fps: Column, dur: Column, on_s: float, off_s: float, pad: float, fps_value: float = 30.0) -> DataFrame:
    """Windows of a switch over the rows where ``occupied`` is known: on after on_s, off after off_s, padded and clamped to the clip.

    Windows may touch or overlap after padding; they are not merged.
    """
    on_rows, off_rows = max(1, int(on_s * fps_value)), max(1, int(off_s * fps_value))
    known = df.filter(F.col(occupied).isNotNull())
    known = known.withColumn("frame", F.col("i")).withColumn("i", (F.row_number().over(order(by)) - 1).cast("int"))
    known = known.withColumn("on", latch(by, F.col(occupied), ~F.col(occupied), on_rows, off_rows))
    before = F.coalesce(F.lag("on").over(order(by)), F.lit(False))
    edges = known.withColumn("step", F.when(F.col("on") & ~before, F.lit(1)).when(~F.col("on") & before, F.lit(-1))).filter("step is not null")
    closed = F.lead("frame").over(order(by))
    wins = edges.withColumn("t1", F.coalesce((closed - off_rows) / fps, dur)).filter("step = 1").withColumn("t0", (F.col("frame") - on_rows) / fps)
    wins = wins.filter("t1 > t0")
    return wins.select(*by, F.round(F.greatest(F.lit(0.0), F.col("t0") - pad), 2).alias("t0"), F.round(F.least(dur, F.col("t1") + pad), 2).alias("t1"))
