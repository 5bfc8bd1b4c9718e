"""What is shown at a time: as-of lookups on tables of spans and instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frame_at(t: Column, fps: Column, n: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.round(t * fps).cast("int"), n - 1))


def ramp(t: Column, start: Column, seconds: float) -> Column:
    """0 to 1 over some seconds from a start."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (t - start) / seconds))


def caption_y(t: Column, low: Column) -> Column:
    """470, sliding to 200 between 4.5 and 5.1 s, and 1080 lower in the low slot."""
    return F.when(t < 4.5, F.lit(470.0)).when(t > 5.1, F.lit(200.0)).otherwise(470 - 270 * (t - 4.5) / 0.6) + 1080 * low


def triangle_opacity(age: Column) -> Column:
    return 0.35 + 0.65 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), age / 0.6))


def fade_in_window(times: DataFrame, windows: DataFrame, seconds: float) -> DataFrame:
    """How far each time (clip_id, t) is inside a window, ramps of ``seconds`` at both ends counted; the largest counts.

    Windows are spread over the seconds they touch, so that the range join is an equi-join.
    """
    spread = windows.withColumn("sec", F.explode(F.sequence(F.floor(F.col("t0") - seconds), F.floor(F.col("t1") + seconds))))
    x = times.withColumn("sec", F.floor("t")).join(spread, ["clip_id", "sec"], "left")
    inside = F.least(ramp(F.col("t"), F.col("t0") - seconds, seconds), 1 - ramp(F.col("t"), F.col("t1"), seconds))
    return x.groupBy("clip_id", "t").agg(F.coalesce(F.max(inside), F.lit(0.0)).alias("f"))


def last_before(times: DataFrame, marks: DataFrame, tolerance: float, value: str = "name") -> DataFrame:
    """Each time with the last mark (clip_id, t) at or before it, if not older than ``tolerance`` (a backward as-of join)."""
    both = times.select("clip_id", "t", F.lit(1).alias("ask"), F.lit(None).cast("struct<t:double,v:string>").alias("m")).unionByName(
        marks.select("clip_id", F.col("t").cast("double").alias("t"), F.lit(0).alias("ask"), F.struct(F.col("t").cast("double").alias("t"), F.col(value).alias("v")).alias("m"))
    )
    w = Window.partitionBy("clip_id").orderBy("t", "ask", "m").rowsBetween(Window.unboundedPreceding, 0)
    x = both.withColumn("m", F.last("m", ignorenulls=True).over(w)).filter("ask = 1")
    fresh = F.col("t") - F.col("m.t") <= tolerance
    return x.select("clip_id", "t", F.when(fresh, F.col("m.v")).alias(value), F.when(fresh, F.col("m.t")).alias("since"))


def active_phases(times: DataFrame, phases: DataFrame, before: float = 0.1, after: float = 0.4, top: int = 1) -> DataFrame:
    """Phases in force at each time, the latest begun first, at most ``top``."""
    spread = phases.withColumn("sec", F.explode(F.sequence(F.floor(F.col("t0") - before), F.floor(F.col("t1") + after))))
    x = times.withColumn("sec", F.floor("t")).join(spread, ["clip_id", "sec"]).filter(F.col("t").between(F.col("t0") - before, F.col("t1") + after))
    rank = F.row_number().over(Window.partitionBy("clip_id", "t").orderBy(F.desc("t0"), "name", "side"))
    return x.withColumn("rank", rank).filter(F.col("rank") <= top).select("clip_id", "t", "rank", "name", "side", "t0", "t1")


def technique_panel(times: DataFrame, phases: DataFrame, events: DataFrame, recent: float = 6.0) -> DataFrame:
    """The phase in force, else the last event of some seconds, else nothing."""
    p = active_phases(times, phases).select("clip_id", "t", F.col("name").alias("phase"))
    e = last_before(times, events, recent).select("clip_id", "t", F.col("name").alias("event"))
    x = times.join(p, ["clip_id", "t"], "left").join(e, ["clip_id", "t"], "left")
    return x.select("clip_id", "t", F.coalesce("phase", "event").alias("shown"), F.when(F.col("phase").isNotNull(), "phase").when(F.col("event").isNotNull(), "event").otherwise("default").alias("kind"))


def first_contacts(on: Column, points: Column) -> Column:
    """End points of the first three limbs in contact, in limb order (for drawing)."""
    return F.slice(F.filter(F.zip_with(on, points, lambda a, p: F.when(a, p)), lambda p: p.isNotNull()), 1, 3)


def visible(t: Column, pose_t0: Column, ov_end: Column) -> Column:
    return (t >= pose_t0 - 0.8) & (t <= ov_end)


def clock(t: Column) -> Column:
    """mm:ss.s, tenths rounded from the exact binary value (ties to even) as C does; Java's formats round the shortest decimal digits."""
    s = t - 60 * F.floor(t / 60)
    ten = 8 * s + 2 * s
    rest = 2 * s - (ten - 8 * s)  # 10 s is ten + rest exactly
    half = ten - F.floor(ten) == 0.5
    tenths = F.when(half & (rest < 0), F.floor(ten)).when(half & (rest > 0), F.ceil(ten)).otherwise(F.floor(F.rint(ten)))
    return F.when(t.isNotNull(), F.format_string("%02d:%02d.%d", F.floor(t / 60).cast("int"), F.floor(tenths / 10), tenths % 10))
