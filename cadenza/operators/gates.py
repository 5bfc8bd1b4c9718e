"""Quality gates: violations as rows, and an error when there are any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import GateConfig
from ..schemas import LIMBS, STATES


class GateError(ValueError):
    """A gate found violations."""


def _rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Names of the rules that each row breaks."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.select("clip_id", "i", F.explode(broken).alias("rule"))


def _clips(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return _rows(df.withColumn("i", F.lit(None).cast("int")), rules)


def _outside(v: Column, most: float | None, edge: float = 0.0) -> Column:
    return F.lit(False) if most is None else ~v.between(-edge, most + edge)


def pose_gate(frames: DataFrame, conf: GateConfig = GateConfig()) -> DataFrame:
    """clip_id, i (null for the whole clip) and rule of each violation in pose frames."""
    place = F.row_number().over(Window.partitionBy("clip_id").orderBy("i")) - 1
    k = F.col("kpts")
    rules = {
        "index": F.col("i") != F.col("place"),
        "joints": F.size(k) != 17,
        "malformed": F.exists(k, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull() | p["c"].isNull()),
        "confidence": F.exists(k, lambda p: ~p["c"].between(0.0, 1.0)),
        "x": F.exists(k, lambda p: _outside(p["x"], conf.w, conf.edge)),
        "y": F.exists(k, lambda p: _outside(p["y"], conf.h, conf.edge)),
    }
    rate = frames.groupBy("clip_id").agg((F.count("kpts") / F.count("*")).alias("rate"))
    return _rows(frames.withColumn("place", place), rules).unionByName(_clips(rate, {"rate": F.col("rate") < conf.min_detect}))


def analysis_gate(frames: DataFrame, stats: DataFrame, events: DataFrame, conf: GateConfig = GateConfig()) -> DataFrame:
    """The same for analysed frames (as ``output`` gives them), statistics and events."""
    n = sum((F.coalesce(F.col(f"contacts.{limb}"), F.lit(False)).cast("int") for limb in LIMBS), F.lit(0))
    due = F.when(~F.col("climbing") | F.col("com").isNull(), "idle").when(n >= 4, "4pt").when(n == 3, "3pt").when(n == 2, "2pt").otherwise("1pt")
    needed = ("t", "contacts", "n", "state", "st_t0", "bd", "climbing")
    rules = {
        "missing": F.lit(False) if not needed else F.greatest(*[F.col(c).isNull().cast("int") for c in needed]) == 1,
        "state_domain": ~F.col("state").isin(*STATES),
        "contact_count": F.col("n") != n,
        "state": F.col("state") != due,
        "angle": F.exists(F.map_values("angles"), lambda v: ~v.between(0.0, 180.0)),
        "com_x": _outside(F.col("com.x"), conf.w),
        "com_y": _outside(F.col("com.y"), conf.h),
        "margin": F.col("margin") < 0,
        "barndoor": (F.col("bd") < 0) | F.isnan("bd") | (F.col("bd") == float("inf")),
    }
    rate = frames.groupBy("clip_id").agg((F.count("com") / F.count("*")).alias("rate"), F.count("*").alias("n"))
    total = F.aggregate(F.map_values("state_s"), F.lit(0.0), lambda a, v: a + v)
    dur = F.col("n") / F.col("fps")
    clip = {
        "com_rate": F.col("rate") < conf.min_com,
        "state_sum": (total != 0) & (F.abs(total - dur) > 0.5 * F.greatest(F.lit(1.0), dur * 0.01)),
        "torso": F.coalesce(F.col("torso_px"), F.lit(0.0)) <= 0,
    }
    fields = ("t0", "t1", "dur", "dx", "dy", "disp")
    event = {
        "event_field": F.greatest(*[F.col(c).isNull().cast("int") for c in fields]) == 1,
        "event_order": F.coalesce(F.col("t1"), F.lit(0.0)) <= F.coalesce(F.col("t0"), F.lit(0.0)),
        "event_limbs": F.coalesce(F.size("moved"), F.lit(0)) <= 0,
    }
    return _rows(frames, rules).unionByName(_clips(rate.join(stats.select("clip_id", "fps", "state_s", "torso_px"), "clip_id"), clip)).unionByName(_clips(events, event))


def missing_keys(keys: Column, required: list[str]) -> Column:
    return F.array_except(F.array(*map(F.lit, required)), keys)


def require(violations: DataFrame, show: int = 5) -> None:
    """Stop with an error that names some violations, if there are any."""
    if some := violations.limit(show).collect():
        raise GateError("; ".join(f"{r['clip_id']}[{r['i']}]: {r['rule']}" for r in some))
