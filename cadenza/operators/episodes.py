"""Contact episodes of limbs, and the transfers that they make up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TRANSFER, EpisodeConfig
from ..schemas import LIMB_LABEL, LIMBS
from . import series as S

BY = ["clip_id", "limb"]


def to_limbs(frames: DataFrame) -> DataFrame:
    """One row per clip, limb and frame: whether it is in contact."""
    return frames.select("clip_id", "i", "fps", F.explode(F.array(*[F.struct(F.lit(limb).alias("limb"), F.lit(k).alias("rank"), F.col(limb).alias("on")) for k, limb in enumerate(LIMBS)])).alias("v")).select("clip_id", "i", "fps", "v.*")


def marked(limbs: DataFrame, conf: EpisodeConfig) -> DataFrame:
    """Breaks (contact ends after being held) and the first firm landing after each row."""
    bit = F.col("on").cast("int")
    before = F.lag("on").over(S.order(BY))
    broke = F.coalesce(before & ~F.col("on"), F.lit(False)) & (F.coalesce(F.sum(bit).over(S.span(BY, -conf.pre, -1)), F.lit(0)) >= conf.pre_on)
    firm = F.col("on") & (F.sum(bit).over(S.span(BY, 0, conf.land - 1)) >= conf.land_on)
    out = limbs.withColumn("broke", broke).withColumn("firm", F.when(firm, F.col("i")))
    return out.withColumn("landing", F.min("firm").over(S.onward(BY)))


def episodes(limbs: DataFrame, conf: EpisodeConfig = TRANSFER, floor_frames: bool = True) -> DataFrame:
    """Break ``a`` and landing ``b`` of each episode; a break within an earlier one's span is passed over.

    ``floor_frames``: the least duration counts whole frames, else seconds.
    """
    gap = F.floor(F.lit(conf.gap_s) * F.col("fps"))
    breaks = marked(limbs, conf).filter("broke").withColumn("b", F.when(F.col("landing") - F.col("i") < gap, F.col("landing")))
    long = (F.col("b") - F.col("i") >= F.floor(F.lit(conf.least_s) * F.col("fps"))) if floor_frames else ((F.col("b") - F.col("i")) / F.col("fps") >= conf.least_s)
    listed = breaks.groupBy(*BY).agg(F.first("rank").alias("rank"), F.array_sort(F.collect_list(F.struct(F.col("i").alias("a"), "b", F.coalesce(long, F.lit(False)).alias("ok")))).alias("breaks"))
    start = F.struct(F.lit(-1).alias("end"), F.array().cast("array<struct<a:int,b:int>>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        taken = F.struct(F.coalesce(x["b"], x["a"]).alias("end"), F.when(x["ok"], F.concat(state["found"], F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))).otherwise(state["found"]).alias("found"))
        return F.when(x["a"] <= state["end"], state).otherwise(taken)

    return listed.select(*BY, "rank", F.inline(F.aggregate("breaks", start, step)["found"]))


def merge_overlaps(spans: DataFrame) -> DataFrame:
    """Spans (clip_id, limb, rank, a, b) that truly overlap become one, with its limbs in order."""
    w = Window.partitionBy("clip_id").orderBy("a", "rank")
    reached = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("a") >= reached).cast("int"), F.lit(1))
    placed = spans.withColumn("new", new).withColumn("group", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    limbs = F.transform(F.array_sort(F.collect_list(F.struct("a", "rank", "limb"))), lambda v: v["limb"])
    return placed.groupBy("clip_id", "group").agg(limbs.alias("limbs"), F.min("a").alias("a"), F.max("b").alias("b"))


def transfers(merged: DataFrame, frames: DataFrame, least: float = 0.20) -> DataFrame:
    """Transfers of weight: spans on the wall across which the centre of mass moves enough.

    The four frames that a span looks up are joined on their (clamped) index.
    """
    n = frames.groupBy("clip_id").agg((F.max("i")).alias("last"), F.first("fps").alias("fps"), F.first("torso").alias("torso"))
    x = merged.join(n, "clip_id")
    clamp = lambda c: F.greatest(F.least(c, F.col("last")), F.lit(0)).cast("int")
    x = x.withColumn("i0", clamp(F.col("a") - F.floor(0.4 * F.col("fps")))).withColumn("i1", clamp(F.col("b") + F.floor(0.6 * F.col("fps")))).withColumn("is0", clamp(F.col("a") - 1)).withColumn("is1", clamp(F.col("b") + 2))
    small = frames.select("clip_id", "i", "com", "state", "climbing")
    for key, cols in (("a", {"climbing": "climb_a"}), ("b", {"climbing": "climb_b"}), ("i0", {"com": "c0"}), ("i1", {"com": "c1"}), ("is0", {"state": "s0"}), ("is1", {"state": "s1"})):
        x = x.join(small.select("clip_id", F.col("i").alias(key), *[F.col(c).alias(to) for c, to in cols.items()]), ["clip_id", key])
    dx, dy = (F.col("c1.x") - F.col("c0.x")) / F.col("torso"), (F.col("c1.y") - F.col("c0.y")) / F.col("torso")
    labels = F.create_map(*[v for k, t in LIMB_LABEL.items() for v in (F.lit(k), F.lit(t))])
    x = x.filter("climb_a or climb_b").withColumn("dx", dx).withColumn("dy", dy).withColumn("disp", F.hypot("dx", "dy")).filter(F.col("disp") > least)
    sec = lambda c: F.round(c / F.col("fps"), 2)
    return x.select("clip_id", sec(F.col("a")).alias("t0"), sec(F.col("b")).alias("t1"), sec(F.col("b") - F.col("a")).alias("dur"), F.transform("limbs", lambda v: F.element_at(labels, v)).alias("moved"), *[F.round(c, 2).alias(c) for c in ("dx", "dy", "disp")], "s0", "s1")
