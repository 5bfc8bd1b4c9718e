"""Following one person through the detections of a clip."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PoseConfig
from ..functions.geometry import box_area, hip_mid


def select_target(detections: DataFrame, conf: PoseConfig = PoseConfig()) -> DataFrame:
    """One row per frame of ``detections`` (clip_id, i, det, track_id, bbox, kpts): the person followed.

    From the topmost box down, the first whose hips are within reach of the last seen hips;
    the topmost if none is.  The choice depends on the one before, so a clip's frames are
    folded in order; the fold carries hips only, and picks detections by number.
    """
    seen = detections.select("clip_id", "i", "det", (F.col("bbox")[1] + F.col("bbox")[3]).alias("top"), hip_mid(F.col("kpts")).alias("hip"))
    frames = seen.groupBy("clip_id", "i").agg(F.array_sort(F.collect_list(F.struct("top", "det", "hip"))).alias("people"))
    clips = frames.groupBy("clip_id").agg(F.array_sort(F.collect_list(F.struct("i", "people"))).alias("frames"))
    start = F.struct(F.lit(None).cast("struct<x:double,y:double>").alias("hip"), F.array().cast("array<struct<i:int,det:int>>").alias("picked"))

    def step(state, frame):
        near = F.filter(frame["people"], lambda p: F.coalesce(F.hypot(p["hip"]["x"] - state["hip"]["x"], p["hip"]["y"] - state["hip"]["y"]) < conf.track_reach, F.lit(False)))
        one = F.coalesce(F.get(near, F.lit(0)), F.get(frame["people"], F.lit(0)))
        return F.struct(F.coalesce(one["hip"], state["hip"]).alias("hip"), F.concat(state["picked"], F.array(F.struct(frame["i"].cast("int").alias("i"), one["det"].cast("int").alias("det")))).alias("picked"))

    picked = clips.select("clip_id", F.inline(F.aggregate("frames", start, step)["picked"]))
    return detections.join(picked, ["clip_id", "i", "det"])


def track_areas(detections: DataFrame, top: int = 8) -> DataFrame:
    """Total box area of the ``top`` tracks of a clip."""
    total = detections.filter("track_id is not null").groupBy("clip_id", "track_id").agg(F.sum(box_area(F.col("bbox"))).alias("area"))
    rank = F.row_number().over(Window.partitionBy("clip_id").orderBy(F.desc("area"), "track_id"))
    return total.withColumn("rank", rank).filter(F.col("rank") <= top)


def pose_frames(clips: DataFrame, detections: DataFrame, conf: PoseConfig = PoseConfig()) -> DataFrame:
    """All frames of ``clips`` (clip_id, fps, n_frames); those without a detection have nulls."""
    every = clips.select("clip_id", "fps", F.explode(F.sequence(F.lit(0), F.col("n_frames") - 1)).alias("i"))
    kept = select_target(detections, conf).select("clip_id", "i", "track_id", "bbox", "kpts")
    return every.join(kept, ["clip_id", "i"], "left").select("clip_id", "i", (F.col("i") / F.col("fps")).alias("t"), "track_id", "bbox", "kpts")
