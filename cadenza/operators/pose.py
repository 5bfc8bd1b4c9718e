"""From pose frames to analysed frames: cleaning, smoothing, contacts, states, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ContactConfig, PoseConfig
from ..functions import geometry as G
from ..schemas import JOINTS, LIMB_JOINT, LIMBS, STATES
from . import series as S

CLIP = ["clip_id"]


def to_joints(frames: DataFrame, conf: PoseConfig = PoseConfig()) -> DataFrame:
    """One row per clip, joint and frame: x, y, c; null below the least confidence."""
    empty = F.array_repeat(F.lit(None).cast("struct<x:double,y:double,c:double>"), len(JOINTS))
    long = frames.select("clip_id", "i", F.posexplode(F.coalesce("kpts", empty)).alias("joint", "p"))
    sure = F.coalesce(F.col("p.c") >= conf.min_conf, F.lit(False))
    return long.select("clip_id", "joint", "i", *[F.when(sure, F.col(f"p.{v}")).cast("double").alias(v) for v in "xyc"])


def clean(joints: DataFrame) -> DataFrame:
    """Gaps of two or more values interpolated; a joint hardly seen has confidence 0."""
    by = ["clip_id", "joint"]
    out = S.fill_gaps(joints, by, "x", "y", "c")
    return out.withColumn("c", F.coalesce("c", F.lit(0.0)))


def smooth(joints: DataFrame, conf: PoseConfig = PoseConfig()) -> DataFrame:
    return S.smooth(joints, ["clip_id", "joint"], "x", "y", window=conf.smooth_window)


def to_frames(joints: DataFrame) -> DataFrame:
    """One row per clip and frame with joints in order."""
    ordered = F.array_sort(F.collect_list(F.struct("joint", "x", "y")))
    return joints.groupBy("clip_id", "i").agg(F.transform(ordered, lambda p: G.point(p["x"], p["y"])).alias("kpts"))


def body(frames: DataFrame, conf: PoseConfig = PoseConfig()) -> DataFrame:
    """``to_frames`` of cleaned and smoothed joints, worked out on one row a frame: all joints share the clip's windows, and nothing is unfolded and gathered again."""
    size = len(JOINTS)
    empty = F.array().cast("array<struct<x:double,y:double,c:double>>")
    seen = F.transform(F.coalesce("kpts", empty), lambda p: F.when(F.coalesce(p["c"] >= conf.min_conf, F.lit(False)), p))
    places = F.sequence(F.lit(0), F.lit(size - 1))
    values = F.transform(places, lambda j: F.get("seen", j)["x"].cast("double")), F.transform(places, lambda j: F.get("seen", j)["y"].cast("double"))
    wide = frames.select("clip_id", "i", seen.alias("seen")).select("clip_id", "i", F.concat(*values).alias("v"))
    filled = S.fill_gaps_each(wide, CLIP, "v", 2 * size).withColumn("v", F.transform("v", lambda x: F.coalesce(x, F.lit(0.0))))
    smoothed = S.smooth_each(filled, CLIP, "v", conf.smooth_window)
    return smoothed.select("clip_id", "i", F.transform(places, lambda j: G.point(F.get("v", j), F.get("v", j + size))).alias("kpts"))


def body_scale(frames: DataFrame) -> DataFrame:
    """Median torso length, and the hip height of standing, by clip."""
    k = F.col("kpts")
    hips = G.mid(G.joint(k, "lhip"), G.joint(k, "rhip"))
    parts = frames.select("clip_id", G.dist(G.mid(G.joint(k, "lsho"), G.joint(k, "rsho")), hips).alias("d"), hips["y"].alias("hip_y"))
    return parts.groupBy("clip_id").agg(F.percentile("d", 0.5).alias("torso"), F.percentile("hip_y", 0.9).alias("stand_y"), F.count("*").alias("n_frames"))


def with_scale(frames: DataFrame) -> DataFrame:
    """Each frame with its clip's ``body_scale``, by windows: the frames are worked out once."""
    k, whole = F.col("kpts"), Window.partitionBy(*CLIP)
    hips = G.mid(G.joint(k, "lhip"), G.joint(k, "rhip"))
    parts = frames.withColumns({"__d": G.dist(G.mid(G.joint(k, "lsho"), G.joint(k, "rsho")), hips), "__y": hips["y"]})
    return parts.withColumns({"torso": F.percentile("__d", 0.5).over(whole), "stand_y": F.percentile("__y", 0.9).over(whole)}).drop("__d", "__y")


def contacts(frames: DataFrame, conf: ContactConfig = ContactConfig()) -> DataFrame:
    """``frames`` (with fps and torso) and, for each limb, its filtered speed and whether it is in contact."""
    out = frames.withColumns({f"{limb}_{v}": G.joint(F.col("kpts"), LIMB_JOINT[limb])[v] for limb in LIMBS for v in "xy"})
    out = out.withColumns({f"{limb}_raw": S.speed(CLIP, f"{limb}_x", f"{limb}_y", F.col("fps"), F.col("torso"), conf.speed_reach) for limb in LIMBS})
    out = out.withColumns({f"{limb}_speed": F.coalesce(S.median5(CLIP, F.col(f"{limb}_raw")), F.lit(99.0)) for limb in LIMBS})
    out = out.withColumns({limb: S.latch(CLIP, F.col(f"{limb}_speed") < conf.on_t, F.col(f"{limb}_speed") > conf.off_t, conf.on_frames, conf.off_frames) for limb in LIMBS})
    return out.drop(*[f"{limb}_{x}" for limb in LIMBS for x in ("x", "y", "raw")])


def on_points() -> Column:
    """Limbs in contact with their end points, in limb order."""
    limbs = F.array(*[F.struct(F.lit(limb).alias("limb"), F.col(limb).alias("on"), G.joint(F.col("kpts"), LIMB_JOINT[limb]).alias("p"), F.lit(limb in ("lh", "rh")).alias("hand")) for limb in LIMBS])
    return F.filter(limbs, lambda v: v["on"])


def states(frames: DataFrame) -> DataFrame:
    """State, its beginning, support triangle and barn-door arm of frames with contacts, com and climbing."""
    n = reduce(lambda a, b: a + b, [F.col(limb).cast("int") for limb in LIMBS])
    active = F.col("climbing") & F.col("com").isNotNull()
    state = F.when(~active, "idle").when(n >= 4, "4pt").when(n == 3, "3pt").when(n == 2, "2pt").otherwise("1pt")
    out = frames.withColumn("n", n).withColumn("state", state).withColumn("st_t0", S.since(CLIP, F.col("state"), F.col("fps"))).withColumn("on", on_points())
    high = F.transform(F.array_sort(F.transform("on", lambda v: F.struct(v["p"]["y"].alias("y"), v["p"]["x"].alias("x")))), lambda v: G.point(v["x"], v["y"]))
    out = out.withColumn("tri", F.when(F.col("n") == 3, F.transform("on", lambda v: v["p"])).when(F.col("n") >= 4, F.slice(high, 1, 3)))
    corner = [F.get("tri", F.lit(k)) for k in range(3)]
    pair = [F.get("on", F.lit(k))["p"] for k in range(2)]
    com, three = F.col("com"), F.col("state").isin("3pt", "4pt")
    inside = F.when(three, G.in_triangle(com, *corner)).when(F.col("state") == "2pt", F.lit(False))
    margin = F.when(three, G.triangle_margin(com, *corner)).when(F.col("state") == "2pt", G.segment_dist(com, *pair))
    two_hands = F.size(F.filter("on", lambda v: v["hand"])) >= 2
    same = F.filter("on", lambda v: v["hand"] == two_hands)
    arm = G.line_dist(com, F.get(same, F.lit(0))["p"], F.get(same, F.lit(1))["p"]) / F.col("torso")
    bd = F.when((F.col("state") == "3pt") & (F.size(same) == 2), arm).otherwise(F.lit(0.0))
    return out.withColumn("inside", inside).withColumn("margin", margin / F.col("torso")).withColumn("bd", bd).drop("on", "tri")


def analyse(frames: DataFrame, clips: DataFrame, pose: PoseConfig = PoseConfig(), contact: ContactConfig = ContactConfig()) -> DataFrame:
    """Analysed frames at full precision (``output`` rounds them)."""
    out = with_scale(body(frames, pose)).join(clips.select("clip_id", "fps"), "clip_id")
    k = F.col("kpts")
    hip_y = (G.joint(k, "lhip")["y"] + G.joint(k, "rhip")["y"]) / 2
    out = out.withColumn("com", G.com(k)).withColumn("climbing", hip_y < F.col("stand_y") - pose.climb_rise * F.col("torso"))
    out = states(contacts(out, contact))
    angles = G.joint_angles(k)
    pairs = F.create_map(*[x for name, c in angles.items() for x in (F.lit(name), c)])
    v = F.hypot(S.gradient(CLIP, F.col("com.x")), S.gradient(CLIP, F.col("com.y"))) * F.col("fps")
    return out.withColumn("angles", pairs).withColumn("com_vel", F.when(v != 0, v)).withColumn("t", F.col("i") / F.col("fps"))


def output(frames: DataFrame) -> DataFrame:
    """Analysis frames as written: rounded, limbs in one struct."""
    r = lambda c, k: F.round(F.col(c), k).alias(c)
    xy = lambda p: G.point(F.round(p["x"], 1), F.round(p["y"], 1))
    return frames.select(
        "clip_id", "i", r("t", 3), F.transform("kpts", xy).alias("kpts"), F.transform_values("angles", lambda _, v: F.round(v, 1)).alias("angles"), F.when(F.col("com").isNotNull(), xy(F.col("com"))).alias("com"),
        r("com_vel", 2), F.struct(*LIMBS).alias("contacts"), "n", "state", r("st_t0", 2), r("bd", 2), r("margin", 3), "inside", "climbing",
    )


def clip_stats(frames: DataFrame, events: DataFrame) -> DataFrame:
    """Durations of states, climbing time, transfers and extremes of a clip."""
    seconds = F.create_map(*[x for s in STATES for x in (F.lit(s), F.round(F.count_if(F.col("state") == s) / F.first("fps"), 1))])
    by = frames.groupBy("clip_id").agg(
        F.first("fps").alias("fps"), F.count("*").cast("int").alias("n_frames"), F.round(F.first("torso"), 1).alias("torso_px"), F.round(F.count("*") / F.first("fps"), 1).alias("duration_s"),
        F.round(F.count_if("climbing") / F.first("fps"), 1).alias("climbing_s"), seconds.alias("state_s"), F.round(F.max("bd"), 2).alias("max_barndoor"), F.round(100 * F.count("com") / F.count("*"), 1).alias("com_detected_pct"),
    )
    moves = events.groupBy("clip_id").agg(F.count("*").cast("int").alias("transfers"))
    return by.join(moves, "clip_id", "left").withColumn("transfers", F.coalesce("transfers", F.lit(0)))


def still_speed(frames: DataFrame, times: float = 1.4) -> DataFrame:
    """A threshold for contact from the slower quarter of a clip's limb speeds."""
    speeds = frames.select("clip_id", F.explode(F.array(*[f"{limb}_speed" for limb in LIMBS])).alias("v"))
    return speeds.groupBy("clip_id").agg((F.percentile("v", 0.25) * times).alias("on_t"))
