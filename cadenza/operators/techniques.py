"""Rule-based technique detection on analysed frames: nine phases and six events.

Phases are masks: predicate, optional set/reset latch, boxcar smoothing, runs of a least
length; all masks of a clip are bits of one number and share one stage of windows.  Events start
from contact episodes, breaks or runs, which are few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TECHNIQUE
from ..functions import geometry as G
from . import series as S
from .episodes import episodes, marked, to_limbs

CLIP = ["clip_id"]
SIDE = {"l": "左", "r": "右"}
OTHER = {"l": "r", "r": "l"}


def features(frames: DataFrame) -> DataFrame:
    """The columns that detectors use, one row per frame (angles by name, joints as structs)."""
    k = F.col("kpts")
    out = frames
    for s in "lr":
        for j in ("sho", "wr", "hip", "knee", "ank"):
            out = out.withColumn(f"{s}{j}", G.joint(k, f"{s}{j}"))
        out = out.withColumn(f"{s}el_deg", F.element_at("angles", f"{s}el")).withColumn(f"{s}knee_deg", F.element_at("angles", f"{s}knee"))
    base = frames.groupBy("clip_id").agg(
        F.percentile(G.joint(k, "lank")["x"] - G.joint(k, "rank")["x"], 0.5).alias("feet_order"), F.percentile(G.joint(k, "lwr")["x"] - G.joint(k, "rwr")["x"], 0.5).alias("hands_order")
    )
    return out.join(base, "clip_id").withColumn("T", F.greatest("torso", F.lit(1e-6)))


def masks(f: DataFrame, fps: float) -> list[tuple[str, str, Column, float, Column, Column]]:
    """Name, side, mask before smoothing, least seconds, measured column and confidence (of ``sec`` and ``top``) of each phase."""
    c = F.col
    climbing, hand = c("climbing"), c("lh") | c("rh")
    known = lambda x: F.coalesce(x, F.lit(False))
    sec, top = c("sec"), c("top")
    none = F.lit(None).cast("double")
    out = []
    sho = F.abs(c("lsho.x") - c("rsho.x")) / c("T")
    out.append(("side_on", "", S.set_reset(CLIP, climbing & hand & (sho < 0.38), sho > 0.48), 0.8, none, 0.5 + sec / 4))
    mid_x = (c("lhip.x") + c("rhip.x")) / 2
    for s in "lr":
        o, foot = OTHER[s], c(f"{s}f")
        hip, knee, ank = (F.abs(c(f"{s}{j}.x") - mid_x) for j in ("hip", "knee", "ank"))
        out.append(("drop_knee", SIDE[s], climbing & foot & (knee + 0.08 * c("T") < F.least(hip, ank)) & (c(f"{s}knee_deg") < 155), 0.5, none, 0.55 + sec / 3))
        out.append(("lock_off", f"{SIDE[s]}手", climbing & c(f"{s}h") & ~c(f"{o}h") & (c(f"{s}el_deg") < 82), 0.6, none, 0.55 + sec / 2))
        hooked = (G.dist(c(f"{s}ank"), c(f"{o}knee")) < 0.18 * c("T")) & (F.abs(c(f"{s}ank.y") - c(f"{o}knee.y")) < 0.15 * c("T"))
        out.append(("knee_bar", SIDE[s], climbing & ~foot & hooked, 0.6, none, F.lit(0.6)))
        lift = (c(f"{s}knee.y") - c(f"{s}ank.y")) / c("T")
        out.append(("heel_hook", SIDE[s], climbing & foot & (lift > 0.25) & (c(f"{s}knee_deg") < 175), 0.5, lift, 0.5 + top / 1.5))
        others = [c("lwr.x"), c("rwr.x"), c(f"{o}ank.x")]
        x = c(f"{s}ank.x")
        outside = (x < F.least(*others) - 0.5 * c("T")) | (x > F.greatest(*others) + 0.5 * c("T"))
        out.append(("flagging", SIDE[s], climbing & ~foot & c(f"{o}f") & outside & (c(f"{s}knee_deg") > 150), 0.5, none, 0.5 + sec / 2))
    crossed = -F.signum("feet_order") * (c("lank.x") - c("rank.x"))
    flip = S.set_reset(CLIP, climbing & (crossed > 0.06 * c("T")), ~known(crossed > -0.05 * c("T")))
    out.append(("cross_feet", "", flip & c("feet_order").isNotNull(), 0.3, crossed / c("T"), 0.4 + top))
    apart = G.dist(c("lwr"), c("rwr")) / c("T")
    out.append(("match_hands", "", climbing & c("lh") & c("rh") & (c("lf") | c("rf")) & (apart < 0.28), 0.4, none, 0.6 + sec / 3))
    out.append(("straight_arm", "", climbing & hand & (c("lel_deg") > 158) & (c("rel_deg") > 158), 1.0, none, 0.5 + sec / 4))
    return [(name, side, known(mask), least, measure, conf) for name, side, mask, least, measure, conf in out]


def phases(f: DataFrame, fps: float) -> DataFrame:
    """Phases of all nine kinds (``f``: ``features``)."""
    listed = masks(f, fps)
    bit = lambda k: F.lit(1 << k).cast("long")
    raw = [F.when(mask, bit(k)).otherwise(F.lit(0).cast("long")) for k, (_, _, mask, _, _, _) in enumerate(listed)]
    wide = f.select("clip_id", "i", reduce(lambda a, b: a.bitwiseOR(b), raw).alias("on"), F.array(*[v[4].cast("double") for v in listed]).alias("measures"))
    wide = S.boxcars(wide, CLIP, "on", len(listed), S.boxcar_width(fps)).filter("on <> 0")
    kinds = F.filter(F.sequence(F.lit(0), F.lit(len(listed) - 1)), lambda k: F.getbit("on", k) == 1)
    some = wide.select("clip_id", "i", "measures", F.explode(kinds).alias("kind")).withColumn("measure", F.get("measures", "kind")).drop("measures")
    by = ["clip_id", "kind"]
    some = some.withColumn("run", F.col("i") - F.row_number().over(S.order(by)))
    least = F.element_at(F.array(*[F.lit(v[3]) for v in listed]), F.col("kind") + 1)
    spans = some.groupBy(*by, "run").agg(F.min("i").alias("a"), F.max("i").alias("b"), F.count("*").alias("rows"), F.max("measure").alias("top"))
    spans = spans.filter((F.col("rows") >= 3) & (F.col("rows") / fps >= least)).withColumn("sec", (F.col("b") - F.col("a")) / fps)
    pick = lambda values: F.element_at(F.array(*values), F.col("kind") + 1)
    return spans.select(
        "clip_id", pick([F.lit(v[0]) for v in listed]).alias("name"), F.round(F.col("a") / fps, 2).alias("t0"), F.round(F.col("b") / fps, 2).alias("t1"),
        pick([F.lit(v[1]) for v in listed]).alias("side"), F.round(F.least(F.lit(1.0), pick([v[5].cast("double") for v in listed])), 2).alias("conf"),
    )


def at(f: DataFrame, key: str, *cols: str) -> DataFrame:
    """Columns of the frame whose place is in column ``key``, prefixed by it."""
    return f.select("clip_id", F.col("i").alias(key), *[F.col(c).alias(f"{key}_{c}") for c in cols])


def event(name: str, t: Column, side: Column, conf: Column) -> list:
    return ["clip_id", F.lit(name).alias("name"), F.round(t, 2).alias("t"), side.alias("side"), F.round(F.least(F.lit(1.0), conf), 2).alias("conf")]


def sided(limb: Column, word: str) -> Column:
    return F.concat(F.when(F.substring(limb, 1, 1) == "l", "左").otherwise("右"), F.lit(word))


def by_limb(limb: Column, key: str, col: str, other: bool = False) -> Column:
    """The joint column of the limb's own side (or the other) at ``key``."""
    left, right = F.col(f"{key}_l{col}"), F.col(f"{key}_r{col}")
    own = F.substring(limb, 1, 1) == ("r" if other else "l")
    return F.when(own, left).otherwise(right)


def high_step(f: DataFrame, eps: DataFrame, fps: float) -> DataFrame:
    """A foot lands above the other knee and its own hip; at most one a second on each side."""
    x = eps.filter("limb in ('lf', 'rf')").join(at(f, "b", "climbing", "T", "lknee", "rknee", "lank", "rank", "lhip", "rhip"), ["clip_id", "b"]).filter("b_climbing")
    limb, T = F.col("limb"), F.col("b_T")
    x = x.withColumn("margin", (by_limb(limb, "b", "knee", other=True)["y"] - by_limb(limb, "b", "ank")["y"]) / T).withColumn("above", (by_limb(limb, "b", "hip")["y"] - by_limb(limb, "b", "ank")["y"]) / T)
    x = x.filter("margin > 0.12 and above > 0.05").groupBy("clip_id", "limb").agg(F.array_sort(F.collect_list(F.struct("b", "margin"))).alias("steps"))
    start = F.struct(F.lit(-999).alias("last"), F.array().cast("array<struct<b:int,margin:double>>").alias("kept"))
    fold = F.aggregate("steps", start, lambda s, v: F.when(v["b"] - s["last"] > 30, F.struct(v["b"].alias("last"), F.concat(s["kept"], F.array(v)).alias("kept"))).otherwise(s))
    return x.select("clip_id", "limb", F.inline(fold["kept"])).select(*event("high_step", F.col("b") / fps, sided(F.col("limb"), "脚"), 0.6 + F.col("margin") / 1.2))


def foot_swap(f: DataFrame, limbs: DataFrame, fps: float) -> DataFrame:
    """One foot leaves and the other, free until then, firmly lands on its spot soon after."""
    m = marked(limbs.filter("limb in ('lf', 'rf')"), TECHNIQUE)
    other = m.select("clip_id", F.when(F.col("limb") == "lf", "rf").otherwise("lf").alias("limb"), "i", F.col("landing").alias("land"))
    x = m.filter("broke").select("clip_id", "limb", "i").join(other, ["clip_id", "limb", "i"]).filter(F.col("land") - F.col("i") <= int(0.9 * fps)).withColumn("p", F.col("i") - 1)
    x = x.join(at(f, "p", "lank", "rank", "lf", "rf"), ["clip_id", "p"]).join(at(f, "land", "lank", "rank", "climbing", "T"), ["clip_id", "land"])
    free = ~F.when(F.col("limb") == "lf", F.col("p_rf")).otherwise(F.col("p_lf"))
    near = G.dist(by_limb(F.col("limb"), "p", "ank"), by_limb(F.col("limb"), "land", "ank", other=True)) < 0.35 * F.col("land_T")
    return x.filter(free & near & F.col("land_climbing")).select(*event("foot_swap", F.col("land") / fps, F.lit(""), F.lit(0.85)))


def cross_hands(f: DataFrame, eps: DataFrame, fps: float) -> DataFrame:
    """A hand lands across the other, against the clip's usual order."""
    x = eps.filter("limb in ('lh', 'rh')").join(at(f, "b", "climbing", "T", "lwr", "rwr", "hands_order"), ["clip_id", "b"]).filter("b_climbing")
    crossed = -F.signum("b_hands_order") * (F.col("b_lwr.x") - F.col("b_rwr.x")) > 0.1 * F.col("b_T")
    return x.filter(crossed).select(*event("cross_hands", F.col("b") / fps, sided(F.col("limb"), "手"), F.lit(0.8)))


def within(x: DataFrame, key: str, f: DataFrame, rows: int, *cols: str) -> DataFrame:
    """Each row with the frames from its ``key`` on, ``rows`` of them at most."""
    span = x.withColumn("j", F.explode(F.sequence(F.col(key), F.col(key) + rows - 1)))
    return span.join(at(f, "j", *cols), ["clip_id", "j"])


def rock_over(f: DataFrame, eps: DataFrame, fps: float) -> DataFrame:
    """After a foot lands the centre of mass comes over it and rises, a hand holding."""
    x = eps.filter("limb in ('lf', 'rf')").join(at(f, "b", "climbing", "com", "lank", "rank", "T"), ["clip_id", "b"]).filter("b_climbing")
    x = within(x, "b", f, int(1.2 * fps), "lh", "rh", "com")
    over = F.abs(F.col("j_com.x") - by_limb(F.col("limb"), "b", "ank")["x"]) < 0.3 * F.col("b_T")
    rise = (F.col("b_com.y") - F.col("j_com.y")) / F.col("b_T") >= 0.15
    first = x.filter((F.col("j_lh") | F.col("j_rh")) & over & rise).groupBy("clip_id", "limb", "a", "b").agg(F.min("j").alias("j"))
    return first.select(*event("rock_over", F.col("j") / fps, sided(F.col("limb"), "脚"), F.lit(0.8)))


def dyno(f: DataFrame, fps: float) -> DataFrame:
    """Both feet off, from a climbing frame on, while the centre of mass shoots up."""
    x = f.select("clip_id", "i", "climbing", "T", (~(F.col("lf") | F.col("rf"))).alias("off"), S.mean5(CLIP, F.col("com.y")).alias("y"))
    x = x.withColumn("vy", S.gradient(CLIP, F.col("y")) * fps / F.col("T")).filter("off").withColumn("run", F.col("i") - F.row_number().over(S.order(CLIP)))
    by = ["clip_id", "run"]
    begun = x.withColumn("a", F.min(F.when(F.col("climbing"), F.col("i"))).over(Window.partitionBy(*by))).filter("i >= a")
    jump = begun.groupBy(*by, "a").agg(F.count("*").alias("rows"), F.min("vy").alias("burst")).filter((F.col("rows") >= int(0.25 * fps)) & (F.col("burst") < -1.0))
    return jump.select(*event("dyno", F.col("a") / fps, F.lit(""), 0.5 - F.col("burst") / 2))


def mantle(f: DataFrame, fps: float) -> DataFrame:
    """Both hands low and elbows bent, then straight with the body risen; every bent frame is tried, and none is found again within a second and a half."""
    low = (F.col("lsho.y") + F.col("rsho.y")) / 2 + 0.15 * F.col("T")
    prep = F.col("climbing") & F.col("lh") & F.col("rh") & (F.col("lwr.y") > low) & (F.col("rwr.y") > low) & (F.col("lel_deg") < 115) & (F.col("rel_deg") < 115)
    straight = F.when((F.col("lel_deg") > 150) & (F.col("rel_deg") > 150), F.col("com.y"))
    x = f.select("clip_id", "i", "T", prep.alias("prep"), F.col("com.y").alias("y"), F.min(straight).over(S.span(CLIP, 0, int(1.8 * fps) - 1)).alias("top"))
    done = x.filter(F.col("prep") & ((F.col("y") - F.col("top")) / F.col("T") >= 0.25))
    listed = done.groupBy("clip_id").agg(F.array_sort(F.collect_list("i")).alias("steps"))
    start = F.array().cast("array<int>")
    last = lambda kept: F.round(F.get(kept, F.size(kept) - 1) / F.lit(fps), 2) * fps
    free = lambda kept, a: F.coalesce(F.abs(last(kept) - a) >= 1.5 * fps, F.lit(True))
    fold = F.aggregate("steps", start, lambda kept, a: F.when(free(kept, a), F.concat(kept, F.array(a))).otherwise(kept))
    return listed.select("clip_id", F.explode(fold).alias("a")).select(*event("mantle", F.col("a") / fps, F.lit(""), F.lit(0.75)))


def detect(frames: DataFrame, fps: float = 30.0) -> tuple[DataFrame, DataFrame]:
    """Phases and events of clips of one frame rate."""
    f = features(frames)
    limbs = to_limbs(f.withColumn("fps", F.lit(float(fps))))
    eps = episodes(limbs, TECHNIQUE, floor_frames=False)
    parts = [high_step(f, eps, fps), foot_swap(f, limbs, fps), cross_hands(f, eps, fps), rock_over(f, eps, fps), dyno(f, fps), mantle(f, fps)]
    events = parts[0]
    for more in parts[1:]:
        events = events.unionByName(more)
    return phases(f, fps), events


def from_time(frames: DataFrame, from_t: float, fps: float = 30.0) -> tuple[DataFrame, DataFrame]:
    """``detect`` on the frames from a time on; times count from the clip's start (by ``from_t``, not by the frame)."""
    low = round(from_t * fps)
    p, e = detect(frames.filter(F.col("i") >= low).withColumn("i", F.col("i") - low), fps)
    shift = lambda c: F.round(F.col(c) + from_t, 2)
    return p.withColumn("t0", shift("t0")).withColumn("t1", shift("t1")), e.withColumn("t", shift("t"))
