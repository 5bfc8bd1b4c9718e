"""Scheduling on a clip's timeline: segments, captions, zones, slots and cut points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ScheduleConfig
from ..functions import geometry as G
from . import series as S

CLIP = ["clip_id"]


def pick_segment(frames: DataFrame, fps: float, max_s: float = 0.0) -> DataFrame:
    """First and last frame of what is shown: all up to a second and a half past the longest climb, at most max_s."""
    n = frames.groupBy("clip_id").agg(F.count("*").alias("n"))
    best = S.longest_run(frames.select("clip_id", "i", "climbing"), CLIP, "climbing", int(2.5 * fps))
    x = n.join(best.select("clip_id", "b"), "clip_id", "left")
    end = F.least(F.col("n") - 1, F.coalesce(F.col("b") + int(1.5 * fps), F.lit(int((max_s or 10.0) * fps) - 1)))
    if max_s:
        end = F.when(F.col("b").isNotNull() & ((end + 1) / fps > max_s), F.lit(int(max_s * fps) - 1)).otherwise(end)
    return x.select("clip_id", F.lit(0).alias("a"), end.cast("int").alias("b"))


def segment(frames: DataFrame, bounds: DataFrame) -> DataFrame:
    return frames.join(bounds, "clip_id").filter(F.col("i").between(F.col("a"), F.col("b"))).drop("a", "b")


def rebase_spans(spans: DataFrame, bounds: DataFrame) -> DataFrame:
    """Spans that meet the segment (off, dur), in its time."""
    x = spans.join(bounds, "clip_id").filter((F.col("t1") > F.col("off")) & (F.col("t0") < F.col("off") + F.col("dur")))
    return x.withColumn("t0", F.round(F.col("t0") - F.col("off"), 2)).withColumn("t1", F.round(F.col("t1") - F.col("off"), 2)).drop("off", "dur")


def rebase_instants(marks: DataFrame, bounds: DataFrame) -> DataFrame:
    """Instants within the segment, its ends included, in its time."""
    x = marks.join(bounds, "clip_id").filter(F.col("t").between(F.col("off"), F.col("off") + F.col("dur")))
    return x.withColumn("t", F.round(F.col("t") - F.col("off"), 2)).drop("off", "dur")


def schedule(events: DataFrame, bounds: DataFrame, conf: ScheduleConfig = ScheduleConfig()) -> DataFrame:
    """Captions for events (clip_id, seq, t0, t1, dur, disp): those that fit, with the time each may take.

    ``bounds``: off and seg_dur by clip.  In order of start, an event too close to the one
    kept before takes its place only if it moves more, and only if it then fits.
    """
    x = events.join(bounds, "clip_id").withColumn("s", F.col("t0") - F.col("off")).withColumn("e", F.col("t1") - F.col("off"))
    x = x.filter((F.col("e") >= conf.title_end) & (F.col("s") >= 0.5) & (F.col("s") <= F.col("seg_dur") - 1.0))
    rank = F.row_number().over(Window.partitionBy("clip_id").orderBy(F.desc("disp"), "seq"))
    x = x.withColumn("rank", rank).filter(F.col("rank") <= conf.cap)
    near = conf.hand_off + conf.min_cap_dur
    order = F.array_sort(F.collect_list(F.struct("s", "seq", "disp", "dur", "e")))
    start = F.array().cast("array<struct<s:double,seq:int,disp:double,dur:double,e:double>>")

    def step(kept: Column, v: Column) -> Column:
        last = F.element_at(kept, -1)
        rest = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        fits = lambda k: (F.size(k) == 0) | (v["s"] - F.coalesce(F.get(k, F.size(k) - 1)["s"], F.lit(-1e9)) >= near)
        one = F.array(v)
        return F.when(fits(kept), F.concat(kept, one)).when(v["disp"] > F.get(kept, F.size(kept) - 1)["disp"], F.when(fits(rest), F.concat(rest, one)).otherwise(rest)).otherwise(kept)

    typed = F.transform(order, lambda v: F.struct(v["s"].cast("double").alias("s"), v["seq"].cast("int").alias("seq"), v["disp"].cast("double").alias("disp"), v["dur"].cast("double").alias("dur"), v["e"].cast("double").alias("e")))
    kept = x.groupBy("clip_id").agg(typed.alias("v")).select("clip_id", F.inline(F.aggregate("v", start, step)))
    after = F.lead("s").over(Window.partitionBy("clip_id").orderBy("s", "seq"))
    cap = F.least(F.least(F.col("dur"), F.lit(conf.longest)), after - F.col("s") - conf.hand_off)
    return kept.select("clip_id", "seq", F.col("s").alias("t0"), F.col("e").alias("t1"), "dur", "disp", F.round(F.greatest(cap, F.lit(conf.min_cap_dur)), 2).alias("cap_dur"))


def zones(scheduled: DataFrame) -> DataFrame:
    """Time each caption takes, handed over before the next."""
    after = F.lead("t0").over(Window.partitionBy("clip_id").orderBy("t0", "seq"))
    c0 = F.col("t0") - 0.35
    c1 = F.least(F.col("t0") + F.col("cap_dur") + 1.3, after - 0.36)
    return scheduled.select("clip_id", "seq", F.round(c0, 2).alias("c0"), F.round(F.greatest(c1, c0 + 0.5), 2).alias("c1"))


def sequence(captions: DataFrame, bounds: DataFrame, trim: bool = True) -> DataFrame:
    """Speech captions one after another; ``bounds``: off, dur and ov_end by clip.  ``trim``: none over the closing card."""
    x = captions.join(bounds, "clip_id").groupBy("clip_id").agg(F.first("off").alias("off"), F.first("dur").alias("dur"), F.first("ov_end").alias("ov_end"), F.array_sort(F.collect_list(F.struct("k", "start", "end"))).alias("caps"))
    start = F.struct(F.lit(0.0).alias("prev"), F.array().cast("array<struct<k:int,cs:double,ce:double,win:double>>").alias("out"))
    off, dur, ov = F.col("off"), F.col("dur"), F.col("ov_end")

    def step(s: Column, c: Column) -> Column:
        cs = F.greatest(c["start"] - off - 0.15, s["prev"] + 0.05)
        ce = F.greatest(c["end"] - off, cs + 0.4)
        cut = F.least(ce, ov - 0.3) if trim else ce
        gone = ((ce > ov - 0.3) & (cut - cs < 0.4)) | (cs > dur - 0.2) if trim else cs > dur - 0.2
        win = cut - cs + 0.45
        row = F.struct(c["k"].cast("int").alias("k"), cs.alias("cs"), cut.alias("ce"), win.alias("win"))
        return F.when(gone, s).otherwise(F.struct((cs + win + 0.05).alias("prev"), F.concat(s["out"], F.array(row)).alias("out")))

    rows = x.select("clip_id", F.inline(F.aggregate("caps", start, step)["out"]))
    return rows.select("clip_id", "k", *[F.round(c, 2).alias(c) for c in ("cs", "ce", "win")])


def timing(frames: DataFrame, fps: float) -> DataFrame:
    """When layers begin and end, from the first climbing frame and the duration."""
    x = frames.groupBy("clip_id").agg(F.min(F.when(F.col("climbing"), F.col("i") / fps)).alias("first"), (F.count("*") / fps).alias("dur"))
    pose_t0 = F.coalesce("first", F.lit(4.3))
    pre = F.greatest(F.lit(0.0), pose_t0 - 0.8)
    sum_t0 = F.greatest(F.lit(4.4), F.col("dur") - 4.8)
    hud = F.greatest(F.lit(4.3), pre)
    return x.select("clip_id", "dur", F.round(pose_t0, 2).alias("pose_t0"), pre.alias("pose_pre"), hud.alias("hud_start"), sum_t0.alias("sum_t0"), F.round(sum_t0 - 0.15, 2).alias("ov_end"), (sum_t0 - 0.15 - hud).alias("hud_dur"), F.greatest(F.lit(0.1), sum_t0 + 0.05 - pre).alias("pose_dur"))


def hide_windows(frames: DataFrame, fps: float, panel_top: float, panel_x1: float | None = None) -> DataFrame:
    """Windows in which a joint is over the lower panel (frames without joints count as free)."""
    low = lambda p: (p["y"] > panel_top) & (F.lit(True) if panel_x1 is None else p["x"] <= panel_x1)
    occ = F.coalesce(F.exists("kpts", lambda p: F.coalesce(low(p), F.lit(False))), F.lit(False))
    x = frames.select("clip_id", "i", occ.alias("occ"), (F.count("*").over(Window.partitionBy("clip_id")) / fps).alias("dur"))
    return S.occlusion_windows(x, CLIP, "occ", F.lit(fps), F.col("dur"), 0.4, 0.6, 0.3, fps)


def slot_windows(frames: DataFrame, fps: float, scale: float = 1.0, vw: float = 1080.0, top: float = 200.0, low: float = 1280.0, band: float = 160.0, half: float = 500.0, on_s: float = 1.0, dwell_s: float = 6.0, pad: float = 0.2) -> DataFrame:
    """Windows in which captions sit in the low slot, away from the body.

    The slot that is looked at depends on the last switch, so each clip's two hit series
    (null without joints) are folded in order.
    """
    rect = lambda base: tuple(F.lit(float(v)) for v in (vw / 2 - half * scale, base * scale, vw / 2 + half * scale, (base + band) * scale))
    hits = frames.select("clip_id", "i", G.body_in_rect(F.col("kpts"), rect(top)).alias("hi"), G.body_in_rect(F.col("kpts"), rect(low)).alias("lo"))
    clips = hits.groupBy("clip_id").agg(F.array_sort(F.collect_list(F.struct("i", "hi", "lo"))).alias("v"), (F.count("*") / fps).alias("dur"))
    need, dwell = max(1, int(on_s * fps)), int(dwell_s * fps)
    start = F.struct(F.lit(False).alias("low"), F.lit(0).alias("cnt"), F.lit(dwell).alias("since"), F.lit(0.0).alias("t0"), F.array().cast("array<struct<t0:double,t1:double>>").alias("out"))

    def step(s: Column, f: Column) -> Column:
        here, there = F.when(s["low"], f["lo"]).otherwise(f["hi"]), F.when(s["low"], f["hi"]).otherwise(f["lo"])
        since, cnt = s["since"] + 1, s["cnt"] + 1
        t = (f["i"] - need) / F.lit(fps)
        state = lambda lo, c, n, t0, out: F.struct(lo.alias("low"), c.alias("cnt"), n.alias("since"), t0.alias("t0"), out.alias("out"))
        moves = here & (cnt >= need) & (since >= dwell) & ~F.coalesce(there, F.lit(False))
        closed = F.concat(s["out"], F.array(F.struct(F.round(s["t0"], 2).alias("t0"), F.round(t + pad, 2).alias("t1"))))
        moved = state(~s["low"], F.lit(0), F.lit(0), F.when(s["low"], s["t0"]).otherwise(F.greatest(F.lit(0.0), t - pad)), F.when(s["low"], closed).otherwise(s["out"]))
        return F.when(here.isNull(), state(s["low"], s["cnt"], since, s["t0"], s["out"])).when(moves, moved).otherwise(state(s["low"], F.when(here, cnt).otherwise(F.lit(0)), since, s["t0"], s["out"]))

    done = clips.select("clip_id", "dur", F.aggregate("v", start, step).alias("s"))
    last = F.array(F.struct(F.round("s.t0", 2).alias("t0"), F.round("dur", 2).alias("t1")))
    return done.select("clip_id", F.inline(F.when(F.col("s.low"), F.concat("s.out", last)).otherwise(F.col("s.out")))).filter("t1 > t0")


def boundaries(scheduled: DataFrame, captions: DataFrame, timings: DataFrame) -> DataFrame:
    """Starts of all clips on a timeline, each once."""
    starts = scheduled.select("clip_id", F.round(F.greatest(F.lit(0.0), F.col("t0") - 0.35), 2).alias("s"))
    return starts.unionByName(captions.select("clip_id", F.col("cs").alias("s"))).unionByName(timings.select("clip_id", F.round("sum_t0", 2).alias("s"))).distinct()


def kills(scheduled: DataFrame, bounds: DataFrame) -> DataFrame:
    """When each event caption must be off: after its fade (just before a boundary it would meet), and at every boundary it crosses.

    Boundaries are found by second: an equi-join on whole seconds, then the exact test.
    """
    exits = scheduled.select("clip_id", "seq", "t0", (F.col("t0") + F.col("cap_dur") + 1.15).alias("kill"))
    at = bounds.select("clip_id", "s", F.floor("s").alias("sec"))
    near = exits.withColumn("sec", F.explode(F.array_distinct(F.array(F.floor(F.col("kill") - 0.05), F.floor(F.col("kill") + 0.05))))).join(at, ["clip_id", "sec"]).filter(F.abs(F.col("kill") - F.col("s")) < 0.05)
    snapped = exits.join(near.select("clip_id", "seq", F.lit(True).alias("snap")).distinct(), ["clip_id", "seq"], "left")
    own = snapped.select("clip_id", "seq", F.round(F.when(F.col("snap"), F.col("kill") - 0.06).otherwise(F.col("kill")), 2).alias("t"), F.lit("own").alias("kind"))
    spread = exits.withColumn("sec", F.explode(F.sequence(F.floor(F.col("t0") + 0.4), F.floor("kill")))).join(at, ["clip_id", "sec"]).filter((F.col("s") > F.col("t0") + 0.4) & (F.col("s") < F.col("kill")))
    return own.unionByName(spread.select("clip_id", "seq", F.round("s", 2).alias("t"), F.lit("boundary").alias("kind")))


def labels(events: DataFrame) -> DataFrame:
    """Texts of an event's caption: what kind of move, which limbs, where to."""
    none = F.lit(None).cast("string")
    x = F.when(F.col("dx") < -0.15, "左移").when(F.col("dx") > 0.15, "右移").otherwise(none)
    y = F.when(F.col("dy") < -0.15, "上升").when(F.col("dy") > 0.15, "下降").otherwise(none)
    moved = F.concat(F.array_join(F.slice("moved", 1, 2), "、"), F.when(F.size("moved") > 2, "等").otherwise(""))
    return events.withColumn("label", F.when((F.col("s0") == "3pt") & (F.col("s1") == "3pt"), "三点平衡转移").otherwise("重心转移")).withColumn("limbs", F.when(F.coalesce(F.size("moved"), F.lit(0)) > 0, moved).otherwise("肢体")).withColumn("way", F.coalesce(F.nullif(F.concat_ws("·", x, y), F.lit("")), F.lit("重心调整")))


def summary(stats: DataFrame, phases: DataFrame, events: DataFrame) -> DataFrame:
    """Numbers of the closing card."""
    n = phases.select("clip_id", "name").unionByName(events.select("clip_id", "name")).groupBy("clip_id").agg(F.count("*").alias("n_tech"), F.count_distinct("name").alias("n_kinds"))
    return stats.join(n, "clip_id", "left").select("clip_id", F.round(F.element_at("state_s", "3pt"), 0).alias("three_point_s"), "transfers", F.coalesce("n_tech", F.lit(0)).alias("n_tech"), F.coalesce("n_kinds", F.lit(0)).alias("n_kinds"), F.round("max_barndoor", 0).alias("max_barndoor"))


def window_summary(frames: DataFrame, events: DataFrame, t0: float, t1: float, fps: float) -> DataFrame:
    """Seconds on three points, largest barn-door arm and transfers that begin within a window of a clip."""
    part = frames.filter((F.col("i") >= t0 * fps) & (F.col("i") <= t1 * fps))
    body = part.groupBy("clip_id").agg(F.round(F.count_if(F.col("state") == "3pt") / fps, 4).alias("three_point_s"), F.round(F.max("bd"), 4).alias("max_bd"))
    n = events.filter(F.col("t0").between(t0, t1)).groupBy("clip_id").agg(F.count("*").alias("n"))
    return body.join(n, "clip_id", "left").select("clip_id", "three_point_s", "max_bd", F.coalesce("n", F.lit(0)).alias("n_events"))


def hud_scale(w: Column, h: Column) -> Column:
    return F.least(w / 1080, h / 1920)
