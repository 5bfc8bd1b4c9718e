"""Synthetic clips through the whole engine, and detectors on edited bodies."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from cadenza.config import GateConfig
from cadenza.operators import episodes, gates, lookups, pose, techniques, timeline, tracking
from cadenza.plans import registry, standin
from cadenza.schemas import JOINTS, KP
from cadenza.sources import documents, sinks

# A standing body in torso lengths around the middle of the hips, y downward (fixed values).
BODY = {"nose": (0, -1.25), "leye": (-0.08, -1.32), "reye": (0.08, -1.32), "lear": (-0.16, -1.25), "rear": (0.16, -1.25), "lsho": (-0.45, -1.0), "rsho": (0.45, -1.0), "lel": (-0.6, -0.55), "rel": (0.6, -0.55), "lwr": (-0.55, -0.1), "rwr": (0.55, -0.1), "lhip": (-0.25, 0), "rhip": (0.25, 0), "lknee": (-0.3, 0.5), "rknee": (0.3, 0.5), "lank": (-0.32, 1.0), "rank": (0.32, 1.0)}
T, FPS = 120.0, 30.0


def body(cx=540.0, cy=800.0, c=0.9, **moved):
    pts = [[cx + BODY[n][0] * T, cy + BODY[n][1] * T, c] for n in JOINTS]
    for n, (x, y) in moved.items():
        pts[KP[n]][:2] = [x, y]
    return pts


def reach_clip():
    """Stand, hang still on the wall, then reach with the right hand and settle."""
    frames = [body(540, 1500)] * 30 + [body(540, 800)] * 30
    still = body(540, 800)
    for i in range(60, 150):
        u = min(1.0, (i - 60) / 15)
        pts = body(540 + 50 * u, 800 - 20 * u)
        for n in ("lwr", "lank", "rank"):
            pts[KP[n]] = still[KP[n]]
        pts[KP["rwr"]] = [pts[KP["rwr"]][0] + 200 * u, pts[KP["rwr"]][1] - 60 * u, 0.9]
        frames.append(pts)
    return frames


def pose_rows(spark, clips):
    rows = [(c, i, i / FPS, 1, [0.0, 0.0, 1.0, 1.0], p) for c, frames in clips.items() for i, p in enumerate(frames)]
    return spark.createDataFrame(rows, "clip_id string, i int, t double, track_id int, bbox array<double>, kpts array<array<double>>").withColumn("kpts", F.transform("kpts", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"), p[2].alias("c"))))


@pytest.fixture(scope="module")
def run(spark):
    frames = pose_rows(spark, {"reach": reach_clip(), "stand": [body(540, 1500)] * 60})
    clips = spark.createDataFrame([("reach", FPS), ("stand", FPS)], "clip_id string, fps double")
    a = pose.analyse(frames, clips).persist()
    e = episodes.transfers(episodes.merge_overlaps(episodes.episodes(episodes.to_limbs(a))), a).persist()
    return frames, a, e


def test_reach_is_found(run):
    frames, a, e = run
    assert gates.pose_gate(frames, GateConfig(w=1080, h=1920)).count() == 0
    stats = pose.clip_stats(a, e)
    assert gates.analysis_gate(pose.output(a), stats, e, GateConfig(w=1080, h=1920)).collect() == []
    rows = e.collect()
    assert {r.clip_id for r in rows} == {"reach"} and any("右手" in r.moved and r.disp > 0.2 and 1.0 <= r.t0 <= 3.67 for r in rows)
    s = {r.clip_id: r for r in stats.collect()}
    assert s["reach"].state_s["3pt"] > 0 and s["stand"].climbing_s == 0 and s["stand"].state_s["idle"] == 2.0
    assert s["reach"].com_detected_pct == 100.0


def test_documents_go_round(spark, run):
    frames, a, e = run
    out, stats = pose.output(a), pose.clip_stats(a, e)
    body_ = sinks.analysis_json(out, stats, e)
    f, s, ev = documents.analysis(body_)
    assert f.count() == out.count() and ev.count() == e.count()
    assert {(r.clip_id, r.i, r.state, r.n) for r in f.collect()} == {(r.clip_id, r.i, r.state, r.n) for r in out.collect()}
    clips = spark.createDataFrame([("reach", FPS), ("stand", FPS)], "clip_id string, fps double")
    c, p = documents.pose(sinks.pose_json(frames, clips))
    assert {r.clip_id: r.n_frames for r in c.collect()} == {"reach": 150, "stand": 60} and p.count() == 210


def test_gates_report_faults(spark, run):
    bad = [body() for _ in range(8)]
    bad[2][5][2] = 1.5
    bad[3] = bad[3][:16]
    bad[4][0][0] = -400.0
    frames = pose_rows(spark, {"x": bad}).filter("i <> 6")
    got = {(r.i, r.rule) for r in gates.pose_gate(frames, GateConfig(w=1080, h=1920)).collect()}
    assert got == {(2, "confidence"), (3, "joints"), (4, "x"), (7, "index")}
    none = frames.withColumn("kpts", F.when(F.col("i") > 5, F.col("kpts")))
    assert (None, "rate") in {(r.i, r.rule) for r in gates.pose_gate(none).collect()}
    with pytest.raises(gates.GateError):
        gates.require(gates.pose_gate(frames, GateConfig(w=1080, h=1920)))
    _, a, e = run
    broken = pose.output(a).withColumn("state", F.when(F.col("i") == 0, "5pt").otherwise(F.col("state"))).withColumn("margin", F.when(F.col("i") == 1, -1.0).otherwise(F.col("margin")))
    rules = {r.rule for r in gates.analysis_gate(broken, pose.clip_stats(a, e).withColumn("torso_px", F.lit(0.0)), e.withColumn("t1", F.col("t0"))).collect()}
    assert {"state_domain", "state", "margin", "torso", "event_order"} <= rules


def still(n=40, on=("lh", "rh", "lf", "rf"), elbow=90.0, knee=170.0, edit=None, off=None):
    """Frames for detectors: contacts and angles given, joints edited per frame."""
    rows = []
    for i in range(n):
        pts = body(**(edit(i) if edit else {}))
        hold = {k: k in on and not (off and off(i, k)) for k in ("lh", "rh", "lf", "rf")}
        rows.append((i, [[float(v) for v in p[:2]] for p in pts], hold, elbow(i) if callable(elbow) else elbow, knee))
    return rows


def analysed(spark, rows, com=None):
    data = [("c", i, FPS, T, True, *h.values(), k, {"lel": float(el), "rel": float(el), "lknee": float(kn), "rknee": float(kn)}, *map(float, com(i) if com else (540.0, 700.0))) for i, k, h, el, kn in rows]
    df = spark.createDataFrame(data, "clip_id string, i int, fps double, torso double, climbing boolean, lh boolean, rh boolean, lf boolean, rf boolean, kpts array<array<double>>, angles map<string,double>, cx double, cy double")
    return df.withColumn("kpts", F.transform("kpts", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))).withColumn("com", F.struct(F.col("cx").alias("x"), F.col("cy").alias("y"))).drop("cx", "cy")


def names(spark, rows, com=None):
    p, e = techniques.detect(analysed(spark, rows, com), FPS)
    return {(r["name"], r.side) for r in p.collect()}, {(r["name"], r.side) for r in e.collect()}


PHASES = {
    ("side_on", ""): dict(edit=lambda i: {"lsho": (400, 680), "rsho": (420, 680)}),
    ("heel_hook", "右"): dict(edit=lambda i: {"rank": (580, 860 - 60)}),
    ("cross_feet", ""): dict(n=60, edit=lambda i: {"lank": (580, 920), "rank": (500, 920)} if 30 <= i < 48 else {}),
    ("match_hands", ""): dict(edit=lambda i: {"lwr": (536, 700), "rwr": (544, 700)}),
    ("straight_arm", ""): dict(elbow=170.0),
    ("flagging", "右"): dict(on=("lh", "rh", "lf"), edit=lambda i: {"rank": (540 + 1.4 * T, 920)}),
    ("drop_knee", "右"): dict(knee=120.0, edit=lambda i: {"rknee": (546, 860)}),
    ("lock_off", "左手"): dict(on=("lh", "lf", "rf"), elbow=75.0),
    ("knee_bar", "左"): dict(on=("lh", "rh", "rf"), edit=lambda i: {"lank": (576, 860)}),
}


@pytest.mark.parametrize("want", PHASES)
def test_phase(spark, want):
    assert want in names(spark, still(**PHASES[want]))[0]


def test_no_phase_on_a_plain_body_or_on_the_ground(spark):
    assert names(spark, still()) == (set(), set())
    ground = analysed(spark, still(elbow=170.0)).withColumn("climbing", F.lit(False))
    assert all(x.count() == 0 for x in techniques.detect(ground, FPS))
    apart = still(edit=lambda i: {"lwr": (521, 700), "rwr": (559, 700)})
    assert ("match_hands", "") not in names(spark, apart)[0]


def test_events(spark):
    high = still(n=60, edit=lambda i: {"lank": (500, 800 - 0.9 * T)} if i >= 30 else {}, off=lambda i, k: k == "lf" and 30 <= i <= 41)
    assert ("high_step", "左脚") in names(spark, high)[1]
    swap = still(n=60, edit=lambda i: {"lank": (500, 920), "rank": (505, 920)}, off=lambda i, k: (k == "lf" and i >= 30) or (k == "rf" and i < 40))
    assert ("foot_swap", "") in names(spark, swap)[1]
    cross = still(n=60, edit=lambda i: {"lwr": (640, 700), "rwr": (600, 700)} if 35 <= i < 45 else {}, off=lambda i, k: k == "lh" and 25 <= i < 36)
    assert ("cross_hands", "左手") in names(spark, cross)[1]
    rock = still(n=60, off=lambda i, k: k == "lf" and 15 <= i < 30)
    assert ("rock_over", "左脚") in names(spark, rock, com=lambda i: (505.0, 700.0 - (36 if i > 40 else 0)))[1]
    jump = still(n=60, off=lambda i, k: k in ("lf", "rf") and 15 <= i <= 32)
    assert ("dyno", "") in names(spark, jump, com=lambda i: (540.0, 700.0 - 18 * min(max(i - 15, 0), 17)))[1]
    press = still(n=60, elbow=lambda i: 100.0 if i < 25 else 160.0, edit=lambda i: {"lwr": (480, 720), "rwr": (600, 720)})
    got = techniques.detect(analysed(spark, press, com=lambda i: (540.0, 700.0 - (0.5 * T if i >= 25 else 0))), FPS)[1].filter("name = 'mantle'")
    assert got.count() == 1


def mantles(rows, com):
    """Starts of mantles, each bent frame tried in turn."""
    found = []
    for i, pts, hold, elbow, _ in rows:
        low = (pts[KP["lsho"]][1] + pts[KP["rsho"]][1]) / 2 + 0.15 * T
        if not (hold["lh"] and hold["rh"] and min(pts[KP["lwr"]][1], pts[KP["rwr"]][1]) > low and elbow < 115):
            continue
        if any(abs(round(e / FPS, 2) * FPS - i) < 1.5 * FPS for e in found):
            continue
        if any(rows[j][3] > 150 and (com(i)[1] - com(j)[1]) / T >= 0.25 for j in range(i, min(len(rows), i + int(1.8 * FPS)))):
            found.append(i)
    return found


def test_every_bent_frame_starts_a_mantle(spark):
    want, clips = [], []
    for k in range(4):
        r = random.Random(k)
        ys, bent, hands = [700.0 + r.choice([0, 0, 20, 40]) for _ in range(500)], [r.choice([100.0, 130.0, 130.0, 130.0, 160.0]) for _ in range(500)], [r.random() < 0.8 for _ in range(500)]
        rows = still(n=500, elbow=lambda i: bent[i], edit=lambda i: {"lwr": (480, 720), "rwr": (600, 720)}, off=lambda i, limb: limb == "rh" and not hands[i])  # noqa: B023
        com = lambda i: (540.0, ys[i])  # noqa: B023, E731
        clips.append(analysed(spark, rows, com).withColumn("clip_id", F.lit(f"c{k}")))
        want += [(f"c{k}", round(i / FPS, 2)) for i in mantles(rows, com)]
    f = techniques.features(clips[0].unionByName(clips[1]).unionByName(clips[2]).unionByName(clips[3]))
    assert len(want) > 20 and sorted((r.clip_id, r.t) for r in techniques.mantle(f, FPS).collect()) == want


@pytest.fixture
def dip(spark, monkeypatch):
    """The frames of queries: a press that only each third bent frame, from the second on, is low enough for."""
    press = still(n=60, elbow=lambda i: 100.0 if i < 25 else 160.0, edit=lambda i: {"lwr": (480, 720), "rwr": (600, 720)})
    a = analysed(spark, press, com=lambda i: (540.0, 680.0 if i >= 25 else 720.0 if i % 3 == 1 else 700.0))
    a = a.withColumn("state", F.lit("4pt")).withColumn("bd", F.lit(0.0))
    monkeypatch.setattr(standin, "analysed_once", lambda *_: a)


def test_summary_card_of_a_dip(spark, dip):
    (card,) = registry.QUERIES["q_summary_card"](spark, "").collect()
    assert (card.n_tech, card.n_kinds) == (2, 2)


def test_technique_counts_of_a_dip(spark, dip):
    assert {(r["name"], r.n) for r in registry.QUERIES["q_technique_counts"](spark, "").collect()} == {("straight_arm", 1), ("mantle", 1)}


def test_technique_json_of_a_dip(spark, dip):
    (script,) = registry.QUERIES["q_technique_json"](spark, "").collect()
    assert json.loads(script.body.removeprefix("window.TECH = ").removesuffix(";"))["events"] == [{"t": 0.03, "name": "mantle", "side": "", "conf": 0.75}]


def test_target_selection(spark):
    def person(y, hip_x, hip_y, c=0.9):
        pts = [[0.0, 0.0, 0.9]] * 17
        pts[11], pts[12] = [hip_x - 5.0, float(hip_y), c], [hip_x + 5.0, float(hip_y), c]
        return [0.0, float(y), 10.0, y + 20.0], pts

    frames = [
        [person(500, 100, 500), person(100, 100, 100)],  # the topmost
        [person(90, 900, 90), person(120, 110, 120)],  # nearer the last
        [person(50, 900, 50, c=0.1), person(130, 120, 130)],  # unsure hips are passed over
        [person(700, 900, 700), person(650, 900, 650)],  # none within reach: the topmost
    ]
    rows = [("c", i, d, d, b, k) for i, f in enumerate(frames) for d, (b, k) in enumerate(f)]
    df = spark.createDataFrame(rows, "clip_id string, i int, det int, track_id int, bbox array<double>, kpts array<array<double>>").withColumn("kpts", F.transform("kpts", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"), p[2].alias("c"))))
    assert [r.det for r in tracking.select_target(df).orderBy("i").collect()] == [1, 1, 1, 1]
    assert {r.track_id: r.area for r in tracking.track_areas(df).collect()} == {0: 800.0, 1: 800.0}
    clips = spark.createDataFrame([("c", 25.0, 6)], "clip_id string, fps double, n_frames int")
    assert [(r.t, r.kpts is None) for r in tracking.pose_frames(clips, df).orderBy("i").collect()][3:] == [(0.12, False), (0.16, True), (0.2, True)]


def events(spark, rows):
    return spark.createDataFrame([("c", i, float(a), float(b), round(float(b - a), 2), d) for i, (a, b, d) in enumerate(rows)], "clip_id string, seq int, t0 double, t1 double, dur double, disp double")


@pytest.fixture(scope="module")
def bounds(spark):
    return spark.createDataFrame([("c", 0.0, 30.0)], "clip_id string, off double, seg_dur double")


def test_schedule(spark, bounds):
    chain = timeline.schedule(events(spark, [(10, 13, 0.22), (12.5, 13.6, 0.28), (15, 16.4, 0.24)]), bounds).orderBy("t0").collect()
    assert [r.cap_dur for r in chain] == [0.85, 0.85, 1.4]
    assert [r.t0 for r in timeline.schedule(events(spark, [(10, 14, 0.5), (11.4, 15, 0.9)]), bounds).collect()] == [11.4]
    assert [r.t0 for r in timeline.schedule(events(spark, [(1, 2, 0.5), (3, 4, 0.5), (10, 12, 0.5), (29.9, 30, 0.5)]), bounds).collect()] == [10.0]
    # close to the one before by less than the gap: the larger takes its place
    near = timeline.schedule(events(spark, [(10, 11, 0.5), (12.2, 13, 0.3), (12.1, 13, 0.1), (12.14, 13, 0.9)]), bounds)
    assert [r.t0 for r in near.collect()] == [12.14]


def test_segment_and_timing(spark):
    df = spark.createDataFrame([("c", i, 10 <= i < 70) for i in range(150)] + [("n", i, False) for i in range(400)], "clip_id string, i int, climbing boolean")
    got = {r.clip_id: (r.a, r.b) for r in timeline.pick_segment(df, FPS).collect()}
    assert got == {"c": (0, 114), "n": (0, 299)}
    assert {r.clip_id: r.b for r in timeline.pick_segment(df, FPS, max_s=3.0).collect()} == {"c": 89, "n": 89}
    t = {r.clip_id: r for r in timeline.timing(df, FPS).collect()}
    assert t["c"].pose_t0 == 0.33 and t["n"].pose_t0 == 4.3 and math.isclose(t["n"].sum_t0, 400 / 30 - 4.8)


def slots(spark, heads):
    """Frames with one joint at a height."""
    rows = [("c", i, [None if y is None else [540.0, y]] + [None] * 16) for i, y in enumerate(heads)]
    df = spark.createDataFrame(rows, "clip_id string, i int, kpts array<array<double>>").withColumn("kpts", F.transform("kpts", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return [(r.t0, r.t1) for r in timeline.slot_windows(df, FPS).orderBy("t0").collect()]


def test_slots(spark):
    got = slots(spark, [900.0] * 150 + [300.0] * 150)
    assert len(got) == 1 and 4.0 <= got[0][0] <= 5.5 and got[0][1] == 10.0
    assert slots(spark, [300.0 if i // 10 % 2 else 900.0 for i in range(300)]) == []
    assert slots(spark, [None] * 100) == []


def test_lookups(spark):
    times = spark.createDataFrame([("c", float(t)) for t in (0, 1, 2, 5, 9)], "clip_id string, t double")
    marks = spark.createDataFrame([("c", 1.0, "a"), ("c", 4.0, "b")], "clip_id string, t double, name string")
    phases = spark.createDataFrame([("c", "p", "", 1.5, 2.2), ("c", "q", "", 1.9, 3.0)], "clip_id string, name string, side string, t0 double, t1 double")
    assert {r.t: r["name"] for r in lookups.last_before(times, marks, 2.0).collect()} == {0: None, 1: "a", 2: "a", 5: "b", 9: None}
    assert {r.t: (r.shown, r.kind) for r in lookups.technique_panel(times, phases, marks).collect()} == {0: (None, "default"), 1: ("a", "event"), 2: ("q", "phase"), 5: ("b", "event"), 9: ("b", "event")}


def test_splice(spark, run):
    frames = run[0]
    one = frames.filter("clip_id = 'reach'")
    out = sinks.splice(one, one, 9, 100, "both")
    assert [r.i for r in out.orderBy("i").collect()] == list(range(60))


def test_templates_and_scripts(spark):
    df = spark.createDataFrame([("c", 1.5, "x")], "clip_id string, dur double, name string")
    assert sinks.template(df, "<b>{{DUR}} {{NAME}}</b>").first().body == "<b>1.5 x</b>"
    assert sinks.script(df.selectExpr("clip_id", "'{}' as body")).first().body == "window.DATA = {};"
