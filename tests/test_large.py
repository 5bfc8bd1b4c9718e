"""Queries at places and sizes that the small tables do not have."""

import random

import duckdb
import pytest

from cadenza.operators import pose
from cadenza.plans import registry, standin

from .test_queries import D, rows


def same_as_sql(spark, folder: str, table: str, name: str) -> list:
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet/*.parquet'")
    want = rows(con.execute(registry.ORACLES[name]).df())
    assert rows(registry.QUERIES[name](spark, folder).toPandas()) == want
    return want


def test_clock_rounds_the_exact_binary_value(spark, tmp_path):
    """0.15, 1.15 and 1.25 are shown as C shows them: below, below, to even."""
    values = [14.55, 4.85, 24.25, 33.95, 43.65, 111.55, 121.25, 130.95, 140.65, None]
    spark.createDataFrame([(k, k, f"2024-01-01 00:00:{k:02d}", "view", v) for k, v in enumerate(values)], "event_id long, user_id long, ts string, event_type string, value double").selectExpr("event_id", "user_id", "cast(ts as timestamp) as ts", "event_type", "value").write.parquet(str(tmp_path / "events.parquet"))
    same_as_sql(spark, str(tmp_path), "events", "q_frame_lookup")


@pytest.mark.parametrize("name", ["q_smooth_pose", "q_transfer_events"])
def test_no_frame_from_a_row_to_the_end(spark, name):
    """Spark works such a frame out anew for each row: the square of a clip's frames."""
    plan = registry.QUERIES[name](spark, D)._jdf.queryExecution().analyzed().toString()
    assert "currentrow$(), unboundedfollowing$()" not in plan and "windowspecdefinition" in plan


def test_frames_are_analysed_once(spark):
    """A query that looks at the frames several times reads them as written, and does not work them out again."""
    files = registry.QUERIES["q_transfer_events"](spark, D).inputFiles()
    assert files and not [f for f in files if "embeddings" in f]


def test_joints_are_not_unfolded(spark):
    """All joints of a frame share its row, and no clip is worked out twice for its scale."""
    plan = pose.analyse(standin.frames(spark, D), standin.clips(spark, D), contact=standin.CONTACT)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and plan.count("Relation") == 2


def test_frames_with_gaps_equal_their_joints(spark):
    """Short and long clips, joints seen always, sometimes, once and never, frames without any."""
    r = random.Random(3)
    seen = lambda j: j > 3 and (j > 9 or r.random() < 0.6)
    rows = [(f"c{n}", i, None if r.random() < 0.1 else [(r.random() * 9, r.random() * 9, 0.9 if seen(j) or (j == 2 and i == 1) else 0.1) for j in range(17)]) for n in (1, 2, 3, 4, 5, 6, 8, 9, 10, 40) for i in range(n)]
    df = spark.createDataFrame(rows, "clip_id string, i int, kpts array<struct<x:double,y:double,c:double>>")
    want = {(x.clip_id, x.i): x.kpts for x in pose.to_frames(pose.smooth(pose.clean(pose.to_joints(df)))).collect()}
    got = {(x.clip_id, x.i): x.kpts for x in pose.body(df).collect()}
    assert len(want) == len(rows) and got.keys() == want.keys()
    for key in want:
        assert [v for p in got[key] for v in p] == pytest.approx([v for p in want[key] for v in p], abs=1e-9)
