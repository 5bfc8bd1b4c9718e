"""Documents out of tables: JSON, SRT, script payloads and filled templates, one row per clip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _xy(p: Column) -> Column:
    return F.when(p["x"].isNotNull(), F.array(p["x"], p["y"]))


def pose_json(frames: DataFrame, clips: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    row = F.struct("i", "t", "track_id", "bbox", F.transform("kpts", lambda p: F.array(F.round(p["x"], 1), F.round(p["y"], 1), F.round(p["c"], 3))).alias("kpts"))
    d = frames.groupBy("clip_id").agg(F.array_sort(F.collect_list(row)).alias("frames")).join(clips, "clip_id")
    meta = [F.col("fps"), F.size("frames").alias("n_frames")]
    if areas is not None:
        listed = areas.groupBy("clip_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("track_id").cast("string"), F.round("area", 1)))).alias("track_area"))
        d = d.join(listed, "clip_id", "left")
        meta.append(F.col("track_area"))
    return d.select("clip_id", F.to_json(F.struct(F.struct(*meta).alias("meta"), "frames"), {"ignoreNullFields": "false"}).alias("body"))


def analysis_json(frames: DataFrame, stats: DataFrame, events: DataFrame) -> DataFrame:
    """``frames`` as pose.output gives them."""
    cols = [c for c in frames.columns if c not in ("clip_id", "kpts", "com")]
    row = F.struct("i", *[c for c in cols if c != "i"], F.transform("kpts", _xy).alias("kpts"), _xy(F.col("com")).alias("com"))
    listed = frames.groupBy("clip_id").agg(F.sort_array(F.collect_list(F.struct("i", F.to_json(row, {"ignoreNullFields": "false"}).alias("j")))).alias("rows"))
    body = listed.select("clip_id", F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["j"]), ","), F.lit("]")).alias("frames"))
    moves = events.groupBy("clip_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*[c for c in events.columns if c != "clip_id"])))).alias("events"))
    d = body.join(stats, "clip_id").join(moves, "clip_id", "left")
    stat = F.to_json(F.struct(*[c for c in stats.columns if c != "clip_id"]))
    return d.select("clip_id", F.concat(F.lit('{"meta":{"fps":'), F.col("fps").cast("string"), F.lit('},"stats":'), stat, F.lit(',"frames":'), "frames", F.lit(',"events":'), F.coalesce("events", F.lit("[]")), F.lit("}")).alias("body"))


def technique_json(phases: DataFrame, events: DataFrame) -> DataFrame:
    p = phases.groupBy("clip_id").agg(F.array_sort(F.collect_list(F.struct("t0", "t1", "name", "side", "conf"))).alias("phases"))
    e = events.groupBy("clip_id").agg(F.array_sort(F.collect_list(F.struct("t", "name", "side", "conf"))).alias("events"))
    none = lambda c, t: F.coalesce(c, F.array().cast(t))
    d = p.join(e, "clip_id", "full")
    return d.select("clip_id", F.to_json(F.struct(none("phases", "array<struct<t0:double,t1:double,name:string,side:string,conf:double>>").alias("phases"), none("events", "array<struct<t:double,name:string,side:string,conf:double>>").alias("events"))).alias("body"))


def captions_json(captions: DataFrame) -> DataFrame:
    row = F.struct("k", F.struct(F.round("start", 2).alias("start"), F.round("end", 2).alias("end"), "text", "terms").alias("c"))
    return captions.groupBy("clip_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["c"])).alias("body"))


def segments_json(segments: DataFrame) -> DataFrame:
    row = F.struct("seg", F.struct("start", "end", "text", "words").alias("c"))
    return segments.groupBy("clip_id").agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["c"]).alias("segments"))).alias("body"))


def script(payload: DataFrame, name: str = "DATA") -> DataFrame:
    """A JSON body as a script that assigns it."""
    return payload.select("clip_id", F.concat(F.lit(f"window.{name} = "), "body", F.lit(";")).alias("body"))


def template(values: DataFrame, html: str) -> DataFrame:
    """``html`` with each {{COLUMN}} replaced by the row's value."""
    body = F.lit(html)
    for c in values.columns:
        if c != "clip_id":
            body = F.replace(body, F.lit("{{" + c.upper() + "}}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return values.select("clip_id", body.alias("body"))


def write(bodies: DataFrame, path: str) -> None:
    """A folder for each clip with its document."""
    bodies.write.mode("overwrite").partitionBy("clip_id").text(path)


def splice(first: DataFrame, second: DataFrame, end: int, start: int, clip_id: str) -> DataFrame:
    """Frames of one clip up to ``end``, then of another from ``start``, renumbered as one clip."""
    a = first.filter(F.col("i") <= end)
    b = second.filter(F.col("i") >= start).withColumn("i", F.col("i") - start + end + 1)
    return a.unionByName(b).withColumn("clip_id", F.lit(clip_id))
