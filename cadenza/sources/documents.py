"""Reading the JSON documents of clips: one file, or one row of text, for each clip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POSE = "struct<meta:struct<video:string,fps:double,n_frames:int>,frames:array<struct<i:int,t:double,track_id:int,bbox:array<double>,kpts:array<array<double>>>>>"
ANALYSIS = (
    "struct<meta:struct<fps:double>,stats:struct<fps:double,n_frames:int,torso_px:double,duration_s:double,climbing_s:double,state_s:map<string,double>,transfers:int,max_barndoor:double,com_detected_pct:double>,"
    "frames:array<struct<i:int,t:double,kpts:array<array<double>>,angles:map<string,double>,com:array<double>,com_vel:double,contacts:struct<lh:boolean,rh:boolean,lf:boolean,rf:boolean>,n:int,state:string,st_t0:double,bd:double,margin:double,inside:boolean,climbing:boolean>>,"
    "events:array<struct<t0:double,t1:double,dur:double,moved:array<string>,dx:double,dy:double,disp:double,s0:string,s1:string>>>"
)
WORD = "struct<word:string,start:double,end:double>"
SEGMENTS = f"array<struct<start:double,end:double,text:string,words:array<{WORD}>>>"
TECH = "struct<phases:array<struct<name:string,t0:double,t1:double,side:string,conf:double>>,events:array<struct<name:string,t:double,side:string,conf:double>>>"
FPS = 30.0


def read(spark: SparkSession, path: str) -> DataFrame:
    """clip_id (the file's name without its extension) and body of each file."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("clip_id"), F.col("value").alias("body"))


def _point(p: Column, names: str) -> Column:
    return F.when(p.isNotNull(), F.struct(*[F.get(p, F.lit(k)).alias(n) for k, n in enumerate(names)]))


def pose(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clips (clip_id, fps, n_frames) and pose frames."""
    d = docs.select("clip_id", F.from_json("body", POSE).alias("d"))
    clips = d.select("clip_id", F.coalesce("d.meta.fps", F.lit(FPS)).alias("fps"), F.size("d.frames").alias("n_frames"))
    f = d.select("clip_id", F.coalesce("d.meta.fps", F.lit(FPS)).alias("fps"), F.explode("d.frames").alias("f"))
    return clips, f.select("clip_id", "f.i", (F.col("f.i") / F.col("fps")).alias("t"), "f.track_id", "f.bbox", F.transform("f.kpts", lambda p: _point(p, "xyc")).alias("kpts"))


def analysis(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Analysed frames, statistics and transfer events."""
    d = docs.select("clip_id", F.from_json("body", ANALYSIS).alias("d"))
    f = d.select("clip_id", F.explode("d.frames").alias("f")).select("clip_id", "f.*")
    f = f.withColumn("kpts", F.transform("kpts", lambda p: _point(p, "xy"))).withColumn("com", _point(F.col("com"), "xy"))
    return f, d.select("clip_id", "d.stats.*"), d.select("clip_id", F.posexplode("d.events").alias("seq", "e")).select("clip_id", "seq", "e.*")


def words(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Word stream, and segments without words; a document is {segments} or a bare list."""
    both = F.coalesce(F.from_json("body", f"struct<segments:{SEGMENTS}>")["segments"], F.from_json("body", SEGMENTS))
    seg = docs.select("clip_id", F.posexplode(both).alias("k", "s")).select("clip_id", "k", "s.*")
    flat = seg.select("clip_id", "k", F.posexplode("words").alias("j", "w"))
    from pyspark.sql import Window

    pos = (F.row_number().over(Window.partitionBy("clip_id").orderBy("k", "j")) - 1).cast("int")
    return flat.select("clip_id", pos.alias("pos"), "w.word", "w.start", "w.end"), seg.filter(F.coalesce(F.size("words"), F.lit(0)) <= 0).select("clip_id", "k", "start", "end", "text")


def technique(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    d = docs.select("clip_id", F.from_json("body", TECH).alias("d"))
    return d.select("clip_id", F.inline("d.phases")), d.select("clip_id", F.inline("d.events"))


def fixes(replies: DataFrame) -> DataFrame:
    """Proposals (clip_id, seq, i, text) in a model's reply (clip_id, body)."""
    from ..functions.text import first_json_array

    return replies.select("clip_id", F.posexplode(first_json_array(F.col("body"), "array<struct<i:int,text:string>>")).alias("seq", "p")).select("clip_id", "seq", "p.i", "p.text")


def raw_streams(docs: DataFrame, *names: str) -> dict[str, DataFrame]:
    """Word streams of a cached document {name: [words]}."""
    out = {}
    for n in names:
        d = docs.select("clip_id", F.posexplode(F.from_json(F.get_json_object("body", f"$.{n}"), f"array<{WORD}>")).alias("pos", "w"))
        out[n] = d.select("clip_id", "pos", "w.word", "w.start", "w.end")
    return out
