"""Series, pose clips and word streams made from the general tables, for queries."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ContactConfig
from ..operators import pose, series

FPS = 30.0
#: Embeddings do not move like bodies; these thresholds give contacts that come and go.
CONTACT = ContactConfig(on_t=3.0, off_t=4.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user in time order: user_id, i, x and the event's type."""
    df = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", F.col("value").alias("x"))
    return series.number(df, ["user_id"], "ts", "event_id").select("user_id", "i", "x", "event_type", "event_id")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pose frames from vectors: a clip for each label, 17 joints from 51 numbers."""
    df = table(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("clip_id"), "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    numbered = series.number(df, ["clip_id"], "vec_id")
    kpts = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.struct(
        (540 + 400 * F.get("e", 3 * j)).alias("x"), (800 + 400 * F.get("e", 3 * j + 1)).alias("y"), F.least(F.lit(1.0), 4 * F.abs(F.get("e", 3 * j + 2))).alias("c")))
    return numbered.select("clip_id", "i", "vec_id", (F.col("i") / FPS).alias("t"), kpts.alias("kpts"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("clip_id").distinct().withColumn("fps", F.lit(FPS))


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed frames."""
    return pose.analyse(frames(spark, sf_dir), clips(spark, sf_dir), contact=CONTACT)


_open: dict[str, SparkSession] = {}


@atexit.register
def release() -> None:
    """Delete the frames that queries so far have kept; runs by itself when the driver ends."""
    while _open:
        path, spark = _open.popitem()
        with contextlib.suppress(Exception):  # the session may be gone; what is left is in the folder that the cluster names
            if spark.sparkContext._jsc is not None:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def analysed_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed frames for queries that look at them several times: written once below ``spark.checkpoint.dir`` (where that is unset, worked out at each look)."""
    df, folder = analysed(spark, sf_dir), spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df
    path = f"{folder.rstrip('/')}/analysed-{uuid.uuid4().hex}"
    _open[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a document as one clip: three tenths of a second each, a pause after every eleventh."""
    def timed(word, pos):
        start = 0.3 * pos + F.floor(pos / 11)
        return F.struct(pos.alias("pos"), word.alias("word"), start.alias("start"), (start + 0.25).alias("end"))

    listed = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("clip_id"), F.transform(listed, timed).alias("words"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, a row for each word."""
    return spoken(spark, sf_dir).select("clip_id", F.inline("words"))


