"""Dictionaries of a project: Markdown sections of corrections, terms and a prompt; or flat lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dictionary:
    """A dictionary is small by its nature; its parts are plain values of a plan."""

    fixes: dict[str, str] = field(default_factory=dict)
    highlight: list[str] = field(default_factory=list)
    prompt: str = ""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """place, line and the section it stands in."""
    d = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "raw"))
    d = d.select("place", F.trim("raw").alias("line"))
    head = F.when(F.col("line").startswith("##"), F.trim(F.regexp_replace("line", "^[# ]+", "")))
    w = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)  # one small file
    return d.withColumn("section", F.last(head, ignorenulls=True).over(w)).filter(~F.col("line").startswith("##"))


def mappings(d: DataFrame) -> DataFrame:
    pair = F.split("line", "=>", 2)
    x = d.filter(F.contains("line", F.lit("=>")) & F.contains("section", F.lit("纠错")))
    return x.select("place", F.trim(F.get(pair, F.lit(0))).alias("wrong"), F.trim(F.get(pair, F.lit(1))).alias("right")).filter("wrong <> '' and right <> ''")


def terms(d: DataFrame) -> DataFrame:
    x = d.filter(F.contains("section", F.lit("术语")) & ~(F.contains("line", F.lit("=>")) & F.contains("section", F.lit("纠错"))))
    x = x.select(F.explode(F.split("line", r"[·•|、，,\s]+")).alias("term"))
    return x.filter(F.char_length("term").between(2, 12) & ~F.rlike("term", F.lit("^[0-9]+$"))).distinct()


def load(spark: SparkSession, path: str) -> Dictionary:
    d = lines(spark, path)
    other = ~F.contains("section", F.lit("术语")) & F.contains("section", F.lit("initial-prompt"))
    prompt = "".join(r["line"] for r in d.filter(other).orderBy("place").select("line").collect())
    fixes = {r["wrong"]: r["right"] for r in mappings(d).orderBy("place").collect()}
    return Dictionary(fixes, sorted(r["term"] for r in terms(d).collect()), prompt)


def flat(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither empty nor comments."""
    return spark.read.text(path).select(F.trim("value").alias("line")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))
