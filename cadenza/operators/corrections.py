"""Proposed corrections of captions, let through by deterministic gates."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CorrectionConfig
from ..functions.text import LATIN, find_terms


def accepted(old: str, new: str, seconds: float, allowed: frozenset[str], conf: CorrectionConfig) -> bool:
    """Similar enough, not shortened, no new Latin words, and readable in its time."""
    match = difflib.SequenceMatcher(None, old, new)
    kept = sum(b.size for b in match.get_matching_blocks()) / max(len(old), 1)
    known = allowed | set(re.findall(LATIN, old))
    return match.ratio() >= conf.min_ratio and len(new) >= conf.min_length * len(old) and kept >= conf.min_kept and known.issuperset(re.findall(LATIN, new)) and len(new) / max(seconds, 0.1) <= conf.max_cps


def apply(captions: DataFrame, fixes: DataFrame, allowed: frozenset[str] = frozenset(), conf: CorrectionConfig = CorrectionConfig()) -> DataFrame:
    """Captions (clip_id, k, start, end, text, terms) after fixes (clip_id, seq, i, text) in turn; a later one sees an earlier one's result.

    Only fixes that name a caption take part, so the function runs on corrected captions alone.
    """
    given = fixes.filter("text is not null and text <> ''").groupBy("clip_id", F.col("i").alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda v: v["text"]).alias("proposed"))
    some = captions.join(given, ["clip_id", "k"])

    @F.pandas_udf("string")
    def settle(old: pd.Series, proposed: pd.Series, seconds: pd.Series) -> pd.Series:
        out = []
        for text, news, dur in zip(old, proposed, seconds, strict=True):
            for new in (n.strip() for n in news):
                if new and new != text and accepted(text, new, dur, allowed, conf):
                    text = new
            out.append(text)
        return pd.Series(out)

    settled = some.select("clip_id", "k", settle(F.col("text"), F.col("proposed"), F.col("end") - F.col("start")).alias("settled"))
    out = captions.join(settled, ["clip_id", "k"], "left")
    changed = F.col("settled").isNotNull() & (F.col("settled") != F.col("text"))
    out = out.withColumn("terms", F.when(changed, find_terms(F.col("settled"))).otherwise(F.col("terms"))).withColumn("text", F.coalesce("settled", "text"))
    return out.select(*captions.columns)


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Captions that changed, old and new."""
    a, b = before.select("clip_id", "k", F.col("text").alias("old")), after.select("clip_id", "k", F.col("text").alias("new"))
    return a.join(b, ["clip_id", "k"]).filter("old <> new")
