"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the mixture's characters
over the characters it has.  Each document draws how often it appears by inverting
the Poisson distribution with that mean at a uniform number hashed from a seed and
its id, so that a rerun, or a lost executor's retry, draws the same.  Copies are
then put in one global random order.

Rules for odd input: a null text counts no characters and is replicated like any
other; a very long text is one document like any other; a null source is a source of
its own; a source without characters, or with target weight 0, has rate 0; a null id is
hashed as empty text; repeated rows (one id) draw the same number each and have equal
shuffle keys, so they stand together; an empty table gives an empty result; all columns
are kept, and ``copy`` and ``shuffle_key`` replace columns of those names.

The documents are shuffled once, by the random key.  The rates, a row for each source, are
written and counted; up to ``FEW_SOURCES`` of them are broadcast.  More are joined by a
shuffle on the source and one of ``SALTS`` parts of it, so that no source is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

SEED = "mix-1"
TEMPERATURE = 0.5
FEW_SOURCES, SALTS = 100_000, 64
MAX_RATE = 600.0  # exp(-rate) is a normal double below it; larger means are split into parts of at most this


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an md5 of text parts joined by |."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(16**13))


def poisson(rate: Column, u: Column) -> Column:
    """The least k whose cumulative Poisson probability exceeds u (a mean up to MAX_RATE).

    The sum over k is carried by a fold over a sequence that is long enough for the
    mean: beyond mean + 12 roots + 40 the rest is under 1e-17, less than one step of u.
    """
    steps = F.sequence(F.lit(1), (rate + 12 * F.sqrt(rate) + 40).cast("int"))
    first = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("c"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        more = F.struct(k.cast("int").alias("k"), p.alias("p"), (state["c"] + p).alias("c"))
        return F.when(state["c"] > u, state).otherwise(more)

    return F.aggregate(steps, first, add)["k"]


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, size: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Mean repetition rate by source.  ``weights``: shares by source (others 0); else chars ** temperature.  ``size``: of the mixture, in multiples of the input's characters."""
    by = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0))).alias("chars"))
    if weights is None:
        weight = F.pow(F.col("chars").cast("double"), F.lit(temperature))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
    by = by.withColumn("weight", weight)
    total = by.agg(F.sum("weight").alias("weights"), F.sum("chars").alias("all_chars"))
    rate = F.coalesce(F.try_divide(F.col("weight") / F.col("weights") * F.col("all_chars") * F.lit(size), F.col("chars")), F.lit(0.0))
    return by.crossJoin(F.broadcast(total)).select("source", "chars", F.when(F.col("weights") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))  # one row of totals


def with_rates(docs: DataFrame, rates: DataFrame, source_col: str, id_col: str, few: int = FEW_SOURCES) -> DataFrame:
    """Documents and the ``__rate`` of their source."""
    same = F.col(source_col).eqNullSafe(F.col("__source"))
    if rates.count() <= few:
        return docs.join(F.broadcast(rates), same)  # at most ``few`` rows
    salted = docs.withColumn("__salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
    copies = rates.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, same & (F.col("__salt") == F.col("__part"))).drop("__salt", "__part")


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, size: float = 1.0, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Documents, each as often as drawn, in global random order: dealt to partitions by a hash of the random ``shuffle_key``, ascending by it within each."""
    names = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    rates = source_rates(docs, weights, temperature, size, source_col, text_col).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    joined = with_rates(docs.select(*[F.col(f"`{c}`") for c in names]), Workspace(docs.sparkSession, "mixing").keep(rates, "rates"), source_col, id_col)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    parts = F.greatest(F.lit(1), F.ceil(F.col("__rate") / MAX_RATE).cast("int"))
    draws = F.transform(F.sequence(F.lit(1), parts), lambda i: poisson(F.col("__rate") / parts, uniform(F.lit(seed), key, i.cast("string"))))
    n = F.when(F.col("__rate") > 0, F.aggregate(draws, F.lit(0), lambda a, x: a + x)).otherwise(F.lit(0))
    some = joined.withColumn("__n", n).filter("__n > 0")
    out = some.select(*[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("copy").cast("string")))
    return out.withColumn("shuffle_key", order).repartition("shuffle_key").sortWithinPartitions("shuffle_key", id_col, "copy")


#: The same rows for ``replicate`` with its defaults, over a relation of documents.
def replicate_sql(documents: str, columns: str = "doc_id, source, copy, shuffle_key", seed: str = SEED, temperature: float = TEMPERATURE) -> str:
    return f"""
WITH RECURSIVE mix_docs AS (FROM {documents}), by_source AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS chars FROM mix_docs GROUP BY source
), weighed AS (SELECT source, chars, pow(chars::DOUBLE, {temperature}) AS weight FROM by_source
), totals AS (SELECT sum(weight) AS weights, sum(chars) AS all_chars FROM weighed
), rates AS (
  SELECT source, CASE WHEN weights > 0 AND chars > 0 THEN weight / weights * all_chars::DOUBLE / chars ELSE 0.0::DOUBLE END AS rate FROM weighed, totals
), parts AS (SELECT source, rate, greatest(1, ceil(rate / {MAX_RATE}))::INTEGER AS parts FROM rates
), cumulated(source, part_rate, k, p, c, last) AS (
  SELECT source, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)), (rate / parts + 12 * sqrt(rate / parts) + 40)::INTEGER FROM parts WHERE rate > 0
  UNION ALL SELECT source, part_rate, k + 1, p * part_rate / (k + 1), c + p * part_rate / (k + 1), last FROM cumulated WHERE k < last
), ladder AS (SELECT source, list(c ORDER BY k) AS steps FROM cumulated GROUP BY source
), drawn AS (
  SELECT d.*, list_sum([len(list_filter(steps, lambda x: x <= ('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(d.doc_id::VARCHAR, ''), i::VARCHAR)), 1, 13))::BIGINT / {16**13}.0::DOUBLE)) FOR i IN range(1, parts + 1)])::INTEGER AS n
  FROM mix_docs d JOIN parts r ON d.source IS NOT DISTINCT FROM r.source JOIN ladder l ON d.source IS NOT DISTINCT FROM l.source
), copies AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1))::INTEGER AS copy FROM drawn)
SELECT {columns} FROM (SELECT *, md5(concat_ws('|', '{seed}', 'order', coalesce(doc_id::VARCHAR, ''), copy::VARCHAR)) AS shuffle_key FROM copies)
"""
