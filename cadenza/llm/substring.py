"""Substring deduplication over a log-structured index of window hashes.

A long window (35 words) is found through a short one inside it: of the 8-word windows
that it covers, the one of least hash (leftmost of ties) is its anchor.  Equal long
windows have equal anchors at equal distance, so the index needs anchors only, about one
in fifteen words.

* A batch of documents becomes a run: the distinct hashes of its anchors with their
  number, sorted and bucketed by hash, never changed afterwards.
* Each new run is merge-joined with every earlier run.  Hashes that occur again are hits.
* When a level has ``FANOUT`` runs they are merged into one run of the next level.

The index is a folder (``Index.open``): packed texts, anchors, hits and runs by batch.  It
outlives the session, and a later one adds batches to it.  A run is there once Spark has
committed it; one that a merged run covers is left over from a merge that was cut off, and
is deleted on opening.

Hits are then verified.  All long windows of one anchor form a block; equal digests of
whole blocks verify all windows of a block at once.  Where an anchor's blocks differ, one
block of each kind is cut in its windows, which are compared one by one.  A group of
copies is thus counted, never paired.  Digests are taken over 64-bit hashes of the words
(and the anchor's own hash beside them); two windows that differ pass for equal only if
words at the same places share a hash (a chance of 2 ** -64 for a pair of words) or both
digests collide.

Hashes, blocks and windows that occur very often are joined by broadcasting their keys,
of which there are few (see ``skew``).

Rules for odd input: a null or empty text has no words; a text shorter than a window
keeps all of its words; a very long text is a chunk of its own; windows are judged on the
input; repeated rows and rows of null id are documents like any other, so their windows
occur elsewhere; ties of anchor hashes go to the left; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import COLUMNS, ids_of, pack, unpack
from .skew import kept_in
from .textcore import U64, Words, mix, powers, inverse, sliding_argmin
from .workspace import Workspace, delete, parallelism

WINDOW, ANCHOR = 35, 8
CHUNK = 2 << 20  # of text: the arrays of a chunk take some thirty times that
BATCHES, FANOUT = 4, 2
BLOCK_BASE = U64(0xC6A4A7935BD1E995)
ANCHORS = "hash long, block long, chunk long, place int, low int, high int"
RUN = re.compile(r"run-(\d+)-(\d+)-(\d+)$")


class Anchors:
    """Anchors of a chunk: their places, the first and last long windows they stand for, and the hashes."""

    def __init__(self, row: dict):
        self.texts = unpack(row)
        self.words = words = Words(self.texts)
        short, _ = words.windows(ANCHOR)
        n = max(0, len(words) - WINDOW + 1)
        inside = words.doc[:n] == words.doc[WINDOW - 1 :] if n else np.zeros(0, bool)
        starts = np.flatnonzero(inside)
        place = sliding_argmin(short, WINDOW - ANCHOR + 1)[starts] if len(starts) else np.zeros(0, np.int64)
        new = np.ones(len(place), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        heads = np.flatnonzero(new)
        self.place = place[heads]
        self.low = starts[heads]
        self.high = starts[np.append(heads[1:], len(starts)) - 1] if len(heads) else starts[:0]
        self.hash = short[self.place] if len(heads) else np.zeros(0, U64)
        self.total = np.zeros(len(words) + 1, dtype=U64)
        np.cumsum(words.hash * powers(BLOCK_BASE, len(words)), out=self.total[1:])

    def span(self, low: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words from low to ends (exclusive)."""
        raw = (self.total[ends] - self.total[low]) * powers(inverse(BLOCK_BASE), len(self.total))[low]
        return mix(raw ^ mix((ends - low).astype(U64)))

    def blocks(self) -> np.ndarray:
        return mix(self.span(self.low, self.high + WINDOW) + (self.place - self.low).astype(U64))


def occurrences(packed: DataFrame) -> DataFrame:
    """A row per anchor: hash, block digest, chunk, place, and how far its windows begin before and after."""
    schema = pa.schema([("hash", pa.int64()), ("block", pa.int64()), ("chunk", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = Anchors(row)
                n = len(a.place)
                columns = [a.hash.view(np.int64), a.blocks().view(np.int64), np.full(n, row["chunk"]), a.place, a.low - a.place, a.high - a.place]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if len(c) else pa.array([], t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return packed.mapInArrow(run, ANCHORS)


def by_chunk(packed: DataFrame, other: DataFrame, work, schema: str) -> DataFrame:
    return packed.groupBy("chunk").cogroup(other.groupBy("chunk")).applyInArrow(work, schema)


def cut_windows(packed: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each long window of given blocks: anchor hash, window digest, its chunk and first word, and whether its block is alone."""
    schema = pa.schema([("hash", pa.int64()), ("window", pa.int64()), ("chunk", pa.int64()), ("start", pa.int32()), ("alone", pa.bool_())])

    def work(rows: pa.Table, given: pa.Table) -> pa.Table:
        if not len(given):
            return schema.empty_table()
        a = Anchors(rows.to_pylist()[0])
        place, low, high = (given.column(c).to_numpy().astype(np.int64) for c in ("place", "low", "high"))
        n = high - low + 1
        start = np.repeat(place + low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = mix(a.span(start, start + WINDOW) + (np.repeat(place, n) - start).astype(U64))
        return pa.table([np.repeat(given.column("hash").to_numpy(), n), window.view(np.int64), np.repeat(given.column("chunk").to_numpy(), n), start.astype(np.int32), np.repeat(given.column("alone").to_numpy(zero_copy_only=False), n)], schema=schema)

    return by_chunk(packed, blocks, work, "hash long, window long, chunk long, start int, alone boolean")


class Index:
    """Texts, anchors and sorted runs of their hashes in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = parallelism(spark)
        self.database = f"substring_{uuid.uuid4().hex}"  # names of the runs for this session; the files are the index's
        self.runs: dict[tuple[int, int], str] = {}
        self.next = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Index:
        """The index of a folder; a new one if there is none."""
        index = cls(spark, path)
        spark.sql(f"CREATE DATABASE {index.database} LOCATION '{index.path}/names'")
        found = [m for m in map(RUN.search, index._list("runs")) if m and "_SUCCESS" in index._list(f"runs/{m[0]}")]
        spans = {(int(m[1]), int(m[2])): m for m in found}
        for (low, high), m in spans.items():
            if any((a, b) != (low, high) and a <= low and high <= b for a, b in spans):
                delete(spark, f"{index.path}/runs/{m[0]}")
                continue
            index.runs[low, high] = index._table(m[0])
            spark.sql(f"CREATE TABLE {index.runs[low, high]} (hash LONG, n LONG) USING parquet CLUSTERED BY (hash) SORTED BY (hash) INTO {m[3]} BUCKETS LOCATION '{index.path}/runs/{m[0]}'")
        index.next = max((high for _, high in index.runs), default=-1) + 1
        return index

    def __enter__(self) -> Index:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Forget the session's names; the files stay."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")

    def _list(self, name: str) -> list[str]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        system = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [x.getPath().getName() for x in system.listStatus(at)] if system.exists(at) else []

    def _move(self, source: str, target: str) -> bool:
        one, other = (self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}") for x in (source, target))
        system = one.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(one):
            return False
        system.delete(other, True)
        system.mkdirs(other.getParent())
        if not system.rename(one, other):
            raise OSError(f"{source} could not become {target}")
        return True

    def _table(self, name: str) -> str:
        return f"{self.database}.{name.replace('-', '_')}"

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")  # a batch that was cut off is written anew
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def _write(self, df: DataFrame, low: int, high: int) -> str:
        name = f"run-{low}-{high}-{self.buckets}"
        df.write.format("parquet").mode("overwrite").option("path", f"{self.path}/runs/{name}").bucketBy(self.buckets, "hash").sortBy("hash").saveAsTable(self._table(name))
        return self._table(name)

    def read(self, name: str, batches: list[int] | None = None) -> DataFrame:
        """A kind of table (texts, anchors, hits) of some batches, or of all."""
        schema = {"texts": COLUMNS, "anchors": ANCHORS, "hits": "hash long"}[name]
        some = [self.spark.read.schema(schema).parquet(f"{self.path}/{name}/{b}") for b in (range(self.next) if batches is None else batches)]
        out = some[0]
        for more in some[1:]:
            out = out.unionByName(more)
        return out

    def add(self, docs: DataFrame, chunk: int = CHUNK, batches: int = 1) -> list[int]:
        """Take in documents (columns id, text) as so many batches; their numbers."""
        first = self.next
        packed = pack(docs, chunk).withColumn("batch", (F.col("chunk") % batches + first).cast("int"))
        # numbers of chunks are unique in the index: batch, task, place
        packed = packed.withColumn("chunk", F.shiftleft(F.lit(first).cast("long"), 44).bitwiseOR(F.shiftleft(F.shiftright("chunk", 32), 24)).bitwiseOR(F.col("chunk").bitwiseAND(F.lit((1 << 24) - 1))))
        packed.write.mode("overwrite").partitionBy("batch").parquet(f"{self.path}/packed-{first}")
        for b in range(first, first + batches):
            if not self._move(f"packed-{first}/batch={b}", f"texts/{b}"):
                self._keep(packed.drop("batch").limit(0), f"texts/{b}")  # no chunk fell to this batch
        delete(self.spark, f"{self.path}/packed-{first}")
        for b in range(first, first + batches):
            self._take(b)
        return list(range(first, first + batches))

    def _take(self, batch: int) -> None:
        """A batch's anchors become a run; hits are hashes met twice in it, or in an earlier run."""
        found = self._keep(occurrences(self.read("texts", [batch])), f"anchors/{batch}")
        run = self.spark.table(self._write(found.groupBy("hash").agg(F.count("*").alias("n")), batch, batch))
        hits = run.filter("n > 1").select("hash")
        for old in self.runs.values():
            hits = hits.unionByName(run.join(self.spark.table(old).hint("merge"), "hash").select("hash"))
        self._keep(hits, f"hits/{batch}")
        self.runs[batch, batch] = self._table(f"run-{batch}-{batch}-{self.buckets}")
        self.next = batch + 1
        self.compact()

    def compact(self) -> None:
        """Merge the last ``FANOUT`` runs of equal length, in order of hash, counts added, until there are not so many."""
        while True:
            spans = sorted(self.runs)[-FANOUT:]
            if len(spans) < FANOUT or len({high - low for low, high in spans}) > 1:
                return
            merged = self.spark.table(self.runs[spans[0]])
            for other in spans[1:]:
                more = self.spark.table(self.runs[other]).withColumnRenamed("n", "more").hint("merge")
                merged = merged.join(more, "hash", "full").select("hash", (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
            low, high = spans[0][0], spans[-1][1]
            self.runs[low, high] = self._write(merged, low, high)
            for old in spans:
                name = self.runs.pop(old)
                self.spark.sql(f"DROP TABLE {name}")
                delete(self.spark, f"{self.path}/runs/{name.split('.')[1].replace('_', '-')}")

    def counts(self) -> DataFrame:
        """Hashes that are hits of a batch, and how often they occur in all."""
        every = None
        for name in self.runs.values():
            run = self.spark.table(name)
            every = run if every is None else every.unionByName(run)
        return every.groupBy("hash").agg(F.sum("n").alias("n"))

    def ranges(self, space: Workspace, batches: list[int] | None = None) -> DataFrame:
        """Ranges (chunk, low, high) of first words of long windows that start somewhere else too, as far as hits of the given batches tell."""
        found = self.read("anchors")
        total = found.count()
        hits = self.read("hits", batches).distinct().join(self.counts(), "hash")
        again = space.keep(kept_in(found, hits, ["hash"], total), "again")
        first = F.min(F.struct("chunk", "place", "low", "high")).alias("one")
        blocks = space.keep(again.groupBy("hash", "block").agg(F.count("*").alias("n"), first), "blocks")
        whole = kept_in(again, blocks.filter("n > 1"), ["hash", "block"], total).select("chunk", (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high"))
        split = blocks.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
        some = kept_in(blocks.withColumnRenamed("n", "copies"), split, ["hash"], total).select("hash", "one.*", (F.col("copies") == 1).alias("alone"))
        windows = space.keep(cut_windows(self.read("texts"), some), "windows")
        twice = windows.groupBy("hash", "window").agg(F.count("*").alias("n"), F.max("alone").alias("any")).filter("n > 1 and any")
        single = kept_in(windows.filter("alone"), twice, ["hash", "window"], windows.count()).select("chunk", F.col("start").alias("low"), F.col("start").alias("high"))
        ranges = space.keep(whole.unionByName(single), "ranges")
        for name in ("again", "blocks", "windows"):
            space.drop(name)
        return ranges

    def kept(self, batches: list[int] | None = None, with_text: bool = False) -> DataFrame:
        """A row per document of the given batches, judged against all that the index holds."""
        ranges = self.ranges(Workspace(self.spark, "substring"), batches)
        return applied(self.read("texts", batches), ranges, with_text)


def applied(packed: DataFrame, ranges: DataFrame, with_text: bool = False) -> DataFrame:
    """Documents of packed texts without the words of the ranges' windows."""
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())] + [("kept_text", pa.string())] * with_text

    def work(rows: pa.Table, gone: pa.Table) -> pa.Table:
        if not len(rows):  # a chunk of another batch
            return pa.schema(fields).empty_table()
        row = rows.to_pylist()[0]
        texts = unpack(row)
        words = Words(texts, hashes=False)
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, gone.column("low").to_numpy(), 1)
        np.add.at(change, gone.column("high").to_numpy().astype(np.int64) + WINDOW, -1)
        keep = np.cumsum(change)[:-1] == 0
        n = np.diff(words.first)
        kept = np.bincount(words.doc[keep], minlength=len(n))
        out = []
        for i in range(len(n)):
            own = texts.bytes_of(i).split()  # the same words: bytes.split() cuts at these six bytes
            if kept[i] < n[i]:
                own = [w for w, k in zip(own, keep[words.first[i] : words.first[i + 1]].tolist(), strict=True) if k]
            out.append(b" ".join(own))
        columns = [ids_of(row), n, n - kept, [hashlib.sha256(t).hexdigest() for t in out]] + [[t.decode() for t in out]] * with_text
        return pa.table([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], schema=pa.schema(fields))

    return by_chunk(packed, ranges, work, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, chunk: int = CHUNK) -> DataFrame:
    """One row per document: words, words removed and the digest of what is kept (``with_text``: and that text)."""
    space = Workspace(docs.sparkSession, "substring")
    with Index.open(docs.sparkSession, f"{space.path}/index") as index:
        index.add(docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text"), chunk, BATCHES)
        ranges = index.ranges(space)
        for name in ("anchors", "hits", "runs"):
            space.drop(f"index/{name}")
        return applied(index.read("texts"), ranges, with_text)
