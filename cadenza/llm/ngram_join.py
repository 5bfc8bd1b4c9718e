"""N-gram Jaccard self-join by partitioning the universe of shingles.

Sets that differ in at most H elements, cut by a hash of the element into M segments,
agree on whole segments if M > H, and differ in at most one element of some segment if
2 M > H (pigeonhole).  Sizes fall into bands of ratio 5/4; each band has its own H, and a
set is indexed in its own band and in the next, where it may be the smaller partner.  A
band's plan is the cheaper of two (``allocation``; cost: signatures of a set, and how often
segments as short as the plan's meet by chance):

* Whole segments, H * SPREAD + 2 of them.  An indexed segment is the hash of the sum of its
  elements' hashes.  A set must share at least ``need`` = M - h - (its empty segments) of
  them with other sets, h being the most by which a partner of its size can differ; all
  others drop out before any pair is formed.  So a passage that many documents share makes
  no candidates by itself.
* Few segments, H // 2 + 1 of them, each with its one-deletion neighbourhood.

A set whose empty segments alone could reach M - h (or, of the second plan, one with a
segment of at most one element) may agree with another such set there only; these also
index the first fifth of their elements in hash order (prefix filter), so that no pair is
lost.

Documents of equal sets are one class from the start.  Documents that share a segment
form a list.  A pivot of each list is verified, exactly, against the others, ``ROUNDS`` times
with other pivots in the lists that lie in more than one component still.  What is then left
is dealt in blocks of at most CROWD documents; a pair of blocks that have a list in common is
one task, which counts shared segments by array operations and verifies only pairs of
different components that share as many as they need.  Links inside a component need no
check, and no pair is ever a row.  A list of N documents that no pivot joins makes
(N / CROWD) ** 2 / 2 such tasks: that part grows with the square of lists of texts which are
alike in many segments without being near copies.

Sets are compared by 64-bit hashes of their shingles, and sets of equal 64-bit keys are one
class: of 10^9 different sets two share a key with a chance of 3 %.

Rules for odd input: a null or empty text, or one without words, has the empty set and
its own id as component; fewer words than five are one shingle; very long texts are
compared whole; repeated rows are equal documents, and rows of one id but different texts
are documents of their own; a row of null id links like any other, and its component is
the least id that it reaches, null if there is none; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .skew import looked_up
from .textcore import U64, Texts, Words, mix, powers, segment_sum
from .workspace import Workspace, bounded_batches, give_back, parallelism

SHINGLE, SHARE = 5, 80
SPREAD = 1.25  # segments of a band: this times its H, and two more
GROUPS = 8  # parts of a band's segments, for dealing
OWN, NEXT, PREFIX = 0, 1, 2
BLOCK = 2 << 20
STEPS, ROUNDS = 2, 3
CHANCE = 16  # cost, in signatures, of a segment that is met by chance always; each element halves that
BUCKET = 8 << 20  # bytes of text whose segments a bucket holds, about
CROWD = 256  # documents of a block, in which what pivots leave is compared


def bands(largest: int) -> np.ndarray:
    """Largest sizes of the bands, up to one above ``largest``."""
    out, low = [0], 1
    while True:
        out.append(low * 100 // SHARE)
        low = out[-1] + 1
        if out[-2] > largest:
            return np.array(out)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 5-word shingle hashes, ascending within each text, and where each text's begin."""
    words = Words(texts, lower=True)
    hashes, whole = words.windows(SHINGLE)
    doc = words.doc[: len(hashes)][whole]
    hashes = hashes[whole]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        place = np.arange(len(words)) - words.first[words.doc]
        weight = powers(U64(0xA24BAED4963EE407), SHINGLE)[np.minimum(place, SHINGLE - 1)]
        sums = segment_sum(words.hash * weight, words.first[:-1], words.first[1:])[short]
        hashes = np.concatenate([hashes, mix(sums ^ count[short].astype(U64))])
        doc = np.concatenate([doc, short])
    order = np.argsort(hashes)
    doc = doc[order].astype(np.uint16 if len(texts) < 65536 else np.int64)
    by = np.argsort(doc, kind="stable")
    doc, hashes = doc[by], hashes[order][by]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def set_keys(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit key of each set, from its elements alone."""
    n = np.diff(first).astype(U64)
    one = segment_sum(mix(hashes ^ U64(0x632BE59BD9B4E019)), first[:-1], first[1:])
    two = segment_sum(mix(hashes + U64(0x9FB21C651E98DF25)), first[:-1], first[1:])
    return mix(one ^ mix(two + n))


def most_apart(n: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Most elements by which a partner of at most ``top`` elements can differ: overlap >= SHARE / (100 + SHARE) of both sizes."""
    partner = np.minimum(top, n * 100 // SHARE)
    return (n + partner) * (100 - SHARE) // (100 + SHARE)


def allocation(high: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By largest size of a band and its H: number of segments, and whether with one-deletion neighbourhoods."""
    many = (apart * SPREAD).astype(np.int64) + 2
    few = apart // 2 + 1
    whole_cost = many + CHANCE * many * 0.5 ** (high / many)
    near_cost = few + high + CHANCE * few * 0.5 ** (high / few - 1)
    near = near_cost < whole_cost
    return np.where(near, few, many), near


def signatures(hashes: np.ndarray, first: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Bucket, signature, text and kind of every indexed segment; and by text what its own and next band need."""
    n = np.diff(first)
    top = bands(int(n.max(initial=1)))
    band = np.searchsorted(top, n)
    doc = np.repeat(np.arange(len(n)), n)
    out: list[tuple[np.ndarray, ...]] = []
    need = np.zeros((2, len(n)), dtype=np.int64)
    scarce = np.zeros(len(n), dtype=bool)
    for kind in (OWN, NEXT):
        plan = band + kind
        high = top[np.minimum(plan, len(top) - 1)]
        apart = 2 * high * (100 - SHARE) // (100 + SHARE)
        used = (n > 0) & (apart > 0) & ((kind == OWN) | (n * 100 // SHARE > top[band]))
        planned, by_deletion = allocation(high, apart)
        near = used & by_deletion
        cut = used & ~by_deletion
        m = np.where(used, planned, 0)
        base = np.concatenate([[0], np.cumsum(m)])
        live = used[doc]
        d, h = doc[live], hashes[live]
        seed = mix(plan.astype(U64) + U64(0x5851F42D4C957F2D))
        spot = mix(h ^ seed[d])
        segment = ((spot >> U64(32)) * m[d].astype(U64) >> U64(32)).astype(np.int64)
        cell = base[d] + segment
        value = mix(spot + U64(0x2545F4914F6CDD1D))
        total = np.zeros(base[-1], dtype=U64)
        np.add.at(total, cell, value)
        size = np.bincount(cell, minlength=base[-1])
        owner = np.repeat(np.arange(len(n)), m)
        number = np.arange(base[-1]) - base[owner]
        full = np.flatnonzero(size)

        def emit(o, num, summed, left, kind=kind, plan=plan, seed=seed, m=m):
            sig = mix(summed ^ mix(seed[o] + (num.astype(U64) << U64(20)) + left.astype(U64)))
            bucket = (plan[o] * 1009 + num * GROUPS // np.maximum(m[o], 1)) + (sig % U64(max(1, buckets // 64))).astype(np.int64) * 7
            out.append((bucket % buckets, sig, o, np.full(len(o), kind)))

        emit(owner[full], number[full], total[full], size[full])
        one = near[d] & (size[cell] > 1)
        if one.any():
            emit(d[one], segment[one], total[cell[one]] - value[one], size[cell[one]] - 1)
        empty = np.bincount(owner[size == 0], minlength=len(n))
        own_need = m - most_apart(n, high) - empty
        scarce |= cut & (own_need < 1)
        scarce |= near & (np.bincount(owner[size < 2], minlength=len(n)) > 0)
        need[kind] = np.where(near, 1, np.where(cut, np.maximum(own_need, 1), 0))
    if scarce.any():
        rank = np.arange(len(doc)) - first[doc]
        early = scarce[doc] & (rank <= n[doc] - -(-n[doc] * SHARE // 100))
        sig = mix(hashes[early] ^ U64(0x94D049BB133111EB))
        out.append(((sig % U64(buckets)).astype(np.int64), sig, doc[early], np.full(early.sum(), PREFIX)))
    bucket, sig, owner, kind = (np.concatenate(x) for x in zip(*out, strict=True))
    return bucket, sig, owner, kind, need


INDEX = "doc_id long, n long, key long, need_own long, need_next long, bucket int, keys binary, high binary, low binary, owners binary"


def index(docs: DataFrame, buckets: int) -> DataFrame:
    """A row per document (its set's size, key and needs), and rows of packed signatures by bucket."""
    types = [pa.int64()] * 5 + [pa.int32()] + [pa.binary()] * 4
    schema = pa.schema(list(zip((c.split()[0] for c in INDEX.split(", ")), types, strict=True)))

    def run(batches):
        for batch in batches:
            for at, block in Texts.of(batch.column(1)).blocks(BLOCK):
                hashes, first = shingles(block)
                n, keys = np.diff(first), set_keys(hashes, first).view(np.int64)
                bucket, sig, owner, kind, need = signatures(hashes, first, buckets)
                blank = [None] * len(block)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([batch.column(0).slice(at, len(block)), n, keys, need[OWN], need[NEXT], *[blank] * 5], types, strict=True)], schema=schema)
                order = np.lexsort((owner, bucket))
                bucket, sig, mark = bucket[order], sig[order], (owner * 3 + kind)[order]
                heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
                rows: list[list] = [[], [], [], [], []]
                for lo, hi in zip(heads, [*heads[1:], len(bucket)], strict=True):
                    present, local = np.unique(mark[lo:hi], return_inverse=True)
                    rows[0].append(int(bucket[lo]))
                    rows[1].append(np.stack([keys[present // 3], present % 3]).tobytes())
                    rows[2].append((sig[lo:hi] >> U64(32)).astype(np.uint32).tobytes())
                    rows[3].append((sig[lo:hi] >> U64(16)).astype(np.uint16).tobytes())
                    rows[4].append(local.astype(np.uint16 if len(present) < 65536 else np.uint32).tobytes())
                none = [None] * len(rows[0])
                if len(rows[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*[none] * 5, *rows], types, strict=True)], schema=schema)
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, INDEX)


def shared_lists(packed: DataFrame) -> DataFrame:
    """Within each bucket: sets that have a signature in common with others, by the list of those sets."""
    schema = pa.schema([("list", pa.int64()), ("key", pa.int64()), ("kind", pa.int32()), ("segments", pa.int64()), ("many", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        sigs, keys, kinds = [], [], []
        for k, high, low, own in zip(*(rows.column(c).to_pylist() for c in ("keys", "high", "low", "owners")), strict=True):
            table = np.frombuffer(k, np.int64).reshape(2, -1)
            top = np.frombuffer(high, np.uint32)
            local = np.frombuffer(own, np.uint16 if len(own) == 2 * len(top) else np.uint32)
            sigs.append(top.astype(U64) << U64(16) | np.frombuffer(low, np.uint16))
            keys.append(table[0][local])
            kinds.append(table[1][local].astype(np.int8))
        sig, key, kind = (np.concatenate(x) for x in (sigs, keys, kinds))
        order = np.argsort(sig)
        sig, key, kind = sig[order], key[order], kind[order]
        same = np.zeros(len(sig) + 1, dtype=bool)
        same[1:-1] = sig[1:] == sig[:-1]
        some = same[:-1] | same[1:]
        sig, key, kind = sig[some], key[some], kind[some]
        order = np.lexsort((kind, key, sig))  # few are left
        sig, key, kind = sig[order], key[order], kind[order]
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key, kind = sig[new], key[new], kind[new]
        heads = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.zeros(0, np.int64)
        many = np.diff(np.append(heads, len(sig)))
        names = mix(np.add.reduceat(mix(key.view(U64) + mix(kind.astype(U64) + U64(11))), heads)) if len(heads) else np.zeros(0, U64)
        names, many_of = np.repeat(names, many), np.repeat(many, many)
        some = many_of > 1
        names, key, kind, many_of = names[some], key[some], kind[some], many_of[some]
        order = np.lexsort((kind, key, names))
        names, key, kind, many_of = names[order], key[order], kind[order], many_of[order]
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])
        at = np.flatnonzero(new)
        return pa.table([pa.array(names[at].view(np.int64)), pa.array(key[at]), pa.array(kind[at].astype(np.int32)), pa.array(np.diff(np.append(at, len(names)))), pa.array(many_of[at])], schema=schema)

    return packed.select("bucket", "keys", "high", "low", "owners").groupBy("bucket").applyInArrow(run, "list long, key long, kind int, segments long, many long")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of set keys with SHARE of their union in common; each ``a`` is met once per 1,000 partners."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / 1000).alias("salts"))
    salted = pairs.join(many, "a").withColumn("salt", F.pmod(F.col("b"), F.col("salts")))
    heads = many.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")).withColumn("b", F.lit(None).cast("long"))
    wanted = salted.select("a", "salt", "b").unionByName(heads.select("a", "salt", "b"))
    rows = wanted.withColumn("key", F.coalesce("b", "a")).join(texts, "key").select("a", "salt", "b", "text")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        own: np.ndarray | None = None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            found: list[tuple[int, int]] = []
            for at, block in Texts.of(batch.column(3)).blocks(BLOCK):
                hashes, first = shingles(block)
                for i in range(len(block)):
                    these = hashes[first[i] : first[i + 1]]
                    if b[at + i] is None:
                        own = these
                        continue
                    place = np.minimum(np.searchsorted(own, these), len(own) - 1)
                    both = int((own[place] == these).sum())
                    if 100 * both >= SHARE * (len(own) + len(these) - both):
                        found.append((a[at + i], b[at + i]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.mapInArrow(run, "a long, b long")


def crowded(members: DataFrame, texts: DataFrame, space: Workspace) -> DataFrame:
    """Links among documents that pivots left in different components.

    ``members``: list, key, kind, segments, root, n, need_own, need_next, many (sets of the list), open (the list is
    unresolved and the set keeps it).
    """
    per_key = members.groupBy("key").agg(
        F.collect_list(F.struct("list", "kind", "segments")).alias("lists"), F.first("root").alias("root"), F.first("n").alias("n"), F.first("need_own").alias("need_own"), F.first("need_next").alias("need_next"),
    )
    # documents are dealt by the largest list within a few steps, so that those with lists in common meet in few blocks
    spots = members.filter("open").select("list", "key", "many")
    near = spots.groupBy("key").agg(F.max(F.struct("many", "list")).alias("near"))
    for step in range(STEPS):
        best = spots.join(near, "key").groupBy("list").agg(F.max("near").alias("best"))
        near = space.keep(spots.join(best, "list").groupBy("key").agg(F.max("best").alias("near")), f"near-{step}")
    per_key = per_key.join(near.select("key", F.col("near.list").alias("near")), "key")
    size = per_key.groupBy("near").agg(F.ceil(F.count("*") / CROWD).alias("salts"))
    placed = per_key.join(size, "near").withColumn("block", F.xxhash64("near", F.pmod(F.col("key"), F.col("salts")))).drop("near", "salts")
    placed = space.keep(placed, "placed")
    spots = spots.join(placed.select("key", "block"), "key").select("list", "block").distinct()
    other = spots.select("list", F.col("block").alias("b2"))
    tasks = spots.withColumnRenamed("block", "b1").join(other, "list").filter("b1 <= b2").select("b1", "b2").distinct()
    sides = tasks.select("b1", "b2", F.explode(F.when(F.col("b1") == F.col("b2"), F.array(F.struct(F.lit(0).alias("side"), F.col("b1").alias("block")))).otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("b1").alias("block")), F.struct(F.lit(1).alias("side"), F.col("b2").alias("block"))))).alias("s")).select("b1", "b2", "s.side", "s.block")
    rows = sides.join(placed.join(texts, "key"), "block").drop("block")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        key, n, root, own, nxt = (table.column(c).to_numpy() for c in ("key", "n", "root", "need_own", "need_next"))
        need = np.stack([own, nxt, np.ones_like(own)])
        lists = table.column("lists").combine_chunks()
        owner = np.repeat(np.arange(len(key)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        name, kind, segments = (flat.field(i).to_numpy() for i in range(3))
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
        within = side.max() == 0
        left, right = np.full(len(key), -1), np.full(len(key), -1)
        left[one], right[two] = np.arange(len(one)), np.arange(len(two))
        wanted = np.zeros((len(one), len(two)), dtype=bool)
        order = np.argsort(name, kind="stable")
        name, kind, segments, owner = name[order], kind[order], segments[order], owner[order]
        edges = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1], [True]]))
        shared: dict[tuple[int, int], np.ndarray] = {}
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi - lo < 2:
                continue
            for ka in np.unique(kind[lo:hi]):
                a = owner[lo:hi][(kind[lo:hi] == ka) & (left[owner[lo:hi]] >= 0)]
                for kb in np.unique(kind[lo:hi]):
                    b = owner[lo:hi][(kind[lo:hi] == kb) & (right[owner[lo:hi]] >= 0)]
                    if len(a) and len(b):
                        if (ka, kb) not in shared:
                            shared[ka, kb] = np.zeros(wanted.shape, dtype=np.int32)
                        shared[ka, kb][np.ix_(left[a], right[b])] += int(segments[lo])
        for (ka, kb), count in shared.items():
            wanted |= count >= np.maximum(need[ka][one][:, None], need[kb][two][None, :])
        sizes = np.minimum(n[one][:, None], n[two][None, :]) * 100 >= np.maximum(n[one][:, None], n[two][None, :]) * SHARE
        wanted &= sizes & (root[one][:, None] != root[two][None, :])
        if within:
            wanted &= np.arange(len(one))[:, None] < np.arange(len(two))[None, :]
        i, j = np.nonzero(wanted)
        if not len(i):
            return schema.empty_table()
        used = np.unique(np.concatenate([one[i], two[j]]))
        sets: dict[int, np.ndarray] = {}
        for at, block in Texts.of(table.column("text").take(pa.array(used))).blocks(BLOCK):
            hashes, first = shingles(block)
            sets |= {int(used[at + k]): hashes[first[k] : first[k + 1]] for k in range(len(block))}
        found = []
        for x, y in zip(one[i].tolist(), two[j].tolist(), strict=True):
            s, t = sets[x], sets[y]
            if len(s) > len(t):
                s, t = t, s
            both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            if 100 * both >= SHARE * (len(s) + len(t) - both):
                found.append((key[x], key[y]))
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.groupBy("b1", "b2").applyInArrow(run, "a long, b long")


def with_keys(docs: DataFrame, text_col: str, key_col: str, size_col: str) -> DataFrame:
    """All rows and columns, and the key and size of the text's set."""
    at = docs.columns.index(text_col)
    names = [*docs.columns, key_col, size_col]

    def run(batches):
        for batch in batches:
            for low, block in Texts.of(batch.column(at)).blocks(BLOCK):
                hashes, first = shingles(block)
                added = [pa.array(set_keys(hashes, first).view(np.int64)), pa.array(np.diff(first))]
                yield pa.RecordBatch.from_arrays([*(c.slice(low, len(block)) for c in batch.columns), *added], names)
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(key_col, T.LongType()), T.StructField(size_col, T.LongType())]))


def texts_of(picked: DataFrame, wanted: DataFrame) -> DataFrame:
    """A text of each wanted ``key``, found by the least id ``rep`` of its documents (which others may have too)."""
    ids = wanted.select("rep").distinct()
    some = picked.join(ids, picked["doc_id"].eqNullSafe(ids["rep"]), "left_semi")
    return with_keys(some.select("text"), "text", "key", "n").join(wanted.select("key"), "key", "left_semi").select("key", "text").dropDuplicates(["key"])


def linked(picked: DataFrame, space: Workspace) -> DataFrame:
    """A row per document (doc_id, text): doc_id, n, the key of its set, and the component's least id and the key that goes with it."""
    spark = picked.sparkSession
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    indexed = space.keep(index(picked, max(2 * parallelism(spark), -(-size // BUCKET))), "index")
    rows = indexed.filter("bucket is null").select("doc_id", "n", "key", "need_own", "need_next")
    classes = space.keep(rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("need_own").alias("need_own"), F.first("need_next").alias("need_next")), "classes")
    # segments of one list lie in several buckets; its members share all of them
    raw = shared_lists(indexed.filter("bucket is not null")).groupBy("list", "key", "kind").agg(F.sum("segments").alias("segments"), F.max("many").alias("many"))
    need = F.when(F.col("kind") == OWN, F.col("need_own")).when(F.col("kind") == NEXT, F.col("need_next")).otherwise(F.lit(1))
    own = Window.partitionBy("key", "kind")
    rare = own.orderBy("many", "list").rowsBetween(Window.unboundedPreceding, -1)
    met = raw.join(classes.drop("rep"), "key").withColumn("need", need).withColumn("shared", F.sum("segments").over(own)).withColumn("rarer", F.coalesce(F.sum("segments").over(rare), F.lit(0)))
    # of its shared segments a set can do without the need - 1 most frequent
    met = met.filter("shared >= need").withColumn("kept", F.col("rarer") <= F.col("shared") - F.col("need"))
    met = space.keep(met.select("list", "key", "kind", "segments", "n", "need_own", "need_next", "kept"), "met")
    kept = met.filter("kept").select("list", "key", "n").distinct()
    heads = kept.groupBy("list").agg(F.min(F.struct("key", "n")).alias("p"), F.count("*").alias("many")).filter("many > 1").select("list", "p")
    alike = F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * SHARE
    lists = space.keep(looked_up(kept, heads, "list", kept.count()), "lists")
    texts = space.keep(texts_of(picked, lists.select("key").distinct().join(classes, "key").select("key", "rep")), "texts")
    pairs = space.keep(lists.filter((F.col("key") != F.col("p.key")) & alike).select(F.col("p.key").alias("a"), F.col("key").alias("b")).distinct(), "pairs")
    links = space.keep(verify(pairs, texts), "links-0")
    roots = components(links, space, "roots-0")
    members = kept.count()
    for k in range(1, ROUNDS):  # other pivots where the first left more than one component
        spread, unresolved = unresolved_lists(lists, roots)
        pivot = spread.join(unresolved, "list").groupBy("list").agg(F.min(F.struct(F.xxhash64("key", F.lit(k)).alias("h"), "key", "n", "root")).alias("p"))
        rest = looked_up(spread, pivot, "list", members).filter((F.col("root") != F.col("p.root")) & alike)
        pairs = space.keep(rest.select(F.col("p.key").alias("a"), F.col("key").alias("b")).distinct(), f"pairs-{k}")
        more = space.keep(verify(pairs, texts), f"links-{k}")
        links = links.unionByName(more)
        roots = components(links, space, f"roots-{k}")
    _, unresolved = unresolved_lists(lists, roots)
    unresolved = unresolved.withColumn("unresolved", F.lit(True))
    busy = lists.join(unresolved, "list").select("key").distinct()
    open_ = met.join(busy, "key").join(unresolved, "list", "left").join(roots, F.col("key") == F.col("node"), "left")
    open_ = space.keep(open_.select("list", "key", "kind", "segments", F.coalesce("root", "key").alias("root"), "n", "need_own", "need_next", "many", (F.col("kept") & F.coalesce("unresolved", F.lit(False))).alias("open")), "members")
    links = links.unionByName(space.keep(crowded(open_, texts, space), f"links-{ROUNDS}"))
    roots = components(links, space, f"roots-{ROUNDS}")
    named = classes.select("key", "rep").join(roots, F.col("key") == F.col("node"), "left").select("key", "rep", F.coalesce("root", "key").alias("root"))
    least = named.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("first")).select("root", F.col("first.rep").alias("component_id"), F.col("first.key").alias("first_key"))
    classed = space.keep(looked_up(named, least, "root", classes.count()).select("key", "component_id", "first_key"), "classed")
    out = rows.select("doc_id", "n", "key").join(classed, "key", "left")
    out = space.keep(out.select("doc_id", "n", "key", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "first_key"), "linked")
    for name in ("index", "classes", "met", "lists", "texts", "placed", "classed", *(f"{x}-{k}" for x in ("links", "pairs", "roots", "near") for k in range(ROUNDS + 1)), "pairs"):
        space.drop(name)
    return out


def unresolved_lists(lists: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of all lists with their component; and the lists of more than two members in more than one, with their size."""
    spread = lists.select("list", "key", "n").join(roots, F.col("key") == F.col("node"), "left").select("list", "key", "n", F.coalesce("root", "key").alias("root"))
    ends = spread.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many"))
    return spread, ends.filter("low != high and many > 2").select("list", "many")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id (the least id it reaches by links)."""
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return linked(picked, Workspace(docs.sparkSession, "ngram-join")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: of least id (nulls last), then least set key, then least text and other columns.

    Rows without words are linked with nothing, so all of them stay.
    """
    names = docs.columns
    space = Workspace(docs.sparkSession, "ngram-first")
    found = linked(docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text"), space)
    firsts = found.filter("n > 0 and key = first_key").select("key", "component_id").distinct()
    keyed = with_keys(docs, text_col, "__key", "__n")
    same = (keyed["__key"] == firsts["key"]) & keyed[id_col].cast("long").eqNullSafe(firsts["component_id"])
    some = keyed.filter("__n > 0").join(firsts, same, "left_semi")
    order = [F.col(f"`{text_col}`"), *(F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name not in (text_col, id_col))]
    one = F.row_number().over(Window.partitionBy("__key").orderBy(*order))
    some = some.withColumn("__place", one).filter("__place = 1").select(*[f"`{c}`" for c in names])
    return some.unionByName(keyed.filter("__n = 0").select(*[f"`{c}`" for c in names]))
