"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A document's paragraphs (lines) are hashed, each with its occurrence number, and
every key is added to three cells of a sketch: a count, an XOR of keys and a sum of
check values.  The fingerprint is that sketch, with the number of keys, as base64; it
can be read back (``decoded``) and subtracted from another.  What is left of two
versions holds only the paragraphs that differ, which peeling recovers one pure cell at
a time.  If peeling stops early, both documents give sketches ``GROWTH`` times as large,
until it succeeds.  All documents of a block are peeled together with array operations.

The likeness of two versions is the Jaccard similarity of their key sets, as the
recovered digests and the numbers of keys give it.

Rules for odd input: a null or empty text has one empty paragraph; a very long text is a
block of its own; ids are ordered ascending, nulls first, equal ids by text (a null
first), and the last is followed by the first; one row alone follows itself; repeated
rows follow each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textcore import BYTE_KEY, U64, WORD_BASE, Texts, mix, powers
from .workspace import bounded_batches, parallelism

#: Cells of a fingerprint, cells of a key, and growth of the sketch on failure.
CELLS, HASHES, GROWTH, SALT = 24, 3, 4, 0x51ED270B7A14F0C3


def paragraph_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all paragraphs, and where each text's keys begin."""
    column = Texts.from_strings(texts)
    data, offsets = column.data, column.offsets
    marks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], marks + 1]), kind="stable")
    ends = np.sort(np.concatenate([marks, offsets[1:]]), kind="stable")
    # a line break belongs to the text it stands in, so starts and ends pair up in order
    first = np.concatenate([[0], np.cumsum(1 + np.searchsorted(marks, offsets[1:]) - np.searchsorted(marks, offsets[:-1]))])
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    length = ends - starts
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    power = powers(WORD_BASE, int(length.max(initial=0)) + 1)
    total = np.zeros(len(place) + 1, dtype=U64)
    np.cumsum(BYTE_KEY[data[np.repeat(starts, length) + place]] * power[place], out=total[1:])
    edge = np.concatenate([[0], np.cumsum(length)])
    key = mix((total[edge[1:]] - total[edge[:-1]]) ^ (length.astype(U64) * U64(0xA0761D6478BD642F)))
    order = np.lexsort((key, doc))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))
    number = np.empty(len(key), dtype=U64)
    number[order] = (np.arange(len(key)) - head).astype(U64)
    return mix(key + number * U64(SALT)), first


def cells_of(keys: np.ndarray, sizes: np.ndarray, level: int) -> list[np.ndarray]:
    """The key's cell in each third of a sketch of ``sizes`` cells."""
    third = (sizes // HASHES).astype(U64)
    return [(mix(keys ^ U64(SALT + 977 * level + i)) % third + U64(i) * third).astype(np.int64) for i in range(HASHES)]


def check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ U64(0xC2B2AE3D27D4EB4F))


class Sketches(NamedTuple):
    """Sketches of equal size, a row each: number of keys, and by cell counts, XORs of keys and sums of check values."""

    keys: np.ndarray
    count: np.ndarray
    xor: np.ndarray
    total: np.ndarray

    def take(self, rows) -> Sketches:
        return Sketches(*(x[rows] for x in self))

    def minus(self, other: Sketches) -> Sketches:
        return Sketches(self.keys - other.keys, self.count - other.count, self.xor ^ other.xor, self.total - other.total)


def sketched(keys: np.ndarray, first: np.ndarray, level: int = 0) -> Sketches:
    """A sketch of each set ``keys[first[i]:first[i + 1]]``."""
    n, size, many = len(first) - 1, CELLS * GROWTH**level, np.diff(first)
    keys = keys[first[0] : first[-1]]
    at = np.repeat(np.arange(n) * size, many)
    count, xor, total = np.zeros(n * size, np.int64), np.zeros(n * size, U64), np.zeros(n * size, U64)
    add = check(keys)
    for c in cells_of(keys, np.int64(size), level):
        where = at + c
        count += np.bincount(where, minlength=n * size)
        order = np.argsort(where, kind="stable")
        w = where[order]
        if len(w):
            heads = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            xor[w[heads]] ^= np.bitwise_xor.reduceat(keys[order], heads)
            total[w[heads]] += np.add.reduceat(add[order], heads)
    return Sketches(many, count.reshape(n, size), xor.reshape(n, size), total.reshape(n, size))


def peel(given: Sketches, level: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys recovered from subtracted sketches: row, key and sign (1: only in the first); and which rows were emptied."""
    n, size = given.count.shape
    count, xor, total = (x.copy().reshape(-1) for x in given[1:])
    rows, keys, signs = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    live = np.flatnonzero(np.abs(count) == 1)
    while len(live):
        live = live[np.abs(count[live]) == 1]
        s = count[live]
        pure = total[live] == check(xor[live]) * s.view(U64)
        r, k, s = live[pure] // size, xor[live[pure]], s[pure]
        if not len(r):
            break
        order = np.lexsort((k, r))
        r, k, s = r[order], k[order], s[order]
        one = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
        r, k, s = r[one], k[one], s[one]
        rows.append(r)
        keys.append(k)
        signs.append(s)
        add = check(k) * (-s).view(U64)
        spots = [r * size + spot for spot in cells_of(k, np.int64(size), level)]
        for where in spots:
            np.add.at(count, where, -s)
            np.bitwise_xor.at(xor, where, k)
            np.add.at(total, where, add)
        live = np.unique(np.concatenate(spots))
    left = (count.reshape(n, size) != 0).any(1) | (xor.reshape(n, size) != 0).any(1) | (total.reshape(n, size) != 0).any(1)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(signs), ~left


class Difference(NamedTuple):
    """Of each pair: likeness, cells that were enough; and all recovered digests with their pair and sign."""

    near: np.ndarray
    cells: np.ndarray
    row: np.ndarray
    key: np.ndarray
    sign: np.ndarray

    def lists(self, sign: int) -> pa.Array:
        """Digests of one sign, a list for each pair, ascending."""
        some = self.sign == sign
        order = np.lexsort((self.key[some], self.row[some]))
        row, key = self.row[some][order], self.key[some][order].view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(self.near) + 1)), pa.int32()), pa.array(key))


def pick(keys: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    many = np.diff(first)[rows]
    edges = np.concatenate([[0], np.cumsum(many)])
    return keys[np.repeat(first[rows] - edges[:-1], many) + np.arange(edges[-1])], edges


def difference(a: Sketches, b: Sketches, larger) -> Difference:
    """Compare two versions of each row by their sketches; ``larger(rows, level)`` gives both again, larger, for rows that did not peel."""
    n = len(a.keys)
    apart, cells = np.zeros(n, np.int64), np.zeros(n, np.int64)
    found: list[list[np.ndarray]] = [[], [], []]
    todo, level = np.arange(n), 0
    x, y = a, b
    while True:
        row, key, sign, done = peel(x.minus(y), level)
        keep = done[row]
        for out, v in zip(found, (todo[row[keep]], key[keep], sign[keep]), strict=True):
            out.append(v)
        cells[todo[done]] = CELLS * GROWTH**level
        todo, level = todo[~done], level + 1
        if not len(todo):
            break
        x, y = larger(todo, level)
    row, key, sign = (np.concatenate(v) for v in found)
    apart = np.bincount(row, minlength=n)
    both = a.keys + b.keys
    return Difference((both - apart) / np.maximum(both + apart, 1), cells, row, key, sign)


def encoded(s: Sketches) -> list[str]:
    """Each sketch as base64: number of keys, counts, XORs and sums, little-endian."""
    parts = np.concatenate([s.keys[:, None].astype("<i8").view("<u8"), s.count.astype("<i8").view("<u8"), s.xor, s.total], axis=1).astype("<u8")
    return [base64.b64encode(row.tobytes()).decode() for row in parts]


def decoded(prints: list[str]) -> Sketches:
    """Sketches read back from fingerprints."""
    rows = np.frombuffer(b"".join(map(base64.b64decode, prints)), "<u8").astype(U64).reshape(len(prints), -1)
    count, xor, total = (x.copy() for x in np.split(rows[:, 1:], 3, axis=1))
    return Sketches(rows[:, 0].astype(np.int64), count.view(np.int64), xor, total)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def placed_by(cuts: list[int], column: str):
    """How many of the ascending ``cuts`` are at most the column, by a search in blocks of their root."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    longs = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    before = F.size(F.filter(longs([b[0] for b in blocks]), lambda c: c <= F.col(column)))
    inside = F.element_at(F.array(*map(longs, blocks)), F.greatest(before, F.lit(1)))
    return F.when(F.col(column).isNull() | (before == 0), 0).otherwise((before - 1) * step + F.size(F.filter(inside, lambda c: c <= F.col(column))))


def in_turn(docs: DataFrame, parts: int) -> DataFrame:
    """Documents in ascending order within groups ``part``; each group ends with the next one's first document (``extra``)."""
    cuts = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (10 * parts)) if parts > 1 else []
    placed = docs.withColumn("part", placed_by(sorted({int(c) for c in cuts}), "doc_id").cast("int")).withColumn("extra", F.lit(0))
    heads = placed.groupBy("part").agg(F.min_by(F.struct("doc_id", "text"), F.struct("doc_id", "text")).alias("head"))  # a row for each group
    there = placed.select("part").distinct()  # at most ``parts`` numbers, in one task; the texts stay where they are
    turn = there.select(F.col("part").alias("own"), F.lag("part").over(Window.orderBy("part")).alias("before"), F.max("part").over(Window.partitionBy(F.lit(0))).alias("last"))
    moved = heads.join(F.broadcast(turn), F.col("part") == F.col("own"))
    heads = moved.select(F.col("head.doc_id").alias("doc_id"), F.col("head.text").alias("text"), F.coalesce("before", "last").alias("part"), F.lit(1).alias("extra"))
    return placed.unionByName(heads)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "cells_edited", "cells_next", "only_before", "only_edited")
TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, cells_edited long, cells_next long, only_before array<long>, only_edited array<long>"
BLOCK_CHARS = 1_000_000


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row per document: fingerprints of it and its edited text, likeness to that and to the next document, digests that only one version has."""
    bounded_batches(docs.sparkSession)
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    parts = parts or max(1, parallelism(docs.sparkSession))
    turn = in_turn(picked, parts).repartition(parts, "part").sortWithinPartitions("part", "extra", "doc_id", "text")
    schema = pa.schema(list(zip(NAMES, TYPES, strict=True)))

    def block(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all but the last text, which only follows."""
        n = len(ids)
        new = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        keys, first = paragraph_keys(texts)
        keys_e, first_e = paragraph_keys(new)
        own, changed = sketched(keys, first), sketched(keys_e, first_e)
        grown = lambda k, f, rows, level: sketched(*pick(k, f, rows), level)
        here = own.take(slice(0, n))
        e = difference(here, changed, lambda rows, level: (grown(keys, first, rows, level), grown(keys_e, first_e, rows, level)))
        x = difference(here, own.take(slice(1, n + 1)), lambda rows, level: (grown(keys, first, rows, level), grown(keys, first, rows + 1, level)))
        columns = [ids, [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in new], encoded(here), encoded(changed), e.near, x.near, e.cells, x.cells, e.lists(1), e.lists(-1)]
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], schema=schema)

    def run(batches):
        ids, texts, held, own = [], [], 0, None
        for batch in batches:
            for doc, text, part, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                if own is not None and part != own and ids:
                    raise AssertionError("a group ends with the next one's first document")
                own = part
                if ids and (extra or held > BLOCK_CHARS):
                    yield block(ids, [*texts, text])
                    ids, texts, held = [], [], 0
                if not extra:
                    ids.append(doc)
                    texts.append(text)
                    held += len(text)

    return turn.mapInArrow(run, COLUMNS)
