"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed trigram model learned from all training texts.  A state is a
context: a pair of words that was met at least ``LEAST_CONTEXT`` times, a word (or the
beginning of a text), or nothing.  A state has an arc for each word that followed it in
training, with log10 P(word | state) and the next state, and a failure arc to the state of
its last word (or of nothing), whose weight is the mass kept for words without an arc.

* P0(w) = (c(w) + 1) / (N + V + 1), add-one over the training tokens and one unknown.
* P(w | s) = (1 - k) c(s w) / c(s) + k P(w | s'), s' the state behind the failure arc.
* k depends on the length of s and the size class of c(s) (powers of two): the share of
  training tokens in contexts of that class whose n-gram was met once, the leave-one-out
  estimate of the mass of unseen words, at most ``MOST_FAILURE``.

The automaton is far larger than a task, so it is never collected.  Texts are packed in
chunks of bounded size; a chunk sends each bucket of the hash space its distinct words and
pairs with their training counts, once, as packed sorted arrays; a bucket adds them up and
answers each chunk in the chunk's own order.  A second round does so for triples, but only
for those whose pairs leave their count open.  So a chunk has exactly the states and arcs
that its texts can reach.  One left-to-right traversal carries the state; a chunk's texts
go side by side, and long ones in pieces, each of which reads the two words before it
first, as no state reaches further back.

N-grams are told apart by 64-bit hashes (no two of 10^8 n-grams are likely to share one).
Buckets are as many as the bytes of the texts ask for, ``BUCKET`` each; a bucket holds at
most one row of a chunk, so rows never outnumber the n-grams that they carry.

Rules for odd input: a null or empty text is one end token; a null id counts as empty
text for the split; texts of any length stay whole; repeated rows count as often as they
stand and each get a score; without training texts every probability is P0 of an empty
model, 1; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import CHUNK, ids_of, pack, unpack
from .textcore import U64, Texts, Words, mix
from .workspace import Workspace

MOST_FAILURE, LEAST_CONTEXT = 0.98, 2
CLASSES = 48
BUCKET = 8 << 20  # bytes of text whose n-grams a bucket holds
END, BEGIN = U64(0x1F83D9ABFB41BD6B), U64(0x5BE0CD19137E2179)
WORD, PAIR, TRIPLE, STATS = 0, 1, 2, 3
FOLDS, HELD = 7, 2
PIECE = 128  # tokens of a text that are traversed beside others


def held_out(doc: int | None) -> bool:
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % FOLDS == HELD


class Stream:
    """The token stream of a chunk: each text's words and an end; the context of a first word is BEGIN."""

    def __init__(self, texts: Texts, held: np.ndarray):
        words = Words(texts, lower=True)
        n = np.diff(words.first) + 1
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.token = np.full(self.first[-1], END)
        self.token[np.arange(len(words)) + words.doc] = words.hash
        context = np.empty_like(self.token)
        context[1:] = self.token[:-1]
        context[self.first[:-1]] = BEGIN
        self.doc = np.repeat(np.arange(len(n)), n)
        self.train = ~held[self.doc]
        self.opens = np.zeros(len(self.token), dtype=bool)
        self.opens[self.first[:-1]] = True
        self.word = mix(self.token ^ U64(0x3C6EF372FE94F82B))
        self.pair = mix(mix(context + U64(0x510E527FADE682D1)) ^ self.token)

    def triples(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the pair before each place and the token there (no place opens a text)."""
        return mix(mix(self.pair[at - 1] + U64(0x6A09E667F3BCC908)) ^ self.token[at])


def stream_of(row: dict) -> Stream:
    return Stream(unpack(row), np.array([held_out(d) for d in ids_of(row).to_pylist()], dtype=bool))


def deflate(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), "zstd", asbytes=True)


def inflate(blob: bytes, n: int, kind=np.int64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).reshape(-1).view(kind)


ASKED = "chunk long, kind int, bucket int, size long, hashes binary, counts binary, classes binary, met array<long>, once array<long>"
ASKED_SCHEMA = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("size", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary()), ("classes", pa.binary()), ("met", pa.list_(pa.int64())), ("once", pa.list_(pa.int64()))])


def by_bucket(chunk: int, kind: int, values: np.ndarray, counts: np.ndarray, classes: np.ndarray | None, buckets: int) -> list[tuple]:
    """Rows of ascending distinct hashes with their counts (and classes), one for each bucket of the hash space."""
    own = ((values >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
    edges = np.searchsorted(own, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        part = slice(edges[b], edges[b + 1])
        steps = np.diff(values[part], prepend=U64(0))
        rows.append((chunk, kind, int(b), len(steps), deflate(steps), deflate(counts[part].astype(np.int64)), None if classes is None else deflate(classes[part].astype(np.uint8)), None, None))
    return rows


def as_table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(ASKED_SCHEMA), ASKED_SCHEMA.types, strict=True)], schema=ASKED_SCHEMA)


def asked(packed: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's distinct words and pairs and their training counts, by bucket."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                stream = stream_of(row)
                for kind, grams in ((WORD, stream.word), (PAIR, stream.pair)):
                    values, places = np.unique(grams, return_inverse=True)
                    counts = np.bincount(places[stream.train], minlength=len(values))
                    yield from as_table(by_bucket(row["chunk"], kind, values, counts, None, buckets)).to_batches()

    return packed.mapInArrow(run, ASKED)


ANSWERED = "chunk long, kind int, bucket int, size long, counts binary, types long, tokens long, met array<long>, once array<long>"
ANSWERED_SCHEMA = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("size", pa.int64()), ("counts", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64()), ("met", pa.list_(pa.int64())), ("once", pa.list_(pa.int64()))])


def answer(rows: pa.Table) -> pa.Table:
    """Total training counts for each chunk's row of a bucket, in the row's order; and a row of the bucket's own figures."""
    kind, bucket = rows.column("kind")[0].as_py(), rows.column("bucket")[0].as_py()
    if kind == STATS:
        met, once = (np.array(rows.column(c).to_pylist(), np.int64).sum(0) for c in ("met", "once"))
        own = (None, kind, bucket, None, None, 0, 0, met.tolist(), once.tolist())
        return pa.table([pa.array([c], t) for c, t in zip(own, ANSWERED_SCHEMA.types, strict=True)], schema=ANSWERED_SCHEMA)
    sizes = rows.column("size").to_pylist()
    hashes = np.concatenate([np.cumsum(inflate(b.as_py(), n, U64), dtype=U64) for b, n in zip(rows.column("hashes"), sizes, strict=True)])
    counts = np.concatenate([inflate(b.as_py(), n) for b, n in zip(rows.column("counts"), sizes, strict=True)])
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    total = np.add.reduceat(counts[order], heads)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.repeat(total, np.diff(np.append(heads, len(order))))
    ends = np.cumsum(sizes)
    blobs = [deflate(back[e - s : e]) for e, s in zip(ends, sizes, strict=True)]
    met = once = None
    if kind == TRIPLE:
        classes = np.concatenate([inflate(b.as_py(), n, np.uint8) for b, n in zip(rows.column("classes"), sizes, strict=True)])[order[heads]]
        met = np.zeros(2 * CLASSES, np.int64)
        np.add.at(met, CLASSES + classes, total)
        once = np.bincount(CLASSES + classes[total == 1].astype(np.int64), minlength=2 * CLASSES)
        met, once = met.tolist(), once.tolist()
    n = len(blobs)
    columns = [[*rows.column("chunk").to_pylist(), None], [kind] * (n + 1), [bucket] * (n + 1), [*sizes, None], [*blobs, None], [None] * n + [int((total > 0).sum())], [None] * n + [int(total.sum())], [None] * n + [met], [None] * n + [once]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, ANSWERED_SCHEMA.types, strict=True)], schema=ANSWERED_SCHEMA)


def answered(wanted: DataFrame) -> DataFrame:
    return wanted.groupBy("bucket", "kind").applyInArrow(answer, ANSWERED)


def counts_of(answers: pa.Table, kind: int, places: np.ndarray) -> np.ndarray:
    """A chunk's answers of one kind, at the places of its distinct n-grams."""
    rows = sorted(((b, c, n) for k, b, c, n in zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "counts", "size")), strict=True) if k == kind), key=lambda r: r[0])
    return np.concatenate([inflate(c, n) for _, c, n in rows])[places] if len(places) else np.zeros(0, np.int64)


def size_class(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(count, 1)).astype(np.int64), CLASSES - 1)


class Counts:
    """By token: training counts of itself, of its pair, of the word and of the pair before it."""

    def __init__(self, stream: Stream, answers: pa.Table, begins: int):
        self.words, self.w = np.unique(stream.word, return_inverse=True)
        self.pairs, self.p = np.unique(stream.pair, return_inverse=True)
        self.word, self.pair = counts_of(answers, WORD, self.w), counts_of(answers, PAIR, self.p)
        self.context, self.context2 = np.empty_like(self.word), np.empty_like(self.pair)
        self.context[1:], self.context2[1:] = self.word[:-1], self.pair[:-1]
        self.context[stream.opens], self.context2[stream.opens] = begins, 0
        in_state = self.context2 >= LEAST_CONTEXT
        alone = stream.train & (self.pair == 1)  # its pair is met here only, and so is the triple
        self.triple = (in_state & alone).astype(np.int64)
        self.open = np.flatnonzero(in_state & (self.pair > 0) & ~alone)


def triples_of(stream: Stream, c: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct triples whose count is open: hashes, a place of each among ``c.open``, and each open place's number."""
    values, at, places = np.unique(stream.triples(c.open), return_index=True, return_inverse=True)
    return values, at, places


def asked_next(stream: Stream, c: Counts, chunk: int, buckets: int) -> pa.Table:
    """A chunk's triples of open count by bucket, and a row of what its tokens tell of the failure weights."""
    values, at, places = triples_of(stream, c)
    counts = np.bincount(places[stream.train[c.open]], minlength=len(values))
    rows = by_bucket(chunk, TRIPLE, values, counts, size_class(c.context2[c.open][at]), buckets)
    known = stream.train & (c.context > 0)
    one = size_class(c.context[known])
    alone = stream.train & (c.triple == 1)
    two = size_class(c.context2[alone])
    met = np.concatenate([np.bincount(one, minlength=CLASSES), np.bincount(two, minlength=CLASSES)])
    once = np.concatenate([np.bincount(one[c.pair[known] == 1], minlength=CLASSES), np.bincount(two, minlength=CLASSES)])
    return as_table([*rows, (chunk, STATS, -1 - chunk % 64, 0, None, None, None, met.tolist(), once.tolist())])


def failure_weights(met: np.ndarray, once: np.ndarray) -> np.ndarray:
    """By length of the context (one word, two) and size class."""
    k = np.full(2 * CLASSES, MOST_FAILURE)
    some = met > 0
    k[some] = np.clip(once[some] / met[some], 1 - MOST_FAILURE, MOST_FAILURE)
    return k.reshape(2, CLASSES)


class Automaton:
    """States and arcs that a chunk's texts can reach.

    State 0 is nothing, 1 the beginning of a text, 2 on the words, then the pairs.  ``arcs``
    are sorted numbers state * words + word with ``weight`` and ``target``; state 0 has an arc
    for every word (``weight0``, ``target0``); ``fail`` and ``behind`` are the failure arcs.
    """

    def __init__(self, stream: Stream, c: Counts, failure: np.ndarray, n: int, v: int, begins: int):
        w, p, size = c.w, c.p, len(c.words)
        self.w, self.size = w, size
        first_w, first_p = np.empty(size, np.int64), np.empty(len(c.pairs), np.int64)
        first_w[w[::-1]], first_p[p[::-1]] = np.arange(len(w))[::-1], np.arange(len(p))[::-1]
        word, pair = c.word[first_w], c.pair[first_p]
        p0 = (word + 1) / (n + v + 1)
        self.weight0, self.target0 = np.log10(p0), np.where(word > 0, 2 + np.arange(size), 0)
        k1 = np.where(c.context > 0, failure[0][size_class(c.context)], 1.0)
        p1 = (1 - k1) * c.pair / np.maximum(c.context, 1) + k1 * p0[w]
        after = np.where(c.pair >= LEAST_CONTEXT, 2 + size + p, self.target0[w])
        source1 = np.empty_like(w)
        source1[1:] = 2 + w[:-1]
        source1[stream.opens] = 1
        one = first_p[pair > 0]
        two = np.flatnonzero(c.triple)
        k2 = failure[1][size_class(c.context2[two])]
        p2 = (1 - k2) * c.triple[two] / c.context2[two] + k2 * p1[two]
        arcs = np.concatenate([source1[one] * size + w[one], (2 + size + p[two - 1]) * size + w[two]])
        self.arcs, rank = np.unique(arcs, return_index=True)
        self.weight, self.target = np.log10(np.concatenate([p1[one], p2]))[rank], np.concatenate([after[one], after[two]])[rank]
        count = np.concatenate([[1, begins], word, pair])
        self.fail = np.concatenate([[0.0], np.log10(failure[0][size_class(count[1 : 2 + size])]), np.log10(failure[1][size_class(pair)])])
        self.behind = np.concatenate([np.zeros(2 + size, np.int64), self.target0[w[first_p]]])
        self.start = 1 if begins else 0

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and log10 probabilities: along the arc, or down failure arcs until there is one."""
        score, target = np.zeros(len(state)), np.empty_like(state)
        left = np.arange(len(state))
        while len(left):
            now, wanted = state[left], word[left]
            key = now * self.size + wanted
            at = np.minimum(np.searchsorted(self.arcs, key), max(len(self.arcs) - 1, 0))
            hit = (self.arcs[at] == key) if len(self.arcs) else np.zeros(len(left), bool)
            found = left[hit]
            score[found] += self.weight[at[hit]]
            target[found] = self.target[at[hit]]
            ground = left[now == 0]
            score[ground] += self.weight0[word[ground]]
            target[ground] = self.target0[word[ground]]
            left = left[~hit & (now > 0)]
            score[left] += self.fail[state[left]]
            state[left] = self.behind[state[left]]
        return target, score

    def traverse(self, first: np.ndarray) -> np.ndarray:
        """log10 probability of each token, left to right within each text (texts begin at ``first``)."""
        length = np.diff(first)
        pieces = -(-length // PIECE)
        text = np.repeat(np.arange(len(length)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = first[:-1][text] + number * PIECE
        size = np.minimum(PIECE, first[1:][text] - start)
        order = np.argsort(-size, kind="stable")
        start, size, later = start[order], size[order], number[order] > 0
        out = np.empty(first[-1])
        state = np.where(later, 0, self.start)
        for back in (2, 1):  # the two words before a piece lead to its state
            state[later] = self.step(state[later], self.w[start[later] - back])[0]
        for t in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -t, side="left"))  # sizes descend: those longer than t
            state = state[:live]
            at = start[:live] + t
            state, out[at] = self.step(state, self.w[at])
        return out


def by_chunk(packed: DataFrame, answers: DataFrame, work, schema: str) -> DataFrame:
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(work, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """One row per document: held_out, counts, base_score and score; learned from the rows that are not held out."""
    spark = docs.sparkSession
    space = Workspace(spark, "lm")
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    packed = space.keep(pack(picked, chunk), "packed")
    buckets = max(1, -(-int(packed.agg(F.sum("bytes")).first()[0] or 0) // bucket))
    begins = picked.filter(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS != HELD).count()
    replies = space.keep(answered(asked(packed, buckets)), "answers")
    one = replies.filter((F.col("kind") == WORD) & F.col("chunk").isNull()).agg(F.sum("types"), F.sum("tokens")).first()  # two numbers
    v, n = int(one[0] or 0), int(one[1] or 0)
    answers = replies.filter("chunk is not null").select("chunk", "kind", "bucket", "counts", "size")

    def second(rows: pa.Table, given: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        stream = stream_of(row)
        return asked_next(stream, Counts(stream, given, begins), row["chunk"], buckets)

    more = space.keep(answered(by_chunk(packed, answers, second, ASKED)), "triples")
    figures = more.filter("chunk is null").select(F.posexplode(F.arrays_zip("met", "once")).alias("k", "x")).groupBy("k").agg(F.sum("x.met").alias("met"), F.sum("x.once").alias("once"))
    met, once = np.zeros((2, 2 * CLASSES))
    for r in figures.collect():  # two rows for each class
        met[r["k"]], once[r["k"]] = r["met"], r["once"]
    failure = failure_weights(met, once)
    answers = answers.unionByName(more.filter("chunk is not null").select("chunk", "kind", "bucket", "counts", "size"))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def traverse(rows: pa.Table, given: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        stream = stream_of(row)
        c = Counts(stream, given, begins)
        if len(c.open):
            c.triple[c.open] = counts_of(given, TRIPLE, triples_of(stream, c)[2])
        found = Automaton(stream, c, failure, n, v, begins).traverse(stream.first)
        size = len(stream.first) - 1
        add = lambda x: np.bincount(stream.doc, x, size)  # noqa: E731  in the order of the tokens
        columns = [ids_of(row), [held_out(d) for d in ids_of(row).to_pylist()], np.diff(stream.first), add(c.word > 0).astype(np.int64), np.full(size, n), add(np.log10((c.word + 1) / (n + v + 1))), add(found)]
        return pa.table([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, schema.types, strict=True)], schema=schema)

    return by_chunk(packed, answers, traverse, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
