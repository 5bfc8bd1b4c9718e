"""Byte-level BPE by recursive queries of an in-process DuckDB, one per worker.

A worker splits texts into pre-token pieces, and pieces into words where no token of the
vocabulary can reach across (no two-byte token there, and none that has the three bytes
around the place), so that no merge ever could.  Words it has not met become
token-position rows, which join the merge table; each step of a recursive query contracts
every word's pair of least rank, the leftmost first, until no pair is left.  A step takes
all places of that least rank, from left to right, that do not overlap: a merge cannot
make a pair of lower rank than its own, unless its token is ``risky`` (some merge with it
ranks lower than itself); of those a step takes the leftmost place only.  So the steps are
as many as a word has different ranks, not bytes, and words of any length go one way.

A word's rows of its last step, in order of position, are its ids; ordered aggregation
turns each document's ids, joined with the token table, into its bytes.

A piece that is one token as it stands is that token, as in the library.  The memo of
pieces and words met changes speed and memory only.

Rules for odd input: a null or empty text has no tokens; texts and pieces of any length
are encoded whole; rows of null id and repeated rows each get a result; an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .workspace import bounded_batches, give_back

BLOCK_CHARS = 2_000_000
WORD_BYTES = 250_000  # of new words in a query
MEMO, SMALL_MEMO = 400_000, 60_000  # pieces of a generation; the one before is kept too, and what is met again moves on

#: A token-position row is one number: word, position and id, in that order of significance.
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
#: {word} is the number of bits below the word's own.
CONTRACT = f"""
WITH RECURSIVE step(v, depth) AS (
  SELECT v, 0 FROM start
  UNION ALL (
    WITH pairs AS (
      SELECT v, depth, lead(v) OVER o AS w, lag(v) OVER o AS before, lead(v, 2) OVER o AS after FROM step WINDOW o AS (ORDER BY v)
    ), ranked AS (
      SELECT p.*, merged, risky FROM pairs p JOIN merges ON (((v & {ID_MASK}) << {ID_BITS}) | (w & {ID_MASK})) = pair WHERE (v >> {{word}}) = (w >> {{word}})
    ), least AS (
      SELECT v >> {{word}} AS word, min(merged) AS merged FROM ranked GROUP BY v >> {{word}}
    ), met AS (
      SELECT r.*, lag(w) OVER o AS prior, lead(v) OVER o AS later FROM ranked r JOIN least l ON (r.v >> {{word}}) = l.word AND r.merged = l.merged WINDOW o AS (ORDER BY v)
    ), runs AS (
      SELECT *, row_number() OVER (ORDER BY v) AS n FROM met WHERE prior = v OR later = w
    ), apart AS (
      SELECT v, w, before, after, depth, merged, risky FROM met WHERE prior IS DISTINCT FROM v AND later IS DISTINCT FROM w
      UNION ALL SELECT v, w, before, after, depth, merged, risky FROM (SELECT *, n - max(CASE WHEN prior = v THEN 0 ELSE n END) OVER (ORDER BY v) AS place FROM runs) r WHERE place % 2 = 0
    ), beside AS (
      SELECT v, merged, risky, after, CASE WHEN lag(w) OVER (ORDER BY v) = before THEN (before >> {ID_BITS} << {ID_BITS}) | merged ELSE before END AS before FROM apart
    ), sharp AS (
      SELECT v >> {{word}} AS word, min(v) AS stop FROM (
        SELECT v, merged, ((before & {ID_MASK}) << {ID_BITS}) | merged AS pair FROM beside WHERE risky AND (before >> {{word}}) = (v >> {{word}})
        UNION ALL SELECT v, merged, (merged << {ID_BITS}) | (after & {ID_MASK}) FROM beside WHERE risky AND (after >> {{word}}) = (v >> {{word}})
      ) a JOIN lower m ON m.pair = a.pair WHERE m.merged < a.merged
      GROUP BY v >> {{word}}
    ), taken AS (
      SELECT v, w, depth, merged FROM apart LEFT JOIN sharp ON (v >> {{word}}) = word WHERE stop IS NULL OR v <= stop
    )
    SELECT s.v, s.depth + 1 FROM step s SEMI JOIN least l ON (s.v >> {{word}}) = l.word ANTI JOIN (SELECT v FROM taken UNION ALL SELECT w FROM taken) t ON s.v = t.v
    UNION ALL SELECT ((v >> {ID_BITS}) << {ID_BITS}) | merged, depth + 1 FROM taken
  )
)
SELECT v, depth FROM step
"""
#: Bytes stand as the characters of the same number, from 256 on.
DECODE = "SELECT doc, array_to_string(list(txt ORDER BY pos), '') AS txt FROM given_ids JOIN tokens USING (id) GROUP BY doc"


ABOVE = {b: 256 + b for b in range(256)}


@functools.lru_cache(2)
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one process: the merge table in DuckDB, and pieces met so far (a bounded memo)."""

    def __init__(self, path: str, pattern: str, most: int = MEMO):
        self.most = most
        self.ranks = ranks = vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.names = {i: str(i) for i in ranks.values()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        merges = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        left, right, merged = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        risky = np.union1d(left[merged < left], right[merged < right])
        self.pairs = np.zeros(1 << 16, dtype=bool)
        self.pairs[[t[0] << 8 | t[1] for t in ranks if len(t) == 2]] = True
        self.triples = np.zeros(1 << 24, dtype=bool)
        self.triples[list({t[k] << 16 | t[k + 1] << 8 | t[k + 2] for t in ranks for k in range(len(t) - 2)})] = True
        config = {"threads": 1, "memory_limit": "128MB", "preserve_insertion_order": False, "temp_directory": f"{os.environ.get('SPARK_LOCAL_DIRS', '/tmp').split(',')[0]}/duckdb-{os.getpid()}"}
        self.db = duckdb.connect(config=config)  # spills where Spark's workers do
        given = pa.table({"pair": left << ID_BITS | right, "merged": merged, "risky": np.isin(merged, risky)})  # noqa: F841 (read by name)
        tokens = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "txt": [b.decode("latin-1").translate(ABOVE) for b in ranks]})  # noqa: F841
        self.db.execute("SET disabled_optimizers = 'compressed_materialization,join_filter_pushdown'")  # they cost more than they save on steps this small
        self.db.execute("CREATE TABLE merges AS FROM given; CREATE TABLE tokens AS FROM tokens")
        self.db.execute(f"CREATE TABLE lower AS SELECT pair, merged FROM merges WHERE merged < greatest(pair >> {ID_BITS}, pair & {ID_MASK})")  # what makes tokens risky

    def cut(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bytes, where a new word begins among them, and where each piece does."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = np.cumsum(length) - length
        x = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int32)
        piece = np.repeat(np.arange(len(pieces)), length)
        reach = np.zeros(len(x) + 1, dtype=bool)  # a token may reach across the left edge of a byte
        if len(x) > 1:
            reach[1:-1] = self.pairs[x[:-1] << 8 | x[1:]]
        if len(x) > 2:
            three = self.triples[x[:-2] << 16 | x[1:-1] << 8 | x[2:]] & (piece[:-2] == piece[2:])
            reach[1:-2] |= three
            reach[2:-1] |= three
        begins = ~reach[:-1]
        begins[first] = True
        return x, np.flatnonzero(begins), first

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not in the memo."""
        raw = [p.encode() for p in pieces]
        data = b"".join(raw)
        _, starts, first = self.cut(raw)
        edges = [*starts.tolist(), len(data)]
        own = np.searchsorted(starts, [*first.tolist(), len(data)]).tolist()
        if len(self.words) > self.most:
            self.words = {}
        words = self.words
        cut = {k: [data[edges[w] : edges[w + 1]] for w in range(own[k], own[k + 1])] for k, r in enumerate(raw) if own[k + 1] - own[k] > 1 and r not in self.ranks}
        parts = set().union(*cut.values())
        alone = {}  # pieces that are one word are kept in the memo of pieces only
        new = sorted(parts.difference(words).union(r for k, r in enumerate(raw) if k not in cut))
        some: list[bytes] = []
        held = 0
        for w in new:
            if some and held + len(w) > WORD_BYTES:
                alone.update(self.contract(some))
                some, held = [], 0
            some.append(w)
            held += len(w)
        if some:
            alone.update(self.contract(some))
        words.update((w, alone[w]) for w in parts if w in alone)
        for k, (p, r) in enumerate(zip(pieces, raw, strict=True)):
            self.memo[p] = b"".join([words[w] for w in cut[k]]) if k in cut else alone[r]

    def contract(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words, by the recursive query."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        lengths = np.where(whole >= 0, 1, np.fromiter(map(len, words), np.int64, len(words)))
        places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids = np.repeat(whole, lengths)
        ids[ids < 0] = self.byte_id[np.frombuffer(b"".join(w for w, i in zip(words, whole.tolist(), strict=True) if i < 0), np.uint8)]
        below = ID_BITS + int(lengths.max()).bit_length()
        self.db.register("start", pa.table({"v": np.repeat(np.arange(len(words)), lengths) << below | places << ID_BITS | ids}))
        step = self.db.sql(CONTRACT.format(word=below)).to_arrow_table()
        v, depth = step.column("v").to_numpy(), step.column("depth").to_numpy()
        last = np.zeros(len(words), depth.dtype)
        np.maximum.at(last, v >> below, depth)
        v = np.sort(v[depth == last[v >> below]])  # a word's rows of its last step, in order
        flat = (v & ID_MASK).astype(np.int32).tobytes()
        edge = (np.searchsorted(v, np.arange(len(words) + 1) << below) * 4).tolist()
        return {w: flat[lo:hi] for w, lo, hi in zip(words, edge[:-1], edge[1:], strict=True)}

    def run(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.split(t) for t in texts]
        if len(self.memo) > self.most:
            self.before, self.memo = self.memo, {}
        memo, before = self.memo, self.before
        new = set().union(*split).difference(memo)
        memo.update({p: before[p] for p in new.intersection(before)})
        if new := new.difference(memo):
            self.learn(sorted(new))
        return [np.frombuffer(b"".join([memo[p] for p in pieces]), np.int32) for pieces in split]

    def decode(self, documents: list[np.ndarray]) -> list[bytes]:
        """Bytes of each document's ids in order, by ordered aggregation."""
        sizes = [len(d) for d in documents]
        flat = np.concatenate([*documents, np.zeros(0, np.int32)]).astype(np.int32)
        self.db.register("given_ids", pa.table({"doc": np.repeat(np.arange(len(documents), dtype=np.int32), sizes), "pos": np.arange(len(flat), dtype=np.int32), "id": flat}))
        out = [b""] * len(documents)
        for doc, txt in self.db.execute(DECODE).fetchall():
            out[doc] = txt.encode("utf-16-le")[::2]
        return out


@functools.lru_cache(1)
def codec_of(path: str, pattern: str, most: int = MEMO) -> Codec:
    """The codec of this worker process, kept from task to task with what it has met."""
    return Codec(path, pattern, most)


def groups(column: pa.Array, rows: int = 128):
    """Runs of texts (null: empty) of about BLOCK_CHARS code points, with their first row; few rows are held as strings at a time."""
    at, texts, total = 0, [], 0
    for low in range(0, len(column), rows):
        for t in column.slice(low, rows).to_pylist():
            if total and total + len(t or "") > BLOCK_CHARS:
                yield at, texts
                at, texts, total = at + len(texts), [], 0
            texts.append(t or "")
            total += len(t or "")
    if texts:
        yield at, texts


def encode_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token count, digest of the ids and digest of the bytes they decode to."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        codec = codec_of(path, pattern)
        names = codec.names.__getitem__
        for batch in batches:
            for at, some in groups(batch.column(1)):
                found = codec.run(some)
                ids = [hashlib.sha256(",".join(map(names, d.tolist())).encode()).hexdigest() for d in found]
                back = [hashlib.sha256(b).hexdigest() for b in codec.decode(found)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), pa.array([len(d) for d in found], pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], schema=schema)
        give_back()

    bounded_batches(docs.sparkSession)
    picked = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", memo: int = SMALL_MEMO) -> DataFrame:
    """All rows and columns, and the ids of the text (a null text: no ids); an existing ``ids_col`` is replaced.

    ``memo`` changes speed and memory only; it is small here, as this stage shares its workers with others.
    """
    from pyspark.sql import types as T

    names = [c for c in docs.columns if c != ids_col]
    at_text = names.index(text_col)
    out = T.StructType([f for f in docs.schema.fields if f.name != ids_col]).add(ids_col, T.ArrayType(T.IntegerType()))

    def run(batches):
        codec = codec_of(path, pattern, memo)
        for batch in batches:
            for at, some in groups(batch.column(at_text)):
                found = codec.run(some)
                sizes = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(some)) for c in batch.columns), ids], [*names, ids_col])
        codec_of.cache_clear()
        del codec
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, out)
