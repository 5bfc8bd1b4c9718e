"""Quality classifier: a generalised additive model with pairwise interactions.

Features are counts and ratios of the whole text.  Each is cut into quantile bins;
cyclic boosting visits one feature after another and fits a shallow tree on its
bins to the current gradient, so that the sum of a feature's trees is one lookup
table.  The most useful pairs then get two-way tables the same way.  A score is the
sigmoid of a sum of table entries: additions of bins, over whole Arrow batches.

The model is fitted on at most ``SAMPLE`` labelled rows (chosen by a hash of the
id); everything else sees all rows.

Rules for odd input: a null or empty text has features 0 and is scored like any
other; labels that are null are left out, several labels of one id count by their
mean (1 from 0.5 on); without labels every score is 0.5; repeated rows get equal
scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textcore import U64, Texts, Words
from .workspace import bounded_batches, give_back

SAMPLE = 12_000
FEATURES = ("chars", "words", "word_len", "words_a_line", "upper", "digit", "mark", "pipe", "bang", "other_punct", "wide", "repeat_next", "distinct", "marked_word", "upper_word", "line_repeat", "stop_like", "sentence_end")
BINS, ROUNDS, PAIRS, PAIR_BINS, RATE = 32, 120, 6, 8, 0.15
SUB = 1 << 20

_class = np.zeros(256, dtype=np.uint8)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"%$#&*~^=<>{}[]\\/_@", b"|", b"!?", b".,;:'\"()-"), 1):
    _class[list(_chars)] = _i
_class[0x80:0xC0] = 8  # continuation
_class[0xC0:] = 7


def _by_doc(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[offsets])


def _distinct(words: Words, n: int) -> np.ndarray:
    """Number of different words of each text."""
    order = np.argsort(words.hash ^ (words.doc.astype(U64) * U64(0x9E3779B97F4A7C15)), kind="stable")
    h, d = words.hash[order], words.doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return np.bincount(d[new], minlength=n)


def features(texts: Texts) -> np.ndarray:
    """A row of FEATURES for each text."""
    return np.concatenate([_features(b) for _, b in texts.blocks(SUB)]) if len(texts) else np.zeros((0, len(FEATURES)))


def _features(texts: Texts) -> np.ndarray:
    n, data, offsets = len(texts), texts.data, texts.offsets
    kind = _class[data]
    count = [_by_doc(kind == i, offsets) for i in range(9)]
    size = np.diff(offsets)
    chars = size - count[8]
    words = Words(texts)
    n_words = np.diff(words.first)
    lines = _by_doc(data == 10, offsets) + 1
    at_word = lambda mask: np.bincount(words.doc[mask], minlength=n)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    last = kind[words.ends - 1] if len(words) else np.zeros(0, np.uint8)
    first = kind[words.starts] if len(words) else np.zeros(0, np.uint8)
    total_upper = np.concatenate([[0], np.cumsum(kind == 1)])
    length = words.ends - words.starts
    all_upper = (total_upper[words.ends] - total_upper[words.starts]) * 2 > length
    # a line's first word and the word before it: a repeated pair at line starts hints at repeated lines
    newline = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(words), dtype=bool)
    if len(words):
        opens[1:] = (newline[words.starts[1:]] != newline[words.starts[:-1]]) | (words.doc[1:] != words.doc[:-1])
    heads = np.flatnonzero(opens)
    line_again = np.zeros(n)
    if len(heads):
        pair = words.hash[heads] + words.hash[np.minimum(heads + 1, len(words) - 1)] * U64(3)
        doc = words.doc[heads]
        order = np.lexsort((pair, doc))
        same = (pair[order][1:] == pair[order][:-1]) & (doc[order][1:] == doc[order][:-1])
        line_again = np.bincount(doc[order][1:][same], minlength=n)
    ratio = lambda a, b: a / np.maximum(b, 1)
    return np.column_stack([
        np.log1p(chars), np.log1p(n_words), ratio(chars - lines, n_words), ratio(n_words, lines),
        ratio(count[1], chars), ratio(count[2], chars), ratio(count[3], chars), ratio(count[4], chars), ratio(count[5], chars), ratio(count[6], chars), ratio(count[7], chars),
        ratio(at_word(again), n_words), ratio(_distinct(words, n), n_words), ratio(at_word((last == 3) | (last == 4)), n_words), ratio(at_word(all_upper & (length > 1)), n_words),
        ratio(line_again, lines), ratio(at_word(length <= 3), n_words), ratio(at_word((last == 6) & (first != 6)), n_words),
    ])


class Gam:
    """Bin edges, lookup tables of features and pairs, and the intercept."""

    def __init__(self, edges, tables, pairs, pair_edges, pair_tables, intercept):
        self.edges, self.tables, self.pairs, self.pair_edges, self.pair_tables, self.intercept = edges, tables, pairs, pair_edges, pair_tables, intercept

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += t[np.searchsorted(e, x[:, j], side="right")]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[np.searchsorted(self.pair_edges[i], x[:, i], side="right"), np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float = 1.0) -> np.ndarray:
    """Leaf values over ordered bins of a tree that splits the best place, then each side again."""
    value = np.full(len(g), g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 2:
        return value
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge)
    gain[(hl < 1e-9) | (hr < 1e-9)] = -1
    cut = int(gain.argmax()) + 1
    if gain[cut - 1] <= g.sum() ** 2 / (h.sum() + ridge) + 1e-9:
        return value
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1, ridge), _tree(g[cut:], h[cut:], depth - 1, ridge)])


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Four leaves of the best cross of one cut in either feature, and their gain."""
    cg, ch = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    best, table = -1.0, np.zeros_like(g)
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            leaves = []
            for r0, r1, c0, c1 in ((0, a, 0, b), (0, a, b, -1), (a, -1, 0, b), (a, -1, b, -1)):
                s = lambda m: m[r1, c1] - m[r0, c1] - m[r1, c0] + m[r0, c0]  # noqa: B023, E731
                leaves.append((s(cg), s(ch)))
            if (gain := sum(x * x / (y + ridge) for x, y in leaves)) > best:
                v = [x / (y + ridge) for x, y in leaves]
                best, table = gain, np.empty_like(g)
                table[:a, :b], table[:a, b:], table[a:, :b], table[a:, b:] = v
    return table, best


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Boost the features in turn, then the pairs of most gain."""
    n = x.shape[1]
    quantiles = lambda v, k: np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1])) if len(v) else np.zeros(0)
    edges = [quantiles(x[:, j], BINS) for j in range(n)]
    pair_edges = [quantiles(x[:, j], PAIR_BINS) for j in range(n)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not len(y):
        return Gam(edges, tables, [], pair_edges, [], 0.0)
    share = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(share / (1 - share)))
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    small = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(pair_edges)]
    margin = np.full(len(y), intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(n):
            g, h = gradient()
            step = RATE * _tree(np.bincount(bins[j], g, len(tables[j])), np.bincount(bins[j], h, len(tables[j])), 2)
            tables[j] += step
            margin += step[bins[j]]
    shape = lambda i, j: (len(pair_edges[i]) + 1, len(pair_edges[j]) + 1)

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        r, c = shape(i, j)
        return np.bincount(small[i] * c + small[j], v, r * c).reshape(r, c)

    g, h = gradient()
    gains = {(i, j): _pair_tree(grid(i, j, g), grid(i, j, h))[1] for i in range(n) for j in range(i + 1, n)}
    pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    pair_tables = [np.zeros(shape(*p)) for p in pairs]
    for _ in range(ROUNDS // 4):
        for k, (i, j) in enumerate(pairs):
            g, h = gradient()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            pair_tables[k] += step
            margin += step[small[i], small[j]]
    return Gam(edges, tables, pairs, pair_edges, pair_tables, intercept)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts and labels of at most SAMPLE labelled rows (``keep``: a condition on ``doc_id``)."""
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).dropna()
    own = (own.filter(keep) if keep is not None else own).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    some = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)  # the documented bound of the fit
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(some), "doc_id").select("doc_id", "text", "label")  # at most SAMPLE rows of two numbers


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", keep: Column | None = None) -> Gam:
    names = [f"f{i}" for i in range(len(FEATURES))]
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), *((n, pa.float64()) for n in names)])

    def run(batches):
        for batch in batches:
            x = features(Texts.of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(x[:, i]) for i in range(len(names)))], schema=schema)
        give_back()

    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, labels, label_col, keep).mapInArrow(run, "doc_id long, label int, " + ", ".join(f"{n} double" for n in names)).toPandas()
    rows = rows.sort_values(["doc_id", *names]).reset_index(drop=True)  # bounded by SAMPLE; the same model on every run
    return fit(rows[names].to_numpy(float), rows["label"].to_numpy(float))


def scored(docs: DataFrame, model: Gam, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """All rows and columns, and the score (replacing a column of that name)."""
    from pyspark.sql import types as T

    names = [c for c in docs.columns if c != score_col]
    at = names.index(text_col)
    out = T.StructType([f for f in docs.schema.fields if f.name != score_col]).add(score_col, T.DoubleType())

    def run(batches):
        for batch in batches:
            x = features(Texts.of(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], [*names, score_col])
        give_back()

    bounded_batches(docs.sparkSession)
    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, out)
