"""The training-data operators against brute force on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cadenza.llm import bpe, chunks, fingerprint, licenses, lm, media, mixing, ngram_join, pii, quality, registry, skew, substring
from cadenza.llm.textcore import Texts, Words, sliding_argmin

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path(registry.TOKENIZER)


def corpus(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioublnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)] + ["The", "É", "漢字", "x" * 90]
    say = lambda n: " ".join(rng.choice(vocab) + ("\n" if rng.random() < 0.1 else "") for _ in range(n))
    texts = [say(rng.randint(1, 160)) for _ in range(50)]
    passage = say(60)
    texts += [say(30) + " " + passage + " " + say(30) for _ in range(8)]
    base = say(200).split(" ")
    for _ in range(10):  # near copies
        edit = list(base)
        for _ in range(rng.randint(1, 12)):
            edit[rng.randrange(len(edit))] = rng.choice(vocab)
        texts.append(" ".join(edit))
    texts += [texts[0]] * 5 + [texts[60]] * 3
    texts += [None, "", " \n\t ", "one", "one two", "one two", "ONE two", "a b c d e", "a b c d e f", "the " * 300, "0" * 5000, "x@" * 2000, "é" * 900]
    rows = [(i, t, "en", f"src{i % 3}" if i % 11 else None, 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (3, texts[3], "en", "src0", 0)]  # a row that is there twice


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def test_words_and_windows_of_the_array_tokeniser():
    texts = [r[1] for r in corpus()] + ["a\x0bb", "ab"]
    block = Texts.from_strings(texts)
    w = Words(block)
    assert [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends, strict=True)] == [x for t in texts for x in WORD.findall(t or "")]
    seen = {}
    for h, a, b in zip(w.hash.tolist(), w.starts, w.ends, strict=True):
        assert seen.setdefault(h, bytes(w.data[a:b])) == bytes(w.data[a:b])
    values = np.random.default_rng(1).integers(0, 4, 300).astype(np.uint64)
    assert all(a == i + int(values[i : i + 28].argmin()) for i, a in enumerate(sliding_argmin(values, 28)))


def test_op1_substring_dedup(docs, empty):
    rows = [(r.doc_id, WORD.findall(r.text or "")) for r in docs.collect()]
    count = Counter(tuple(w[k : k + 35]) for _, w in rows for k in range(len(w) - 34))
    want = Counter()
    for doc, w in rows:
        gone = set()
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    for size in (chunks.CHUNK, 3000):
        got = substring.dedup(docs.withColumnRenamed("n_chars", "hash"), chunk=size).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert sum(r[2] for r in want) > 600
    assert substring.dedup(empty).count() == 0
    text = substring.dedup(docs, with_text=True).filter("doc_id = 3").first()
    assert hashlib.sha256(text.kept_text.encode()).hexdigest() == text.kept_sha256


def kept_by_hand(rows):
    """(id, words, removed, digest) of (id, text) rows."""
    rows = [(d, WORD.findall(t or "")) for d, t in rows]
    count = Counter(tuple(w[k : k + 35]) for _, w in rows for k in range(len(w) - 34))
    for doc, w in rows:
        gone = {x for k in range(len(w) - 34) if count[tuple(w[k : k + 35])] > 1 for x in range(k, k + 35)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def test_op1_index_is_added_to_by_a_later_session(spark, docs, tmp_path):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "n " * 40), (None, "n " * 40)]
    path, size = str(tmp_path / "index"), 3000
    frame = lambda some, session: session.createDataFrame(some, "doc_id long, text string")
    with substring.Index.open(spark, path) as index:
        assert index.add(frame(rows[:30], spark), size) == [0] and index.add(frame(rows[30:50], spark), size, batches=2) == [1, 2]
        assert sorted(index.runs) == [(0, 1), (2, 2)]
        old = index.kept()
        assert Counter(map(tuple, old.collect())) == Counter(kept_by_hand(rows[:50]))
        names = index.database
    assert names not in [d.name for d in spark.catalog.listDatabases()]
    other = spark.newSession()
    (tmp_path / "index" / "runs" / "run-5-5-4").mkdir()  # what a cut-off run leaves behind
    with substring.Index.open(other, path) as index:
        assert sorted(index.runs) == [(0, 1), (2, 2)]
        assert index.add(frame(rows[50:], other), size) == [3]
        assert sorted(index.runs) == [(0, 3)]
        want = list(kept_by_hand(rows))
        assert Counter(map(tuple, index.kept().collect())) == Counter(want)
        assert Counter(map(tuple, index.kept([3]).collect())) == Counter(want[50:])


def test_op1_heavy_keys_are_joined_like_others(spark, docs, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 2)
    got = Counter(map(tuple, substring.dedup(docs, chunk=3000).collect()))
    assert got == Counter(kept_by_hand([(r.doc_id, r.text) for r in docs.collect()]))


def backoff_model(train):
    """P(word | history) of a trigram model by plain counters."""
    grams = [Counter(tuple(("<s>", *t)[k : k + n]) for t in train for k in range(len(t) + 2 - n)) for n in (1, 2, 3)]
    n, v = sum(map(len, train)), len({w for t in train for w in t})
    of = lambda h: len(train) if h == ("<s>",) else grams[len(h) - 1][h]
    state = lambda h: of(h) > 0 if len(h) == 1 else of(h) >= lm.LEAST_CONTEXT
    met, once = Counter(), Counter()
    for t in train:
        t = ("<s>", *t)
        for k in range(1, len(t)):
            for m in (1, 2):
                h = t[max(0, k - m) : k]
                if len(h) == m and state(h):
                    met[m, int(math.log2(of(h)))] += 1
                    once[m, int(math.log2(of(h)))] += grams[m][*h, t[k]] == 1

    def p(h, w):
        if not h:
            return (grams[0][(w,)] + 1) / (n + v + 1)
        if not state(h):
            return p(h[1:], w)
        size = len(h), int(math.log2(of(h)))
        k = min(0.98, max(0.02, once[size] / met[size])) if met[size] else 0.98
        return (1 - k) * grams[len(h)][*h, w] / of(h) + k * p(h[1:], w)

    return p, grams[0], n, v


def test_op2_lm_scores(docs, empty):
    rows = [(r.doc_id, [*WORD.findall(lower(r.text)), None]) for r in docs.collect()]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    p, uni, n, v = backoff_model([t for d, t in rows if not held[d]])
    for size, bucket in ((chunks.CHUNK, lm.BUCKET), (2500, 9000)):
        got = {r.doc_id: r for r in lm.score(docs.withColumnRenamed("lang", "kind"), chunk=size, bucket=bucket).collect()}
        for d, t in rows:
            r = got[d]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(t), sum(uni[(w,)] > 0 for w in t), n)
            assert math.isclose(r.base_score, sum(math.log10((uni[(w,)] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
            at = ["<s>", *t]
            assert math.isclose(r.score, sum(math.log10(p(tuple(at[max(0, k - 2) : k]), at[k])) for k in range(1, len(at))), rel_tol=1e-9)
    assert lm.score(empty).count() == 0


def test_op2_without_training_texts_and_without_ids(spark):
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    got = lm.score(spark.createDataFrame([(held, "a b a b")], "doc_id long, text string")).first()
    assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (True, 5, 0, 0, 0.0, 0.0)
    got = lm.score(spark.createDataFrame([(None, "a"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.held_out, r.n_tokens, r.train_tokens) for r in got) == [(False, 1, 3), (False, 2, 3)]


def test_op2_probabilities_of_a_state_add_up_to_one():
    rng = random.Random(1)
    train = [[rng.choice("abcdefg") for _ in range(rng.randint(1, 30))] + [None] for _ in range(40)]
    p, uni, n, v = backoff_model(train)
    for h in ((), ("<s>",), ("a",), ("a", "b"), ("zz",)):
        assert math.isclose(sum(p(h, w) for (w,) in uni if w != "<s>") + p(h, "never met"), 1.0)


def test_op2_counts_beyond_32_bits():
    import pyarrow as pa

    values = np.array([5, 9, 2**63 + 1], np.uint64)
    rows = [r for chunk in (1, 2) for r in lm.by_bucket(chunk, lm.WORD, values, np.array([2**32, 1, 2**40]), None, 1)]
    out = lm.answer(lm.as_table(rows))
    assert lm.counts_of(out.slice(0, 1), lm.WORD, np.arange(3)).tolist() == [2**33, 2, 2**41]
    last = out.slice(2).to_pylist()[0]
    assert (last["types"], last["tokens"]) == (3, 2**33 + 2 + 2**41)
    assert isinstance(out, pa.Table) and (lm.size_class(np.array([2**33, 2**40])) == [33, 40]).all()


def test_op3_fingerprints(docs, empty):
    from collections import Counter as Bag

    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0], r[1]))
    near = lambda a, b: (lambda x, y: sum((x & y).values()) / sum((x | y).values()))(Bag(a.split("\n")), Bag(b.split("\n")))
    for parts in (1, 5):
        got = sorted(fingerprint.compare_next(docs, parts=parts).collect(), key=lambda r: r.doc_id)
        assert len(got) == len(rows)
        for r, (doc, text), (_, after) in zip(got, rows, [*rows[1:], rows[0]], strict=True):
            edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
            assert (r.doc_id, r.n_chars, r.edited_sha256) == (doc, len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert math.isclose(r.near_edited, near(text, edited)) and math.isclose(r.near_next, near(text, after))
        by_text = {t: r.fingerprint for r, (_, t) in zip(got, rows, strict=True)}
        assert all(by_text[t] == r.fingerprint for r, (_, t) in zip(got, rows, strict=True))
        assert len(set(by_text.values())) == len(by_text)
    assert fingerprint.compare_next(empty).count() == 0


def test_op3_sketches_grow_until_they_peel():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b, first = np.concatenate([keys[:600], keys[:600]]), np.concatenate([keys[300:], keys[:600]]), np.array([0, 600, 1200])
    x, y = fingerprint.sketched(a, first), fingerprint.sketched(b, first)
    larger = lambda rows, level: tuple(fingerprint.sketched(*fingerprint.pick(k, first, rows), level) for k in (a, b))
    out = fingerprint.difference(x, y, larger)
    assert out.lists(1).to_pylist() == [sorted(keys[:300].view(np.int64).tolist()), []] and out.lists(-1).to_pylist() == [sorted(keys[600:].view(np.int64).tolist()), []]
    assert out.near.tolist() == [300 / 900, 1.0] and out.cells[0] > 600 > out.cells[1]


def test_op3_fingerprints_can_be_subtracted(spark):
    """A few paragraphs that two versions do not share come out of the returned strings alone."""
    lines = [f"line {i}" for i in range(400)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines[:-3], "a", "b"]))]
    got = {r.doc_id: r for r in fingerprint.compare_next(spark.createDataFrame(rows, "doc_id long, text string"), parts=1).collect()}
    a, b = (fingerprint.decoded([got[i].fingerprint]) for i in (1, 2))
    row, key, sign, done = fingerprint.peel(a.minus(b))
    assert done.all() and (sign == 1).sum() == 3 and (sign == -1).sum() == 2
    keys, first = fingerprint.paragraph_keys([t for _, t in rows])
    assert set(key.tolist()) == set(keys[: first[1]].tolist()) ^ set(keys[first[1] :].tolist())
    assert math.isclose(got[1].near_next, 397 / 402)
    edited = rows[0][1][: -(len(rows[0][1]) // 2)] + rows[1][1][: len(rows[0][1]) // 2]
    mine = fingerprint.paragraph_keys([rows[0][1], edited])
    one, two = (set(mine[0][mine[1][i] : mine[1][i + 1]].view(np.int64).tolist()) for i in (0, 1))
    assert set(got[1].only_before) == one - two and set(got[1].only_edited) == two - one


def test_op4_quality(spark, empty):
    D = "/root/testdata/sf0.01"
    got = registry.op4_quality(spark, D)
    labels = spark.read.parquet(f"{D}/labels.parquet")
    m = got.join(labels, "doc_id").filter("held_out").toPandas()
    assert len(m) > 50 and (m.predicted == m.quality).mean() > 0.95
    assert got.count() == spark.read.parquet(f"{D}/documents.parquet").count()
    assert m.score.between(0, 1).all()
    model = quality.train(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    blank = quality.scored(spark.createDataFrame([(1, None), (2, "a b")], "doc_id long, text string"), model).collect()
    assert [r.score for r in blank] == [0.5, 0.5]
    odd = spark.createDataFrame([(1, None), (1, 1), (1, 0), (2, 0), (9, 1)], "doc_id long, quality int")
    kept = quality.training_rows(spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string"), odd, "quality", None).collect()
    assert sorted((r.doc_id, r.label) for r in kept) == [(1, 1), (2, 0)]


def test_op4_tables_learn_a_feature_and_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # an interaction only
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.9


def test_op5_mixing(docs, empty, spark):
    rates = {r.source: r for r in mixing.source_rates(docs).collect()}
    total = sum(r.chars for r in rates.values())
    weights = {s: math.sqrt(r.chars) for s, r in rates.items()}
    for s, r in rates.items():
        assert math.isclose(r.rate, weights[s] / sum(weights.values()) * total / r.chars)

    def draw(rate, doc):
        u = int(hashlib.md5(f"{mixing.SEED}|{doc}|1".encode()).hexdigest()[:13], 16) / 16**13
        k, p = 0, math.exp(-rate)
        c = p
        while c <= u:
            k += 1
            p *= rate / k
            c += p
        return k

    want = Counter()
    for r in docs.collect():
        for copy in range(1, draw(rates[r.source].rate, r.doc_id) + 1):
            want[r.doc_id, copy] += 1
    out = mixing.replicate(docs)
    got = out.collect()
    assert Counter((r.doc_id, r["copy"]) for r in got) == want
    assert set(out.columns) == {*docs.columns, "copy", "shuffle_key"}
    assert mixing.replicate(empty).count() == 0
    assert mixing.replicate(docs, weights={}).count() == 0
    only = mixing.replicate(docs, weights={"src1": 1.0})
    assert {r.source for r in only.select("source").distinct().collect()} == {"src1"}
    many = spark.range(300).selectExpr("id as doc_id", "'x' as text", "'s' as source")
    n = mixing.replicate(many, size=2000.0).count()  # a mean above one inversion's limit
    assert abs(n - 600_000) < 5 * math.sqrt(600_000)
    by_key = mixing.with_rates(docs, mixing.source_rates(docs).selectExpr("source as __source", "rate as __rate"), "source", "doc_id", few=0)
    assert Counter((r.doc_id, r["__rate"]) for r in by_key.collect()) == Counter((r.doc_id, rates[r.source].rate) for r in docs.collect())
    assert "__salt" not in by_key.columns


def test_op6_bpe(docs, empty):
    ranks = bpe.vocabulary(PATH)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())] += 1
    got = bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.encode_digests(empty, PATH, public_tokenizers.PATTERN).count() == 0
    clash = docs.limit(3).withColumnRenamed("lang", "n_tokens").selectExpr("cast(null as long) as doc_id", "text", "n_tokens")
    assert [r.doc_id for r in bpe.encode_digests(clash, PATH, public_tokenizers.PATTERN).collect()] == [None] * 3
    own = bpe.encoded(docs, PATH, public_tokenizers.PATTERN)
    codec = bpe.codec_of(PATH, public_tokenizers.PATTERN)
    for r in own.filter("doc_id % 7 = 0").collect():
        assert r.token_ids == enc.encode_ordinary(r.text or "")
        assert codec.decode([np.array(r.token_ids, np.int32)]) == [(r.text or "").encode()]


def test_op6_pieces_of_all_lengths_go_one_way():
    codec = bpe.Codec(PATH, public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(PATH), special_tokens={})
    rng = random.Random(4)
    alphabets = ("a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "=-_*#", " ", "éüß", "漢字語文本", "ที่การ", "0")
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in alphabets for n in (*range(1, 40), 399, 401, 4097, 20_000)] + ["ab" * 50_000, "a" * 100_000, "x\x00y"]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(3, 30))) for _ in range(3000)]
    found = codec.run(texts)
    assert all(d.tolist() == enc.encode_ordinary(t) for t, d in zip(texts, found, strict=True))
    assert codec.decode(found) == [t.encode() for t in texts]
    assert codec.decode([found[1][:0], found[2]]) == [b"", texts[2].encode()]


def test_op6_no_token_reaches_across_a_cut():
    codec = bpe.Codec(PATH, public_tokenizers.PATTERN)
    ranks = bpe.vocabulary(PATH)
    pieces = [t.encode() for t in ("xqzjkvw", "漢字語", "hello", "qqqq")]
    data, starts, first = codec.cut(pieces)
    text = data.astype(np.uint8).tobytes()
    for s in set(starts) - set(first):
        assert not any(text[a:b] in ranks for a in range(max(0, s - 12), s) for b in range(s + 1, s + 12) if not any(a < f < b for f in first))


def components(sets: dict) -> dict:
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def shingle_set(text):
    w = WORD.findall(lower(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_op7_ngram_join(docs, empty):
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    want = components(sets)
    got = ngram_join.join(docs.withColumnRenamed("lang", "key")).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(d, len(s), want[d]) for d, s in sets.items()}
    assert sum(d != c for d, c in want.items()) > 10
    assert ngram_join.join(empty).count() == 0
    kept = ngram_join.keep_first(docs)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) and kept.columns == docs.columns


@pytest.mark.parametrize("seed", range(3))
def test_op7_finds_every_link_of_random_sets(spark, seed):
    """Near copies at all sizes, around the threshold, in one crowd."""
    rng = random.Random(seed)
    rows = []
    for size in (5, 6, 7, 8, 9, 10, 11, 12, 14, 17, 20, 25, 40, 90):
        base = [str(rng.random()) for _ in range(size + 4)]
        for _ in range(8):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(text))
                text[k : k + 1] = rng.choice([[], [str(rng.random())], [text[k], str(rng.random())]])
            rows.append((len(rows), " ".join(text)))
    want = components({d: shingle_set(t) for d, t in rows})
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def row_components(rows):
    """The least id (or None) that each row of (id, text) reaches, rows being documents of their own."""
    found = components({k: shingle_set(t) for k, (_, t) in enumerate(rows)})
    return [min((rows[m][0] for m in found if found[m] == found[k] and rows[m][0] is not None), default=None) for k in range(len(rows))]


def odd_rows():
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (None, c), (None, c + " y"), (None, None), (None, ""), (7, c + " x"), (8, None), (9, "A " + a[3:]), (9, "other words"), (9, "other  words")]
    return rows + [(None, "p q r s t u v w"), (None, "p q r s t u v w"), (4, "one two"), (4, "one two")]


def test_op7_rows_of_one_id_and_of_none(spark):
    rows = odd_rows()
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(d, len(shingle_set(t)), r if shingle_set(t) else d) for (d, t), r in zip(rows, row_components(rows), strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_op7_keep_first_keeps_a_row_of_each_component(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, f"l{k}") for k, (d, t) in enumerate(rows)], "doc_id long, text string, key string")
    kept = [(r.doc_id, r.text) for r in ngram_join.keep_first(docs).collect()]
    part = components({k: shingle_set(t) for k, (_, t) in enumerate(rows)})
    of = lambda k: (part[k] if shingle_set(rows[k][1]) else ("blank", k))
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(of(k), []).append(k)
    assert len(kept) == len(groups)
    left = list(kept)
    for members in groups.values():
        least = min((rows[k][0] is None, rows[k][0] or 0) for k in members)
        fits = [rows[k] for k in members if (rows[k][0] is None, rows[k][0] or 0) == least and rows[k] in left]
        left.remove(fits[0])
    assert not left and ngram_join.keep_first(docs).columns == docs.columns


def test_op7_hub_of_copies(spark, monkeypatch):
    """Thousands of near copies of one text, and heavy keys from a few rows on."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", 50)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join([*base[: k % 100], f"own{k}", *base[k % 100 + 1 :]])) for k in range(1, 3000)] + [(0, " ".join(base)), (5000, "apart from all others here")]
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got == {d: 0 if d < 5000 else d for d, _ in rows}


def test_op7_plans_are_exact_and_chosen_by_cost():
    sizes = ngram_join.bands(10_000)[1:]
    apart = 2 * sizes * 20 // 180
    m, near = ngram_join.allocation(sizes, apart)
    assert (2 * m[near] > apart[near]).all() and (m[~near] > apart[~near]).all()
    assert near[apart == 1].all() and near[apart == 2].any() and not near[apart > 6].any()


def test_op8_licenses(spark, empty):
    files = spark.createDataFrame(
        [
            (1, "a/b/c/one.py", "x = 1"), (2, "a/b/LICENSE", "Released under the MIT License."), (3, "a/COPYING", "This work is licensed under the GNU General Public License, version 3."),
            (4, "a/d/two.py", "# Licensed under the Apache License, Version 2.0.\n" + "y = more words than the line above has " * 5), (5, "a/d/e/three.py", "the license of the day"), (6, "z/four.py", None), (7, None, "Released under the MIT License."), (8, "top.py", ""),
            (9, "a/b/c/one.py", "x = 1"), (10, "k/notes.txt", "Licensed under CC BY-NC 4.0."), (11, "k/five.txt", "word"),
        ],
        "doc_id long, path string, text string",
    )
    got = {r.doc_id: (r.license, r.inherited_from, r.is_license_file) for r in licenses.scan(files).collect()}
    assert got[1] == got[9] == ("MIT", "a/b", False) and got[2] == ("MIT", None, True)
    assert got[4] == ("Apache-2.0", None, False) and got[5] == ("GPL-3.0", "a", False)
    assert got[6] == got[8] == (None, None, False) and got[7][0] == "MIT" and got[11] == ("CC-BY-NC-4.0", "k", False)
    assert licenses.scan(empty.selectExpr("doc_id", "lang as path", "text")).count() == 0


def test_op8_evidence_is_an_exact_bound():
    idf = {t: 1.0 + len(t) / 3 for t in licenses.vocabulary(licenses.TEMPLATES)}
    weights = licenses.template_weights(licenses.TEMPLATES, idf)
    strong = set(licenses.evidence(weights, licenses.THRESHOLD))
    for name in licenses.TEMPLATES:
        weak = sum(w * w for (n, t), w in weights.items() if n == name and t not in strong)
        assert weak < licenses.THRESHOLD**2


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m[0].split("."))) or (kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits))) or (kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_op9_pii(spark, docs, empty):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab@@..-+019 4(é") for _ in range(60)) for _ in range(1500)]
    texts += ["pay 4111 1111 1111 1111 now", "4111 1111 1111 1112", "a@b.c.d@e.f", "call +1 (743) 555-3824.", "1.2.3.4.5.6.7.8", "256.1.1.1", "IBAN GB82 WEST 1234 5698 7654 32", "GB83 WEST 1234 5698 7654 32", "my ssn 078-05-1120", "part 078-05-1120", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.detect(rows).collect()}
    for d, t in enumerate(texts):
        base = base_spans(t or "")
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(got[d].spans.split(","))
        assert got[d].n_email == base.count("email") and got[d].n_card == base.count("card")
    last = len(texts) - 12
    assert got[last + 6].spans.endswith("iban:5:32") and "iban" not in got[last + 7].spans
    assert "ssn" in got[last + 8].spans and "ssn" not in got[last + 9].spans
    assert pii.detect(empty).count() == 0
    out = {r.doc_id: r.text for r in pii.redacted(rows).collect()}
    assert out[last] == "pay <card> now" and out[last + 10] is None
    assert pii.redacted(docs).columns == docs.columns


def test_op9_ibans_end_where_their_country_says(spark):
    found = {
        "IBAN DE89370400440532013000 BIC COBADEFF": "iban:5:27", "DE89 3704 0044 0532 0130 00 EUR 500": "iban:0:27", "GB82WEST12345698765432 IBAN": "iban:0:22",
        "XDE89370400440532013000": "", "DE89370400440532013000x": "", "DE88370400440532013000": "", "ZZ89370400440532013000": "",
    }
    assert {t: ",".join(x for x in pii.joined(pii.annotate(t)[1]).split(",") if x.startswith("iban")) for t in found} == found


def test_op9_context_of_four_languages_and_whole_words():
    for text in ("Sozialversicherungsnummer 123-45-6789", "numéro de sécurité sociale: 123-45-6789", "seguridad social 123-45-6789", "x Sozialversicherungsnummer lautet wie folgt 123-45-6789"):
        assert "ssn" in pii.joined(pii.annotate(text)[1]), text
    for text in ("pieza 123-45-6789", "123-45-6789", "unsocial 123-45-6789"):
        assert "ssn" not in pii.joined(pii.annotate(text)[1]), text


def test_op9_odd_rows(spark):
    rows = spark.createDataFrame([(None, "a@b.c", "x"), (1, "1" * 200_000 + " 4111111111111111", "x"), (1, "a@b.c", "x"), (1, "a@b.c", "x")], "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, r.n_email, r.n_card, r.spans) for r in pii.detect(rows).collect())
    assert got == [(0, 1, 0, "email:0:5"), (1, 0, 0, ""), (1, 1, 0, "email:0:5"), (1, 1, 0, "email:0:5")]


def test_op10_media(spark, docs, empty):
    for r, t in ((r, r.text) for r in docs.collect()):
        n, payload = media.padded(t)
        found = media.parse(media.encode(payload))
        assert found["payload"] == payload and len(payload) % 64 == 0 and len(payload) >= max(64, n)
        assert found["bad_crc"] == found["skipped"] == 0 and found["samples"] == 1152 * found["frames"] == 1152 * found["xing"]["frames"]
    got = {r.doc_id: r for r in media.media_columns(docs).collect()}
    r = next(x for x in docs.collect() if x.text and len(x.text) > 500)
    n, payload = media.padded(r.text)
    assert (got[r.doc_id].n_bytes, got[r.doc_id].payload_sha256, got[r.doc_id].tail_crc32) == (n, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert media.media_columns(empty).count() == 0


def test_op10_gives_back_every_payload():
    """Marks of tags, tables and frames at all places, and payloads of all sizes."""
    rng = random.Random(2)
    for n in [*range(64, 3008, 64), 20_032]:
        for mark in (b"TAG", b"ID3\x03\x00\x00", b"Xing", b"Info", b"\xff\xfb\x90\x00", b"\xff" * 64):
            for at in {0, n - 128, n - 64, *(rng.randrange(n) for _ in range(6))}:
                payload = bytearray(rng.randbytes(n)) if rng.random() < 0.5 else bytearray(n)
                payload[max(0, at) : max(0, at) + len(mark)] = mark
                payload = bytes(payload[:n])
                assert media.parse(media.encode(payload))["payload"] == payload


def test_op10_texts_with_marks(spark):
    texts = ["A TAG " + "x" * 70, "TAGTAG" * 500, "ID3" * 70, "Xing" * 333, "", None, "y" * 300_000]
    rows = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)] + [(None, "TAG" * 90, "m")], "doc_id long, text string, media_bytes string")
    for r in media.media_columns(rows).collect():
        n, payload = media.padded("TAG" * 90 if r.doc_id is None else texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def test_op10_resynchronises_after_damage():
    payload = bytes(range(256)) * 20
    data = bytearray(media.encode(payload))
    whole = media.parse(bytes(data))
    at = whole["offsets"][2]
    broken = bytes(data[:at]) + b"\xff\xff\x00garbage" + bytes(data[at:])
    found = media.parse(broken)
    assert found["payload"] == payload and found["skipped"] == 10 and found["frames"] == whole["frames"]
    data[whole["offsets"][1] + 10] ^= 1  # in the protected part
    found = media.parse(bytes(data))
    assert found["bad_crc"] == 1 and found["frames"] == whole["frames"] - 1
