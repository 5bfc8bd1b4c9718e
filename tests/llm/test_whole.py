"""Training-data operators on inputs where a cut would lose results."""

import random

from cadenza.llm import media, ngram_join

from .test_operators import components, shingle_set


def test_op7_lists_of_several_buckets_are_one(spark, monkeypatch):
    """Version chains: each version is near its neighbours only; and templates; what pivots leave is counted by whole lists."""
    seen = []
    monkeypatch.setattr(ngram_join, "crowded", lambda members, *rest, f=ngram_join.crowded: (seen.append(members), f(members, *rest))[1])
    rng = random.Random(8)
    rows = []
    for length, step in ((14, 1), (24, 2), (60, 5), (150, 12), (300, 25)):
        words = [str(rng.randrange(10**9)) for _ in range(length + 24 * step)]
        rows += [(len(rows) + k, " ".join(words[k * step : k * step + length])) for k in range(24)]
    for step in (10, 60):  # templates: all agree in many segments, those of the second in too little to be linked
        common, words = ([str(rng.randrange(10**9)) for _ in range(n)] for n in (300, 60 + 24 * step))
        rows += [(len(rows) + k, " ".join([*common, *words[k * step : k * step + 60]])) for k in range(24)]
    want = components({d: shingle_set(t) for d, t in rows})
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    lists = [(r.list, r.key, r.kind) for r in seen[0].collect()]
    assert lists and len(lists) == len(set(lists))


def test_op10_payload_may_hold_the_mark_of_a_tag():
    for n in range(64, 3000, 64):
        for at in range(max(0, n - 200), n - 2):
            payload = bytearray(n)
            payload[at : at + 3] = b"TAG"
            assert media.parse(media.encode(bytes(payload)))["payload"] == payload
