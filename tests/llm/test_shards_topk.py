import random
import zlib

import numpy as np
import pytest

from tiersmith.llm import kd_shards, norm_topk


def test_shards_are_even_and_slots_gapless(spark, docs):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(0, 400), rng.choice(["en", "de", None]), f"s{rng.randrange(3)}", rng.choice([None, i % 50])) for i in range(600)]
    rows += [(1000 + i, "the same text", "en", "s0", 13) for i in range(400)] + [(7, None), (7, None), (None, "")]
    df = docs(rows).withColumnRenamed("source", "shard")
    got = kd_shards.kd_shards(df, ["doc_id", "text"], shards=8).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        by.setdefault(r["shard"], []).append(r)
    sizes = [sum(r["size"] for r in by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 3 * 401 + sum(sizes) * 0.01
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by.values())


def test_equal_texts_stay_together(spark, docs):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(30)) for _ in range(1500)]
    rows = [(i, t, "en", "s", 30) for i, t in enumerate(texts + texts[:700])]
    got = kd_shards.kd_shards(docs(rows), ["text"], shards=5, dims=["n_chars", "lang"]).collect()
    of = {}
    for r in got:
        of.setdefault(r["text"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values()) and {s for x in of.values() for s in x} == set(range(5))


def test_ties_of_one_row_split_by_number(spark, docs):
    got = kd_shards.kd_shards(docs([(1, "same", "en", "s", 4)] * 4000), ["doc_id"], shards=4).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [1000] * 4


def test_target_bytes_and_empty(spark, docs):
    df = docs([(i, "y" * 9) for i in range(100)])
    assert kd_shards.kd_shards(df, ["doc_id"], target_bytes=100).select("shard").distinct().count() == 10
    assert kd_shards.kd_shards(docs([]), ["doc_id"], shards=8).count() == 0
    assert kd_shards.kd_shards(docs([(1, "a")]), ["doc_id"], shards=8).count() == 1


def brute(vectors, k=10):
    ok = [(i, [int(x) for x in np.floor(1024 * np.array(v, float))]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ok):
        if q is not None and q % 100 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0, i) for j, (i, b) in enumerate(ok) if j != at]
            out += [(q, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda t: t[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["plain", "ties", "large", "few"])
def test_topk_equals_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(norm_topk, "BLOCK", 64)
    monkeypatch.setattr(norm_topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(norm_topk, "SEEDS", 40)
    rng = np.random.default_rng(5)
    n = 6 if case == "few" else 900
    v = rng.normal(0, 1, (n, 8)) * rng.gamma(1, 1, (n, 1))
    if case == "ties":
        v = np.round(v)
        v[: n // 3] = v[0]
    if case == "large":
        v *= 1e5
    vectors = [(int(i), [float(x) for x in row]) for i, row in zip(rng.permutation(n), v)]
    vectors += [(200, None), (300, [float("nan")] * 8), (400, [None] + [1.0] * 7), (None, [0.5] * 8), (100, list(vectors[0][1])), (500, [float("inf")] + [0.0] * 7), (600, [])]
    df = spark.createDataFrame([(i, x, 0) for i, x in vectors], "vec_id long, embedding array<double>, score int")
    got = sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in norm_topk.exact_topk(df).collect()), key=str)
    want = brute([(i, (list(x) + [0.0] * 8)[:8] if x is not None else None) for i, x in vectors])
    assert [(q, r, s) for q, r, _, s in got] == [(q, r, s) for q, r, _, s in want] and got == want


def test_topk_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (100, None)], "vec_id long, embedding array<float>")
    assert norm_topk.exact_topk(df).count() == 0
    one = spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<float>")
    assert norm_topk.exact_topk(one).count() == 0
