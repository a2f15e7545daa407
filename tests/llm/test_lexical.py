import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tiersmith.llm import lexical

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERMS.findall((text or "").translate(LOW))


def brute(docs, items, k=10):
    held = [(i, Counter(split(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_docs, n_words = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for _, c in held for w in c)
    wanted = defaultdict(Counter)
    for item, text in items:
        wanted[item].update(split(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for (doc, counts), n in zip(held, sizes):
            m = 25 + (75 * n * n_docs) // n_words if n_words else 25
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 8 * m))
                        for w, q in query.items() if w in counts)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if no else doc, -s) for r, (s, no, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted(map(tuple, lexical.ranked_search(docs, items, **options).collect()), key=repr)


def items_table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def corpus(seed, docs, items):
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice(["the", "of", "Of", "é", "É", "x-ray", "a1", *map(str, range(30))]) for _ in range(n))
    return [(i, text(draw.randrange(0, 40))) for i in range(docs)], [(i, text(draw.randrange(0, 12))) for i in range(items)]


def test_random_corpus_equals_brute_force(spark, docs):
    rows, items = corpus(3, 200, 70)
    assert found(docs(rows), items_table(spark, items)) == brute(rows, items)


def test_small_tiles_blocks_and_exact_parts(spark, docs, monkeypatch):
    rows, items = corpus(4, 90, 25)
    items.append((99, "the " * 500 + "of 7"))
    for name, value in (("TILE_ITEMS", 3), ("TILE_DOCS", 7), ("TILE_TERMS", 2), ("BLOCK_BYTES", 200), ("EXACT", 1 << 36)):
        monkeypatch.setattr(lexical, name, value)
    assert found(docs(rows), items_table(spark, items), k=4) == brute(rows, items, 4)


def test_partial_sums_stay_below_the_bound():
    weights = np.array([26_000, 5, 17_000, 9_000], np.int64)
    row, term = np.array([0, 0, 0, 1]), np.array([0, 1, 3, 0])
    count = np.array([700_000, 3, 40, 2])
    products = lexical._products(row, term, count, weights, 2)
    total = np.zeros((2, 4), np.int64)
    for columns, matrix in products:
        assert (matrix @ (weights[columns].astype(float) * lexical.SCALE)).max() < lexical.EXACT
        total[:, columns] += matrix.astype(np.int64)
    assert total.tolist() == [[700_000, 3, 0, 40], [2, 0, 0, 0]]


def test_ties_nulls_and_repeats(spark, docs):
    rows = [(i, "same words here") for i in (50, 40, 40, None, *range(100, 140))] + [(1, None), (2, ""), (3, " ..."), (4, "other"), (None, "words")]
    items = [(1, "words"), (2, None), (3, "absent"), (None, "other"), (1, "here words"), (5, "")]
    out = found(docs(rows), items_table(spark, items))
    assert out == brute(rows, items)
    assert [r[2] for r in sorted((r for r in out if r[0] == 1), key=lambda r: r[1])] == [40, 40, 50, *range(100, 107)]


def test_empty_tables_and_very_long_text(spark, docs):
    assert found(docs([]), items_table(spark, [(1, "a")])) == []
    assert found(docs([(1, "a")]), items_table(spark, [])) == []
    rows, items = [(1, "a b " * 100_000), (2, "a"), (3, "c")], [(1, "a b b"), (2, "c")]
    assert found(docs(rows), items_table(spark, items)) == brute(rows, items)


@pytest.mark.parametrize("key", ["op13_ranked_search"])
def test_query(spark, key):
    from tiersmith.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(c, "text").collect()]
    assert sorted(map(tuple, QUERIES[key](spark, sf).collect()), key=repr) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
