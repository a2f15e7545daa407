import random
from itertools import combinations

import pytest

from tiersmith.llm import jaccard_join


def token_set(text, width=4):
    words = (text or "").encode().lower().split()
    if len(words) >= width:
        return {tuple(words[i: i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def brute(rows, percent=85):
    sets = [token_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[find(i)] = min(names.get(find(i), doc), doc)
    return sorted((str(doc), len(s), str(names.get(find(i)) if s else doc)) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, families=4, size=25, shared=True):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([8, 30, 60, 150]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 25) + 1)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text + ([] if rng.random() < 0.8 else [word() for _ in range(rng.randrange(9))])))
    for _ in range(50):
        own = [word() for _ in range(rng.randrange(1, 80))]
        at = rng.randrange(len(own))
        rows.append(" ".join(own[:at] + (passage if shared else []) + own[at:]))
    rows += [" ".join(passage), " ".join(passage[:-1]), "a b c", "A  b\tC", "a b", "", " ", None, rows[0].upper(), rows[0], "x " * 4000, "x " * 5000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("rare", [2, 16])
def test_components_equal_brute_force(spark, docs, monkeypatch, rare):
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    rows = corpus(rare) + [(3, "repeated id with other words in it and more"), (3, "repeated id with other words in it and more"), (None, "no id but words that nobody else has"),
                           (None, "no id but words that nobody else has"), (70_000, corpus(rare)[5][1]), (None, corpus(rare)[5][1])]
    df = docs(rows).withColumnRenamed("source", "component_id").withColumnRenamed("lang", "node")
    got = jaccard_join.jaccard_components(df).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows)


def test_leftovers_of_a_star_are_compared(spark, docs):
    """A chain in which the first document links with few of a large group."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows = [(i, " ".join(words[i * 2: 200 + i * 2])) for i in range(60)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs(rows)).collect()}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("rare", [2, 16])
def test_sets_that_may_miss_nothing_link_with_larger_ones(spark, docs, monkeypatch, rare):
    """Nine words against the same with one more at either end: 6 of 7 shingles."""
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    rng = random.Random(rare)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts = []
    for copies in [1] * 30 + [25, 40]:
        core = [word() for _ in range(9)]
        texts.append(" ".join(core))  # links with all of the others, most of which link only through it
        for _ in range(copies):
            texts += [" ".join(core + [word()]), " ".join([word()] + core)]
    for n in range(4, 14):  # small sets of every size, each in one longer by a word
        core = [word() for _ in range(n)]
        texts += [" ".join(core), " ".join(core + [word()])]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = jaccard_join.jaccard_components(docs(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute(rows)
    small = [r["text"] for r in jaccard_join.keep_first(docs(rows)).collect()]
    assert len(small) == len({c for _, _, c in brute(rows)})


def test_sizes_with_a_larger_partner():
    for percent in (50, 85, 90, 99, 100):
        for n in range(1, 250):
            assert jaccard_join.larger(n, percent) == (100 * n >= percent * (n + 1))


def test_frequent_prefixes_and_regimes():
    import numpy as np

    for n in (7, 23, 24, 399, 400, 3000):
        tokens = np.sort(np.random.default_rng(n).integers(0, 2 ** 63, n).astype(np.uint64))
        need = jaccard_join.misses(n) + 1
        for low, groups in jaccard_join.GROUPS:
            if n >= low * 0.85:
                assert n - groups >= need or groups == 1  # a prefix worth enough exists
                assert len(jaccard_join._combinations(tokens, need, groups)) >= need


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (202, 200)]
    got = {r["node"]: r["root"] for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200, 202: 200}


def test_keep_first(spark, docs):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [(5, a), (2, a.upper()), (2, a.upper()), (9, a + " end"), (4, "else " * 3), (None, "else " * 3), (None, None), (8, None), (8, None), (11, "z y x w v u")]
    kept = jaccard_join.keep_first(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"]) == sorted([("2", a.upper()), ("4", "else " * 3), ("11", "z y x w v u")])
    assert kept.where("text is null").count() == 3
    assert jaccard_join.keep_first(docs([])).count() == 0


def test_sets_of_single_texts():
    for text in ("", None, "a", "a b", "A b c", "a b c d", "a b c d e"):
        (got,) = jaccard_join.token_sets([text])
        assert len(got) == len(token_set(text)) and (got < 2 ** 63).all()
    assert len({next(jaccard_join.token_sets([t])).tobytes() for t in ("a", "a b", "b a", "a b c", "a b c d")}) == 5
    assert next(jaccard_join.token_sets(["A  b\tC"])).tolist() == next(jaccard_join.token_sets(["a b c"])).tolist()
