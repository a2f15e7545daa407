import random
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from tiersmith.llm import packing
from tiersmith.llm.common import json_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


def optimum(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j, level in enumerate(bins):
            if level + items[i] <= capacity and level not in bins[:j]:
                place(i + 1, bins[:j] + [level + items[i]] + bins[j + 1:])
        place(i + 1, bins + [items[i]])

    place(0, [])
    return best[0]


def checked(runs, counts, capacity):
    used = Counter()
    for pattern, copies in runs:
        assert sum(x * n for x, n in pattern) <= capacity
        for x, n in pattern:
            used[x] += n * copies
    assert used == Counter({x: n for x, n in counts.items() if n})
    return sum(copies for _, copies in runs)


def test_plan_is_optimal_on_small_sets():
    rng = random.Random(1)
    better = 0
    for _ in range(300):
        capacity = rng.choice([10, 20, 50, 100])
        items = sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 13))), reverse=True)
        counts = dict(Counter(items))
        bins = checked(packing.plan_packing(counts, capacity), counts, capacity)
        assert bins == optimum(items, capacity) >= packing.lower_bound(counts, capacity)
        better += bins < checked(packing.best_fit(counts, capacity), counts, capacity)
    assert better  # the search improves on best fit somewhere


def test_many_copies_stay_few_patterns():
    counts = {600: 70_000, 424: 70_000, 256: 40_000, 1024: 500_000, 7: 10}
    runs = packing.plan_packing(counts)
    assert checked(runs, counts, 1024) == packing.lower_bound(counts, 1024) and len(runs) < 50
    assert packing.plan_packing({}) == []


def test_best_fit_equals_one_by_one():
    rng = random.Random(2)
    for _ in range(100):
        items = sorted((rng.randrange(1, 60) for _ in range(80)), reverse=True)
        rooms = []
        for x in items:
            fits = [r for r in rooms if r >= x]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - x)
            else:
                rooms.append(100 - x)
        assert checked(packing.best_fit(dict(Counter(items)), 100), Counter(items), 100) == len(rooms)


def test_pack_texts(spark, docs):
    library = Tokenizer.from_file(PATH)
    texts = [(1, "a b c " * 900), (2, None), (3, ""), (4, "same text"), (4, "same text"), (None, "x<|endoftext|>y"), (6, "word " * 5000), *((i, "t " * (i * 13 % 700)) for i in range(10, 60))]
    pieces = packing.token_pieces(docs(texts).select("doc_id", "text"), ["doc_id"], json_bytes(PATH), ids=True)
    packed = packing.pack(pieces).cache()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        found = sorted(by_doc[doc], key=lambda r: r["piece"])
        if doc != 4:
            assert [i for r in found for i in r["ids"]] == ids and [r["piece"] for r in found] == list(range(len(found)))
            assert len(ids) > 1024 or len(found) == 1
            assert all(r["length"] == 1024 for r in found[1:]) and all(r["start"] == sum(x["length"] for x in found[:k]) for k, r in enumerate(found))
    assert len(by_doc[4]) == 2
    for rows in by_sequence.values():
        end = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    counts = Counter(r["length"] for rows in by_sequence.values() for r in rows)
    assert len(by_sequence) == sum(c for _, c in packing.plan_packing(dict(counts)))
    whole = {r["sequence_id"]: r["ids"] for r in packing.packed_sequences(packed).collect()}
    assert whole == {s: [i for r in sorted(rows, key=lambda r: r["offset"]) for i in r["ids"]] for s, rows in by_sequence.items()}


def test_empty_table(spark, docs):
    pieces = packing.token_pieces(docs([]).select("doc_id", "text"), ["doc_id"], json_bytes(PATH))
    assert packing.pack(pieces).count() == 0
