import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tiersmith.llm import decontaminate as dc
from tiersmith.llm.common import Scratch

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans(dc.UPPER, dc.LOWER)


def split(text):
    return WORDS.findall((text or "").translate(LOW))


def brute(docs, items, width):
    windows = {}
    for item, text in items:
        w = split(text)
        k = min(width, len(w))
        for s in range(len(w) - k + 1) if w else ():
            windows.setdefault(tuple(w[s: s + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, held = split(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                found = windows.get(tuple(w[s: s + k]))
                if found:
                    hit.update(range(s, s + k))
                    held |= found
        names = sorted(str(x) for x in held if x is not None)
        out.append((doc, len(w), len(hit), len(held), names))
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in df.collect()), key=repr)


def items_table(spark, items, kind="long"):
    return spark.createDataFrame(items, f"item_id {kind}, text string, doc_id string, pos string")


def test_random_corpus_equals_brute_force(spark, docs):
    draw = random.Random(5)
    text = lambda n: " ".join(draw.choice("a b c the É.é X-x ß 9").strip() for _ in range(n))
    corpus = [(i, text(draw.randrange(0, 60))) for i in range(80)]
    items = [(i, text(draw.randrange(0, 9)), "x", "y") for i in range(30)]
    for width in (1, 2, 3, 5):
        found = dc.contamination(docs(corpus), items_table(spark, items), width=width)
        assert rows(found) == sorted(brute(corpus, [i[:2] for i in items], width), key=repr), width


def test_defined_cases(spark, docs):
    passage = " ".join(f"w{i}" for i in range(12))
    corpus = [(1, None), (2, ""), (3, " .,\n"), (4, f"Zed {passage.upper()} end"), (4, f"Zed {passage.upper()} end"), (None, passage),
              (5, "short one"), (6, "one short"), (7, "é É"), (8, passage.replace("w5", "w 5"))]
    items = [(9, passage, "", ""), (10, passage, "", ""), (10, "short one", "", ""), (None, "SHORT, one!", "", ""), (11, None, "", ""), (12, "...", "", ""),
             (13, "É", "", "")]
    found = rows(dc.contamination(docs(corpus), items_table(spark, items)))
    assert found == sorted(brute(corpus, [i[:2] for i in items], 10), key=repr)
    by_id = {r[0]: r for r in found}
    assert by_id[4] == (4, 14, 12, 2, ["10", "9"]) and by_id[5] == (5, 2, 2, 2, ["10"]) and by_id[7][2] == 1 and by_id[8][2] == 0
    assert len(found) == len(corpus)


def test_empty_tables(spark, docs):
    none, some = items_table(spark, []), items_table(spark, [(1, "a b", "", "")])
    assert rows(dc.contamination(docs([]), some)) == []
    assert rows(dc.contamination(docs([(1, "a b")]), none)) == [(1, 2, 0, 0, [])]


def test_beyond_the_broadcast_bound_and_very_long_texts(spark, docs, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    corpus = [(1, "the of " * 60_000 + "the the of x y z"), (2, "x y z the of the")] + [(i, "the of the") for i in range(3, 40)]
    items = [(1, "the the of x y", "", ""), (2, "of the of", "", ""), (3, "z the", "", "")]
    assert rows(dc.contamination(docs(corpus), items_table(spark, items), width=3)) == sorted(brute(corpus, [i[:2] for i in items], 3), key=repr)


def test_proximity(spark, docs):
    draw = random.Random(8)
    corpus = [(i, " ".join(draw.choice("abcdefg") for _ in range(50))) for i in range(20)]
    put = Scratch(spark, "test")
    index = dc.Index(docs(corpus), spark.createDataFrame([(c,) for c in "abcdefg"], "word string"), put)
    queries = dc.phrase_table([(1, "a b"), (2, "C d e"), (3, "f f"), (4, "a q")], index)
    names = {r.doc: r.doc_id for r in index.documents.collect()}
    for within in (2, 3, 5):
        found = {(r.phrase, names[r.doc], r.pos) for r in dc.proximity_matches(index, queries, within, put).collect()}
        expected = set()
        for q, wanted in ((1, {"a", "b"}), (2, {"c", "d", "e"}), (3, {"f"})):
            for doc, text in corpus:
                w = text.split()
                for end in range(len(w)):
                    if w[end] in wanted and wanted <= set(w[max(0, end - within + 1): end + 1]):
                        expected.add((q, doc, end + 1))
        assert found == expected


def test_query_is_native_and_hashes_items(spark):
    from tiersmith.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    df = QUERIES["op11_benchmark_decontamination"](spark, sf)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(*c).collect()]
    expected = {d: (n, h, i, hashlib.sha256(",".join(names).encode()).hexdigest(), h > 0)
                for d, n, h, i, names in brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"), 10)}
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()} == expected


@pytest.mark.parametrize("word", ["", "A", "É", "aÉB", "İ", "x9"])
def test_only_a_to_z_are_lowered(spark, word):
    assert spark.range(1).select(dc.lowered(F.lit(word)).alias("w")).first().w == word.translate(LOW)
