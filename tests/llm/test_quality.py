import random
import re

import numpy as np

from tiersmith.llm import pu_quality, quality_rules
from tiersmith.llm.common import held_out

EN = "the of and to in is it for on that with as stone river morning window garden paper letter silver quiet".split()
DE = "der die und zu den das von mit sich auf haus garten fluss morgen papier fenster brief silber ruhig".split()


def prose(words, n, seed):
    rng = random.Random(seed)
    out = [rng.choice(words) + ("" if rng.random() < 0.6 else rng.choice("abcdefgh")) for _ in range(n)]
    return " ".join(w.capitalize() + ". " if rng.random() < 0.08 else w for w in out)


def brute_repeats(words):
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i: i + 5]), []).append(i)
    return len({j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)})


def test_counts_against_brute_force():
    rng = random.Random(3)
    bins = list(dict.fromkeys(quality_rules.COMMON_WORDS))
    forms = {f: k for k, w in enumerate(bins) for f in (w, w.capitalize(), w.upper())}
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b ", "the ", "\n", "\t", "x# ", "é|", " ", "\x1c"]) for _ in range(rng.randrange(0, 90)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        got = quality_rules.text_counts(text, forms, len(bins))
        assert got[:5] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), brute_repeats(words))
        assert sum(got[5]) == len(text) and sum(got[6]) == len(words)
    assert quality_rules.text_counts(None, forms, len(bins))[:5] == (0, 0, 0, 0, 0)


def test_distance():
    a = np.array([[1, 1, 0], [0, 0, 5], [0, 0, 0], [2, 2, 0]])
    assert np.allclose(quality_rules.jensen_shannon(a, np.array([0.5, 0.5, 0])), [0, 1, 0, 0])


def test_junk_goes_and_prose_stays(spark, docs):
    rows = [(i, prose(EN if i % 2 else DE, 300, i), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, " ".join(w.upper() + "!!" for w in prose(EN, 300, 100).split()), "en"), (101, " ".join(w + "###" for w in prose(DE, 300, 101).split()), "de"),
             (102, " | ".join(prose(EN, 300, 102).split()), None), (103, None, "en"), (104, "", None), (105, "short text of a few words", "en"),
             (106, "again and again the same five words " * 30, "en"), (107, rows[0][1], None), (107, rows[0][1], None), (None, rows[1][1], "en")]
    got = {}
    for r in quality_rules.quality_rules(docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][0]["kept"] for i in range(60)) and all(r["kept"] for r in got[107] + got[None])
    assert not any(got[i][0]["kept"] for i in (100, 101, 102, 103, 104, 105, 106))
    assert not got[100][0]["base_failed"] and got[106][0]["base_failed"] and got[103][0]["n_words"] == 0


def test_rules_without_rows_or_languages(spark, docs):
    assert quality_rules.quality_rules(docs([])).count() == 0
    got = quality_rules.quality_rules(docs([(1, prose(EN, 50, 1)), (2, None)])).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True, False]


def test_non_negative_risk_separates_held_out():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 0.1, (900, pu_quality.N_FEATURES)) + 0.5
    bad = rng.normal(0, 0.1, (300, pu_quality.N_FEATURES)) + np.where(np.arange(pu_quality.N_FEATURES) < 20, 0.9, 0.5)
    unlabelled = np.concatenate([good[300:600], bad[:100]])
    model = pu_quality.PuModel().fit(good[:300], unlabelled, 0.75)
    x, y = np.concatenate([good[:100], bad[:100]]), np.repeat([1, 0], 100)
    model.calibrate(x, y, 0.75)
    assert (model.score(good[600:]) >= 0.7).mean() > 0.97 and (model.score(bad[100:]) < 0.7).mean() > 0.97


def test_classifier_on_tables(spark, docs):
    junk = [(1000 + i, " ".join([random.Random(i).choice(EN).upper() + "!!"] * 60)) for i in range(60)]
    rows = [(i, prose(EN, 80, i)) for i in range(240)] + junk + [(5000, None), (5001, ""), (None, prose(EN, 80, 7))]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 240, 2)] + [(1000 + i, 0, 0) for i in range(0, 60, 2)] + [(0, 1, 0), (None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    df = docs(rows).withColumnRenamed("source", "score")  # a clashing name
    model = pu_quality.fit_pu(df, labels)
    got = df.select("doc_id", held_out().alias("held_out"), pu_quality.score_column(model).alias("p")).collect()
    assert len(got) == len(rows) and all(0 <= r["p"] <= 1 for r in got)
    held = [(r["doc_id"] < 1000, r["p"] >= 0.7) for r in got if r["held_out"] and r["doc_id"] < 5000]
    assert sum(a == b for a, b in held) > 0.95 * len(held) > 30
    assert {r["doc_id"]: r["p"] for r in got}[5000] == 0
    again = pu_quality.fit_pu(df, labels)
    assert np.array_equal(model.weights[0], again.weights[0])


def test_classifier_where_every_text_is_labelled(spark, docs):
    junk = [(1000 + i, " ".join([random.Random(i).choice(EN).upper() + "!!"] * 60)) for i in range(60)]
    df = docs([(i, prose(EN, 80, i)) for i in range(240)] + junk)
    labels = df.selectExpr("doc_id", "if(doc_id < 1000, 1, 0) AS quality")
    model = pu_quality.fit_pu(df, labels)
    got = df.select("doc_id", held_out().alias("held_out"), pu_quality.score_column(model).alias("p")).collect()
    held = [(r["doc_id"] < 1000, r["p"] >= pu_quality.KEEP_SCORE) for r in got if r["held_out"]]
    assert model.constant is None and {a for a, _ in held} == {True, False}
    assert sum(a == b for a, b in held) > 0.95 * len(held) > 30
    assert pu_quality.fit_pu(df.where("doc_id < 1000"), labels.where("quality = 1")).constant == 1  # no other rows


def test_classifier_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for rows in ([], [(1, "some words"), (2, None)]):
        df = docs(rows)
        got = df.select("doc_id", pu_quality.score_column(pu_quality.fit_pu(df, none)).alias("p")).collect()
        assert sorted(r["p"] for r in got) == ([0, 1] if rows else [])
