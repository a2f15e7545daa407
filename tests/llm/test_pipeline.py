"""The pipeline against the operators' own brute-force answers on its input."""

import os

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tiersmith.llm import jaccard_join, langid, packing, pu_quality
from tiersmith.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "ngram_jaccard_join", "best_fit_packing"]
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = pu_quality.fit_pu(docs, labels)
    good = {i: t for i, t in rows.items() if pu_quality.features(t).any() and model.score(pu_quality.features(t)[None])[0] >= pu_quality.KEEP_SCORE}
    kept = docs.where(docs["doc_id"].isin(list(good)))
    crf = langid.fit_crf(kept, familiar=True)
    spoken = {}
    for i, t in good.items():
        words = langid.text_words(t)
        usual = crf.familiarity(np.mean([crf.evidence(langid.word_features([w]))[0] for w in words]), len(words)) if words else 0
        for _, p in crf.label_words([words]):
            if p.mean(axis=0).max() >= corpus_pipeline.MIN_LANGUAGE_SCORE and usual >= corpus_pipeline.MIN_FAMILIAR:
                spoken[i] = t
    sets = {i: next(jaccard_join.token_sets([t])).tolist() for i, t in sorted(spoken.items())}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            if 100 * min(len(sets[i]), len(sets[j])) >= 85 * max(len(sets[i]), len(sets[j])):
                shared = len(set(sets[i]) & set(sets[j]))
                if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                    old, new = max(group[i], group[j]), min(group[i], group[j])
                    group = {k: new if v == old else v for k, v in group.items()}
    survivors = {i for i in ids if group[i] == i}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == survivors and len(survivors) > 100
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY


def test_stages_keep_columns_and_take_odd_rows(spark, docs):
    odd = docs([(None, None), (1, ""), (1, ""), (2, "plain words of a text " * 30, "en", "s", 5)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns, name
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs([]), SF).count() == 0


def test_language_stage_drops_texts_in_no_known_language(spark, docs):
    known = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    strange = ["La casa del nostro vicino è stata venduta ieri mattina a una famiglia che viene dalla Toscana e che ha tre figli piccoli.",
               "Η γάτα κοιμάται πάνω στο τραπέζι της κουζίνας και ο σκύλος τρέχει στον κήπο.", "今天天气很好，我们一起去公园散步，然后回家吃饭。",
               "xqz wvk jjq qxv zzk wpq vvx kqj xzw qqk jxv", "12345 --- 678"]
    rows = known + [(1_000_000 + i, t, None, "s", len(t)) for i, t in enumerate(strange)]
    left = {r.doc_id for r in corpus_pipeline.language_id(spark, docs(rows), SF).collect()}
    assert not any(i >= 1_000_000 for i in left)
    spoken = {r[0] for r in known if r[1] and langid.text_words(r[1])}
    assert len(spoken - left) <= 0.01 * len(spoken)
