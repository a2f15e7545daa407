import random
import tracemalloc

import numpy as np
import pandas as pd

from tiersmith.llm import langid
from tiersmith.llm.common import held_out

SYLLABLES = {"en": "the ing th er on an re nd ti es".split(), "de": "der sch ein ich ung ver keit ßü pf zu".split(), "es": "ción de la que ado os ra ñu mente el".split()}


def text(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


def plain_posteriors(scores, step):
    e = np.exp(scores)
    n, k = e.shape
    paths = np.zeros((n, k))
    alpha, beta = np.zeros((n, k)), np.ones((n, k))
    alpha[0] = e[0] / e[0].sum()
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ step) * e[t]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = step @ (e[t + 1] * beta[t + 1])
        beta[t] /= beta[t].sum()
    paths = alpha * beta
    return paths / paths.sum(axis=1, keepdims=True)


def test_forward_backward_in_pieces_is_exact():
    model = langid.Crf(["a", "b", "c"])
    model.transitions = np.random.default_rng(1).normal(0, 1, (3, 3))
    sizes = np.array([1, 300, langid.PIECE, langid.PIECE + 1, 5, 700, 2])
    scores = np.random.default_rng(2).normal(0, 2, (sizes.sum(), 3))
    got, _ = model.posteriors(scores, sizes)
    at = 0
    for n in sizes:
        assert np.allclose(got[at: at + n], plain_posteriors(scores[at: at + n], np.exp(model.transitions)))
        at += n


def test_gradient_of_transitions_counts_pairs():
    model = langid.Crf(["a", "b"])
    model.transitions = np.array([[0.3, -0.2], [0.1, 0.4]])
    scores = np.random.default_rng(3).normal(0, 1, (4, 2))
    _, moves = model.posteriors(scores, np.array([4]), True)
    expected, total = np.zeros((2, 2)), 0.0
    for path in np.ndindex(2, 2, 2, 2):
        weight = np.exp(sum(scores[t, s] for t, s in enumerate(path)) + sum(model.transitions[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for a, b in zip(path, path[1:]):
            expected[a, b] += weight
    assert np.allclose(moves, expected / total)


def test_words_of_code_switched_text_get_their_labels(spark):
    rng = random.Random(5)
    texts = [(lang, langid.text_words(text(lang, 60, rng))) for lang in SYLLABLES for _ in range(60)]
    model = langid.Crf(sorted(SYLLABLES)).fit(langid.training_chains(texts, sorted(SYLLABLES)))
    words = langid.text_words(text("en", 30, rng) + " " + text("es", 30, rng))
    (_, found), = model.label_words([words])
    labels = [model.labels[i] for i in found.argmax(axis=1)]
    assert sum(x == "en" for x in labels[:30]) > 27 and sum(x == "es" for x in labels[30:]) > 27
    assert model.transitions.diagonal().min() > model.transitions[~np.eye(3, dtype=bool)].max()


def test_documents_and_odd_cases(spark, docs):
    rng = random.Random(6)
    rows = [(i, text(lang, 40, rng), lang) for i in range(240) for lang in [list(SYLLABLES)[i % 3]]]
    odd = [(900, None, "en"), (901, "", "de"), (902, "123 -- ² ½ _", "en"), (903, text("de", 20_000, rng), None), (904, rows[0][1], "en"), (904, rows[0][1], "en"), (None, rows[1][1], "de"), (906, "x" * 50_000, None)]
    df = docs(rows + odd).withColumnRenamed("n_chars", "lang_pred")
    model = langid.fit_crf(df)
    got = {}
    for r in df.select("doc_id", held_out().alias("h"), langid.language_column(model).alias("l")).select("doc_id", "h", "l.*").collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows) + len(odd)
    held = [got[i][0]["lang_pred"] == lang for i, _, lang in rows if got[i][0]["h"]]
    assert len(held) > 30 and sum(held) >= 0.97 * len(held)
    for i in (900, 901, 902):
        assert (got[i][0]["lang_pred"], got[i][0]["score"]) == ("und", 0)
    assert got[903][0]["lang_pred"] == "de" and len(got[904]) == 2 and 0 <= got[906][0]["score"] <= 1


def test_nothing_to_learn(spark, docs):
    df = docs([(1, "some words", None), (2, None, "en")])
    got = df.select(langid.language_column(langid.fit_crf(df)).alias("l")).collect()
    assert [r["l"]["lang_pred"] for r in got] == ["und", "und"]
    assert docs([]).select(langid.language_column(langid.fit_crf(docs([])))).count() == 0


def test_every_letter_of_a_long_run_counts(spark, docs):
    """Runs that differ in their middle only, as in scripts without spaces."""
    rng = random.Random(8)
    df = docs([(i, text(lang, 80, rng), lang) for i, lang in enumerate(["en", "de"] * 60)])
    model = langid.fit_crf(df)
    runs = [(lang, "x" * 8 + "".join(rng.choice(SYLLABLES[lang]) for _ in range(n)) + "x" * 8) for lang in ("en", "de") for n in (12, 40, 400, 30_000)]
    got = docs([(i, run) for i, (_, run) in enumerate(runs)]).select("doc_id", langid.language_column(model).alias("l")).collect()
    assert {r["doc_id"]: r["l"]["lang_pred"] for r in got} == {i: lang for i, (lang, _) in enumerate(runs)}
    assert "".join(langid.text_words("Ab" * 50_000 + " é")) == "ab" * 50_000 + "é"
    assert max(map(len, langid.text_words("Ab" * 50_000))) == langid._WIDTH


def test_memory_does_not_follow_the_words_of_a_batch(monkeypatch):
    """Four times the long texts in a batch take no more memory, and each keeps its own label."""
    monkeypatch.setattr(langid.F, "pandas_udf", lambda run, kind: lambda text: run)
    rng = random.Random(9)
    fit = [(lang, langid.text_words(text(lang, 60, rng))) for lang in SYLLABLES for _ in range(30)]
    label = langid.language_column(langid.Crf(sorted(SYLLABLES)).fit(langid.training_chains(fit, sorted(SYLLABLES))))
    some = [text("de", 5_000, rng), None, "", "12 ½", text("es", 7, rng), text("en", 5_000, rng), text("de", 1, rng) * 3, text("es", 1_500, rng)]
    whole, = label(iter([pd.Series(some * 5)]))
    monkeypatch.setattr(langid, "CHUNK_WORDS", 4_000)
    peaks = []
    for times in (5, 20):
        tracemalloc.start()
        got, = label(iter([pd.Series(some * times)]))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert got["lang_pred"].tolist() == whole["lang_pred"].tolist()[:8] * times
        assert np.allclose(got["score"], np.tile(whole["score"][:8], times))
    assert whole["lang_pred"].tolist()[:6] == ["de", "und", "und", "und", "es", "en"] and whole["lang_pred"][7] == "es"
    assert peaks[1] < 1.5 * peaks[0], peaks
