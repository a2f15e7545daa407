"""Quality rules by distribution divergence (operator 6).

Every text is reduced in one pass to counts (words, symbols, repeats) and two
histograms: classes of characters and common words.  The references are the
summed histograms of each language, over all documents at first and then,
twice, over those within the median distance of it, so that junk does not
shape them.  A document's divergence is the Jensen-Shannon distance (base 2,
0 to 1) to the nearest language.  Minimum lengths guard both comparisons, and
the tolerance shrinks with the square root of the length, as the sampling
noise of a histogram does.

Defined cases: null or blank text has no words and fails the base rules; an
empty table gives an empty result; without any language value there is no
reference and the method keeps what passes the base rules; very long texts
are counted whole; repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.common import WORD, materialize

# Frequent function words of four languages, the bins of the word histogram.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "be", "by",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht",
    "le", "la", "les", "et", "des", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "pas", "au",
    "el", "los", "las", "y", "en", "un", "por", "con", "no", "su", "al", "del", "se", "lo", "como", "más",
)
SYMBOLS = "#*$%&|<>"
# Character classes by byte; a non-ASCII character counts by its first byte.
CLASSES = ("lower", "upper", "digit", "blank", "sentence", "mark", "other", "decoration", "bar", "shout")
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, *range(9, 14)]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[192:], _CLASS[128:192] = 6, len(CLASSES)
_CLASS[[ord(c) for c in "#*$%&"]], _CLASS[[ord(c) for c in "|<>"]], _CLASS[ord("!")] = 7, 8, 9
# Guards: characters (without white space) and words below which a histogram is not compared.
MIN_CHARS, MIN_WORDS = 200, 60
# Largest distance of the characters (plus a term for the noise of short texts) and of the words.
CHAR_DISTANCE, CHAR_NOISE, WORD_DISTANCE = 0.16, 1.2, 0.6
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, char_hist array<long>, word_hist array<long>"


def repeated_words(codes: np.ndarray, width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(codes) - width + 1
    if n < 2:
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(codes, width)
    keys = (windows.astype(np.uint64) * _MIX[:width]).sum(axis=1, dtype=np.uint64)
    order = np.argsort(keys, kind="stable")
    near = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if not len(near):
        return 0
    near = near[(windows[order[near]] == windows[order[near + 1]]).all(axis=1)]
    starts = np.zeros(n + width, np.int32)
    twice = np.unique(np.concatenate([order[near], order[near + 1]]))
    starts[twice] += 1
    starts[twice + width] -= 1
    return int((np.cumsum(starts) > 0).sum())


def text_counts(text: str | None, common: dict[str, int], bins: int) -> tuple:
    """The fields of ``STATS`` for one text."""
    text = text or ""
    words = WORD.findall(text)
    seen: dict[str, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    counts = np.bincount(codes, minlength=1)
    lines = [line for line in text.split("\n") if WORD.search(line)] if "\n" in text else []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(_CLASS[raw], minlength=len(CLASSES) + 1)[:-1]
    word_hist = np.zeros(bins + 1, np.int64)
    for form, k in common.items():
        code = seen.get(form)
        if code is not None:
            word_hist[k] += counts[code]
    word_hist[bins] = len(words) - word_hist[:bins].sum()
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(codes) if len(seen) < len(words) else 0, hist.tolist(), word_hist.tolist())


def document_counts(df: DataFrame, keep: Sequence[str], text: str = "text", common: Sequence[str] = COMMON_WORDS) -> DataFrame:
    """``keep`` and a struct ``stats`` (fields of ``STATS``) of every text; one narrow pass."""
    bins = list(dict.fromkeys(common))
    forms = {f: k for k, w in enumerate(bins) for f in (w, w.capitalize(), w.upper())}

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in STATS.split(", ")]
        for batch in batches:
            yield pd.DataFrame([text_counts(t, forms, len(bins)) for t in batch], columns=names)

    return df.select(*keep, F.pandas_udf(run, STATS)(F.col(text)).alias("stats"))


def jensen_shannon(hists: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Distance of each row of counts to a distribution; 0 for rows without counts."""
    total = hists.sum(axis=1, keepdims=True)
    p = hists / np.maximum(total, 1)
    m = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / m), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0.0)


def _summed(counted: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Shares of both histograms per language: element-wise sums, pre-aggregated
    before the shuffle; one row per (language, bin) reaches the driver."""
    pieces = counted.where(F.col("_lang").isNotNull()).select(
        "_lang", F.posexplode(F.concat("stats.char_hist", "stats.word_hist")).alias("bin", "n"))
    sums: dict[str, dict[int, int]] = {}
    for lang, k, n in pieces.groupBy("_lang", "bin").agg(F.sum("n")).collect():
        sums.setdefault(lang, {})[k] = n
    chars = len(CLASSES)
    out = {}
    for lang, bins in sorted(sums.items()):
        a = np.array([bins[i] for i in range(len(bins))], float)
        if a[:chars].sum() and a[chars:].sum():
            out[lang] = (a[:chars] / a[:chars].sum(), a[chars:] / a[chars:].sum())
    return out


def _distance_to(references: dict[str, tuple[np.ndarray, np.ndarray]]):
    """Distance of a text's characters to the reference of its own language."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lang, hist in batches:
            out = np.ones(len(lang))
            rows = np.stack(hist.to_list()) if len(lang) else np.zeros((0, len(CLASSES)))
            for key in set(lang) & references.keys():
                of = (lang == key).to_numpy()
                out[of] = jensen_shannon(rows[of], references[key][0])
            yield pd.Series(out)

    return F.pandas_udf(run, "double")


def language_references(counted: DataFrame, rounds: int = 2) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """References per ``_lang`` (see the module's text)."""
    usable = counted.where(~base_failed("stats.") & F.col("_lang").isNotNull())
    references = _summed(usable)
    for _ in range(rounds):
        far = usable.withColumn("_own", _distance_to(references)("_lang", "stats.char_hist"))
        middle = {r[0]: r[1] for r in far.groupBy("_lang").agg(F.percentile_approx("_own", 0.5, 10_000)).collect()}
        if not middle:
            break
        limit = F.create_map(*[F.lit(x) for pair in middle.items() for x in pair])
        references = _summed(far.where(F.col("_own") <= limit[F.col("_lang")])) or references
    return references


def base_failed(prefix: str = ""):
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    words, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 10) | (100 * repeated > 20 * words)


def quality_rules(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep``, the counts, ``char_distance`` and ``word_distance`` (to the
    nearest language), ``nearest`` language, ``base_failed`` and ``kept``.

    The counts are written once (they are small) and read twice: for the
    references and for the verdicts.
    """
    named = df.select(*keep, F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    counted = materialize(document_counts(named, [*keep, "_lang"], "_text"))
    references = language_references(counted)

    def verdicts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for words, chars, char_hist, word_hist in batches:
            n = len(words)
            best = np.full(n, np.inf)
            found = pd.DataFrame({"nearest": pd.Series([None] * n, dtype=object), "char_distance": np.zeros(n), "word_distance": np.zeros(n)})
            if n and references:
                a, b = np.stack(char_hist.to_list()), np.stack(word_hist.to_list())
                long_chars, long_words = chars.to_numpy() >= MIN_CHARS, words.to_numpy() >= MIN_WORDS
                for key, (ref_chars, ref_words) in references.items():
                    dc = np.where(long_chars, jensen_shannon(a, ref_chars), 0.0)
                    dw = np.where(long_words, jensen_shannon(b, ref_words), 0.0)
                    near = dc / CHAR_DISTANCE + dw / WORD_DISTANCE < best
                    best = np.where(near, dc / CHAR_DISTANCE + dw / WORD_DISTANCE, best)
                    found.loc[near, "nearest"] = key
                    found.loc[near, "char_distance"] = dc[near]
                    found.loc[near, "word_distance"] = dw[near]
            yield found

    udf = F.pandas_udf(verdicts, "nearest string, char_distance double, word_distance double")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = counted.withColumn("_v", udf("stats.n_words", "stats.word_chars", "stats.char_hist", "stats.word_hist"))
    tolerance = CHAR_DISTANCE + CHAR_NOISE / F.sqrt(F.greatest(F.col("word_chars"), F.lit(1)))
    fits = (F.col("char_distance") <= tolerance) & (F.col("word_distance") <= WORD_DISTANCE)
    return (judged.select(*keep, *[F.col(f"stats.{c}") for c in names], "_v.nearest", "_v.char_distance", "_v.word_distance")
            .withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & fits))
