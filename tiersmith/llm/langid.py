"""Language identification by a linear-chain conditional random field (operator 8).

The words of a text (runs of letters, lower-cased; runs of over ``_WIDTH``
letters, as in scripts without spaces, are cut into pieces) form a chain.  A word's
label scores come from hashed features: its prefixes and suffixes, character
n-grams and the word itself; learned transitions link neighbours.  Posteriors
come from forward-backward, run over all texts of a batch side by side; a
text's language is the label with the largest expected number of words.

Training uses a bounded sample (``FIT_DOCS`` a language, ``FIT_WORDS`` words
of each, chosen by hashes) of texts with a known language.  Their segments
are strung together across languages, so that the chain learns when text
switches; weights are fitted by AdaGrad on the conditional likelihood.

Defined cases: null text or text without a letter is ``und`` with score 0;
null languages are not learned; without any training row every text with a
letter is ``und`` with score 0; texts are read whole; ties go to the first
label in sorted order; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.common import held_out, sample_key, tidied

_WIDTH = 16  # characters of a word that features look at
# Longer runs of letters are consecutive words, so every letter counts.
WORDS = re.compile(rf"[^\W\d_]{{1,{_WIDTH}}}")
FIT_DOCS, FIT_WORDS = 400, 160
BUCKETS = 1 << 16
EPOCHS, CHAIN = 3, 48
# Columns of :func:`word_features` with bigrams and trigrams; what an n-gram never seen counts.
NGRAMS, GRAM_PRIOR = slice(9, None), 0.02
# Words from which a text's own mean says how texts differ.
LONG_TEXT = 30
# Words of a chain that forward-backward steps through one by one; pieces run side by side.
PIECE = 128
# Words that are held at a time, with their scores, while a batch of texts is labelled.
CHUNK_WORDS = 100_000
_P = np.uint64(0x9E3779B97F4A7C15)


def _codes(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the words, padded; longer words keep both of their ends."""
    cut = [w if len(w) <= _WIDTH else w[: _WIDTH // 2] + w[-_WIDTH // 2:] for w in words]
    raw = np.array(cut, f"U{_WIDTH}").view(np.uint32).reshape(len(cut), _WIDTH)
    return raw.astype(np.uint64), np.fromiter(map(len, cut), np.int64, len(cut))


def _bucket(key: np.ndarray, kind: int) -> np.ndarray:
    h = (key + np.uint64(kind * 7919 + 1)) * _P
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(48)).astype(np.int32)  # BUCKETS = 2 ** 16


def word_features(words: Sequence[str]) -> np.ndarray:
    """Feature buckets of each word, one column a feature; -1 where it has none.

    Columns: the word, prefixes and suffixes of one to four letters, and its
    bigrams and trigrams with the word's edges."""
    chars, size = _codes(words)
    n = len(words)
    mix = np.uint64(0x100000001B3)
    columns = []
    whole = np.zeros(n, np.uint64)
    for i in range(_WIDTH):
        whole = np.where(i < size, whole * mix + chars[:, i] + np.uint64(1), whole)
        if i < 4:
            columns.append(np.where(i < size, _bucket(whole, 1 + i), -1))
    columns.append(_bucket(whole, 0))
    tail = np.zeros(n, np.uint64)
    rows = np.arange(n)
    for i in range(4):
        at = size - 1 - i
        tail = tail * mix + chars[rows, np.maximum(at, 0)] + np.uint64(1)
        columns.append(np.where(at >= 0, _bucket(tail, 5 + i), -1))
    edged = np.zeros((n, _WIDTH + 2), np.uint64)
    edged[:, 1:-1] = chars
    for width in (2, 3):
        for i in range(_WIDTH + 3 - width):
            inside = i + width <= size + 2
            if not inside.any():
                break
            key = edged[:, i]
            for j in range(1, width):
                key = key * mix + edged[:, i + j] + np.uint64(1)
            columns.append(np.where(inside, _bucket(key, 8 + width), -1))
    return np.stack(columns, axis=1)


class Crf:
    """Label scores of words by hashed features, and transitions between neighbours."""

    def __init__(self, labels: Sequence[str]):
        self.labels = list(labels)
        self.weights = np.zeros((BUCKETS + 1, len(self.labels)), np.float32)  # the last row stays 0
        self.transitions = np.zeros((len(self.labels), len(self.labels)))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), len(self.labels)), np.float32)
        for column in features.T:
            out += self.weights[column]  # -1 is the zero row
        return out

    def fit_familiar(self, texts: Sequence[tuple[int, Sequence[str]]]) -> Crf:
        """Learn what texts of the labels look like at all, from ``texts``
        (label index, words).

        A word's evidence is the mean log-frequency of its n-grams in the
        language that explains it best.  Half of the texts are judged by the
        n-grams of the others, both ways: that gives the mean and the spread of
        the evidence of words and of whole texts that were not learned from."""
        def counted(some: Sequence[tuple[int, Sequence[str]]]) -> np.ndarray:
            out = np.full((BUCKETS, len(self.labels)), GRAM_PRIOR, np.float32)
            for label in range(len(self.labels)):
                words = [w for lang, ws in some if lang == label for w in ws]
                if words:
                    grams = word_features(words)[:, NGRAMS]
                    out[:, label] += np.bincount(grams[grams >= 0], minlength=BUCKETS)
            return np.log(out / out.sum(axis=0)).astype(np.float32)

        judged = []
        for odd in (0, 1):
            self.grams = counted([t for i, t in enumerate(texts) if i % 2 == odd])
            judged += [self.evidence(word_features(list(words))) for i, (_, words) in enumerate(texts) if i % 2 != odd and len(words)]
        self.grams = counted(texts)
        words = np.concatenate(judged) if judged else np.zeros(1, np.float32)
        whole = np.array([x.mean() for x in judged if len(x) >= LONG_TEXT]) if judged else words
        self.usual, self.word_spread = float(words.mean()), float(words.std())
        self.text_spread = float(whole.std()) if len(whole) > 1 else self.word_spread
        return self

    def evidence(self, features: np.ndarray) -> np.ndarray:
        """Per word: the mean log-frequency of its n-grams in the language that explains it best."""
        grams = features[:, NGRAMS]
        held = (grams >= 0)[:, :, None]
        return (np.where(held, self.grams[grams], 0).sum(axis=1) / np.maximum(held.sum(axis=1), 1)).max(axis=1)

    def familiarity(self, mean: float, words: int) -> float:
        """How many standard deviations a text of so many words is above (or
        below: negative) the usual evidence."""
        return (mean - self.usual) / (np.hypot(self.text_spread, self.word_spread / np.sqrt(words)) + 1e-6)

    def posteriors(self, scores: np.ndarray, sizes: np.ndarray, count_moves: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of chains laid end to end and, on demand, the
        expected transitions (of chains of at most ``PIECE`` words).

        Chains are cut into pieces that run side by side.  The product of a
        piece's transition matrices carries the forward and backward vectors
        from piece to piece, so the result is that of the whole chain."""
        k = len(self.labels)
        sizes = sizes[sizes > 0]
        e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
        step = np.exp(self.transitions)
        parts = -(-sizes // PIECE)
        first = np.cumsum(parts) - parts  # first piece of each chain
        chain = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(len(chain)) - first[chain]
        starts = (np.cumsum(sizes) - sizes)[chain] + number * PIECE
        lengths = np.minimum(PIECE, sizes[chain] - number * PIECE)
        enter, leave = np.full((len(chain), k), 1.0 / k), np.ones((len(chain), k))
        if (parts > 1).any():
            product = self._products(e, step, starts, lengths, number)
            for j in range(1, int(parts.max())):
                at = first[parts > j] + j
                v = np.einsum("nk,nkl->nl", enter[at - 1], product[at - 1])
                enter[at] = v / v.sum(axis=1, keepdims=True)
            for j in range(int(parts.max()) - 2, -1, -1):
                at = first[parts > j + 1] + j
                v = np.einsum("nkl,nl->nk", product[at + 1], leave[at + 1])
                leave[at] = v / v.sum(axis=1, keepdims=True)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, opening = starts[order], lengths[order], (number == 0)[order, None]
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
        alpha, carry = np.empty((len(scores), k)), enter[order]
        for t in range(longest):
            m = active[t]
            at = starts[:m] + t
            a = carry[:m] @ step
            if t == 0:
                a = np.where(opening[:m], 1.0, a)
            a *= e[at]
            a /= a.sum(axis=1, keepdims=True)
            alpha[at] = carry[:m] = a
        moves, beta = np.zeros((k, k)), leave[order]
        for t in range(longest - 1, -1, -1):
            m = active[t]
            at = starts[:m] + t
            later = active[t + 1] if t + 1 < longest else 0
            if later:  # beta of these holds emission times beta of step t + 1
                if count_moves:
                    pair = alpha[at[:later]][:, :, None] * step[None] * beta[:later][:, None, :]
                    moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                beta[:later] = beta[:later] @ step.T
            p = alpha[at] * beta[:m]
            p /= p.sum(axis=1, keepdims=True)
            alpha[at] = p
            b = beta[:m] * e[at]
            beta[:m] = b / b.sum(axis=1, keepdims=True)
        return alpha, moves

    @staticmethod
    def _products(e: np.ndarray, step: np.ndarray, starts: np.ndarray, lengths: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Scaled product of the matrices of each piece's words."""
        k = len(step)
        product = np.broadcast_to(np.eye(k), (len(starts), k, k)).copy()
        for t in range(int(lengths.max())):
            on = np.flatnonzero(lengths > t)
            moved = product[on] @ step
            if t == 0:  # a chain's first word has no transition before it
                moved = np.where((number[on] == 0)[:, None, None], product[on], moved)
            moved *= e[starts[on] + t][:, None, :]
            product[on] = moved / moved.sum(axis=(1, 2), keepdims=True)
        return product

    def fit(self, chains: list[tuple[list[str], np.ndarray]], epochs: int = EPOCHS, seed: int = 5) -> Crf:
        """AdaGrad on batches of (words, label indexes)."""
        rng = np.random.default_rng(seed)
        codes, distinct = pd.factorize(np.array([w for words, _ in chains for w in words], dtype=object))
        features = word_features(list(distinct))
        ends = np.cumsum([len(words) for words, _ in chains])
        k = len(self.labels)
        seen, seen_moves = np.full(self.weights.shape, 1e-2, np.float32), np.full((k, k), 1e-2)
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 64)):
                at = np.concatenate([np.arange(ends[i] - len(chains[i][0]), ends[i]) for i in batch])
                rows = features[codes[at]]
                sizes = np.array([len(chains[i][0]) for i in batch])
                truth = np.concatenate([chains[i][1] for i in batch])
                found, moves = self.posteriors(self.emissions(rows), sizes, True)
                error = found.astype(np.float32)
                error[np.arange(len(at)), truth] -= 1
                flat, repeat = rows.ravel(), rows.shape[1]
                grad = np.zeros_like(self.weights)
                for j in range(k):
                    grad[:, j] = np.bincount(np.where(flat < 0, BUCKETS, flat), np.repeat(error[:, j], repeat), BUCKETS + 1)
                grad[-1] = 0
                grad = grad / len(at) + 1e-6 * self.weights
                seen += grad * grad
                self.weights -= 0.2 * grad / np.sqrt(seen) * (grad != 0)
                for chain in np.split(truth, np.cumsum(sizes)[:-1]):
                    np.subtract.at(moves, (chain[:-1], chain[1:]), 1)
                moves = moves / len(at) + 1e-4 * self.transitions
                seen_moves += moves * moves
                self.transitions -= 0.2 * moves / np.sqrt(seen_moves)
        return self

    def label_words(self, texts: Sequence[list[str]]) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the text, posteriors of its words), a bounded number of words at a time."""
        return ((i, found) for i, found, _ in self._judged(texts, False))

    def _judged(self, texts: Sequence[list[str]], familiar: bool) -> Iterator[tuple[int, np.ndarray, float]]:
        order = sorted((i for i, words in enumerate(texts) if words), key=lambda i: len(texts[i]))
        while order:
            some, n = [], 0
            while order and (not some or n + len(texts[order[-1]]) <= CHUNK_WORDS):
                some.append(order.pop())
                n += len(texts[some[-1]])
            codes, distinct = pd.factorize(np.array([w for i in some for w in texts[i]], dtype=object))
            scores, seen = [], []
            for part in np.array_split(distinct, len(distinct) // 20_000 + 1):
                features = word_features(list(part))
                scores.append(self.emissions(features))
                seen.append(self.evidence(features) if familiar else np.zeros(len(part)))
            sizes = np.array([len(texts[i]) for i in some])
            found, _ = self.posteriors(np.concatenate(scores)[codes], sizes)
            ends = np.cumsum(sizes)
            means = np.add.reduceat(np.concatenate(seen)[codes], ends - sizes) / sizes
            for i, p, mean, size in zip(some, np.split(found, ends[:-1]), means, sizes):
                yield i, p, self.familiarity(float(mean), int(size)) if familiar else 0.0


def text_words(text: str | None) -> list[str]:
    words = WORDS.findall(text.lower()) if text else []
    # Numerals such as fractions match the pattern but are no letters.
    return words if any(c.isalpha() for w in words[:1] for c in w) else [w for w in words if any(map(str.isalpha, w))]


def _portions(texts: Iterable[str | None]) -> Iterator[tuple[int, list[list[str]]]]:
    """Consecutive texts as (index of the first, words of each): together at most
    ``CHUNK_WORDS`` words, or a single longer text.  A word takes about ten times
    the memory of its letters, so a batch is not cut into words as a whole."""
    first, some, n = 0, [], 0
    for i, text in enumerate(texts):
        words = text_words(text)
        if some and n + len(words) > CHUNK_WORDS:
            yield first, some
            first, some, n = i, [], 0
        some.append(words)
        n += len(words)
    if some:
        yield first, some


def training_chains(texts: Sequence[tuple[str, Sequence[str]]], labels: Sequence[str], seed: int = 3) -> list[tuple[list[str], np.ndarray]]:
    """Segments of texts of random languages, strung together to chains of about ``CHAIN`` words."""
    rng = np.random.default_rng(seed)
    index = {lang: i for i, lang in enumerate(labels)}
    segments = []
    for lang, words in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(4, CHAIN))
            segments.append((index[lang], list(words[at: at + size])))
            at += size
    chains, words, marks = [], [], []
    for i in rng.permutation(len(segments)):
        lang, some = segments[i]
        words, marks = words + some, marks + [lang] * len(some)
        if len(words) >= CHAIN:
            chains.append((words, np.array(marks)))
            words, marks = [], []
    return chains + ([(words, np.array(marks))] if words else [])


def fit_crf(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_words: int = FIT_WORDS, familiar: bool = False) -> Crf:
    """Fit on documents with a language whose id is not held out; with
    ``familiar`` also what texts of these languages look like at all.

    The driver gets at most ``2 * fit_docs`` samples per language of at most
    ``fit_words`` words, taken from a place in the text given by the id."""
    usable = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    labels = sorted(counts)
    if not labels:
        return Crf([])

    def window(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for keys, texts in batches:
            out = []
            for key, text in zip(keys, texts):
                words = text_words(text)
                at = int(key * 7919) % max(1, len(words) - fit_words + 1)
                out.append(words[at: at + fit_words])
            yield pd.Series(out)

    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, fit_docs / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    drawn = (usable.where(sample_key() < share[F.col("lang")]).limit(2 * fit_docs * len(labels))
             .select("lang", F.pandas_udf(window, "array<string>")(place, "text").alias("words")))
    texts = sorted((r["lang"], tuple(r["words"])) for r in drawn.collect() if len(r["words"]))
    model = Crf(labels).fit(training_chains(texts, labels))
    return model.fit_familiar([(labels.index(lang), words) for lang, words in texts]) if familiar else model


def language_column(model: Crf, text: str | Column = "text", familiar: bool = False) -> Column:
    """Struct ``lang_pred``, ``score`` (share of the text's words, in
    expectation, that are in that language) for each text.

    The share is over the learned languages only, so a text in none of them has
    some share of one.  ``familiar`` adds the evidence against that: how many
    standard deviations its n-grams are more (or less: negative) usual than
    those of texts in the learned languages; 0 without words or training."""
    kind = "lang_pred string, score double" + ", familiar double" * familiar

    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores, usual = ["und"] * len(batch), [0.0] * len(batch), [0.0] * len(batch)
            if model.labels:
                for first, some in _portions(batch):
                    for i, p, seen in model._judged(some, familiar):
                        share = p.mean(axis=0)
                        best = int(share.argmax())
                        names[first + i], scores[first + i], usual[first + i] = model.labels[best], min(1.0, float(share[best])), seen
            yield pd.DataFrame({"lang_pred": names, "score": scores} | ({"familiar": usual} if familiar else {}))

    return F.pandas_udf(run, kind)(text)
