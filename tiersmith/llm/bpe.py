"""BPE encoding and decoding of whole texts (operator 4).

Encoding merges by a priority queue of merge ranks over a doubly linked list
of symbols; entries whose symbols have changed since they were pushed are
stale and are skipped.  Decoding joins the vocabulary's strings.

Defined cases: a null text counts as empty (no ids, empty decoded text); very
long texts and words are encoded whole (n log n per word); special tokens
written in a text get their own ids, as in the library; repeated rows are
encoded each; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# White space by the Unicode property, and the separators that
# Python's str.split adds to it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_BLANKS = re.compile(f"[{_SPACE}]+")
# The pre-tokenizer's pattern within one run without white space.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_ANY = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
# Runs whose encoding one Python worker keeps, per generation of its cache.
CACHE_RUNS = 200_000


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class WordBpe:
    """A BPE vocabulary with an end-of-word suffix, from the text of its JSON file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab: dict[str, int] = spec["model"]["vocab"]
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings = {i: s for s, i in (vocab | self.special).items()}
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.final = [vocab[c + suffix] for c in chars]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.made = [vocab[a + b] for a, b in merges]
        self.rank = {(vocab[a] << 20) | vocab[b]: r for r, (a, b) in reversed(list(enumerate(merges)))}
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._young: dict[str, tuple[int, str, str]] = {}
        self._old: dict[str, tuple[int, str, str]] = {}

    def word_ids(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word."""
        raw = word.encode("utf-8")
        inner, rank, n = self.inner, self.rank, len(raw)
        symbol = [inner[b] for b in raw]
        symbol[-1] = self.final[raw[-1]]
        if n == 1:
            return symbol
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        shift = n.bit_length()
        heap = []
        left = symbol[0]
        for at in range(n - 1):
            right = symbol[at + 1]
            r = rank.get((left << 20) | right)
            if r is not None:
                heap.append((r << shift) | at)
            left = right
        heapify(heap)
        mask = (1 << shift) - 1
        made = self.made
        while heap:
            top = heappop(heap)
            at, r = top & mask, top >> shift
            nxt = after[at]
            if symbol[at] < 0 or nxt >= n or rank.get((symbol[at] << 20) | symbol[nxt]) != r:
                continue  # stale: one of its two symbols was merged away or replaced
            symbol[at] = new = made[r]
            symbol[nxt] = -1
            far = after[at] = after[nxt]
            if far < n:
                before[far] = at
                r = rank.get((new << 20) | symbol[far])
                if r is not None:
                    heappush(heap, (r << shift) | at)
            prev = before[at]
            if prev >= 0:
                r = rank.get((symbol[prev] << 20) | new)
                if r is not None:
                    heappush(heap, (r << shift) | prev)
        return [s for s in symbol if s >= 0]

    def words(self, run: str) -> list[str]:
        """Normalized words of a run without white space or special tokens."""
        if run.isascii():
            return _ASCII.findall(run.lower())
        if not unicodedata.is_normalized("NFC", run):
            run = unicodedata.normalize("NFC", run)
        # The normalizer lowers character by character: it has no final sigma.
        return _ANY.findall(run.replace("Σ", "σ").lower())

    def _entry(self, run: str) -> tuple[int, str, str]:
        entry = self._old.get(run)
        if entry is None:
            ids = [i for word in self.words(run) for i in self.word_ids(word)]
            strings = self.strings
            entry = (len(ids), " ".join(map(str, ids)), " ".join([strings[i] for i in ids]))
        if len(run) < 64:
            if len(self._young) >= CACHE_RUNS:
                self._old, self._young = self._young, {}
            self._young[run] = entry
        return entry

    def parts(self, text: str | None) -> list[tuple[int, str, str]]:
        """Per run of the text between white space: number of ids, the ids as
        text, their vocabulary strings."""
        if not text:
            return []
        out: list[tuple[int, str, str]] = []
        for segment in self.splitter.split(text) if self.splitter and "<" in text else [text]:
            if segment in self.special:
                out.append((1, str(self.special[segment]), segment))
                continue
            if any(c in segment for c in _SEPARATORS):
                runs = [r for r in _BLANKS.split(segment) if r]
            else:
                runs = segment.split()
            young, entry = self._young.get, self._entry
            for run in runs:
                found = young(run)
                if found is None:
                    found = entry(run)
                    young = self._young.get
                out.append(found)
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


def encode_texts(df: DataFrame, vocabulary: str, text: str = "text", ids: bool = False, digests: bool = True) -> DataFrame:
    """``df`` plus one struct column ``bpe``: ``n_tokens``, and on demand
    ``ids`` (array of int) and ``decoded`` (``ids=True``) or their digests
    (``digests=True``).  One narrow pass, no shuffle; ``vocabulary`` is the
    text of the JSON file."""
    fields = ["n_tokens long"] + ["ids array<int>", "decoded string"] * ids + ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = WordBpe(vocabulary)
        for batch in batches:
            rows = []
            for value in batch:
                parts = model.parts(value)
                ids_text = " ".join([p[1] for p in parts])
                decoded = " ".join([p[2] for p in parts])
                row: list = [sum([p[0] for p in parts])]
                if ids:
                    row += [list(map(int, ids_text.split())), decoded]
                if digests:
                    row += [hashlib.sha256(ids_text.encode()).hexdigest(),
                            hashlib.sha256(decoded.encode()).hexdigest()]
                rows.append(row)
            yield pd.DataFrame(rows, columns=[f.split(" ")[0] for f in fields])

    udf = F.pandas_udf(run, ", ".join(fields))
    return df.withColumn("bpe", udf(F.col(text)))
