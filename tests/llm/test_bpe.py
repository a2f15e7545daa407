import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tiersmith.llm import bpe
from tiersmith.llm.common import json_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " \t\n", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΟΔΟΣ Σ", "İstanbul ½ ² Ⅷ 一二 x²y", "école café", "a\x1cb\x85c　d _x_ __ 'S 'll don't I'LL",
       "x" * 20000, "ab" * 3000 + " " + "!" * 999, "日本語テキスト 🙂🙂👍🏽", "١٢٣ ३", "ǅ ŉ ﬃ ß ẞ", "The  end.\nthe END\r\n"]


@pytest.fixture(scope="module")
def pair():
    return bpe.WordBpe(json_bytes(PATH)), Tokenizer.from_file(PATH)


def test_same_ids_and_texts_as_the_library(pair):
    own, library = pair
    rng = random.Random(4)
    words = ["".join(rng.choice("aeiouthrnsAEzéüß,.-'") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    for text in [*ODD, " ".join(words), "\n".join(words[:200])]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_cache_does_not_change_results(pair, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_RUNS", 3)
    own = bpe.WordBpe(json_bytes(PATH))
    text = "one two three four five one two three six seven one" * 3
    assert own.encode(text) == pair[1].encode(text, add_special_tokens=False).ids


def test_merges_by_rank_against_plain_search(pair):
    own = pair[0]
    rng = random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("abcdelnorst") for _ in range(rng.randrange(1, 20)))
        symbols = [own.inner[b] for b in word.encode()]
        symbols[-1] = own.final[word.encode()[-1]]
        while True:
            ranked = [(own.rank[(a << 20) | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (a << 20) | b in own.rank]
            if not ranked:
                break
            rank, at = min(ranked)
            symbols[at: at + 2] = [own.made[rank]]
        assert own.word_ids(word) == symbols


def test_dataframe_with_nulls_repeats_and_clashing_columns(spark, pair):
    df = spark.createDataFrame([(1, None, "a"), (2, "Hello there", "b"), (2, "Hello there", "b"), (None, "", "c")], "doc_id long, text string, n_tokens string")
    got = bpe.encode_texts(df, json_bytes(PATH), ids=True).select("doc_id", "text", "bpe.*").collect()
    assert len(got) == 4
    for r in got:
        ids = pair[1].encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.encode_texts(df.limit(0), json_bytes(PATH)).count() == 0
