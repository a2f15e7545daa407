"""Ranked lexical search of queries (items) over all documents (operator 13).

Dense blocked matrix products: a tile of items is a matrix over the compact
vocabulary of these items, a tile of documents a matrix of impacts over the
same terms, and their product in float64 holds every score of the tile.

1. Items are taken in blocks of bounded size; a block's terms travel to the
   tasks.  One pass over the texts writes, per document, its length and the
   occurrences of the block's terms.
2. Corpus figures (documents, words, documents per term) are sums over that
   table.
3. Per tile of documents, impacts are whole numbers; columns are dealt into
   products so that no partial sum can reach 2 ** 53, where float64 stops being
   exact.  The parts are added as 64-bit integers.
4. A tile's top k keeps all ties with the kth score until the ids decide; only
   k rows per item and task leave a task, and a ranking per item ends it.

Defined cases: null and blank texts have no terms, do not count and score
nothing; items without terms, or with none that a document holds, have no rows;
a term repeated in an item counts as often; repeated documents rank each for
itself; null document ids come last among equal scores; rows of one item id are
one item, its terms are those of all its rows; null item ids are ranked like
any other; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiersmith.llm.common import RID_BITS, Scratch, materialize, with_rid

TOP = 10
# Bytes of items' texts that are searched together; larger sets take several passes.
BLOCK_BYTES = 1 << 20
# Sizes of the dense matrices.
TILE_ITEMS, TILE_DOCS, TILE_TERMS = 64, 512, 2048
EXACT = 1 << 53
# No impact exceeds a term's weight times this, whatever the counts.
SCALE = 1_000_000
# Fixed value: terms are runs of ASCII letters and digits and of all that is not ASCII; A-Z are lower-cased.
_TABLE = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """Rows (item, id, text) of so many items that their texts stay within the
    block's size; a larger item is a block of its own."""
    rows = items.select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    each = materialize(with_rid(rows.groupBy("id").agg(F.sum(size).alias("size")), "item")).withColumn("part", F.shiftright("item", RID_BITS))
    # Running sums in two steps: over the input partitions (a row each), then within one.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    parts = each.groupBy("part").agg(F.sum("size").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    start = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = materialize(each.join(parts, "part").select("item", "id", F.floor(start / BLOCK_BYTES).alias("block")))
    for block in [r[0] for r in placed.select("block").distinct().orderBy("block").collect()]:
        wanted = placed.where(F.col("block") == block)
        yield rows.join(wanted, rows["id"].eqNullSafe(wanted["id"])).select("item", rows["id"], "text").collect()


class _Items:
    """One block: its items, vocabulary and occurrences (item, term, count)."""

    def __init__(self, rows: list):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: dict[int, object] = {}
        counts: dict[tuple[int, int], int] = {}
        for row in sorted(rows, key=lambda r: r["item"]):
            self.ids[row["item"]] = row["id"]
            for word in terms(row["text"]):
                at = (row["item"], self.vocabulary.setdefault(word, len(self.vocabulary)))
                counts[at] = counts.get(at, 0) + 1
        self.items = list(self.ids)
        place = {item: i for i, item in enumerate(self.items)}
        self.entries = np.array([(place[i], t, n) for (i, t), n in counts.items()], np.int64).reshape(-1, 3)

    def tiles(self, weights: np.ndarray) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """Per tile: its items, and its products (terms, matrix of counts)."""
        out = []
        for first in range(0, len(self.items), TILE_ITEMS):
            mine = self.entries[(self.entries[:, 0] >= first) & (self.entries[:, 0] < first + TILE_ITEMS)]
            mine = mine[weights[mine[:, 1]] > 0]
            if not len(mine):
                continue
            rows, row = np.unique(mine[:, 0], return_inverse=True)
            out.append((rows, _products(row, mine[:, 1], mine[:, 2], weights, len(rows))))
        return out


def _products(row: np.ndarray, term: np.ndarray, count: np.ndarray, weights: np.ndarray, rows: int):
    """Matrices over the tile's own terms, each with few enough columns that no
    item's sum of counts times the largest impacts reaches 2 ** 53."""
    columns, column = np.unique(term, return_inverse=True)
    counts = np.zeros((rows, len(columns)), np.int64)
    counts[row, column] = count
    out, held, load = [], [], np.zeros(rows, object)

    def done() -> None:
        if held:
            out.append((np.array([t for t, _ in held]), np.stack([c for _, c in held], axis=1).astype(np.float64)))

    for j, t in enumerate(columns):
        most = int(weights[t]) * SCALE
        left = counts[:, j].copy()
        while left.any():
            part = np.minimum(left, max(1, (EXACT - 1) // most))  # of a term repeated beyond that, a part a product
            more = part.astype(object) * most
            if held and (len(held) >= TILE_TERMS or max(load + more) >= EXACT):
                done()
                held, load = [], np.zeros(rows, object)
            held.append((t, part))
            load, left = load + more, left - part
    done()
    return out


def _occurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document: ``n`` words; ``terms`` (ascending) and how often each occurs."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                words = terms(text)
                found = np.array([t for t in map(vocabulary.get, words) if t is not None], np.int32)
                rows.append((len(words), *np.unique(found, return_counts=True)))
            yield pd.DataFrame(rows, columns=["n", "terms", "counts"])

    return docs.select("id", F.pandas_udf(run, "n long, terms array<int>, counts array<int>")("text").alias("o")).select("id", "o.*")


def _weights(held: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with words, all words, and each term's weight (0: in no document)."""
    documents, words = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(size, np.int64)
    for t, n in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's vocabulary at most
        weights[t] = floor(1000 * log((2 * documents + 2) / (2 * n + 1)))
    return documents, words, weights


class _Impacts:
    """Whole numbers of a tile's documents, sparse until a product needs them."""

    def __init__(self, n: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray], documents: int, words: int, weights: np.ndarray):
        self.size, self.owner = len(n), np.repeat(np.arange(len(n)), [len(t) for t in terms])
        self.term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.int64)
        # Python integers: a very long text times a large corpus.
        m = np.array([25 + 75 * int(x) * documents // words for x in n], np.int64)
        self.value = (weights[self.term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.owner]))).astype(np.float64)

    def dense(self, columns: np.ndarray) -> np.ndarray:
        """(terms, documents) of some terms in ascending order."""
        at = np.minimum(np.searchsorted(columns, self.term), len(columns) - 1)
        on = columns[at] == self.term
        out = np.zeros((len(columns), self.size))
        out[at[on], self.owner[on]] = self.value[on]
        return out


def _best(scores: np.ndarray, ids: list, k: int) -> np.ndarray:
    """Columns of the k best positive scores, equal ones by ascending id, nulls last."""
    some = np.flatnonzero(scores > 0)
    if len(some) > k:
        some = some[scores[some] >= np.partition(scores[some], -k)[-k]]
    return np.array(sorted(some, key=lambda j: (-scores[j], ids[j] is None, 0 if ids[j] is None else ids[j]))[:k], np.int64)


def _search(held: DataFrame, block: _Items, documents: int, words: int, weights: np.ndarray, k: int, id_type: str) -> DataFrame:
    """The k best documents of every item in every task."""
    tiles, items = block.tiles(weights), np.array(block.items, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, tuple[np.ndarray, list]] = {}
        for batch in batches:
            for at in range(0, len(batch), TILE_DOCS):
                part = batch.iloc[at: at + TILE_DOCS]
                impacts = _Impacts(part["n"].to_numpy(), list(part["terms"]), list(part["counts"]), documents, words, weights)
                ids = [None if pd.isna(x) else x for x in part["id"]]
                for rows, products in tiles:
                    scores = np.zeros((len(rows), len(part)), np.int64)
                    for columns, counts in products:
                        scores += (counts @ impacts.dense(columns)).astype(np.int64)
                    for row, mine in zip(rows, scores):
                        had, had_ids = kept.get(row, (np.zeros(0, np.int64), []))
                        least = had[-1] if len(had) == k else 1
                        new = np.flatnonzero(mine >= least)
                        if len(new):
                            both, both_ids = np.r_[had, mine[new]], had_ids + [ids[j] for j in new]
                            best = _best(both, both_ids, k)
                            kept[row] = both[best], [both_ids[j] for j in best]
        yield pd.DataFrame({"item": np.repeat(items[list(kept)], [len(s) for s, _ in kept.values()]) if kept else np.zeros(0, np.int64),
                            "doc_id": pd.Series([i for _, ids in kept.values() for i in ids], dtype=object),
                            "score": np.concatenate([s for s, _ in kept.values()]) if kept else np.zeros(0, np.int64)})

    return held.where("n > 0 and size(terms) > 0").select("id", "n", "terms", "counts").mapInPandas(run, f"item long, doc_id {id_type}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per item its k best documents: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``."""
    spark: SparkSession = docs.sparkSession
    corpus = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    id_type = corpus.schema["id"].dataType.simpleString()
    kept, out = Scratch(spark, "lexical"), None
    for rows in _blocks(items, item_id, item_text):
        block = _Items(rows)
        put = Scratch(spark, "lexical-block")
        held = put(_occurrences(corpus, block.vocabulary))
        documents, words, weights = _weights(held, len(block.vocabulary))
        found = _search(held, block, documents, words, weights, k, id_type)
        ranked = found.withColumn("rank", F.row_number().over(
            Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(block.ids.items()), f"item long, item_id {items.schema[item_id].dataType.simpleString()}")
        named = kept(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
        put.remove()
        out = named if out is None else out.union(named)
    if out is None:
        out = spark.createDataFrame([], f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, doc_id {id_type}, score long")
    return out
