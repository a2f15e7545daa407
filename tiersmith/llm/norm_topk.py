"""Exact top-k inner products over norm-sorted blocks (operator 3).

Vectors are sorted by descending length and cut into blocks.  Their components
are rotated by the right singular vectors of the table (from its Gram matrix,
summed in Spark), so that the first coordinates carry most of the products.
A query that holds k scores above a block's largest length times its own skips
the block; within a block, a partial sum over the leading coordinates plus the
Cauchy-Schwarz bound of the rest decides which vectors get an exact product.
First scores come from the longest vectors of all.

Queries and vectors meet in blocks: a pair of blocks is one small group, a
block of vectors is sent only to the query blocks that still need its lengths.

Defined cases: null vectors and vectors with null or non-finite components
take no part, neither as queries nor as candidates; shorter vectors count as
padded with zeros; fewer than k candidates are returned all; ties go to the
smaller id; a row is no candidate of itself, but rows that repeat it are;
rows without an id take part as candidates only, after all others in ties;
scores are 64-bit integers and wrap beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.common import RID_BITS, materialize

SCALE = 1024
BLOCK, QUERY_BLOCK, SEEDS, LEVELS, PART = 1024, 512, 1024, 64, 64
_EXACT = float(1 << 52)


def usable(vector: str) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    c = F.col(vector)
    good = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & F.coalesce(good, F.lit(False))


def quantized(vector: str, scale: int = SCALE) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products, ``width`` squared numbers, summed by Spark."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch["v"], width).astype(float)
            total += x.T @ x
        i, j = np.divmod(np.arange(width * width), width)
        yield pd.DataFrame({"i": i, "j": j, "s": total.ravel()})

    out = np.zeros((width, width))
    for i, j, s in vectors.select("v").mapInPandas(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s")).collect():
        out[i, j] = s
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products a @ b.T, in floating point where that is exact."""
    if len(a) and len(b) and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _better(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def block_topk(q: np.ndarray, q_rid: np.ndarray, floor: np.ndarray, x: np.ndarray, x_id: np.ndarray, x_rid: np.ndarray,
               rotation: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, places in the block, scores) of what may be in the top k;
    ``floor`` is a score that k other candidates of the query reach."""
    order = np.argsort(-np.linalg.norm(x.astype(float), axis=1), kind="stable")
    x, x_id, x_rid = x[order], x_id[order], x_rid[order]
    lengths = np.linalg.norm(x.astype(float), axis=1)
    head = max(1, x.shape[1] // 4)
    xr, qr = x.astype(float) @ rotation, q.astype(float) @ rotation
    x_rest, q_rest = np.linalg.norm(xr[:, head:], axis=1), np.linalg.norm(qr[:, head:], axis=1)
    q_length = np.linalg.norm(qr, axis=1)
    out = []
    for i in range(len(q)):
        slack = 1e-9 * q_length[i] * (lengths[0] if len(lengths) else 0) + 1e-6
        enough = floor[i] - slack
        # Lengths fall: vectors past this point cannot reach the floor.
        n = int(np.searchsorted(-lengths * q_length[i], -enough, side="right")) if enough > 0 else len(x)
        best = None
        for at in range(0, n, 1024):
            to = min(n, at + 1024)
            if best is not None and len(best[1]) == k and lengths[at] * q_length[i] + slack < best[1][-1]:
                break
            bound = xr[at:to, :head] @ qr[i, :head] + x_rest[at:to] * q_rest[i] + slack
            least = max(floor[i], best[1][-1] if best is not None and len(best[1]) == k else floor[i])
            near = at + np.flatnonzero((bound >= least) & (x_rid[at:to] != q_rid[i]))
            if not len(near):
                continue
            scores = products(q[i: i + 1], x[near])[0]
            where = np.concatenate([best[0], near]) if best is not None else near
            scores = np.concatenate([best[1], scores]) if best is not None else scores
            top = _better(x_id[where], scores, k)
            best = (where[top], scores[top])
        if best is not None:
            out.append((i, order[best[0]], best[1]))
    return out


def exact_topk(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", is_query: Column | None = None, k: int = 10,
               scale: int = SCALE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best."""
    query = F.coalesce(F.col(vec_id) % 100 == 0 if is_query is None else is_query, F.lit(False))
    ready = (df.where(usable(vector)).select(F.col(vec_id).alias("id"), query.alias("query"), quantized(vector, scale).alias("v"))
             .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))))
    rows = materialize(ready.repartitionByRange(F.desc("length"), "id").sortWithinPartitions(F.desc("length"), "id")
                       .withColumn("rid", F.monotonically_increasing_id()))
    place = F.col("rid") - F.shiftleft(F.shiftright("rid", RID_BITS), RID_BITS)
    rows = rows.withColumn("block", F.shiftright("rid", RID_BITS) * (1 << 20) + F.floor(place / BLOCK))
    width, queries, total = rows.agg(F.max(F.size("v")), F.count_if(F.col("query")), F.count(F.lit(1))).first()
    width = max(1, width or 0)
    _, _, rotation = np.linalg.svd(_gram(rows, width))
    rotation = rotation.T
    seeds = rows.orderBy(F.desc("length"), "rid").limit(SEEDS).select("rid", "v").toPandas()  # bounded
    seed_v, seed_rid = _matrix(seeds["v"], width), seeds["rid"].to_numpy(np.int64)

    def first_scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for rids, lists in batches:
            floors = np.full(len(rids), -np.inf)
            scores = products(_matrix(lists, width), seed_v).astype(float)
            scores[rids.to_numpy()[:, None] == seed_rid[None, :]] = -np.inf
            if len(seed_rid) > k:
                floors = np.sort(scores, axis=1)[:, -k]
            yield pd.Series(floors)

    asked = rows.where("query").withColumn("floor", F.pandas_udf(first_scores, "double")("rid", "v"))
    # The length from which a block matters to the query; 0 where its floor is not positive.
    asked = materialize(asked.withColumn("need", F.when((F.col("floor") > 0) & (F.col("length") > 0), F.col("floor") / F.col("length") * (1 - 1e-9)).otherwise(0.0)))
    levels = max(1, min(LEVELS, -(-queries // QUERY_BLOCK)))
    cuts = sorted(set(asked.approxQuantile("need", [i / levels for i in range(1, levels)], 0.001))) if levels > 1 else []
    steps = F.array(*[F.lit(float(c)) for c in [0.0, *cuts]])
    level = F.size(F.filter(steps, lambda c: c <= F.col("need"))) - 1
    asked = asked.withColumn("level", level)
    salts = {r[0]: -(-r[1] // QUERY_BLOCK) for r in asked.groupBy("level").count().collect()}  # at most ``LEVELS`` rows
    dealt = F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]) if salts else F.create_map(F.lit(0), F.lit(1))
    asked = asked.withColumn("group", F.struct("level", F.pmod(F.xxhash64("rid"), dealt[F.col("level")]).cast("int").alias("salt")))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid")
        return pd.DataFrame({"block": [key[0]], "longest": [pdf["length"].max()], "v": [_matrix(pdf["v"], width).tobytes()],
                             "ids": [pdf["id"].astype("float64").isna().to_numpy().tobytes() + pdf["id"].fillna(0).to_numpy(np.int64).tobytes()],
                             "rids": [pdf["rid"].to_numpy(np.int64).tobytes()]})

    blocks = rows.select("block", "rid", "id", "v", "length").groupBy("block").applyInPandas(
        pack, "block long, longest double, v binary, ids binary, rids binary")
    # Each level's query groups meet the blocks in parts of ``PART`` blocks, so no key gathers all of them.
    parts = max(1, -(-total // (BLOCK * PART)))
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    levelled = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(float(c)).alias("least")) for i, c in enumerate([0.0, *cuts])])
    sent = (blocks.withColumn("g", F.explode(levelled)).where(F.col("g.least") <= F.col("longest") * (1 + 1e-9))
            .withColumn("salts", F.coalesce(F.try_element_at(dealt, F.col("g.level")), F.lit(0))).where("salts > 0")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))))
            .select("v", "ids", "rids", F.struct("g.level", "salt").alias("group"), part.alias("part")))
    asked_of = asked.select("group", F.col("rid").alias("q_rid"), F.col("id").alias("q_id"), F.col("v").alias("q"), "floor")

    def pack_queries(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("q_rid")
        return pd.DataFrame({"level": [pdf["group"].iloc[0]["level"]], "salt": [pdf["group"].iloc[0]["salt"]], "q": [_matrix(pdf["q"], width).tobytes()],
                             "q_ids": [pdf["q_id"].to_numpy(np.int64).tobytes()], "q_rids": [pdf["q_rid"].to_numpy(np.int64).tobytes()],
                             "floors": [pdf["floor"].to_numpy(float).tobytes()]})

    packed = (asked_of.groupBy("group").applyInPandas(pack_queries, "level int, salt int, q binary, q_ids binary, q_rids binary, floors binary")
              .select(F.struct("level", "salt").alias("group"), "q", "q_ids", "q_rids", "floors",
                      F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                q, x = (np.frombuffer(m, np.int64).reshape(-1, width) for m in (r.q, r.v))
                n = len(x)
                missing, ids = np.frombuffer(r.ids[:n], bool), np.frombuffer(r.ids[n:], np.int64)
                order_ids = np.where(missing, np.iinfo(np.int64).max, ids)
                q_ids, q_rids = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_rids, np.int64)
                found = block_topk(q, q_rids, np.frombuffer(r.floors, float), x, order_ids, np.frombuffer(r.rids, np.int64), rotation, k)
                if found:
                    size = [len(f[1]) for f in found]
                    at = np.concatenate([f[1] for f in found])
                    who = np.repeat([f[0] for f in found], size)
                    yield pd.DataFrame({"q_rid": q_rids[who], "query_id": q_ids[who], "vec_id": pd.array(np.where(missing[at], 0, ids[at]), "Int64").copy(),
                                        "missing": missing[at], "score": np.concatenate([f[2] for f in found])})

    partial = sent.join(packed, ["group", "part"]).select("q", "q_ids", "q_rids", "floors", "v", "ids", "rids").mapInPandas(
        meet, "q_rid long, query_id long, vec_id long, missing boolean, score long")
    partial = partial.withColumn("vec_id", F.when(~F.col("missing"), F.col("vec_id")))
    best = Window.partitionBy("q_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
