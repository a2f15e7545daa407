"""Jaccard self-join of documents by token-combination prefixes (operator 10).

Tokens are hashes of word n-grams.  A set of ``n`` tokens can miss at most
``e = n - ceil(t n)`` of them in any partner, so of a prefix worth more than
``e`` tokens something is shared.  Tokens are ordered rare before frequent,
then by hash.  A rare token counts one and is indexed alone.  Frequent tokens
are dealt into groups; ``m`` tokens of a group count ``m - 1`` and are indexed
by their pairs, so that a passage shared by many documents makes no long
lists unless most of a document consists of such passages; where a prefix
runs out of rare tokens it is extended through the frequent ones.

1. Sets of equal tokens are one node (pre-aggregated by digest).  Sets so
   small that neither a smaller nor a larger one links with them end here.
2. Tokens at the low end of each node's order are counted; those in over
   ``RARE`` nodes are frequent.  Any token set gives right results as
   "frequent", it only has to be the same for all nodes.
3. Nodes that keep too few rare tokens are extended over their whole sets.
4. Each list proposes its most central node (the one of the fewest rare tokens)
   with all others, so groups of near copies are not compared all with all.
5. Lists that still hold several components: short ones propose all pairs of
   different components.  Long ones are dealt anew by one more token: each node
   is written as its difference to the list's head (tokens it adds, tokens it
   lacks), and a pair not settled by the head must share many of these tokens,
   so of the rarest half of one node's difference at least one is shared
   (:func:`_dealt_anew`).  No link that joins two components is lost.
   Candidates drop out if the low ends of their orders, of which both nodes
   know all tokens, already differ too much; the others are verified on whole
   sets.
6. Components come from alternating large and small stars.

Defined cases: null and blank texts have no tokens and stay alone; texts with
fewer than ``width`` words are one token; equal sets link; repeated rows
belong to one node; null ids never name a component (a component of null ids
alone is named null); other columns are ignored; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.common import Scratch, small_batches, tidied, with_rid

WIDTH, PERCENT = 4, 85
# A token in more nodes than this is frequent.
RARE = 16
# Sizes from which frequent tokens are dealt into so many groups (1: indexed alone, none lost).
GROUPS = ((0, 1), (24, 16), (400, 256))
# Lists longer than this that still hold several components are dealt anew.
LONG_LIST = 4 * RARE
# Centrality of nodes that have rare tokens enough (others: how many they have).
OUTER = 1 << 30
# Tokens are 63-bit hashes; the index and the low ends keep their top 48 bits (equal ones only add candidates).
TOKEN_BYTES, TOKEN_SHIFT = 6, 15
# Rows up to which a side of a join is broadcast (about 16 bytes each).
BROADCAST_ROWS = 1_000_000
CHUNK_WORDS = 100_000

_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def misses(n, percent: int = PERCENT):
    """Tokens of ``n`` that a partner may lack."""
    return n - -(-percent * n // 100)


def larger(n: int, percent: int = PERCENT) -> bool:
    """Whether a set of ``n`` tokens links with any larger one."""
    return 100 * n // percent > n


def token_sets(texts, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes (63 bits) of each text, in order."""
    waiting: list[list[bytes]] = []
    words = 0

    def flush() -> Iterator[np.ndarray]:
        flat = np.empty(sum(map(len, waiting)), object)
        flat[:] = [w for ws in waiting for w in ws]
        codes, distinct = pd.factorize(flat)
        hashes = pd.util.hash_array(distinct, categorize=False)[codes] if len(flat) else np.zeros(0, np.uint64)
        shifted = np.zeros(len(hashes), np.uint64)
        for j in range(width):
            shifted[: max(0, len(hashes) - j)] += hashes[j:] * _MUL[j % len(_MUL)] + np.uint64(j)
        grams = _mix(shifted) >> np.uint64(1)
        at = 0
        for ws in waiting:
            n = len(ws)
            if n >= width:
                yield np.unique(grams[at: at + n - width + 1])
            elif n:
                h = np.uint64(n)
                for x in hashes[at: at + n]:
                    h = _mix(np.array([h * _MUL[4] + x]))[0]
                yield np.array([h >> np.uint64(1)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)
            at += n

    with np.errstate(over="ignore"):
        for text in texts:
            # Bytes: lower() changes A-Z only, split() takes exactly space and tab to CR.
            waiting.append(text.encode("utf-8", "surrogatepass").lower().split() if text else [])
            words += len(waiting[-1])
            if words > CHUNK_WORDS:
                yield from flush()
                waiting, words = [], 0
        yield from flush()


def _packed(tokens: np.ndarray) -> bytes:
    return (tokens >> np.uint64(TOKEN_SHIFT)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES].tobytes()


def _unpacked(raw) -> np.ndarray:
    wide = np.zeros((len(raw) // TOKEN_BYTES, 8), np.uint8)
    wide[:, :TOKEN_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, TOKEN_BYTES)
    return wide.view("<i8").ravel()


def _sketches(df: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document: size of its set, a digest of it, and the low end of its order."""
    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for s in token_sets(batch, width):
                n = len(s)
                e = misses(n, percent)
                # Also where nothing may be missed (e == 0), a larger partner may hold the whole set.
                low = s[: int(1.2 * (e + 1)) + 4] if e or larger(n, percent) else s[:0]
                with np.errstate(over="ignore"):
                    a = _mix(np.array([(s * _MUL[5]).sum(dtype=np.uint64) + np.uint64(n)])).view(np.int64)[0]
                    b = _mix(np.array([_mix(s + _MUL[6]).sum(dtype=np.uint64)])).view(np.int64)[0]
                rows.append((n, a, b, _packed(low)))
            yield pd.DataFrame(rows, columns=["n", "da", "db", "low"])

    return df.withColumn("_s", F.pandas_udf(run, "n long, da long, db long, low binary")("_text"))


def _sets(docs: DataFrame, nodes: DataFrame, count: int, width: int) -> DataFrame:
    """Whole sets of some nodes, read again from one text of each."""
    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([s.view(np.int64) for s in token_sets(batch, width)])

    keys = nodes.select("node", "key")
    keyed = docs.withColumn("key", _key("_id", "_text"))
    same = (keyed["key"]["text"] == keys["key"]["text"]) & keyed["key"]["id"].eqNullSafe(keys["key"]["id"])
    found = keyed.join(_small(keys, count), same).select("node", "_text")
    return found.dropDuplicates(["node"]).select("node", F.pandas_udf(run, "array<long>")("_text").alias("tokens"))


def _key(doc_id, text):
    """Names a row: ids before null ids, then the text's hash."""
    return F.struct(F.col(doc_id).isNull().alias("unnamed"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("text"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _counted(df: DataFrame, put: Scratch) -> tuple[DataFrame, int]:
    df = put(df)
    return df, df.count()


def _low_rows(nodes: DataFrame, fold: bool) -> DataFrame:
    """(token, node) of the low ends; with ``fold`` a token of over ``RARE``
    nodes in one batch gives a single row without a node."""
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("low").to_pylist()
            tokens = _unpacked(b"".join(lists))
            owner = np.repeat(batch.column("node").to_numpy(), [len(x) // TOKEN_BYTES for x in lists])
            few, hot = np.ones(len(tokens), bool), tokens[:0]
            if fold:
                distinct, code, many = np.unique(tokens, return_inverse=True, return_counts=True)
                few, hot = many[code] <= RARE, distinct[many > RARE]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([tokens[few], hot])),
                pa.concat_arrays([pa.array(owner[few]), pa.nulls(len(hot), pa.int64())])], ["token", "node"])

    return nodes.select("node", "low").mapInArrow(run, "token long, node long")


def _lists(rows: DataFrame) -> DataFrame:
    """Of rows dealt and sorted by token: those of tokens in 2 to ``RARE``
    nodes, and one row without a node for each token in more."""
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_tokens, held_nodes = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def done(tokens: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, np.int64)
            many = np.diff(np.r_[first, len(tokens)])
            marked = np.add.reduceat(nodes < 0, first) > 0 if len(first) else np.zeros(0, bool)
            hot = marked | (many > RARE)
            keep = np.repeat(~hot & (many > 1), many)
            out = np.r_[tokens[keep], tokens[first[hot]]]
            whose = pa.concat_arrays([pa.array(nodes[keep]), pa.nulls(int(hot.sum()), pa.int64())])
            return pa.RecordBatch.from_arrays([pa.array(out), whose], ["token", "node"])

        for batch in batches:
            tokens = np.r_[held_tokens, batch.column("token").to_numpy()]
            nodes = np.r_[held_nodes, batch.column("node").fill_null(-1).to_numpy()]
            if not len(tokens):
                continue
            last = int(np.searchsorted(tokens, tokens[-1], side="left"))  # the last token may go on
            yield done(tokens[:last], nodes[:last])
            held_tokens, held_nodes = tokens[last:], nodes[last:]
            if len(held_tokens) > 4 * RARE:  # surely frequent: a marker will do
                held_tokens, held_nodes = held_tokens[:1], np.array([-1])
        yield done(held_tokens, held_nodes)

    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(run, "token long, node long")


def _extended(sets: DataFrame, percent: int) -> DataFrame:
    """Signatures (``sig``, ``node``, ``outer``: rare tokens of the node's prefix,
    ``alone``: whether this is one) of whole sets with their frequent tokens."""
    @tidied
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tokens, frequent in zip(*batch):
                s = np.asarray(tokens, np.int64).view(np.uint64)
                short = (s >> np.uint64(TOKEN_SHIFT)).view(np.int64)
                hot = np.isin(short, np.asarray(frequent if frequent is not None else [], np.int64))
                n = len(s)
                need = misses(n, percent) + 1
                alone, rest = short[~hot][:need], s[hot]
                pairs: list[np.ndarray] = []
                if len(alone) < need:
                    # The spaces of all sizes that a partner may have.
                    least, most = percent * n / 100, 100 * n / percent
                    bounds = [b for b, _ in GROUPS] + [np.inf]
                    for (low, groups), high in zip(GROUPS, bounds[1:]):
                        if most >= low and least < high:
                            pairs.append(_combinations(rest, need - len(alone), groups))
                out.append((np.r_[alone, np.concatenate(pairs).view(np.int64)] if pairs else alone, len(alone)))
            yield pd.DataFrame(out, columns=["sigs", "alone"])

    made = sets.select("node", F.pandas_udf(run, "sigs array<long>, alone int")("tokens", "frequent").alias("g"))
    return made.select("node", F.posexplode("g.sigs").alias("i", "sig"), F.col("g.alone").alias("outer")).select(
        "sig", "node", "outer", (F.col("i") < F.col("outer")).alias("alone"))


def _combinations(tokens: np.ndarray, need: int, groups: int) -> np.ndarray:
    """Hashed pairs within the groups of the shortest prefix of ``tokens``
    (in order) worth ``need``; single tokens where there is but one group."""
    if groups == 1:
        return _mix(tokens[:need] + _MUL[7])
    with np.errstate(over="ignore"):
        group = (_mix(tokens + _MUL[4]) % np.uint64(groups)).astype(np.int64)
        seen: dict[int, list[np.uint64]] = {}
        worth, out = 0, []
        for token, g in zip(tokens, group.tolist()):
            mates = seen.setdefault(g, [])
            if mates:
                worth += 1
                out.append(_mix(np.array(mates) * _MUL[0] + token * _MUL[1] + np.uint64(groups)))
            mates.append(token)
            if worth >= need:
                break
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _near(pairs: DataFrame, nodes: DataFrame, percent: int, put: Scratch) -> DataFrame:
    """Pairs (a, b) whose sizes and low ends allow a link.

    Up to the smaller of the last tokens of two low ends, both nodes' tokens
    are all known; those that only one has must fit the difference allowed."""
    @tidied
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for n, x, m, y in zip(*batch):
                x, y = _unpacked(x), _unpacked(y)
                last = min([t[-1] for t, size in ((x, n), (y, m)) if len(t) < size], default=None)
                if last is not None:  # tokens that equal the last one in their kept bits may go on beyond it
                    x, y = x[x < last], y[y < last]
                apart = len(x) + len(y) - 2 * int(np.isin(x, y).sum())
                out.append(apart * (100 + percent) <= (100 - percent) * (n + m))
            yield pd.Series(out, dtype=bool)

    pairs = put(pairs)
    wanted, count = _counted(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), put)
    low = nodes.select("node", "n", "low").join(_small(wanted, count), "node")
    both = (pairs.join(low.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("low").alias("la")), "a")
            .join(low.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("low").alias("lb")), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    return put(both.where(F.pandas_udf(run, "boolean")("na", "la", "nb", "lb")).select("a", "b", "na", "nb"))


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int, put: Scratch) -> DataFrame:
    """Pairs (a, b) of different nodes that link, checked on whole sets."""
    near = _near(pairs, nodes, percent, put)
    wanted, count = _counted(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), put)
    wanted = put(nodes.select("node", "key").join(_small(wanted, count), "node"))
    sets = put(_sets(docs, wanted, count, width))
    both = (near.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b")
            .withColumn("shared", F.size(F.array_intersect("ta", "tb"))))
    return put(both.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b"))


def components(edges: DataFrame, put: Scratch | None = None) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges``
    (a, b) but the smallest ones themselves."""
    put = put or Scratch(edges.sparkSession, "components")
    stars = put(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        stars = put(small.select("u", F.col("m").alias("v"))
                            .union(small.where("v <> m").select("v", "m")).distinct())
        now = stars.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return stars.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def _hubs(links: DataFrame, put: Scratch) -> DataFrame:
    """(node, root): the smallest node that a node, or that one, links with.
    Nodes of one root are connected; connected nodes may still have several."""
    one = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    up = one.select(F.col("node").alias("root"), F.col("root").alias("above"))
    return put(one.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")))


def _heads(sigs: DataFrame) -> DataFrame:
    """(sig, head): the most central node of each list of several."""
    first = sigs.groupBy("sig").agg(F.min(F.struct("outer", "node")).alias("h"), F.count(F.lit(1)).alias("c"))
    return first.where("c > 1").select("sig", F.col("h.node").alias("head"))


def _first_pairs(sigs: DataFrame) -> DataFrame:
    met = sigs.join(_heads(sigs), "sig").where("node <> head")
    return met.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()


def _dealt_anew(live: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int, put: Scratch) -> DataFrame:
    """Pairs (a, b) of different components that may link, of long lists
    ``live`` (sig, node, root, outer) whose heads were compared with all.

    With ``x`` and ``y`` tokens in the differences of A and B to a head, the
    sets differ in at least ``x + y - 2 s`` tokens if the differences share
    ``s``.  A link allows ``d = (100 - t) / (100 + t)`` of both sizes, so ``s >=
    (x + y - d) / 2``.  If that is 0 or less, both link with the head itself: B
    is larger than the head by ``y`` at most.  So one node, A, does not, and
    ``s`` is more than ``y (1 - q) / 2``, ``q`` being that fraction: with tokens
    ordered by rarity, one is among the first ``y (1 + q) / 2`` of B."""
    less, more = 100 - percent, 100 + percent
    groups = put(live.join(_heads(live), "sig").select("head", "node", "root").distinct())
    wanted, count = _counted(groups.select("node").union(groups.select("head")).distinct(), put)
    sets = put(_sets(docs, nodes.select("node", "key").join(_small(wanted, count), "node"), count, width))
    both = (groups.join(sets, "node").join(sets.select(F.col("node").alias("head"), F.col("tokens").alias("theirs")), "head"))
    # Tokens have 63 bits: their complements, tokens that a node lacks, are other numbers.
    lacks = F.transform(F.array_except("theirs", "tokens"), lambda t: F.bitwise_not(t))
    differ = both.select("head", "node", "root", F.size("tokens").alias("n"), F.size("theirs").alias("nh"),
                         F.concat(F.array_except("tokens", "theirs"), lacks).alias("d")).withColumn("x", F.size("d"))
    each = put(differ.select("head", "node", "root", "n", "x", (more * F.col("x") > less * (F.col("n") + F.col("nh"))).alias("far"),
                             F.explode("d").alias("t")))
    often = each.groupBy("head", "t").agg(F.count(F.lit(1)).alias("f"))
    ranked = put(each.join(often, ["head", "t"]).withColumn(
        "pos", F.row_number().over(Window.partitionBy("head", "node").orderBy("f", "t")) - 1))
    a = ranked.where("far").select("head", "t", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), "x", F.col("pos").alias("pa"))
    b = (ranked.where(2 * more * F.col("pos") < (less + more) * F.col("x"))
         .select("head", "t", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("x").alias("y"), F.col("pos").alias("pb")))
    shared = F.ceil((F.col("x") + F.col("y") - F.floor(less * (F.col("na") + F.col("nb")) / more)) / 2)
    met = a.join(b, (a["head"] == b["head"]) & (a["t"] == b["t"]) & (F.col("ra") != F.col("rb"))
                 & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                 & (F.col("pa") <= F.col("x") - shared) & (F.col("pb") <= F.col("y") - shared))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _short_tokens(sets: DataFrame) -> DataFrame:
    return sets.select("node", F.explode(F.transform("tokens", lambda t: F.shiftright(t, TOKEN_SHIFT))).alias("token"))


def _rooted(sigs: DataFrame, roots: DataFrame) -> DataFrame:
    return sigs.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id`` (smallest
    id reachable by links), ``text_key`` (xxhash64 of the text) and ``first``
    (whether the row is, or repeats, the component's first)."""
    with small_batches(df.sparkSession):
        return _components(df, doc_id, text, width, percent)


def _components(df: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    kept, put = Scratch(df.sparkSession, "jaccard"), Scratch(df.sparkSession, "jaccard-rounds")
    docs = df.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = kept(_sketches(docs, width, percent).select(
        "_id", "_s.n", F.when(F.col("_s.n") > 0, F.struct("_s.da", "_s.db")).alias("digest"), "_s.low",
        _key("_id", "_text").alias("key")))
    nodes = kept(with_rid(
        rows.where("n > 0").groupBy("digest").agg(F.min("_id").alias("least"), F.min("key").alias("key"), F.first("n").alias("n"), F.first("low").alias("low")), "node"))
    members = rows.select("_id", "n", "digest", "key")
    open_nodes = nodes.where(F.length("low") > 0)
    lists = put(_lists(_low_rows(open_nodes, True)))
    frequent, many = _counted(lists.where("node is null").select("token"), put)
    low = _low_rows(open_nodes, False)
    sigs = lists.where("node is not null").select(F.col("token").alias("sig"), "node")

    def short_of_rare(tokens: DataFrame, count: int) -> DataFrame:
        """Nodes whose low end keeps too few rare tokens for a prefix."""
        met = low.join(_small(tokens, count), "token").groupBy("node").agg(F.count(F.lit(1)).alias("f"))
        need = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
        return (open_nodes.select("node", "key", "n", (F.length("low") / TOKEN_BYTES).alias("k")).join(met, "node")
                .where(F.col("k") - F.col("f") < need).select("node", "key"))

    if many:
        some, count = _counted(short_of_rare(frequent, many), put)
        whole = _short_tokens(_sets(docs, some, count, width))
        more = whole.groupBy("token").count().where(F.col("count") > RARE).select("token")
        frequent, many = _counted(frequent.union(more).distinct(), put)
        some, count = _counted(short_of_rare(frequent, many), put)
        sets = put(_sets(docs, some, count, width))
        hits = (_short_tokens(sets).join(_small(frequent, many), "token")
                .groupBy("node").agg(F.collect_list("token").alias("frequent")))
        own = put(_extended(sets.join(hits, "node", "left"), percent))
        alone, count = _counted(own.where("alone").select(F.col("sig").alias("token")).distinct(), put)
        met = low.join(_small(alone, count), "token").select(F.col("token").alias("sig"), "node")
        outer = sigs.union(met).withColumn("outer", F.lit(OUTER))
        sigs = outer.union(own.select("sig", "node", "outer")).groupBy("sig", "node").agg(F.min("outer").alias("outer"))
    else:
        sigs = sigs.withColumn("outer", F.lit(OUTER))
    sigs = put(sigs)
    edges = _verified(_first_pairs(sigs), docs, nodes, width, percent, put)
    live = _rooted(sigs, _hubs(edges, put))
    mixed = live.groupBy("sig").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("c")).where("r0 < r1")
    mixed = put(mixed.select("sig", "c"))
    if mixed.where(F.col("c") > LONG_LIST).limit(1).count():
        long = live.join(mixed.where(F.col("c") > LONG_LIST).select("sig"), "sig")
        edges = edges.union(_verified(_dealt_anew(long, docs, nodes, width, percent, put), docs, nodes, width, percent, put))
    short = live.join(mixed.where(F.col("c") <= LONG_LIST).select("sig"), "sig").join(nodes.select("node", "n"), "node")
    a, b = (short.select("sig", *[F.col(c).alias(c + x) for c in ("node", "root", "n")]) for x in "ab")
    rest = (a.join(b, "sig").where("nodea < nodeb and roota <> rootb")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct())
    roots = kept(components(edges.union(_verified(rest, docs, nodes, width, percent, put)), put))
    put.remove()
    labelled = (nodes.select("node", "digest", "least", "key").join(roots, "node", "left")
                .withColumn("root", F.coalesce("root", "node")))
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.min("key").alias("head"))
    by_digest = labelled.join(names, "root").select("digest", "component_id", "head")
    blank = F.col("digest").isNull()
    return (members.join(by_digest, "digest", "left")
            .select(F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(blank, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.col("key.text").alias("text_key"), (blank | F.col("key").eqNullSafe(F.col("head"))).alias("first")))


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` without the rows that follow another of their component.  Rows
    that repeat id and text are one document and leave one row; blank texts
    are linked with nothing and all stay.  Only the ids to drop are joined."""
    put = Scratch(df.sparkSession, "keep-first")
    found = put(jaccard_components(df, doc_id, text, **options))
    later, count = _counted(found.where(~F.col("first")).select("doc_id", "text_key").distinct(), put)
    told = _small(later.select(F.col("doc_id").alias("_later_id"), F.col("text_key").alias("_later_text")), count)
    same = (F.xxhash64(F.col(text)) == F.col("_later_text")) & F.col(doc_id).eqNullSafe(F.col("_later_id"))
    kept = df.join(told, same, "left_anti")
    repeated = found.where("first and n_shingles > 0").groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    if not repeated:
        return kept
    blank = F.coalesce(F.length(F.regexp_replace(F.col(text), r"[\x20\x09-\x0D]+", "")), F.lit(0)) == 0
    return kept.where(blank).union(kept.where(~blank).dropDuplicates([doc_id, text]))
