"""Merkle dataset manifest with retained SHA-256 midstates (operator 12).

A leaf is the digest of a row's fields.  Within each group the leaves, in
order, are combined eight at a time until one node, the subroot, is left; the
subroots, ordered by group, likewise give the root.  A parent hashes the hex
text of its children, so every child is exactly one block of SHA-256 and the
hash state before a child's slot is its chaining value: 32 bytes that a table
can hold.  Parents retain these states.  To fold a replaced leaf, the state
before its slot is resumed with the replacement and the right siblings only;
what lies left of it is never hashed again.

1. Leaves are hashed by the JVM, written without their texts, dealt by range
   and numbered gaplessly within their group.
2. ``8 ** CHUNK_LEVELS`` consecutive leaves form a chunk, one row; a chunk is
   combined in one call, and chunk tops are the next table's nodes, until
   every group has one node.  Then the same over the subroots.
3. From the root down every chunk gets its path: the retained state, left and
   right siblings of each step up to the root.
4. Each chunk folds its rows' replacements through its own levels and its path.

Nothing but single nodes per 512 rows is shuffled twice; a group of any size
is spread over its chunks.

Defined cases: a null field is ``-``, an empty one ``0:``; a null group comes
first and is a group of its own; rows are ordered by id (nulls first), repeated
ids by their leaf; equal rows are leaves each; an empty table has no rows and
no root; fields are named, other columns are ignored; texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.llm.common import RID_BITS, Scratch, with_rid

FAN = 8
CHUNK_LEVELS = 3
CHUNK = FAN**CHUNK_LEVELS
DIGEST = 32
# What a path keeps of a parent: its state before the slot, and the siblings on both sides.
STEP = T.StructType([T.StructField(name, T.BinaryType()) for name in ("mid", "left", "right")])


def _constants() -> tuple[np.ndarray, np.ndarray]:
    """Fractional parts of cube and square roots of the first primes, as the hash defines them."""
    primes = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]

    def cube_root(n: int) -> int:
        low, high = 0, 1 << 40
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if middle**3 <= n else (low, middle)
        return low

    rounds = [cube_root(p << 96) & 0xFFFFFFFF for p in primes[:64]]
    return np.array(rounds, np.uint32), np.array([isqrt(p << 64) & 0xFFFFFFFF for p in primes[:8]], np.uint32)


_ROUND, _START = _constants()
_HEX = np.array([list(b"%02x" % b) for b in range(256)], np.uint8)


def _resume(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """SHA-256 states (lanes, 8) after one more block (lanes, 64 bytes) each."""
    def turned(x: np.ndarray, n: int) -> np.ndarray:
        return (x >> np.uint32(n)) | (x << np.uint32(32 - n))

    words = list(blocks.view(">u4").astype(np.uint32).T)
    a, b, c, d, e, f, g, h = states.T
    for i in range(64):
        if i >= 16:
            near, far = words[i - 15], words[i - 2]
            words.append(words[i - 16] + words[i - 7] + (turned(near, 7) ^ turned(near, 18) ^ (near >> np.uint32(3)))
                         + (turned(far, 17) ^ turned(far, 19) ^ (far >> np.uint32(10))))
        one = h + (turned(e, 6) ^ turned(e, 11) ^ turned(e, 25)) + ((e & f) ^ (~e & g)) + _ROUND[i] + words[i]
        two = (turned(a, 2) ^ turned(a, 13) ^ turned(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def _as_block(digests: np.ndarray) -> np.ndarray:
    """Digests (lanes, 32) as the 64 bytes of their hex text."""
    return np.ascontiguousarray(_HEX[digests].reshape(len(digests), 64))


def _closed(states: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks, whose states these are."""
    last = np.zeros((len(states), 64), np.uint8)
    last[:, 0] = 0x80
    last[:, 56:] = (children.astype(np.int64) * 512).astype(">u8").view(np.uint8).reshape(-1, 8) if len(states) else 0
    return _resume(states, last).astype(">u4").view(np.uint8).reshape(-1, DIGEST)


def _digests(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(-1, DIGEST)


class _Level:
    """Parents over the nodes of many chunks, with the states before each slot."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray):
        """``nodes`` of all chunks, one after the other; ``sizes``: nodes of each chunk."""
        parents = -(-sizes // FAN)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(nodes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.parent = np.repeat(np.cumsum(parents) - parents, sizes) + inside // FAN
        self.slot = inside % FAN
        self.many = np.bincount(self.parent, minlength=int(parents.sum()))
        self.first = np.cumsum(self.many) - self.many
        self.nodes, self.sizes, self.owner = nodes, parents, owner
        states = np.tile(_START, (len(self.many), 1))
        self.mid = np.empty((len(nodes), 8), np.uint32)
        for slot in range(FAN):
            on = np.flatnonzero(self.many > slot)
            self.mid[self.first[on] + slot] = states[on]
            states[on] = _resume(states[on], _as_block(nodes[self.first[on] + slot]))
        self.tops = _closed(states, self.many)

    def fold(self, digests: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Parents' digests once the nodes ``at`` are replaced, each on its own, by ``digests``."""
        parent, slot = self.parent[at], self.slot[at]
        states = _resume(self.mid[at], _as_block(digests))
        for right in range(1, FAN):
            on = np.flatnonzero(slot + right < self.many[parent])
            states[on] = _resume(states[on], _as_block(self.nodes[at[on] + right]))
        return _closed(states, self.many[parent])

    def siblings(self, i: int) -> tuple[bytes, bytes]:
        first, slot, many = self.first[self.parent[i]], self.slot[i], self.many[self.parent[i]]
        return self.nodes[first: i].tobytes(), self.nodes[i + 1: i - slot + many].tobytes()


def _levels(raw: list[bytes], totals: list[int]) -> list[_Level]:
    """The levels of some chunks.  ``totals``: nodes of each chunk's group,
    which decide how many levels there are before a single node is left.
    Chunks that end earlier stay as they are, so only equally high ones may
    be given together."""
    nodes = _digests(b"".join(raw))
    sizes, out, left = np.array([len(x) // DIGEST for x in raw], np.int64), [], max(totals)
    while left > 1 and len(out) < CHUNK_LEVELS:
        out.append(_Level(nodes, sizes))
        nodes, sizes, left = out[-1].tops, out[-1].sizes, -(-left // FAN)
    return out


def _by_height(totals: pd.Series, most: int = 64):
    """Positions of rows of equal height in their chunk, so many together at most."""
    heights = totals.map(lambda n: sum(FAN**k < n for k in range(CHUNK_LEVELS)))
    for _, rows in totals.groupby(heights).groups.items():
        where = totals.index.get_indexer(rows)
        for i in range(0, len(where), most):
            yield where[i: i + most]


@F.pandas_udf(T.BinaryType())
def _chunk_top(nodes: pd.Series, totals: pd.Series) -> pd.Series:
    with np.errstate(over="ignore"):
        out: list = [None] * len(nodes)
        for rows in _by_height(totals):
            raw = [nodes.iloc[i] for i in rows]
            levels = _levels(raw, [totals.iloc[i] for i in rows])
            tops = levels[-1].tops if levels else _digests(b"".join(raw))
            for i, top in zip(rows, tops):
                out[i] = top.tobytes()
        return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.ArrayType(STEP)))
def _chunk_steps(nodes: pd.Series, totals: pd.Series) -> pd.Series:
    """Of every node of a chunk: the steps up to the chunk's top."""
    with np.errstate(over="ignore"):
        out: list = []
        for raw, total in zip(nodes, totals):
            levels = _levels([raw], [total])
            paths: list[list[dict]] = [[] for _ in range(len(raw) // DIGEST)]
            at = np.arange(len(paths))
            for level in levels:
                for path, i in zip(paths, at):
                    left, right = level.siblings(i)
                    path.append({"mid": level.mid[i].astype("<u4").tobytes(), "left": left, "right": right})
                at = level.parent[at]
            out.append(paths)
        return pd.Series(out, dtype=object)


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _chunk_fold(nodes: pd.Series, totals: pd.Series, given: pd.Series, path: pd.Series) -> pd.Series:
    """The root that each replaced node of a chunk leads to."""
    with np.errstate(over="ignore"):
        out: list = [None] * len(nodes)
        for rows in _by_height(totals):
            levels = _levels([nodes.iloc[i] for i in rows], [totals.iloc[i] for i in rows])
            digests = _digests(b"".join(given.iloc[i] for i in rows))
            sizes = [len(given.iloc[i]) // DIGEST for i in rows]
            at = np.arange(len(digests))
            for level in levels:
                digests, at = level.fold(digests, at), level.parent[at]
            for i, mine in zip(rows, np.split(digests, np.cumsum(sizes)[:-1])):
                for step in path.iloc[i]:
                    mine = _stepped(mine, step)
                out[i] = [d.tobytes() for d in mine]
        return pd.Series(out, dtype=object)


def _stepped(digests: np.ndarray, step: dict) -> np.ndarray:
    """Replacements of one node, each folded into its parent."""
    states = _resume(np.tile(np.frombuffer(step["mid"], "<u4").astype(np.uint32), (len(digests), 1)), _as_block(digests))
    for sibling in _digests(step["right"]):
        states = _resume(states, np.tile(_as_block(sibling[None]), (len(digests), 1)))
    children = (len(step["left"]) + len(step["right"])) // DIGEST + 1
    return _closed(states, np.full(len(digests), children))


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def _chunk_proofs(nodes: pd.Series, totals: pd.Series, path: pd.Series) -> pd.Series:
    """Of every node of a chunk: the siblings on its way to the root, left to right, level by level."""
    with np.errstate(over="ignore"):
        out = []
        for raw, total, above in zip(nodes, totals, path):
            levels = _levels([raw], [total])
            rest = b"".join(s["left"] + s["right"] for s in above)
            proofs, at = [b""] * (len(raw) // DIGEST), np.arange(len(raw) // DIGEST)
            for level in levels:
                proofs = [p + b"".join(level.siblings(i)) for p, i in zip(proofs, at)]
                at = level.parent[at]
            out.append([p + rest for p in proofs])
        return pd.Series(out, dtype=object)


def field(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]).cast("binary"), 256))


def _numbered(rows: DataFrame, keys: Sequence[str], put: Scratch) -> DataFrame:
    """Adds ``idx`` and ``total``: place from 0, and rows, within ``grp``, in
    the order of ``keys``.  Rows are dealt by range with a salt after the keys,
    so neither a large group nor many equal rows meet in one task."""
    salted = with_rid(rows, "_salt")
    order = [F.asc_nulls_first(k) for k in ("grp", *keys, "_salt")]
    dealt = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
    placed = put(with_rid(dealt)).withColumn("_piece", F.shiftright("_rid", RID_BITS))
    before = Window.partitionBy("grp").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (placed.groupBy("grp", "_piece").agg(F.min("_rid").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")) - F.col("_first"))
              .withColumn("total", F.sum("_n").over(Window.partitionBy("grp"))).drop("_n", "_first"))
    return placed.join(pieces, ["grp", "_piece"]).withColumn("idx", F.col("_rid") + F.col("_shift")).drop("_piece", "_rid", "_shift")


def _chunked(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """One row for up to ``CHUNK`` consecutive nodes of a group."""
    member = F.struct("idx", "digest", *payload)
    return (nodes.groupBy("grp", F.floor(F.col("idx") / CHUNK).alias("chunk"))
            .agg(F.first("total").alias("total"), F.sort_array(F.collect_list(member)).alias("members"))
            .withColumn("nodes", _joined("digest")))


def _joined(name: str) -> Column:
    """The members' digests, one after the other."""
    return F.unhex(F.concat_ws("", F.transform("members", lambda m: F.hex(m[name]))))


def _tree(chunks: DataFrame, put: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Chunk tables from the bottom up, and the last single nodes (grp, digest)."""
    tables = [chunks]
    while True:
        high = F.col("total")
        for _ in range(CHUNK_LEVELS):
            high = F.ceil(high / FAN)
        tops = tables[-1].select("grp", F.col("chunk").alias("idx"), high.alias("total"), _chunk_top("nodes", "total").alias("digest"))
        tops = put(tops)
        if not tops.where("total > 1").limit(1).count():
            return tables, tops.select("grp", "digest")
        tables.append(put(_chunked(tops)))


def _with_paths(tables: list[DataFrame], above: DataFrame, put: Scratch) -> DataFrame:
    """The lowest chunks with ``path``: the steps from their top to the root.
    ``above``: (grp, path, ...) of the groups' single nodes."""
    kept = [c for c in above.columns if c != "path"]
    upper = tables[-1].join(above, "grp")
    for lower in reversed(tables[:-1]):
        steps = (upper.select(*kept, "path", F.posexplode(F.arrays_zip(F.col("members.idx").alias("i"), _chunk_steps("nodes", "total").alias("s"))))
                 .select(*kept, F.col("col.i").alias("chunk"), F.concat("col.s", "path").alias("path")))
        upper = lower.join(put(steps), ["grp", "chunk"])
    return upper


def build(rows: DataFrame, order: Sequence[str], payload: Sequence[str], put: Scratch) -> DataFrame:
    """The manifest, a row for every chunk: ``members`` (``idx``, ``digest``,
    ``payload``), ``nodes``, ``total``, ``path``, ``subroot``, ``root``.

    ``rows``: ``grp`` (a string, not null), ``digest`` (32 bytes) and others."""
    chunks = put(_chunked(_numbered(rows, [*order, "digest"], put), payload))
    tables, subroots = _tree(chunks, put)
    tops, root = _tree(put(_chunked(_numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"], put), ["name"])), put)
    # From the root down: the path of every subroot, then of every chunk.
    whole = root.select("grp", F.col("digest").alias("root"), F.array().cast(T.ArrayType(STEP)).alias("path"))
    named = _with_paths(tops, whole, put)
    above = (named.select("root", "path", F.explode(F.arrays_zip("members", _chunk_steps("nodes", "total").alias("s"))).alias("m"))
             .select(F.col("m.members.name").alias("grp"), F.col("m.members.digest").alias("subroot"), "root", F.concat("m.s", "path").alias("path")))
    return _with_paths(tables, put(above), put)


def proofs(chunks: DataFrame) -> DataFrame:
    """Adds ``proofs``, in the order of ``members``: sibling digests, one after the other."""
    return chunks.withColumn("proofs", _chunk_proofs("nodes", "total", "path"))


def folded(chunks: DataFrame, replaced: str) -> DataFrame:
    """Adds ``folded``, in the order of ``members``: the root that results when
    this member alone is replaced by its field ``replaced``."""
    return chunks.withColumn("folded", _chunk_fold("nodes", "total", _joined(replaced), "path"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def manifest(df: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), doc_id: str = "doc_id",
             group: str = "lang", replaced: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof``
    (siblings), ``folded_root``: the root recomputed from the row's proof once
    the columns ``replaced`` have other values (in the rows ``where``)."""
    put = Scratch(df.sparkSession, "merkle")
    own = leaf([F.col(c) for c in fields])
    other = leaf([(replaced or {}).get(c, F.col(c)) for c in fields])
    # A prefix keeps the null group apart from an empty name, and first.
    rows = put(df.select(F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("grp"), F.col(doc_id).alias("id"), own.alias("digest"),
                         (F.when(where, other) if where is not None else other).alias("given")))
    rows = rows.withColumn("given", F.coalesce("given", "digest"))
    chunks = proofs(folded(build(rows, ["id"], ["id", "given"], put), "given"))
    each = chunks.select("subroot", "root", F.explode(F.arrays_zip("members", "proofs", "folded")).alias("m"))
    return each.select(F.col("m.members.id").alias("doc_id"), F.col("m.members.digest").alias("leaf"), "subroot", "root",
                       F.col("m.proofs").alias("proof"), F.col("m.folded").alias("folded_root"))


def tampered(doc_id: str = "doc_id") -> Column:
    """Rows whose id's checksum three divides; null ids are not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 0, F.lit(False))
