"""Best-fit packing of token sequences by bin completion (operator 5).

Spark tokenizes the texts, cuts those longer than a sequence and counts the
pieces of each length.  The counts, one per possible length, are all that a
packing depends on, so the plan is made from them alone: best-fit decreasing
gives the first incumbent, then a branch-and-bound completes the bin of the
largest piece with undominated fillings, pruning by the waste an improvement
could still afford.  Equal bins are kept as one pattern with a number of
copies, so neither the plan nor its making grows with the documents.  Every
piece then finds its place by its rank among the pieces of its length.

Defined cases: a null or empty text is a document of the end token alone;
only documents longer than a sequence are cut, their first piece takes the
remainder; an empty table packs into nothing; repeated rows are packed each;
other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.bpe import byte_characters
from tiersmith.llm.common import gapless_rank, materialize, tidied, with_rid

CAPACITY, END_TOKEN = 1024, 2
# Branch-and-bound: nodes in all, completions tried for a bin, pieces looked at for one.
NODES, FILLINGS, SEARCH = 3_000, 12, 1_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many) of a sequence, in order
Run = tuple[Pattern, int]  # a pattern and its number of copies


def byte_encoding(vocabulary: str):
    """The byte-level BPE of a vocabulary file's text, as a fast encoder with
    the same ids: merge ranks are in the order of the ids."""
    import tiktoken

    spec = json.loads(vocabulary)
    byte = {c: b for b, c in enumerate(byte_characters())}
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
             if token not in {t["content"] for t in spec["added_tokens"]}}
    # Fixed value: the pre-tokenizer's pattern of byte-level vocabularies.
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens={t["content"]: t["id"] for t in spec["added_tokens"]})


def token_pieces(df: DataFrame, keep: Sequence[str], vocabulary: str, text: str = "text", capacity: int = CAPACITY,
                 end: int = END_TOKEN, ids: bool = False) -> DataFrame:
    """``keep`` and one row per piece: ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, on demand, ``ids``."""
    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoding = byte_encoding(vocabulary)
        special = tuple(encoding.special_tokens_set)
        for batch in batches:
            rows = []
            for value in batch:
                value = value or ""
                if any(s in value for s in special):
                    found = encoding.encode(value, allowed_special="all")
                else:
                    found = encoding.encode_ordinary(value)
                found.append(end)
                tokens = np.array(found, "<u4")
                n = len(tokens)
                cuts = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                row = [cuts[:-1], np.diff(cuts).tolist(), [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]]
                rows.append(row + [[tokens[a:b].astype(np.int32) for a, b in zip(cuts, cuts[1:])]] * ids)
            yield pd.DataFrame(rows, columns=["start", "length", "ids_crc32"] + ["ids"] * ids)

    kind = "start array<long>, length array<long>, ids_crc32 array<long>" + ", ids array<array<int>>" * ids
    cut = F.pandas_udf(run, kind)(F.col(text))
    names = ["start", "length", "ids_crc32"] + ["ids"] * ids
    return (df.select(*keep, cut.alias("_p")).select(*keep, F.posexplode(F.arrays_zip(*[f"_p.{c}" for c in names])))
            .select(*keep, F.col("pos").alias("piece"), *[f"col.{c}" for c in names]))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: the volume, and Martello and Toth's bound
    of pieces that cannot share a bin."""
    n = np.zeros(capacity + 1, np.int64)
    for length, c in counts.items():
        n[length] = c
    size = n * np.arange(capacity + 1)
    best = -(-int(size.sum()) // capacity)
    many, volume = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(size)])
    half = capacity // 2
    for a in range(1, half + 1):
        alone = many[-1] - many[capacity - a + 1]
        middle = many[capacity - a + 1] - many[half + 1]
        room = middle * capacity - (volume[capacity - a + 1] - volume[half + 1])
        small = volume[half + 1] - volume[a]
        best = max(best, int(alone + middle + max(0, -(-(small - room) // capacity))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing, a length at a time: equal open bins fill alike."""
    open_bins: dict[int, list[list]] = {}  # room -> [pattern, copies]
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, copies: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append([pattern, copies])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                if left >= each:
                    put(capacity - each * length, ((length, each),), left // each)
                if left % each:
                    put(capacity - left % each * length, ((length, left % each),), 1)
                break
            room = rooms[at]
            group = open_bins[room][-1]
            each = room // length
            copies, count = (min(group[1], left // each), each) if left >= each else (1, left)
            group[1] -= copies
            left -= copies * count
            if not group[1]:
                open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            put(room - count * length, group[0] + ((length, count),), copies)
    return [(pattern, copies) for groups in open_bins.values() for pattern, copies in groups]


def fillings(counts: dict[int, int], room: int, slack: int) -> list[Pattern]:
    """Undominated ways to fill ``room`` that waste at most ``slack``, fullest first.

    A filling is dominated if a piece left outside could replace some of its
    pieces, of no larger total, and still fit."""
    lengths = sorted((x for x, c in counts.items() if c and x <= room), reverse=True)
    found: list[tuple[int, ...]] = []
    visits = 0

    def extend(at: int, left: int, chosen: tuple[int, ...]) -> None:
        nonlocal visits
        visits += 1
        if left <= slack:
            found.append(chosen)
        if visits > SEARCH or len(found) > 8 * FILLINGS:
            return
        for i in range(at, len(lengths)):
            x = lengths[i]
            if x <= left and chosen.count(x) < counts[x]:
                extend(i, left - x, chosen + (x,))
                if visits > SEARCH or len(found) > 8 * FILLINGS:
                    return

    extend(0, room, ())

    def dominated(chosen: tuple[int, ...]) -> bool:
        left = room - sum(chosen)
        if any(x <= left and chosen.count(x) < counts[x] for x in lengths):
            return True
        for k in range(1, min(3, len(chosen)) + 1):
            for some in combinations(chosen, k):
                total = sum(some)
                if any(total <= x <= total + left and chosen.count(x) < counts[x] and some != (x,) and (x > total or k > 1) for x in lengths):
                    return True
        return False

    kept = [c for c in dict.fromkeys(found) if not dominated(c)] or found[:1]
    kept.sort(key=lambda c: (-sum(c), len(c)))
    return [tuple((x, c.count(x)) for x in dict.fromkeys(c)) for c in kept[:FILLINGS]]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Run]:
    """Patterns and copies that pack ``counts`` (pieces by length)."""
    best = best_fit(counts, capacity)
    fewest, bound = sum(c for _, c in best), lower_bound(counts, capacity)
    volume = sum(x * c for x, c in counts.items())
    counts = dict(counts)
    visited, runs = 0, []

    def search(used: int, wasted: int, left: int) -> None:
        nonlocal best, fewest, visited
        visited += 1
        if not left:
            if used < fewest:
                best, fewest = list(runs), used
            return
        largest = max(x for x, c in counts.items() if c)
        counts[largest] -= 1
        # Waste that a packing with one bin less than the incumbent can still afford.
        slack = (fewest - 1) * capacity - volume - wasted
        options = fillings(counts, capacity - largest, slack) if slack >= 0 else []
        counts[largest] += 1
        for filling in options:
            if visited >= nodes or fewest <= bound:
                return
            need = dict(filling)
            need[largest] = need.get(largest, 0) + 1
            size = sum(x * c for x, c in need.items())
            copies = min(counts[x] // c for x, c in need.items())
            if copies > 4 and wasted + copies * (capacity - size) > (fewest - 1) * capacity - volume:
                copies = max(1, ((fewest - 1) * capacity - volume - wasted) // max(1, capacity - size))
            elif copies <= 4:
                copies = 1
            waste = wasted + copies * (capacity - size)
            if used + copies + -(-(left - copies * size) // capacity) >= fewest:
                continue
            for x, c in need.items():
                counts[x] -= copies * c
            runs.append((tuple(sorted(need.items(), reverse=True)), copies))
            search(used + copies, waste, left - copies * size)
            runs.pop()
            for x, c in need.items():
                counts[x] += copies * c

    if fewest > bound:
        import sys

        depth = sys.getrecursionlimit()
        sys.setrecursionlimit(max(depth, 20_000))
        try:
            search(0, 0, volume)
        except RecursionError:
            pass  # a chain of single bins too deep for the search: the incumbent stands
        finally:
            sys.setrecursionlimit(depth)
    return best


def places(runs: list[Run]) -> pd.DataFrame:
    """For each length, which ranks go where: a row per (run, length), sorted by (length, rank)."""
    rows, taken, base = [], {}, 0
    for pattern, copies in runs:
        offset = 0
        for length, each in pattern:
            first = taken.get(length, 0)
            rows.append((length, first, base, each, offset))
            taken[length] = first + each * copies
            offset += each * length
        base += copies
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "each", "offset"]).sort_values(["length", "rank"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``."""
    rows = materialize(with_rid(pieces))
    counts = {r[0]: r[1] for r in rows.groupBy(length).agg(F.count(F.lit(1))).collect()}  # at most ``capacity`` rows
    table = places(plan_packing(counts, capacity))
    keys = (table["length"].to_numpy(np.int64) << 40) + table["rank"].to_numpy(np.int64)
    first, sequence, each, offset = (table[c].to_numpy(np.int64) for c in ("rank", "sequence", "each", "offset"))

    def locate(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for size, rank in batches:
            size, rank = size.to_numpy(np.int64), rank.to_numpy(np.int64)
            at = np.searchsorted(keys, (size << 40) + rank, side="right") - 1
            nth = rank - first[at]
            yield pd.DataFrame({"sequence_id": sequence[at] + nth // each[at], "offset": offset[at] + nth % each[at] * size})

    ranked = gapless_rank(rows, [length], "_rank")
    place = F.pandas_udf(locate, "sequence_id long, offset long")(length, "_rank")
    return ranked.withColumn("_place", place).select(*pieces.columns, "_place.sequence_id", "_place.offset")


def packed_sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and its concatenated
    ``ids``, from packed pieces that carry theirs (at most ``capacity`` ids a group)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", ids)))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p[ids])).alias("ids"))
