import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiersmith.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i: i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    for level in levels[:-1]:
        first = i // 8 * 8
        yield level[first:i], level[i + 1: first + 8]
        i //= 8


def brute(docs, change):
    """Rows (doc_id, leaf, subroot, root, proof digest, folded root) in any order."""
    def leaf(r, text):
        return digest("".join(map(part, (r[0], r[3], r[2], r[4], text))))

    groups = {}
    for r in docs:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, change(r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
    trees = {g: tree([x[2] for x in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    for j, g in enumerate(names):
        for i, (known, doc_id, own, given) in enumerate(groups[g]):
            steps = [*path(trees[g], i), *path(top, j)]
            for left, right in steps:
                given = digest("".join([*left, given, *right]))
            proof = digest("".join("".join(left + right) for left, right in steps))
            yield doc_id if known else None, own, trees[g][-1][0], top[-1][0], proof, given


def lower(r):
    low = str.maketrans(merkle.UPPER, merkle.LOWER)
    return r[1].translate(low) if r[1] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r[1]


def found(df):
    out = merkle.manifest(df, replaced={"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, where=merkle.tampered())
    text = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")]
    rows = out.select("doc_id", *text, F.sha2(F.lower(F.hex("proof")).cast("binary"), 256), F.lower(F.hex("folded_root"))).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("blocks", [0, 1, 3, 8])
def test_states_are_those_of_the_hash(blocks):
    data = np.random.default_rng(blocks).integers(0, 256, (5, max(blocks, 1), 32)).astype(np.uint8)
    with np.errstate(over="ignore"):
        states = np.tile(merkle._START, (5, 1))
        for b in range(blocks):
            states = merkle._resume(states, merkle._as_block(data[:, b]))
        out = merkle._closed(states, np.full(5, blocks))
    assert [o.tobytes() for o in out] == [hashlib.sha256("".join(bytes(x).hex() for x in row[:blocks]).encode()).digest() for row in data]


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1], [64, 65, 2], [513, 7, 1, 1, 1, 1, 1, 1, 1, 30], [4097]])
def test_trees_of_all_heights(docs, sizes):
    rows, n = [], 0
    for g, size in enumerate(sizes):
        for _ in range(size):
            rows.append((n, f"Text {n}" if n % 5 else f"text {n}", f"l{g}" if g else None, "s", n))
            n += 1
    assert found(docs(rows[::-1])) == sorted(brute(rows, lower), key=repr)


def test_defined_cases(docs):
    rows = [(3, None, None, None, None), (3, "", "", "", 0), (None, "É ABC", "en", "s", -1), (4, "Same", "en", "s", 1), (4, "Same", "en", "s", 1),
            (4, "Other", "en", "s", 1), (9, "A" * 300_000, "\U0001F600", "ß", 2), (21, "X", "￿", "s", 5)]
    assert found(docs(rows)) == sorted(brute(rows, lower), key=repr)


def test_empty_table_and_clashing_columns(spark, docs):
    assert found(docs([])) == []
    rows = [(i, f"T{i}", "en", "s", i) for i in range(70)]
    wide = docs(rows).withColumns({c: F.lit(7) for c in ("grp", "digest", "idx", "total", "members", "id", "given", "chunk", "path", "root")})
    assert found(wide) == sorted(brute(rows, lower), key=repr)


def test_query_verifies_what_was_not_changed(spark):
    from tiersmith.llm.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    out = {r.doc_id: r for r in QUERIES["op12_merkle_manifest"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    expected = {r[0]: r[1:] for r in brute(docs, lower)}
    assert {i: (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for i, r in out.items()} == expected
    assert all(out[d.doc_id].verified == (lower(d) == d.text) for d in docs) and not all(r.verified for r in out.values())
