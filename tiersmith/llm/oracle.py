"""DuckDB SQL of the operators that SQL can express, written independently."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
i AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS t
        FROM i, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(s) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS t FROM d, ks, unnest(generate_series(1, len(w) - k + 1)) AS u(s) WHERE len(w) >= k),
m AS (SELECT DISTINCT r, s, k, item_id FROM dw JOIN win USING (k, t)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(s, s + k - 1)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""

RANKED_SEARCH = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
all_docs AS (SELECT count(*) AS nn, sum(len(w)) AS ll FROM d WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS f FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, all_docs GROUP BY t),
doc AS (SELECT r, doc_id, 100 - 75 + (75 * len(w) * nn) // ll AS m FROM d, all_docs WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_words('text')}) AS t FROM benchmark) GROUP BY item_id, t),
scored AS (SELECT item_id, r, sum(c * weight.w * ((1000000000 * f) // (1000 * f + 8 * m))) AS score
           FROM q JOIN weight USING (t) JOIN tf USING (t) JOIN doc USING (r) GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
           FROM scored JOIN doc USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10"""


def _field(column: str) -> str:
    return f"coalesce(octet_length(encode(CAST({column} AS VARCHAR))) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, depth: int) -> str:
    """Tables ``name``0 (grp, idx, n, h) to ``name``<depth> and each node's siblings ``name``s<level>."""
    out = []
    for k in range(depth):
        run = "OVER (PARTITION BY grp, idx // 8 ORDER BY idx ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (SELECT grp, idx, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT grp, idx // 8 AS idx, any_value((n + 7) // 8) AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h FROM {name}{k} GROUP BY grp, idx // 8)""")
    return ",\n".join(out)


def _folds(name: str, first: str, tree: str, depth: int) -> str:
    """``name``0 (from ``first``) to ``name``<depth>: rows on their way up."""
    out = [f"{name}0 AS ({first})"]
    for k in range(depth):
        out.append(f"""{name}{k + 1} AS (SELECT f.row, f.top, f.grp, f.idx // 8 AS idx, CASE WHEN n = 1 THEN h ELSE sha256(l || h || r) END AS h,
  CASE WHEN n = 1 THEN proof ELSE proof || l || r END AS proof FROM {name}{k} f JOIN {tree}s{k} s ON f.grp = s.grp AND f.idx = s.idx)""")
    return ",\n".join(out)


_DEPTH, _TOP_DEPTH = 7, 4
# crc32 as its polynomial defines it: a table of 256 remainders, then a byte at a time.
_CRC = """steps AS (SELECT b, 0 AS step, b AS c FROM range(256) AS t(b)
  UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE step < 8),
remainders AS (SELECT list(c ORDER BY b) AS tab FROM steps WHERE step = 8),
crc AS (SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
  lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1]))) AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), remainders)"""

MERKLE = f"""WITH RECURSIVE {_CRC},
docs AS (SELECT row_number() OVER (ORDER BY 1) AS row, d.doc_id, coalesce('=' || lang, '') AS grp, {_leaf('text')} AS h,
  CASE WHEN crc % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {_leaf('text')} END AS given
  FROM documents d LEFT JOIN crc USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM docs),
a0 AS (SELECT grp, idx, n, h FROM placed),
{_levels('a', _DEPTH)},
subs AS (SELECT grp AS name, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM a{_DEPTH}),
b0 AS (SELECT '' AS grp, idx, n, h FROM subs),
{_levels('b', _TOP_DEPTH)},
{_folds('f', "SELECT row, grp AS top, grp, idx, given AS h, '' AS proof FROM placed", 'a', _DEPTH)},
{_folds('g', f"SELECT row, top, '' AS grp, subs.idx, f{_DEPTH}.h, proof FROM f{_DEPTH} JOIN subs ON subs.name = f{_DEPTH}.grp", 'b', _TOP_DEPTH)}
SELECT p.doc_id, p.h AS leaf, subs.h AS subroot, b{_TOP_DEPTH}.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = b{_TOP_DEPTH}.h AS verified
FROM placed p JOIN g{_TOP_DEPTH} g USING (row) JOIN subs ON subs.name = p.grp, b{_TOP_DEPTH}"""

ORACLES: dict[str, str] = {
    "op11_benchmark_decontamination": DECONTAMINATION,
    "op12_merkle_manifest": MERKLE,
    "op13_ranked_search": RANKED_SEARCH,
}
