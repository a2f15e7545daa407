import random
import re

import numpy as np
from pyspark.sql import functions as F

from tiersmith.llm import license_scan, url_filter


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(r), r, v) for v, r in url_filter.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_against_brute_force_and_trees_judge_the_rest(spark):
    rng = random.Random(1)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'M.', 'a.b.'])}{rng.choice(['example', 'Other', 'x1'])}.{rng.choice(['org', 'com', 'net', 'COM'])}"
            f"/{rng.choice(['en', 'es', 'de', 'fr'])}/{rng.randrange(3000)}{rng.choice(['', '.html', '?a=1&b=2', '#top', '/'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "x://", "://org/", "http://org", "http://org/", "http://com?x=/fr/", "a://b://org/en", "http://example.org/en/1", "http://xexample.org/es/",
             "http://ORG/é ü", "http://e.com/fr/" + "x" * 50_000, urls[0], urls[0]]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, suffix string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block") and 0 <= got[i]["block_score"] <= 1


def test_trees_learn_from_labelled_urls(spark):
    """Blocked pages have many digits; held-out URLs without a rule follow them."""
    rng = random.Random(2)
    rows = []
    for i in range(600):
        bad = i % 2
        tail = "".join(rng.choice("0123456789" if bad else "abcdefgh") for _ in range(20))
        host, lang = ("example.com", "de" if bad else "fr") if i < 400 else ("example.info", "xx")
        rows.append((i, f"http://{host}/{lang}/{tail}", bad))
    df = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df).collect()}
    held = [got[i] == ("block" if bad else "allow") for i, _, bad in rows if i >= 400]
    assert sum(held) >= 0.95 * len(held)


def test_repeated_urls_are_learned_from_once(spark):
    """Whatever the sample's bound: three URLs in 600 rows, and one that has most rows."""
    three = ["http://example.org/es/a", "https://example.org/fr/b?x=1", "http://other.net/c"]
    for urls in (three * 200, three + [three[0]] * 400 + [f"http://h{i}.example.org/en/{i % 3}" for i in range(60)]):
        df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
        for bound in (1, 10, 20_000):
            out = url_filter.judge_urls(df, fit_rows=bound).collect()
            assert len(out) == len(urls)
            assert len({(urls[r.page_id], r.verdict, r.block_score) for r in out}) == len(set(urls))


def test_suffix_statistics_leave_out_the_own_fold(spark):
    rows = [(f"http://a.com/{i}", f"s{i % 2}", float(i % 3 == 0) if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "_url string, suffix string, _y double")
    fold = {r[0]: r[1] for r in df.select("_url", F.pmod(F.xxhash64("_url"), F.lit(url_filter.FOLDS))).collect()}
    out, known, blocked = url_filter._with_suffix_statistics(df)
    assert (known, blocked) == (30, sum(y or 0 for _, _, y in rows))
    for r in out.collect():
        others = [y for u, s, y in rows if s == r.suffix and y is not None and (r._y is None or fold[u] != fold[r._url])]
        assert abs(r.suffix_blocked - (sum(others) + 5) / (len(others) + 10)) < 1e-12 and r.suffix_share == 0.5


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge_urls(df).collect()] == ["allow", "allow"]
    assert url_filter.judge_urls(df.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/de/x"), (2, "http://b.net/")], "page_id long, url string")
    assert [r["verdict"] for r in url_filter.judge_urls(one).collect()] == ["block", "block"]


def full_alignment(template, text):
    """Local alignment without a band: number of matched words of a best-scoring path."""
    n, m = len(template), len(text)
    best = np.zeros((n + 1, m + 1), int)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            best[i, j] = max(0, best[i - 1, j - 1] + (2 if template[i - 1] == text[j - 1] else -1), best[i - 1, j] - 1, best[i, j - 1] - 1)
    return best.max()


def noisy(words, rng):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < 0.03 else [w, "noise"] if x < 0.06 else ["other"] if x < 0.09 else [w]
    return out


def test_scan_against_full_alignment(spark):
    rng = random.Random(3)
    index = license_scan.Index(license_scan.TEMPLATES)
    for _ in range(60):
        name = rng.choice(index.names)
        words = license_scan.TEMPLATES[name].split()
        text = ["word%d" % rng.randrange(99) for _ in range(rng.randrange(20))] + noisy(words, rng) + ["tail"] * rng.randrange(10)
        code = np.array([index.vocabulary.get(w, 0) for w in license_scan.words_of(" ".join(text))])
        t = index.names.index(name)
        expected = full_alignment(index.codes[t].tolist(), code.tolist())
        regions = [r for r in index.regions(code) if r[0] == t]
        got = 0
        for _, _, _, low, high in regions:
            pairs = license_scan.align(index.codes[t], code, low, high)
            assert all(index.codes[t][a] == code[b] for a, b in pairs) and pairs == sorted(pairs)
            gaps = sum((b[0] - a[0] - 1) + (b[1] - a[1] - 1) for a, b in zip(pairs, pairs[1:]))
            got = max(got, 2 * len(pairs) - gaps)
        if expected >= 1.6 * len(index.codes[t]):
            assert got >= 0.8 * expected


def test_winnowing_finds_every_shared_run():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = rng.integers(0, 2 ** 60, 40).astype(np.uint64), rng.integers(0, 2 ** 60, 50).astype(np.uint64)
        at, to = rng.integers(0, 38), rng.integers(0, 48)
        b[to: to + license_scan.WINDOW] = a[at: at + license_scan.WINDOW]
        assert {int(a[i]) for i in license_scan.winnow(a)} & {int(b[i]) for i in license_scan.winnow(b)}


def test_rows_of_texts(spark, docs):
    mit = license_scan.TEMPLATES["MIT (statement)"]
    gpl = license_scan.TEMPLATES["GPL-3.0 (statement)"]
    rows = [(1, f"Some words. {mit} More. {mit}"), (2, None), (3, ""), (4, "nothing here " * 5000 + gpl.upper()), (5, gpl.replace("General ", "")), (5, gpl.replace("General ", "")), (None, mit), (7, "the mit of")]
    df = docs(rows).withColumnRenamed("lang", "license")
    got = sorted(((str(r["doc_id"]), r["license"], r["matched"], r["start"], r["stop"], [tuple(s) for s in r["spans"]]) for r in license_scan.scan_licenses(df).collect()))
    assert got == sorted([("1", "MIT (statement)", 5, 2, 7, [(2, 7)]), ("1", "MIT (statement)", 5, 8, 13, [(8, 13)]), ("4", "GPL-3.0 (statement)", 12, 10_000, 10_012, [(10_000, 10_012)]),
                          ("5", "GPL-3.0 (statement)", 11, 0, 11, [(0, 11)]), ("5", "GPL-3.0 (statement)", 11, 0, 11, [(0, 11)]), ("None", "MIT (statement)", 5, 0, 5, [(0, 5)])])
    assert license_scan.scan_licenses(docs([])).count() == 0


def names_in(index, text):
    return [m["license"] for m in index.scan(text)]


def test_every_template_is_found_as_itself():
    """Whole texts, notices and statements, also with a few words changed."""
    templates = license_scan.all_templates()
    index, rng = license_scan.Index(templates), random.Random(4)
    for name, text in templates.items():
        (got,) = index.scan(f"some words before {text} and some after")
        assert (got["license"], got["coverage"]) == (name, 1.0)
        words = text.split()
        if len(words) > 60 and len(words) < 2000:
            told = {w.encode() for part in license_scan.TELLING.get(name, ((), ())) for w in part}
            changed = [w if rng.random() < 0.97 or license_scan.words_of(w)[0:1] == [] or license_scan.words_of(w)[0] in told else "other" for w in words]
            assert names_in(index, " ".join(changed)) == [name]


def test_whole_texts_are_wanted():
    """The opening of a license is not the license, and its span reaches its end."""
    templates = license_scan.all_templates()
    index = license_scan.Index(templates)
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-2.0"):
        words = templates[name].split()
        assert name not in names_in(index, " ".join(words[: len(words) // 2]))
        (got,) = index.scan(" ".join(["x"] * 7 + words))
        assert got["start"] == 7 and got["stop"] == 7 + len(words)
    two = index.scan(" x ".join([templates["MIT"]] * 2 + [templates["GPL-2.0"]] * 2))
    assert [m["license"] for m in two] == ["MIT", "MIT", "GPL-2.0", "GPL-2.0"]


def test_words_that_tell_licenses_apart():
    index = license_scan.Index(license_scan.all_templates())
    gnu = "This work is licensed under the GNU {}, version {}."
    for text, expected in (
        (gnu.format("Lesser General Public License", "3"), ["LGPL-3.0 (statement)"]),
        (gnu.format("General Public License", "2"), ["GPL-2.0 (statement)"]),
        (gnu.format("Affero General Public License", "3"), ["AGPL-3.0 (statement)"]),
        (gnu.format("General Public License", "4"), []),
        (gnu.format("Free Documentation License", "3"), []),
        ("Released under the Zlib License.", []),
        ("Released under the BSD 3-Clause License.", ["BSD-3-Clause (statement)"]),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0 (statement)"]),
        ("Licensed under CC BY-NC 2.0.", []),
        ("Licensed under the Apache License, Version 1.1.", []),
        (license_scan.TEMPLATES["GPL-2.0-only (notice)"].replace("version 2", "version 1"), []),
    ):
        assert names_in(index, text) == expected, text
    # Relatives without a template of their own are not taken for their neighbour.
    texts = license_scan.all_templates()
    assert "BSD-3-Clause" not in names_in(index, texts["BSD-3-Clause"].replace("3. Neither", "3. All advertising materials must display an acknowledgement. 4. Neither"))
    assert names_in(index, texts["CC-BY-SA-4.0"].replace("ShareAlike", "")) == []
    assert names_in(index, texts["ISC"].replace("provided that the\nabove copyright notice and this permission notice appear in all copies", "")) == []
