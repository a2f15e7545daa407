"""URL filter: rules first, gradient-boosted trees for the rest (operator 7).

Allow and block rules name a host with its subdomains and the start of a path;
the longest that fits decides.  URLs decided by a rule are the labelled
examples from which the trees learn; they judge all other URLs by lexical
features: length, depth, digit ratio, character entropy, parameter counts and
statistics of the host's suffix.  All features are column expressions.

Defined cases: a URL that is null or has no ``://`` has an empty host and path
and no rule; the trees judge it like any other; without labelled URLs of both
kinds the verdict is that of the labels there are (in the sample: of most of
them), ``allow`` without any; very long URLs are read whole; repeated URLs are
judged alike and learned from once, weighted by their number; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.common import materialize

# Fixed values: (verdict, host and path).
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
# Bound of the distinct labelled feature vectors that are fitted on (expected number, where there are more).
FIT_ROWS = 20_000
TREES, DEPTH = 12, 4
# A labelled URL's suffix is described by the labels of the other folds only.
FOLDS = 5
# Suffixes up to which their statistics are broadcast; beyond it they are joined by shuffle.
BROADCAST_ROWS = 500_000
FEATURES = ("length", "host_length", "depth", "dots", "digit_ratio", "symbol_ratio", "entropy", "parameters",
            "parameter_length", "suffix_share", "suffix_blocked", "extension", "secure")


def split_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(F.col(url), F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def match_rule(host: str, path: str, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))) & F.startswith(F.col(path), F.lit("/" + start))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _lexical(df: DataFrame) -> DataFrame:
    """``df`` (with ``_url``, ``host``, ``path``) plus the features of each URL alone."""
    url = F.col("_url")
    n = F.greatest(F.length(url), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(url, pattern, "")) / n

    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    characters = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(characters, F.lit(0.0), lambda s, c: s + F.when(
        F.length(c) > 0, (lambda p: -p * F.log2(p))((n - F.length(F.replace(url, c, F.lit("")))) / n)).otherwise(0.0))
    return df.withColumns({
        "length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"),
        "depth": (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double"),
        "dots": (F.length("host") - F.length(F.replace("host", F.lit("."), F.lit("")))).cast("double"),
        "digit_ratio": share("[^0-9]"), "symbol_ratio": share("[A-Za-z0-9]"), "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "parameter_length": F.length(query).cast("double"),
        "extension": F.col("path").rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "suffix": F.regexp_extract("host", r"([^.:]*)(:[0-9]*)?$", 1),
    })


def _with_suffix_statistics(lexical: DataFrame) -> tuple[DataFrame, float, float]:
    """``lexical`` with ``suffix_share`` and ``suffix_blocked``; the labelled rows, and the blocked ones.

    A share of blocked URLs that counted a row's own label would tell the trees
    that label, so labelled rows get the share of the other folds; equal URLs
    are in one fold."""
    fold = F.pmod(F.xxhash64("_url"), F.lit(FOLDS)).cast("int")
    folds = lexical.groupBy("suffix", fold.alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.count("_y").alias("known"), F.sum("_y").alias("blocked"))
    suffixes = materialize(folds.groupBy("suffix").agg(
        F.sum("n").alias("n"), F.sum("known").alias("known"), F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("blocked"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("known", F.coalesce("blocked", F.lit(0.0)).alias("blocked"))))).alias("own")))
    total = suffixes.agg(F.sum("n"), F.sum("known"), F.sum("blocked"), F.count(F.lit(1))).first()
    rows, known, blocked, distinct = (float(x or 0) for x in total)
    told = F.broadcast(suffixes) if distinct <= BROADCAST_ROWS else suffixes
    mine = F.when(F.col("_y").isNotNull(), F.get(F.map_values(F.map_filter("own", lambda k, _: k == fold)), F.lit(0)))
    rest = {c: F.col(c) - F.coalesce(mine[c], F.lit(0)) for c in ("known", "blocked")}
    joined = lexical.join(told, "suffix")
    # Shrunk to one half.
    return joined.withColumns({"suffix_share": F.col("n") / F.lit(max(rows, 1.0)), "suffix_blocked": (rest["blocked"] + 5.0) / (rest["known"] + 10.0)}), known, blocked


def judge_urls(df: DataFrame, keep: Sequence[str] = ("page_id",), url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
               fit_rows: int = FIT_ROWS, unseen: Column | None = None) -> DataFrame:
    """``keep``, ``host``, ``path``, ``rule``, ``verdict`` and ``block_score``
    (of the trees; null where a rule decides).  URLs that are ``unseen`` (by a
    condition on ``_url``) are judged as if no rule fitted: a held-out part."""
    named = df.select(*keep, F.coalesce(F.col(url), F.lit("")).alias("_url"))
    host, path = split_url("_url")
    matched = match_rule("host", "path", rules)
    named = named.withColumn("host", host).withColumn("path", path).withColumn("_m", matched if unseen is None else F.when(~unseen, matched))
    lexical = _lexical(named).withColumn("_y", F.when(F.col("_m").isNotNull(), (F.col("_m.verdict") == "block").cast("double")))
    described, known, blocked = _with_suffix_statistics(lexical)
    ready = described.select(*keep, "host", "path", "_m", "_y", *FEATURES)

    def settled(verdict: str) -> DataFrame:
        return ready.select(*keep, "host", "path", F.col("_m.rule").alias("rule"), F.coalesce("_m.verdict", F.lit(verdict)).alias("verdict"),
                            F.lit(None).cast("double").alias("block_score"))

    if not 0 < blocked < known:
        return settled("block" if known and blocked else "allow")
    # Distinct vectors, weighted by their rows: copies of a hot URL take one place in the sample.
    vectors = materialize(ready.where(F.col("_y").isNotNull()).groupBy("_y", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("_w")))
    share = min(1.0, fit_rows / vectors.count())
    drawn = F.pmod(F.xxhash64("_y", *FEATURES), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_x")
    sample = materialize(assembled.transform(vectors.where(drawn)).select("_x", "_y", "_w"))
    if sample.select("_y").distinct().count() < 2:
        return settled("block" if 2 * blocked > known else "allow")
    trees = GBTClassifier(featuresCol="_x", labelCol="_y", weightCol="_w", predictionCol="_guess", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.3, seed=11, checkpointInterval=-1)
    trees = trees.setRawPredictionCol("_raw").setProbabilityCol("_p")
    scored = trees.fit(sample).transform(assembled.transform(ready)).withColumn("_s", vector_to_array("_p")[1])
    free = F.col("_m").isNull()
    return scored.select(*keep, "host", "path", F.col("_m.rule").alias("rule"),
                         F.coalesce("_m.verdict", F.when(F.col("_s") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         F.when(free, F.col("_s")).alias("block_score"))
