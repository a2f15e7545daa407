"""Benchmark decontamination by a distributed positional inverted index
(operator 11): exact phrases and proximity, DataFrame functions only.

1. The training texts become postings (term, document, position) of the terms
   that the test texts hold; postings of other terms can match nothing.  Each
   document also gets a header posting at position 0 (term 0), which carries
   its id and number of words, so one pass and one table make the index.
2. A test text is cut into windows of consecutive words; equal windows, also of
   different texts, are one phrase.
3. Phrases are matched from their rarest terms: the list of the rarest one,
   adjusted by its offset to the phrase's start, is intersected with that of
   the second rarest; what is left is checked against the lists of all others.
   Joins are on (document, position, term), which no frequent term, passage or
   document makes hot.
4. Words inside any match are counted by merging the matches' ranges.

Proximity: all terms of a query within so many consecutive words, in any order.

Defined cases: null and blank texts have no words; a text of fewer words than
a window, but not none, is one window; repeated documents count each for
itself; rows of one item id are one item; a null item id counts as an item
without a name; empty tables give no match; other columns are ignored; texts
are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm.common import Scratch

WIDTH = 10
# Fixed value: what stands between words (A-Z are lower-cased).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows up to which terms or phrases are broadcast (about 50 bytes each); beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000
HEADER = 0


def words(text: Column) -> Column:
    """The words of a text, A-Z not yet lower-cased."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def lowered(word: Column) -> Column:
    # lower() would also change letters that are not ASCII, so it gets words of ASCII only.
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class Index:
    """Postings of the training texts: ``term`` (number), ``doc`` (row number),
    ``pos`` (from 1).  ``terms``: (term, word), ``sizes``: (term, postings)."""

    def __init__(self, docs: DataFrame, vocabulary: DataFrame, put: Scratch, doc_id: str = "doc_id", text: str = "text"):
        """``vocabulary``: distinct (word); terms of other words are left out."""
        named = vocabulary.select("word").distinct()
        # Numbered from 1 by the rows' places: written at once, so that the numbers stay.
        self.terms = put(named.withColumn("term", F.monotonically_increasing_id() + 1))
        self.count = self.terms.count()
        lookup = self.terms.union(docs.sparkSession.createDataFrame([("", HEADER)], "word string, term long"))
        rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words"))
        each = rows.select("doc", "doc_id", F.size("words").alias("n"), F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word"))
        first = F.col("pos") == 0
        self.rows = put(each.withColumn("word", lowered(F.col("word"))).join(_small(lookup, self.count), "word").select(
            "term", "doc", "pos", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("n")).alias("n")))
        self.postings = self.rows.where(F.col("term") != HEADER).select("term", "doc", "pos")
        self.documents = self.rows.where(F.col("term") == HEADER).select("doc", "doc_id", F.col("n").cast("long").alias("n_words"))
        self.sizes = put(self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("size")))


def _by_rarity(phrases: DataFrame, index: Index) -> DataFrame:
    """(phrase, offset, term, size, rank): the terms of each phrase, rarest
    first; phrases with a term that the index lacks are left out."""
    at = phrases.select("phrase", F.size("terms").alias("k"), F.posexplode("terms").alias("offset", "term"))
    sized = at.join(index.sizes, "term")
    mine = Window.partitionBy("phrase")
    return (sized.withColumn("rank", F.row_number().over(mine.orderBy("size", "term", "offset")))
            .withColumn("found", F.count(F.lit(1)).over(mine)).where("found = k").drop("found"))


def phrase_matches(index: Index, phrases: DataFrame, put: Scratch) -> DataFrame:
    """(phrase, doc, start, k): every place where a phrase's words stand in order.

    ``phrases``: ``phrase`` (unique) and ``terms``, an array of ``k`` terms."""
    ranked = put(_by_rarity(phrases, index))
    count = ranked.where("rank = 1").count()
    first = ranked.where("rank = 1").select("phrase", "k", "term", F.col("offset").alias("o1"))
    second = ranked.where("rank = 2").select("phrase", F.col("term").alias("t2"), F.col("offset").alias("o2"))
    seeds = _small(first.join(second, "phrase", "left"), count)
    starts = index.postings.join(seeds, "term").withColumn("start", F.col("pos") - F.col("o1")).where("start >= 1")
    found = put(starts.select("phrase", "doc", "start", "k", "t2", "o2"))
    # Postings of second terms only, on both sides of the intersection.
    others = index.postings.join(_small(second.select(F.col("t2").alias("term")).distinct(), count), "term", "left_semi")
    both = (found.where("k > 1").withColumn("pos", F.col("start") + F.col("o2")).withColumnRenamed("t2", "term")
            .join(others, ["doc", "pos", "term"], "left_semi"))
    left = put(both.select("phrase", "doc", "start", "k").union(found.where("k = 1").select("phrase", "doc", "start", "k")))
    rest = ranked.where("rank > 2").groupBy("phrase").agg(F.collect_list(F.struct("offset", "term")).alias("rest"))
    open_ = left.where("k > 2").join(_small(rest, count), "phrase")
    probes = (open_.select("phrase", "doc", "start", "k", F.explode("rest").alias("r"))
              .select("phrase", "doc", "start", "k", (F.col("start") + F.col("r.offset")).alias("pos"), F.col("r.term").alias("term")))
    # Only the documents still in question: their ids are few unless much of the corpus is contaminated.
    asked = put(left.where("k > 2").select("doc").distinct())
    held = index.postings.join(_small(asked, asked.count()), "doc", "left_semi")
    met = probes.join(held, ["doc", "pos", "term"], "left_semi").groupBy("phrase", "doc", "start", "k").agg(F.count(F.lit(1)).alias("m"))
    return put(met.where("m = k - 2").drop("m").union(left.where("k <= 2")))


def proximity_matches(index: Index, queries: DataFrame, within: int, put: Scratch) -> DataFrame:
    """(phrase, doc, pos): every posting that ends a stretch of ``within``
    consecutive words which holds all terms of a query, in any order.

    ``queries``: ``phrase`` and ``terms``; a term named twice counts once."""
    ranked = put(_by_rarity(queries.select("phrase", F.array_distinct("terms").alias("terms")), index))
    count = ranked.where("rank = 1").count()
    bucket = F.floor(F.col("pos") / within)
    # Only postings near one of the rarest term: its own stretch, the one before and the one after.
    near = (index.postings.join(_small(ranked.where("rank = 1").select("phrase", "term"), count), "term")
            .select("phrase", "doc", F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket")).distinct())
    terms = ranked.select("phrase", "term", "k")
    mine = index.postings.join(_small(terms, terms.count()), "term").withColumn("bucket", bucket)
    close = mine.join(near, ["phrase", "doc", "bucket"], "left_semi")
    stretch = Window.partitionBy("phrase", "doc").orderBy("pos").rangeBetween(-(within - 1), 0)
    return (close.withColumn("held", F.size(F.collect_set("term").over(stretch))).where("held = k").select("phrase", "doc", "pos"))


def _hit_words(matches: DataFrame) -> DataFrame:
    """(doc, n_hit): words covered by the ranges of a document's matches."""
    ranges = matches.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("k")).alias("end"))
    before = Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    return ranges.withColumn("new", F.greatest(fresh, F.lit(0))).groupBy("doc").agg(F.sum("new").cast("long").alias("n_hit"))


def item_windows(items: DataFrame, width: int, item_id: str, text: str) -> DataFrame:
    """(item, window): ``item`` a struct of the id, ``window`` an array of ``width`` words, or all of a shorter text."""
    row = items.select(F.struct(F.col(item_id).alias("id")).alias("item"), F.transform(words(F.col(text)), lowered).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return row.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("window")).distinct()


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside any
    match) and ``items`` (ids with a match, as sorted strings), ``n_items``."""
    kept, put = Scratch(docs.sparkSession, "decontaminate"), Scratch(docs.sparkSession, "decontaminate-rounds")
    windows = put(item_windows(items, width, item_id, item_text))
    index = Index(docs, windows.select(F.explode("window").alias("word")), put, doc_id, text)
    numbered = put(windows.select("window").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    at = numbered.select("phrase", F.posexplode("window").alias("i", "word")).join(_small(index.terms, index.count), "word")
    phrases = put(at.groupBy("phrase").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "term"))), lambda x: x["term"]).alias("terms")))
    matches = put(phrase_matches(index, phrases, put))
    owners = put(windows.join(numbered, "window").select("phrase", "item"))
    held = matches.select("doc", "phrase").distinct().join(owners, "phrase").select("doc", "item").distinct()
    name = F.col("item.id").cast("string")
    named = held.groupBy("doc").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list(name)).alias("items"))
    out = index.documents.join(_hit_words(matches), "doc", "left").join(named, "doc", "left")
    result = kept(out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                             F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                             F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    put.remove()
    return result


def phrase_table(phrases: Sequence[tuple[object, str]], index: Index) -> DataFrame:
    """(phrase, terms) of a few named texts, for the searches above; texts with
    a word that the index does not know are left out."""
    spark = index.rows.sparkSession
    rows = spark.createDataFrame(list(phrases), "phrase long, text string")
    at = rows.select("phrase", F.posexplode(F.transform(words(F.col("text")), lowered)).alias("i", "word"))
    known = at.join(index.terms, "word", "left").groupBy("phrase").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "term"))), lambda x: x["term"]).alias("terms"))
    return known.where(~F.exists("terms", lambda t: t.isNull()))
