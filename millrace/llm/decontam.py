"""Benchmark decontamination with a distributed positional inverted index; DataFrame operations only.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. The index stores a posting (document, position, term) for every
training word that occurs in some benchmark item. A phrase (a window of ``LENGTH`` consecutive item words, or the whole of a
shorter item) is found by intersecting the lists of its terms, each shifted back by the term's offset, from the rarest term in the
training text on: first the two rarest lists, then, in the documents left, all others. With a slack, every term may stand up
to that many words beside its place (proximity match).

A document is known by its id and the 128-bit MD5 digest of its text, so null ids and repeated ids with different texts stay apart; rows equal in both
give equal results. Null and empty texts have no words and are not contaminated. Items without words have no windows; an item with a null
id is searched and marks words, but is not counted among the items. An empty benchmark contaminates nothing. Only the named columns
are read.

No broadcast is asked for: the benchmark's terms and windows are written first, so that the planner knows their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.scratch import materialise

LENGTH = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # on text that is not lower-cased
DOC = ["d", "v"]
END = "."  # no word: it holds a character that parts words


def words(text: Column) -> Column:
    """The words in order; where the text begins or ends with another character, an empty string stands there."""
    return F.split(F.translate(text, UPPER, LOWER), APART)


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("d"), digest(text).alias("v"), text.alias("text"))


def digest(text: Column) -> Column:
    """The 16 bytes that tell texts apart; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(win, terms, items): each different window once, with the ids of the items that hold it."""
    items = benchmark.select(F.col(id_col).alias("item"), F.filter(words(F.col(text_col)), lambda w: w != "").alias("ws"))
    n = F.size("ws")
    starts = F.when(n > length, F.sequence(F.lit(1), n - F.lit(length - 1))).when(n > 0, F.array(F.lit(1)))
    each = items.filter(n > 0).select("item", F.explode(F.transform(starts, lambda s: F.slice(F.col("ws"), s, length))).alias("terms"))
    merged = each.groupBy("terms").agg(F.collect_set("item").alias("items"))
    return materialise(merged.select(F.monotonically_increasing_id().alias("win"), "terms", "items"), "windows")


def build_index(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (d, v, pos, term, n_words) of the training words that are in ``terms``; and for each row of ``documents`` one whose
    term is ``END``, so that texts are split once only."""
    split = documents.select(*DOC, words(F.col("text")).alias("ws"))
    counted = split.select(*DOC, F.size(F.filter("ws", lambda w: w != "")).alias("n_words"), F.array_append("ws", F.lit(END)).alias("ws"))
    tokens = counted.select(*DOC, "n_words", F.posexplode("ws").alias("pos", "term"))
    wanted = terms.select("term").unionByName(terms.sparkSession.range(1).select(F.lit(END).alias("term")))
    return materialise(tokens.join(materialise(wanted, "terms"), "term").select(*DOC, "pos", "term", "n_words"), "postings")


def matches(index: DataFrame, wins: DataFrame, slack: int = 0) -> DataFrame:
    """(win, d, v, start, len): where a window's terms stand in a row (or each within ``slack`` words of its place).

    ``start`` is where the window begins as the rarest term sees it.
    """
    index = index.filter(F.col("term") != END).select(*DOC, "pos", "term")
    places = wins.select("win", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
    rarity = index.groupBy("term").agg(F.count("*").alias("n"))
    ranked = materialise(
        places.join(rarity, "term")  # a term that never occurs takes its windows along
        .withColumn("rank", F.row_number().over(W.partitionBy("win").orderBy("n", "off")))
        .withColumn("found", F.count("*").over(W.partitionBy("win")))
        .filter("found = len").drop("found", "n"), "ranked")

    def lists(rank: int) -> DataFrame:
        return (index.join(ranked.filter(F.col("rank") == rank), "term")
                .select("win", *DOC, (F.col("pos") - F.col("off")).alias("start"), "len"))

    shifts = F.explode(F.sequence(F.lit(-slack), F.lit(slack))).alias("shift")
    first, second = lists(1), lists(2).drop("len")
    if slack:
        second = second.select("win", *DOC, "start", shifts).select("win", *DOC, (F.col("start") + F.col("shift")).alias("start"))
    # documents by null-safe equality: the id may be null
    ids = F.coalesce(F.col("d").cast("string"), F.lit("")).alias("k"), F.col("d").isNull().alias("none")
    keyed = lambda df: df.select("*", *ids)
    on = ["win", "k", "none", "v", "start"]
    two = keyed(first.filter("len > 1")).join(keyed(second).select(*on).distinct() if slack else keyed(second).select(*on), on, "left_semi")
    found = materialise(first.filter("len = 1").unionByName(two.drop("k", "none")).distinct(), "candidates")
    held = materialise(keyed(found.filter("len > 2").select(*DOC)).distinct(), "held")
    near = keyed(index).join(held.select("k", "none", "v"), ["k", "none", "v"], "left_semi").select("k", "none", "v", "pos", "term")
    wanted = (keyed(found.filter("len > 2")).join(ranked.filter("rank > 2").select("win", "rank", "off", "term"), "win")
              .select("win", *DOC, "k", "none", "start", "len", "rank", "term", (F.col("start") + F.col("off")).alias("at"), shifts)
              .withColumn("pos", F.col("at") + F.col("shift")))
    whole = (wanted.join(near, ["k", "none", "v", "pos", "term"])
             .groupBy("win", *DOC, "start", "len").agg(F.count_distinct("rank").alias("n"))
             .filter("n = len - 2").drop("n"))
    return materialise(found.filter("len <= 2").unionByName(whole), "matches")


def covered(found: DataFrame) -> DataFrame:
    """(d, v, n_hit): words inside any match, by a sweep over each document's matches."""
    spans = found.select(*DOC, "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    past = F.max("end").over(W.partitionBy(*DOC).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(past, F.col("start")))
    return spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*DOC).agg(F.sum("fresh").alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated, text_digest) per row; items is the sorted list of item ids as text."""
    documents = identified(docs, id_col, text_col)
    wins = windows(benchmark, item_col, item_text_col, length)
    index = build_index(documents, wins.select(F.explode("terms").alias("term")).distinct())
    found = matches(index, wins)
    hits = covered(found)
    of_doc = (found.select("win", *DOC).distinct().join(wins.select("win", F.explode("items").alias("item")), "win")
              .groupBy(*DOC).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    marks = materialise(hits.join(of_doc.select(F.col("d").alias("d2"), F.col("v").alias("v2"), "items"),
                                  F.col("d").eqNullSafe(F.col("d2")) & (F.col("v") == F.col("v2")), "left")
                        .select(F.col("d").alias("hit_d"), F.col("v").alias("hit_v"), "n_hit", "items"), "marks")
    sized = index.filter(F.col("term") == END).select(*DOC, "n_words")  # a row each
    out = sized.join(marks, F.col("d").eqNullSafe(F.col("hit_d")) & (F.col("v") == F.col("hit_v")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("d").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
                      F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      items.alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.col("v").alias("text_digest"))
