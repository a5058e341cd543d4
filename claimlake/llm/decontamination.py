"""Benchmark decontamination: distributed positional inverted index (operator 12, built-in functions only).

Test items are cut into windows of ``width`` consecutive words. The terms of a
window are ranked from the rarest to the commonest in the training texts (they
are counted over all of them). Postings of the terms that are some window's
rarest are stored: the document's row, the position, and the terms at the
positions around it. This is an index partitioned by document, so the lists of
a document meet where it was read, and nothing but matches is shuffled.

A window is matched from its rarest term's postings: the other terms' lists,
adjusted by their offsets, are intersected with it in order of rarity, until
one of them has no such position. ``phrases`` asks for every term at its exact
offset, ``proximity`` for all terms within a span of words, in any order.

The rarest terms are broadcast, in blocks of about ``BLOCK_WORDS`` test words:
a larger benchmark takes more passes over the texts, not more memory. Matches
are folded per document by an aggregate (its items) and a window over its
spans (its words), which spills and holds no more than the document's spans.

Defined cases: words are compared with A-Z in lower case; an item with fewer
words than ``width`` is one window, one without words matches nothing; null
texts have no words; items that share an id count once, a null item id counts
as the empty string; rows that repeat a document id are reported one by one;
empty tables give an empty result or no hits; further columns are ignored.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower, stored, union_all

WIDTH = 10
#: Test words whose windows are broadcast at once.
BLOCK_WORDS = 1_000_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(text: Column) -> Column:
    """The words of a text, one blank between them."""
    return F.btrim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS, " "), F.lit(" "))


def _words(body: str) -> Column:
    return F.split(body, " ")


def test_sequences(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct word sequences of the items: ``seq``, ``body`` and the ``ids`` that have it."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), normalised(F.col(text)).alias("body"))
    listed = named.where("body <> ''").groupBy("body").agg(F.array_sort(F.collect_set("item")).alias("ids"))
    return listed.select(F.sha2(F.col("body").cast("binary"), 256).alias("seq"), "body", "ids")


def term_counts(texts: DataFrame, sequences: DataFrame) -> DataFrame:
    """(term, n): how often each term of the sequences occurs in all texts (zero included)."""
    terms = sequences.select(F.explode(_words("body")).alias("term")).distinct()
    seen = texts.select(F.explode(_words("body")).alias("term")).join(F.broadcast(terms), "term").groupBy("term").agg(F.count("*").alias("n"))
    return terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def ranked_windows(sequences: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """Windows by their rarest ``term``: seq, ``first`` (window start less the term's position), ``length``, ``rest``.

    ``rest`` holds the other terms and their offsets from the rarest one, from the rarest to the commonest.
    """
    at = sequences.select("seq", F.posexplode(_words("body")).alias("pos", "term")).join(F.broadcast(counts), "term")
    lists = at.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("pos", "n", "term"))).alias("at"))  # as long as the item
    starts = F.sequence(F.lit(0), F.greatest(F.size("at") - width, F.lit(0)))
    opened = lists.select("seq", F.size("at").alias("size"), "at", F.explode(starts).alias("start"))
    by_rarity = F.array_sort(F.transform(F.slice("at", F.col("start") + 1, F.lit(width)), lambda a: F.struct(a["n"], a["term"], a["pos"])))
    ordered = opened.select("seq", "start", F.least("size", F.lit(width)).alias("length"), by_rarity.alias("by"))
    lead = F.col("by")[0]
    rest = F.transform(F.slice("by", 2, width), lambda a: F.struct((a["pos"] - lead["pos"]).alias("off"), a["term"].alias("term")))
    return ordered.select("seq", lead["term"].alias("term"), (F.col("start") - lead["pos"]).alias("first"), "length", rest.alias("rest")).distinct()


def index_postings(texts: DataFrame, windows: DataFrame, reach: int) -> DataFrame:
    """Postings of the windows' rarest terms: term, ``row``, ``pos``, and the terms ``around`` it, itself at ``mid``."""
    leads = windows.select("term").distinct()
    words = texts.select("row", _words("body").alias("words")).select("row", "words", F.posexplode("words").alias("pos", "term"))
    low = F.greatest(F.col("pos") - reach, F.lit(0))
    return words.join(F.broadcast(leads), "term").select(
        "term", "row", "pos", (F.col("pos") - low).alias("mid"), F.slice("words", low + 1, F.col("pos") - low + 1 + reach).alias("around"))


def phrases(postings: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, seq, low, high): spans of a document's words that equal a window of a sequence."""
    exact = F.forall("rest", lambda r: F.coalesce(F.get("around", F.col("mid") + r["off"]) == r["term"], F.lit(False)))
    found = postings.join(F.broadcast(windows), "term").where(exact)
    low = F.col("pos") + F.col("first")
    return found.select("row", "seq", low.alias("low"), (low + F.col("length") - 1).alias("high"))


def proximity(postings: DataFrame, windows: DataFrame, within: int) -> DataFrame:
    """(row, seq, low, high): the first spans of at most ``within`` words that hold all terms of a window, in any order.

    One span is given for each posting of the window's rarest term. ``postings`` must reach ``within - 1`` words.
    """
    needed = F.array_distinct(F.transform("rest", lambda r: r["term"]))
    starts = F.sequence(F.greatest(F.col("mid") - within + 1, F.lit(0)), F.col("mid"))
    whole = F.filter(starts, lambda s: F.size(F.array_except("needed", F.slice("around", s + 1, F.lit(within)))) == 0)
    found = postings.join(F.broadcast(windows.withColumn("needed", needed)), "term").withColumn("at", F.get(whole, F.lit(0))).where("at IS NOT NULL")
    low = F.col("pos") - F.col("mid") + F.col("at")
    high = low + F.least(F.lit(within), F.size("around") - F.col("at")) - 1
    return found.select("row", "seq", low.alias("low"), high.alias("high"))


def _matches(docs: DataFrame, items: DataFrame, id_col: str, text: str, item_id: str, item_text: str, width: int, within: int | None):
    """The texts (row, id, n_words) and their matches (row, seq, low, high, ids)."""
    body = docs.select(F.col(id_col).alias("id"), normalised(F.col(text)).alias("body"))
    n_words = F.when(F.col("body") == "", 0).otherwise(F.size(_words("body"))).cast("long")
    texts = stored(body.select(F.monotonically_increasing_id().alias("row"), "id", n_words.alias("n_words"), "body"), "test-texts")
    sequences = stored(test_sequences(items, item_id, item_text), "test-sequences")
    words = sequences.agg(F.sum(F.size(_words("body")) + F.size("ids"))).first()[0] or 0
    blocks = ceil(words / BLOCK_WORDS)
    found = []
    for block in range(blocks):
        mine = sequences.where(F.pmod(F.xxhash64("seq"), F.lit(blocks)) == block)
        windows = stored(ranked_windows(mine, term_counts(texts, mine), width), "test-windows")
        postings = stored(index_postings(texts, windows, (within or width) - 1), "postings")
        spans = phrases(postings, windows) if within is None else proximity(postings, windows, within)
        found.append(spans.join(F.broadcast(mine.select("seq", "ids")), "seq"))
    return texts.select("row", "id", "n_words"), stored(union_all(found), "matches") if found else None


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, within: int | None = None) -> DataFrame:
    """One row per (document, item, span) that matches: id, ``item_id`` as text, ``low``, ``high`` (word positions)."""
    texts, found = _matches(docs, items, id_col, text, item_id, item_text, width, within)
    if found is None:
        return texts.limit(0).selectExpr("id", "cast(null as string) item_id", "0 low", "0 high").withColumnRenamed("id", id_col)
    spans = found.select("row", F.explode("ids").alias("item_id"), "low", "high").distinct()
    return spans.join(texts, "row").select(F.col("id").alias(id_col), "item_id", "low", "high")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", width: int = WIDTH, within: int | None = None) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit`` words inside matches, ``n_items``, ``items_sha256``, ``contaminated``."""
    texts, found = _matches(docs, items, id_col, text, item_id, item_text, width, within)
    if found is None:
        per_row = texts.limit(0).selectExpr("row", "0L n_hit", "array('') items")
    else:
        before = Window.partitionBy("row").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
        spans = found.select("row", "low", "high").distinct()
        new = F.greatest(F.lit(0), F.col("high") - F.greatest(F.col("low") - 1, F.coalesce(F.max("high").over(before), F.lit(-1))))
        hits = spans.select("row", new.cast("long").alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
        named = found.select("row", "seq", "ids").distinct().groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
        per_row = hits.join(named, "row")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return texts.join(per_row, "row", "left").select(
        F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
