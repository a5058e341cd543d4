"""Mixing sources to target weights (operator 6, built-in functions only).

Efraimidis-Spirakis sampling without replacement: a document with quality
weight w gets the key -ln(u) / w, where u in (0, 1) follows from its id alone,
and a source's documents are taken in key order up to a budget of words. A
source whose target is several times its size is taken whole that many times
(complete epochs); only the rest of the target is selected by key.

A running sum over a whole source would put a hot source into one task.
Instead keys are cut into 4096 slices; sums per slice (a partial aggregate)
show the slice in which the budget ends, and only that slice's documents are
sorted and summed. The document on the border is taken if that brings the
source nearer to its target, so a source misses its target by at most half a
document.

Defined cases: a null text has no words and is never in the way; a null source
is a source of its own, ranked last; rows that repeat an id share a key, and
those that repeat id and size are taken alike; documents whose keys tie are
taken in the order of id and size; a null quality weighs least; an empty table gives an empty
result; other columns are ignored by ``mixed_sizes`` and kept by
``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import hot_keys, lookup, ranked, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: No source, and so no document, is taken more often than this.
MOST = 3.0
#: Quality weights: of natural text, and of other text.
QUALITY = (1.0, 0.25)
#: Between the first and the last of these lie the weights of a quality column.
LEVELS = tuple(2.0**-k for k in range(7))
SLICES = 4096


def n_words(text: str) -> Column:
    """Number of words: each becomes one letter, and what is left between them goes (``regexp_count`` would build all words)."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def quality_weight(text: str, size: Column) -> Column:
    """1 for text with natural word lengths (2 to 12 characters on average), else 0.25."""
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(mean.between(2.0, 12.0), F.lit(QUALITY[0])).otherwise(F.lit(QUALITY[1]))


def uniform(id_col: str) -> Column:
    """A number in (0, 1) that depends on the id alone: reruns agree."""
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """Rows with (source, source_size) get a ``target``: the budget shared by weight, water-filled under the caps.

    Weights repeat over the sources in code point order, null last. Targets
    stop at ``most`` times the source's size, and the excess is shared anew by
    weight until no target is above its cap. In closed form: sources fill up
    in the order of cap / weight, and the level at which the budget is spent
    is where the first source does not fill up. Sources are ordered in ranges,
    so no task holds them all; only the level, one number, reaches the driver.
    """
    by_name = F.col("source").asc_nulls_last()
    named = ranked(_in_ranges(sizes, [by_name], "sources"), [], F.col("__range"), [by_name], "__rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    named = named.select(*sizes.columns, w.alias("w"), (most * F.col("source_size")).alias("cap"))
    by_level = [(F.col("cap") / F.col("w")).asc(), by_name]
    caps = _in_ranges(named, by_level, "caps")
    # sums of whole ranges first (few rows), then running sums within each range
    before = Window.partitionBy().orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = caps.groupBy("__range").agg(F.sum("cap").alias("caps"), F.sum("w").alias("ws"), F.sum("source_size").alias("words"))
    ranges = ranges.select(
        "__range", (share * F.sum("words").over(Window.partitionBy())).alias("budget"), F.coalesce(F.sum("caps").over(before), F.lit(0.0)).alias("full"),
        F.sum("ws").over(Window.partitionBy().orderBy("__range").rowsBetween(0, Window.unboundedFollowing)).alias("open"))
    within = Window.partitionBy("__range").orderBy(*by_level).rowsBetween(Window.unboundedPreceding, -1)
    met = caps.select("__range", "w", "cap", *[F.coalesce(F.sum(c).over(within), F.lit(0.0)).alias(f"{c}_before") for c in ("cap", "w")])
    met = met.join(F.broadcast(ranges), "__range").withColumn("level", (F.col("budget") - F.col("full") - F.col("cap_before")) / (F.col("open") - F.col("w_before")))
    level = F.lit(met.where("level * w <= cap").agg(F.max("level")).first()[0]).cast("double")
    return caps.select(*sizes.columns, F.least("cap", F.coalesce(level * F.col("w"), F.col("cap"))).alias("target"))


def _in_ranges(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` stored with the number of the range they fall into: as many ranges as shuffle partitions at most."""
    return stored(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), name)


def given_weight(quality: str) -> Column:
    """A quality between 0 and 1 as weight, at least the smallest of LEVELS; null and NaN weigh that least."""
    q = F.nanvl(F.col(quality).cast("double"), F.lit(0.0))
    return F.least(F.greatest(F.coalesce(q, F.lit(0.0)), F.lit(LEVELS[-1])), F.lit(LEVELS[0]))


def _keyed(docs: DataFrame, id_col: str, text: str, source: str, quality: str | None) -> DataFrame:
    """``docs`` with __skey (never null), __size, __key and __slice."""
    size = n_words(text)
    rows = docs.withColumn("__skey", F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))).withColumn("__size", size)
    weight, levels = (quality_weight(text, F.col("__size")), QUALITY) if quality is None else (given_weight(quality), LEVELS)
    rows = rows.withColumn("__key", -F.log(uniform(id_col)) / weight)
    # 1 - exp(-w * key) spreads the keys of weight w evenly over [0, 1): the mean over the levels grows with the key, and no slice of it
    # holds more than len(levels) times the even share of any level's keys (twice that between two of LEVELS)
    even = sum((1 - F.exp(-w * F.col("__key")) for w in levels), F.lit(0.0)) / len(levels)
    return rows.withColumn("__slice", F.least(F.floor(even * SLICES), F.lit(SLICES - 1)).cast("int"))


def plan(rows: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """Per source (``__skey``): sizes, target, epochs, and the last (slice, key, id, size) of the fractional selection.

    ``rows`` holds (__skey, source, id, __size, __key, __slice) of all documents.
    """
    slices = stored(rows.groupBy("__skey", "source", "__slice").agg(F.sum("__size").alias("words")), "slices")
    sizes = slices.groupBy("__skey", "source").agg(F.sum("words").alias("source_size"))
    goals = source_targets(sizes, weights, share).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goals = stored(goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).drop("source"), "goals")
    before = Window.partitionBy("__skey").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = slices.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    border = ends.join(goals.select("__skey", "rest"), "__skey").where("start <= rest AND start + words > rest")
    border = stored(border.groupBy("__skey").agg(F.min("__slice").alias("border"), F.min_by("start", "__slice").alias("start"), F.max("rest").alias("rest")), "border")
    # only the border slices are sorted and summed: at most one 2048th of the keys of a source (one 292nd with a quality column)
    at = rows.join(border.withColumnRenamed("border", "__slice"), ["__skey", "__slice"])
    in_order = Window.partitionBy("__skey", "__slice").orderBy("__key", "id", "__size").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("up_to", F.col("start") + F.sum("__size").over(in_order)).where("up_to - __size / 2 <= rest")
    last = at.groupBy("__skey").agg(F.max(F.struct("__slice", "__key", "id", "__size")).alias("last"))
    goals = goals.join(border.select("__skey", "border"), "__skey", "left").join(last, "__skey", "left")
    return stored(goals.withColumn("border", F.coalesce("border", F.lit(SLICES))), "goals")


def _times(id_col: str, prefix: str = "") -> Column:
    """How often a document is taken: a function of its own key and its source's goal."""
    mine = F.struct("__slice", "__key", F.col(id_col).alias("id"), "__size")
    epochs, border, rest, last = (F.col(prefix + c) for c in ("epochs", "border", "rest", "last"))
    picked = (F.col("__slice") < border) | F.coalesce(mine <= last, F.lit(False))
    return epochs + (picked & (rest > 0)).cast("long")


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[float] = WEIGHTS, share: float = 1.0, quality: str | None = None) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (in words).

    ``quality`` names a column with weights between 0 and 1, such as the score of a classifier.
    """
    rows = _keyed(docs, id_col, text, source, quality).select("__skey", F.col(source).alias("source"), F.col(id_col).alias("id"), "__size", "__key", "__slice")
    rows = stored(rows, "keys")
    out = lookup(rows, plan(rows, weights, share), "__skey", hot_keys(rows, "__skey"))
    return out.select(F.col("id").alias(id_col), F.col("__size").alias("size"), "source_size", "target", (_times("id") * F.col("__size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
                    weights: Sequence[float] = WEIGHTS, share: float = 1.0, quality: str | None = None) -> DataFrame:
    """The mix itself: whole rows of ``docs``, each as often as it is taken."""
    keyed = _keyed(docs, id_col, text, source, quality)
    slim = stored(keyed.select("__skey", F.col(source).alias("source"), F.col(id_col).alias("id"), "__size", "__key", "__slice"), "keys")
    goals = plan(slim, weights, share).select("__skey", "epochs", "border", "rest", "last")
    out = lookup(keyed, goals.withColumnsRenamed({c: f"__{c}" for c in ("epochs", "border", "rest", "last")}), "__skey", hot_keys(slim, "__skey"))
    out = out.withColumn("__times", _times(id_col, "__")).where("__times > 0")
    return out.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int"))).alias("__copy")).drop("__copy")
