"""Line dedup across sites: distinct-site spread (operator 7, built-in functions only).

A line that stands on many distinct sites is boilerplate and is removed
everywhere. A line's rows are an upper bound of its sites, so lines with fewer
rows than ``min_sites`` are settled by a plain count. For the others a
HyperLogLog sketch of the sites is built per line digest and merged by the
aggregation; only lines whose estimate lies within five standard errors of the
threshold get an exact distinct count.

Lines with a large share of all rows are looked up by broadcast, the others
shuffle; all that moves is a digest, a site, an id and a hash of the text. A document's removed
digests (no more than it has lines) then meet its text in one join.

Defined cases: lines are compared without surrounding blanks and with A-Z in
lower case; blank lines are never boilerplate; a null site is no site; a null
text has one empty line and stays null; rows that repeat an id are cleaned each
by its own text; other columns pass through, whatever their names, but columns
named ``__lines`` and ``__removed`` give way to the results; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import Hot, ascii_lower, hot_keys, lookup, quoted, stored

MIN_SITES = 10
SKETCH_BITS = 12
#: Five standard errors of the sketch.
NEAR = 5 * 1.04 / 2 ** (SKETCH_BITS / 2)


def line_digest(line: Column) -> Column:
    """MD5 of the normalised line as 16 bytes; null for a blank line."""
    body = F.btrim(ascii_lower(line), F.lit(" \t\r"))
    return F.when(body != "", F.unhex(F.md5(body.cast("binary"))))


def boilerplate(lines: DataFrame, hot: Hot, min_sites: int) -> DataFrame:
    """The digests of (digest, site) rows that stand on at least ``min_sites`` distinct sites."""
    often = stored(lines.groupBy("digest").count().where(F.col("count") >= min_sites).select("digest"), "frequent-lines")
    rows = stored(lookup(lines.select("digest", "site"), often, "digest", hot), "frequent-rows")
    spread = rows.groupBy("digest").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"))
    spread = stored(spread, "spread")
    far = spread.where(F.col("sites") > min_sites * (1 + NEAR) + 1).select("digest")
    near = spread.where(F.col("sites").between(min_sites * (1 - NEAR) - 1, min_sites * (1 + NEAR) + 1)).select("digest")
    exact = lookup(rows, near, "digest", hot).where("site IS NOT NULL").distinct().groupBy("digest").count()
    return stored(far.union(exact.where(F.col("count") >= min_sites).select("digest")), "boilerplate")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text cleaned, and ``__lines`` and ``__removed`` (numbers of lines)."""
    docs = docs.select(*quoted([c for c in docs.columns if c not in ("__lines", "__removed")]))
    body = F.xxhash64(text)  # rows without an id, or that repeat one, are told apart by their text
    lines = docs.select(F.col(id_col).alias("id"), body.alias("body"), F.col(site).alias("site"), F.explode(F.split(text, "\n")).alias("line"))
    lines = stored(lines.select("id", "body", "site", line_digest(F.col("line")).alias("digest")).where("digest IS NOT NULL"), "lines")
    hot = hot_keys(lines, "digest")
    gone = lookup(lines.select("id", "body", "digest"), boilerplate(lines, hot, min_sites), "digest", hot)
    gone = gone.groupBy(F.col("id").alias("__id"), F.col("body").alias("__body")).agg(F.collect_set("digest").alias("__gone"))
    joined = docs.join(gone, docs[id_col].eqNullSafe(F.col("__id")) & (body == F.col("__body")), "left").drop("__id", "__body")
    parts = F.split(text, "\n")
    left = F.filter(parts, lambda line: ~F.coalesce(F.array_contains("__gone", line_digest(line)), F.lit(False)))
    cleaned = joined.withColumn("__left", F.when(F.col("__gone").isNull(), parts).otherwise(left))
    count = lambda c: F.when(F.col(text).isNull(), 1).otherwise(F.size(c))
    cleaned = cleaned.withColumn("__lines", count(parts)).withColumn("__removed", F.col("__lines") - count("__left"))
    return cleaned.withColumn(text, F.array_join("__left", "\n")).select(*quoted(docs.columns), "__lines", "__removed")
