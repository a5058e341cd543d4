"""Exact dedup: heavy-hitter split (operator 1, built-in functions only).

Equal texts share a SHA-256 digest. Digests that hold a large share of all
rows are found with frequent-item (Misra-Gries) sketches and counted exactly;
these verified winners are broadcast and their copies resolved map-side. The
remaining digests are grouped by an ordinary shuffle, in which no group is
larger than 1/1024 of the rows.

Defined cases: a null text counts as empty; of equal texts the row with the
largest id stays, a null id ranks below every other; of rows that repeat both
id and text exactly one stays; an empty table gives an empty result; further
columns are ignored by ``mark_copies`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import ascii_lower, hot_keys, quoted, stored


def text_digest(text: str) -> Column:
    """SHA-256 of the text with A-Z in lower case, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))).cast("binary"), 256))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The text is read once; digests and a row number are stored, and all later
    passes read those 50 bytes a row.
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), text_digest(text).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    best = F.max(F.struct("id", "row")).alias("best")  # nulls sort first: a null id never wins against another
    winners = hot_keys(rows, "digest", [best]).rows
    hot = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    cold = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "*", F.count("*").over(group).alias("n"), F.max(F.struct("id", "row")).over(group).alias("best"))
    return hot.unionByName(cold).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the copies: whole rows, one per distinct text.

    Copies of a hot text that are not the winner's are dropped before the
    shuffle, so whole texts are shuffled once and no group is large.
    """
    digests = stored(docs.select(F.col(id_col).alias("id"), text_digest(text).alias("__digest")), "digests")
    winners = hot_keys(digests, "__digest", [F.max("id").alias("__keep")]).rows.drop("n")
    left = docs.withColumn("__digest", text_digest(text)).join(F.broadcast(winners.withColumn("__hot", F.lit(True))), "__digest", "left")
    left = left.where(F.col("__hot").isNull() | F.col(id_col).eqNullSafe(F.col("__keep")))
    ties = quoted([c for c, kind in docs.dtypes if c not in (id_col, text) and not kind.startswith(("map", "variant"))])
    first = Window.partitionBy("__digest").orderBy(F.col(id_col).desc_nulls_last(), F.col(text), *ties)
    return left.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(*quoted(docs.columns))
