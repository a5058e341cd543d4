"""Filter interaction audit: contingency tensor contractions (operator 13).

Every document passes or fails each filter, so what any order of filters does
to a part follows from the part's counts by the filters failed: one axis of
length two (passed, failed) per filter. Built-in functions find the failures
and fold the table to these counts, at most ``2 ** filters`` rows a part; for
each part they are reshaped to 2 x 2 x ... x 2, and ``einsum`` selects passed,
failed or all along each axis for every step of every order.

Documents are read once; digests, ids and failures are stored, and all later
passes read those. Equal texts meet by digest: their smallest id is found by
an aggregate that folds map-side, and digests with a large share of all rows
are looked up by broadcast. Ids are folded before they meet the labels.

Defined cases: a null text counts as empty and a null part as the empty
string; a null id is no smaller than any other and no other is smaller than
it, and it has no label; rows that repeat an id count each, and share its
labels; an id with several labels has each that some row gives it; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import hot_keys, lookup, stored

#: The filters of the audit; the last one is found by ``failures`` itself, the others by ``text_failures``.
FILTERS = "ABCDE"
#: Counts of a cell: documents, documents of quality 1, toxic documents.
COUNTS = ("documents", "good", "toxic")
AUDIT_DDL = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
             "good_lost long, toxic_lost long, shapley long")
_AUDIT_TYPES = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]


def text_failures(text: Column, words: Column) -> list[Column]:
    """Whether a text fails A (few words), B (repeated words), C (capitals) and D (symbols)."""
    count = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [count < 100,
            100 * F.size(F.array_distinct(words)).cast("long") < 80 * count.cast("long"),
            100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
            text.rlike(r"[#$%&*|]")]


def failures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, cell): the filters that each document fails, as one bit each, filter A the highest."""
    read = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # explode keeps the optimizer from copying the split into every expression of the words
    split = read.select("*", F.explode(F.array(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))).alias("words"))
    flags = text_failures(F.col("text"), F.col("words"))
    cell = sum((F.when(failed, 1 << (len(FILTERS) - 1 - i)).otherwise(0) for i, failed in enumerate(flags)), F.lit(0))
    rows = stored(split.select("id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), cell.alias("cell")), "failures")
    first = rows.groupBy("digest").agg(F.min("id").alias("first"))
    marked = lookup(rows, first, "digest", hot_keys(rows, "digest"))
    copy = F.coalesce((F.col("id") > F.col("first")).cast("int"), F.lit(0))
    return marked.select("id", "part", (F.col("cell") + copy).alias("cell"))


def cell_counts(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents, good and toxic ones by (part, cell)."""
    folded = failed.groupBy("id", "part", "cell").agg(F.count("*").alias("documents"))
    is_one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0)))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(is_one("quality").alias("q"), is_one("toxic").alias("t"))
    # null ids match no label: they stay out of the join, where they would meet in one task
    joined = folded.where("id IS NOT NULL").join(known, "id", "left").select("part", "cell", "documents", "q", "t")
    alone = folded.where("id IS NULL").select("part", "cell", "documents", F.lit(None).cast("long").alias("q"), F.lit(None).cast("long").alias("t"))
    weighted = lambda c: F.sum(F.col("documents") * F.coalesce(F.col(c), F.lit(0)))
    return joined.unionByName(alone).groupBy("part", "cell").agg(
        F.sum("documents").alias("documents"), weighted("q").alias("good"), weighted("t").alias("toxic"))


def steps(tensor: np.ndarray, filters: Sequence[str]) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders.

    ``tensor`` has an axis for the counts, then one of length two per filter.
    """
    n = len(filters)
    everything, passed, failed = np.ones(2, np.int64), np.array([1, 0]), np.array([0, 1])
    axes = "".join(chr(ord("a") + i) for i in range(n))
    formula = f"z{axes}," + ",".join(axes) + "->z"
    known: dict[tuple, np.ndarray] = {}

    def select(through: frozenset, at: int, choice: np.ndarray) -> np.ndarray:
        """Counts of what passed all of ``through`` and has ``choice`` on axis ``at``."""
        key = (through, at, choice is failed)
        if key not in known:
            picked = [choice if i == at else passed if i in through else everything for i in range(n)]
            known[key] = np.einsum(formula, tensor, *picked)
        return known[key]

    orders = list(permutations(range(n)))
    removed = [[select(frozenset(order[:k]), at, failed) for k, at in enumerate(order)] for order in orders]
    shapley = [0] * n
    for order, gone in zip(orders, removed):
        for at, counts in zip(order, gone):
            shapley[at] += int(counts[0])
    for order, gone in zip(orders, removed):
        name = "".join(filters[i] for i in order)
        for k, (at, counts) in enumerate(zip(order, gone)):
            kept = select(frozenset(order[:k]), at, passed)[0]
            fails = select(frozenset(), at, failed)[0]
            alone = select(frozenset(range(n)) - {at}, at, failed)[0]
            yield name, k + 1, int(kept), int(counts[0]), int(fails - counts[0]), int(alone), int(counts[1]), int(counts[2]), shapley[at]


def interaction_audit(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, from counts by (part, cell)."""
    cells = F.collect_list(F.struct("cell", *COUNTS)).alias("cells")  # at most 2 ** filters a part

    def contract(batches):
        for batch in batches:
            for part, rows in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                flat = np.zeros((len(COUNTS), 1 << len(filters)), np.int64)
                for r in rows:
                    flat[:, r["cell"]] = [r[c] for c in COUNTS]
                found = [(part, *step) for step in steps(flat.reshape(len(COUNTS), *[2] * len(filters)), filters)]
                names = [field.split()[0] for field in AUDIT_DDL.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _AUDIT_TYPES)], names)

    return counts.groupBy("part").agg(cells).mapInArrow(contract, AUDIT_DDL)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The audit of ``FILTERS`` over ``docs``: how they overlap, and what each order loses at each step."""
    return interaction_audit(cell_counts(failures(docs, id_col, text, part), labels, id_col))
