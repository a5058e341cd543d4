"""Source divergence audit: Arrow compute pipeline (operator 11).

How far apart are the sources of a language in their words, and which words
set a source apart? ``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode`` and hash ``group_by`` run on Arrow batches inside
``mapInArrow`` and give partial counts by (lang, source, term), merged within
a task as far as a bound of rows. One shuffle by (lang, term) sums them into
columnar shards: a row per term with lists of its sources and their counts.
Terms in fewer than ``min_docs`` documents of the language end there.

Each task turns its shards into matrices (terms x sources) of smoothed shares,
and adds up the divergence of each pair of sources; only these sums and each
source's own best terms leave the task. Totals of the sources are taken to the
tasks in blocks of about ``BLOCK_GROUPS`` (lang, source) groups: more groups
take more passes (one per pair of blocks), not more memory.

A share is ``1 + floor(SCALE * (count + 2) / (N + 2 * V))`` with N counts of V
kept terms, the divergence of two shares ``floor((p - q)^2 / (p + q))``. All of
it is exact: counts beyond 64 bits' reach are computed in Python integers.

Defined cases: null text, lang and source count as the empty string; a group
without terms takes part with counts of zero; a language without kept terms
has divergences of zero and no terms; every row is a document, also one that
repeats an id; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from itertools import product
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_batches, stored, union_all
from claimlake.llm.textscan import groups as size_groups

SCALE = 10**9
MIN_DOCS, TOP_TERMS = 10, 10
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text that are split at once, partial counts that are merged at once, and that a task holds.
PIECE_BYTES, MERGE_ROWS, HELD_ROWS = 1 << 22, 1 << 18, 1 << 19
#: (lang, source) groups whose totals a task holds, and cells of a matrix of shares.
BLOCK_GROUPS, MATRIX_CELLS = 512, 1 << 20
_COUNT_DDL = "lang string, source string, term string, n long, docs long"
_PART_DDL = "part string, lang string, source string, item string, value long"


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Occurrences ``n`` and documents ``docs`` by (lang, source, term); a null term marks each group that occurs."""
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
    doc, term = pc.list_parent_indices(words), pc.list_flatten(words)
    whole = pc.not_equal(term, "")
    coded = term.filter(whole).dictionary_encode()
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    group = pc.add(pc.multiply(lang.indices.cast(pa.int64()), len(source.dictionary)), source.indices.cast(pa.int64()))
    in_docs = pa.table({"doc": doc.filter(whole), "term": coded.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    by = pa.table({"group": group.take(in_docs["doc"]), "term": in_docs["term"], "n": in_docs["count_all"]}).group_by(["group", "term"], use_threads=False)
    by = by.aggregate([("n", "sum"), ("n", "count")])
    marks = pc.unique(group)
    of = pa.concat_arrays([by["group"].combine_chunks(), marks])
    none = pa.nulls(len(marks), pa.string())
    zero = pa.array(np.zeros(len(marks), np.int64))
    sources = max(1, len(source.dictionary))
    at = pc.divide(of, sources)
    return pa.table({"lang": lang.dictionary.take(at), "source": source.dictionary.take(pc.subtract(of, pc.multiply(at, sources))),
                     "term": pa.concat_arrays([coded.dictionary.take(by["term"].combine_chunks()), none]),
                     "n": pa.concat_arrays([by["n_sum"].combine_chunks(), zero]), "docs": pa.concat_arrays([by["n_count"].combine_chunks(), zero])})


def merged(parts: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return both.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def _partial_counts(batches):
    held: list[pa.Table] = []
    for batch in batches:
        lang, source, text = (batch.column(c) for c in ("lang", "source", "text"))
        for a, b in size_groups(pc.binary_length(text).to_numpy(zero_copy_only=False), PIECE_BYTES):
            held.append(count_terms(lang.slice(a, b - a), source.slice(a, b - a), text.slice(a, b - a)))
            if sum(t.num_rows for t in held) > (MERGE_ROWS if len(held) > 1 else HELD_ROWS):
                held = [merged(held)]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
    if held:
        yield from merged(held).to_batches(max_chunksize=1 << 16)


def term_shards(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """Kept terms by (lang, term): ``total``, and lists of ``sources`` and ``counts``; a null term lists a language's sources."""
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    spread = texts.mapInArrow(_partial_counts, _COUNT_DDL).repartition("lang", "term")
    summed = spread.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    each = F.collect_list(F.struct("source", "n")).alias("each")  # as many as the term has sources
    shards = summed.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), each)
    kept = shards.where((F.col("docs") >= min_docs) | F.col("term").isNull())
    with arrow_batches(docs.sparkSession, 512):
        return stored(kept.select("lang", "term", "total", F.col("each.source").alias("sources"), F.col("each.n").alias("counts")), "term-shards")


def group_totals(shards: DataFrame) -> DataFrame:
    """(lang, source, n, lang_n, terms): the kept occurrences of each group and of its language, and the kept terms."""
    listed = shards.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("s"))
    own = listed.groupBy("lang", F.col("s.sources").alias("source")).agg(F.sum("s.counts").alias("n"))
    of_lang = shards.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("term").alias("terms"))
    return stored(own.join(of_lang, "lang"), "group-totals")


def share(count: np.ndarray, n: np.ndarray, terms: int) -> np.ndarray:
    """Smoothed shares of counts, scaled and rounded down."""
    if (int(count.max(initial=0)) + 2) * SCALE >= 1 << 63:
        count, n = count.astype(object), np.asarray(n, dtype=object)
    return (1 + SCALE * (count + 2) // (n + 2 * terms)).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Lang:
    """A language's sources in block ``own`` and in block ``other``, and the sums of their pairs' divergences."""

    def __init__(self, rows: list, own: int, other: int):
        self.sources = [r["source"] for r in rows]
        self.n = np.array([r["n"] for r in rows], np.int64)
        self.own = np.array([r["block"] == own for r in rows])
        self.other = np.flatnonzero([r["block"] == other for r in rows])
        self.lang_n, self.terms = rows[0]["lang_n"], rows[0]["terms"]
        self.sums = np.zeros((len(rows), len(self.other)), np.int64)

    def add(self, total: np.ndarray, term: np.ndarray, source: np.ndarray, count: np.ndarray, order: np.ndarray, tops: bool) -> list[tuple]:
        """Adds shards given as (term, source, count) cells; returns the best cells of each own source if ``tops``."""
        counts = np.zeros((len(total), len(self.sources)), np.int64)
        counts[term, source] = count
        p = share(counts, self.n, self.terms)
        for a in np.flatnonzero(self.own):
            self.sums[a] += divergence(p[:, [a]], p[:, self.other]).sum(axis=0)
        if not tops:
            return []
        mine = (count > 0) & self.own[source]
        term, source = term[mine], source[mine]
        p, q = p[term, source], share(total, self.lang_n, self.terms)[term]
        over = p > q
        term, source, value = term[over], source[over], divergence(p[over], q[over])
        best = np.lexsort((order[term], -value, source))
        first = np.flatnonzero(np.diff(source[best], prepend=-1))
        rank = np.arange(len(best)) - np.repeat(first, np.diff(np.append(first, len(best))))
        best = best[rank < TOP_TERMS]
        return list(zip(source[best].tolist(), term[best].tolist(), value[best].tolist()))


def _divergences(rows: list, own: int, other: int):
    """A mapInArrow function: a task's sums by pair of a source in block ``own`` and one in ``other``.

    With one block for both it also gives the sources' best terms, at most TOP_TERMS a batch of shards.
    """
    by_lang: dict[str, list] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)

    def output(part: str, found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array([part] * len(found), pa.string()), *[pa.array(c, pa.string()) for c in cols[:3]],
                                           pa.array(cols[3], pa.int64())], ["part", "lang", "source", "item", "value"])

    def run(batches):
        langs = {name: _Lang(r, own, other) for name, r in by_lang.items()}
        seen = set()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for name in pc.unique(batch.column("lang")).to_pylist():
                if name not in langs:
                    continue
                seen.add(name)  # a language's null term comes to some task, so that every pair has a row
                lang = langs[name]
                one = table.filter(pc.and_(pc.equal(table["lang"], name), pc.is_valid(table["term"])))
                step = max(1, MATRIX_CELLS // len(lang.sources))
                for start in range(0, one.num_rows, step):
                    terms, total, sources, counts = (one[c].slice(start, step).combine_chunks() for c in ("term", "total", "sources", "counts"))
                    of = np.repeat(np.arange(len(terms)), pc.list_value_length(sources).to_numpy(zero_copy_only=False))
                    source = pc.index_in(pc.list_flatten(sources), pa.array(lang.sources, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
                    held = source >= 0
                    order = np.empty(len(terms), np.int64)
                    order[pc.array_sort_indices(terms).to_numpy()] = np.arange(len(terms))
                    best = lang.add(total.to_numpy(), of[held], source[held].astype(np.int64), pc.list_flatten(counts).to_numpy()[held], order, own == other)
                    if best:
                        yield output("term", [(name, lang.sources[s], terms[t].as_py(), v) for s, t, v in best])
        for name in seen:
            lang = langs[name]
            for a in np.flatnonzero(lang.own):
                yield output("pair", [(name, lang.sources[a], lang.sources[b], int(v)) for b, v in zip(lang.other, lang.sums[a]) if b != a])

    return run


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
                      block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources, part ``term`` the terms that stand out."""
    shards = term_shards(docs, text, lang, source, min_docs)
    totals = group_totals(shards)
    blocks = max(1, ceil(totals.count() / block_groups))
    totals = totals.withColumn("block", F.pmod(F.xxhash64("lang", "source"), F.lit(blocks)))
    found = []
    with arrow_batches(docs.sparkSession, 4096):
        for own, other in product(range(blocks), repeat=2):
            held = totals.where(F.col("block").isin(own, other)).orderBy("lang", "source").collect()  # two blocks of groups
            found.append(stored(shards.mapInArrow(_divergences(held, own, other), _PART_DDL), "divergences"))
    rows = union_all(found)
    pairs = rows.where("part = 'pair'").groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    terms = rows.where("part = 'term'").select("*", place).where(F.col("rank") <= TOP_TERMS)
    return pairs.select("*", place).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
