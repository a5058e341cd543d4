"""Substring dedup: line hashing with windows of words in place of lines (operator 9).

Lines alone would miss a passage that is pasted into the middle of another
line, so what is compared is every window of ``min_words`` words, with A-Z in
lower case, wherever it starts. In a document, all windows that occur earlier
(smaller id, then position) are joined to runs where they overlap, and the
runs are removed; their original character offsets are returned. So every
repeated passage of ``min_words`` words or more goes, up to its first and last
word.

Two passes keep this small. Winnowing picks an anchor for each window: of the
runs of half as many words in it, the one with the smallest hash. Equal windows
have equal anchors, so a window can only be repeated if its anchor's hash
occurs twice. The first pass counts the anchors (about one in 13 words); the
second shuffles only windows whose anchor is repeated, by the anchor: one row
holds all windows that have one place of it, and is taken apart after the
shuffle. That filter is a bitmap of bounded size: hashes that meet in a bit let
more windows pass and lose none. The windows of an anchor with a large share of
all places are taken apart before and grouped by digest, and the first place of
a window with a large share of those is found map-side and broadcast. Of each
place only the span of its repeated windows goes on, and only texts that may
have such spans (again a bitmap) are shuffled to meet them.

Defined cases: a null or empty text and one of fewer than ``min_words`` words
have no windows; a null id ranks last; rows that repeat id and text count as
one document and get the same spans; a passage repeated within one document
keeps its first place, and a window that overlaps its own first place is no
repeat; other columns pass through ``drop_repeats``, but columns named
``cleaned`` and ``removed`` give way to the results; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import HOT_ONE_IN, arrow_batches, hot_keys, quoted, stored
from claimlake.llm.textscan import Words, groups, run_hashes, utf8

MIN_WORDS = 50
#: A filter on anchors or on texts has at most this many bits (128 MB).
FILTER_BITS = 1 << 30
#: Windows are equal if a hash of 64 bits and 32 bits of another one, under this salt, are: 10^13 windows make 10^-3 false matches.
CHECK_SALT = 0x9E3779B97F4A7C15


def anchors(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of all windows of ``length`` words, first words of their anchors, hashes of all runs as long as an anchor)."""
    size = (length + 1) // 2
    hashes = run_hashes(words, size)
    n = len(words.start) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), hashes
    best, span, wide = np.arange(len(hashes)), 1, length - size + 1
    while span < wide:  # the smallest of ``span`` hashes, the first of equal ones
        step = min(span, wide - span)
        left, right = best[:-step], best[step:]
        best, span = np.where(hashes[right] < hashes[left], right, left), span + step
    at = np.flatnonzero(words.doc[:n] == words.doc[length - 1 :])
    return at, best[at], hashes


def _scan(texts: pa.Array):
    body, ends = utf8(texts)
    for a, b in groups(np.diff(ends)):
        yield a, b, Words(body[ends[a] : ends[b]], ends[a : b + 1] - ends[a])


def _anchors(length: int):
    """The hash of each anchor, once for each place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in _scan(batch.column("text")):
                _, picked, hashes = anchors(words, length)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[np.unique(picked)].view(np.int64))], ["anchor"])

    return run


def _windows(length: int):
    """One row per anchor and place: the first window it stands for, and the two hashes of that window and the next ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, words in _scan(batch.column("text")):
                at, picked, hashes = anchors(words, length)
                new = np.flatnonzero(np.diff(picked, prepend=-1))
                first, doc = at[new], words.doc[at[new]]
                rows, ends = pa.array(a + doc), pa.array(np.append(new, len(at)).astype(np.int32))
                digests = pa.array(run_hashes(words, length)[at].view(np.int64))
                checks = pa.array((run_hashes(words, length, CHECK_SALT)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("body").take(rows), pa.array(hashes[picked[new]].view(np.int64)),
                     pa.array((first - words.first[doc]).astype(np.int32)), pa.ListArray.from_arrays(ends, digests), pa.ListArray.from_arrays(ends, checks)],
                    ["id", "body", "anchor", "at", "digests", "checks"])

    return run


def _clean(length: int, columns: int, names: list[str], span: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, repeats = batch.column(columns), batch.column(columns + 1)
            for a, b, words in _scan(texts):
                chars = np.concatenate(([0], np.cumsum((words.body & 0xC0) != 0x80)))
                part, found = batch.slice(a, b - a), repeats.slice(a, b - a)
                counts = found.value_lengths().fill_null(0).to_numpy()
                flat, row = found.flatten(), np.repeat(np.arange(b - a), counts)
                begin = flat.field("begin").to_numpy().astype(np.int64) + words.first[row]
                last = flat.field("last").to_numpy().astype(np.int64) + words.first[row]
                order = np.argsort(begin, kind="stable")  # also by text, as no window crosses two
                begin, row, last = begin[order], row[order], np.maximum.accumulate(last[order])
                # overlapping windows are one run
                new = np.flatnonzero(begin - np.concatenate(([-length], last[:-1])) >= length) if len(begin) else begin
                last = last[np.append(new[1:], len(begin)) - 1] + length - 1 if len(begin) else begin
                row, zero = row[new], chars[words.text_start[row[new]]]
                start, end = chars[words.start[begin[new]]] - zero, chars[words.end[last]] - zero
                first_id = flat.field("first_id").take(pa.array(order[new]))
                cut = np.searchsorted(row, np.arange(b - a + 1))
                spans = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), first_id.cast(span[2].type)], fields=list(span)))
                cleaned = part.column(columns).to_pylist()
                for i in np.unique(row):
                    text, rest, done = cleaned[i], [], 0
                    for k in range(cut[i], cut[i + 1]):
                        rest.append(text[done : start[k]])
                        done = end[k]
                    cleaned[i] = "".join(rest) + text[done:]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in range(columns)), pa.array(cleaned, pa.string()), spans], names)

    return run


def _marked(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` with ``__held``: true if ``key`` is among the ``wanted`` (and for a few others, by chance). A bitmap is broadcast, no row is shuffled."""
    bits = min(FILTER_BITS, 1 << max(20, 5 + wanted.count().bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    bit = F.bitmap_bit_position(slot(wanted_key))
    bitmaps = wanted.groupBy(F.bitmap_bucket_number(slot(wanted_key)).alias("__bucket")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    pos = F.bitmap_bit_position(slot(key)).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("__bucket", F.bitmap_bucket_number(slot(key))).join(F.broadcast(bitmaps), "__bucket", "left")
    return met.withColumn("__held", F.coalesce(F.getbit(byte, pos % 8) == 1, F.lit(False))).drop("__bucket", "__bits")


def _dealt(places: DataFrame, often: list[int]) -> DataFrame:
    """``places`` with the ``part`` in which equal windows meet, and the ``known`` first place of hot ones.

    Equal windows have equal anchors, so a place is shuffled whole, by its
    anchor. The windows of the anchors in ``often`` are taken apart (``alone``)
    and meet by digest; hot ones know their first place and need not meet.
    """
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "body", "begin")
    if not often:
        return places.withColumns({"part": F.col("anchor"), "skip": F.lit(0), "known": F.lit(None)})
    whole = F.struct("digests", "checks", F.lit(0).alias("skip"), F.lit(False).alias("alone"))
    apart = F.transform("digests", lambda d, i: F.struct(F.array(d).alias("digests"), F.array(F.get("checks", i)).alias("checks"), i.alias("skip"), F.lit(True).alias("alone")))
    rows = places.select("id", "body", "anchor", "at", F.explode(F.when(F.col("anchor").isin(often), apart).otherwise(F.array(whole))).alias("dealt"))
    rows = rows.select("id", "body", "anchor", "at", "dealt.*")
    window = F.struct(F.get("digests", F.lit(0)).alias("digest"), F.get("checks", F.lit(0)).alias("check"))
    alone = stored(rows.where("alone").select("id", "body", (F.col("at") + F.col("skip")).alias("begin"), window.alias("window")), "windows")
    hot = hot_keys(alone, "window", [F.min(place).alias("known")]).rows.select("window", "known")
    rows = rows.withColumn("window", F.when(F.col("alone"), window)).join(F.broadcast(hot), "window", "left")
    part = F.when(~F.col("alone"), F.col("anchor")).when(F.col("known").isNull(), F.xxhash64("window"))
    # what is left of one place stays together
    return rows.withColumn("part", part.otherwise(F.xxhash64("id", "body", "at", F.spark_partition_id()))).drop("window", "alone")


def _repeats(places: DataFrame, counted: DataFrame, min_words: int) -> DataFrame:
    """Of ``places`` whose anchors are ``counted``, the spans of windows that occur earlier: (id, body, begin, last, first_id)."""
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "body", "begin")
    total = counted.agg(F.sum("count")).first()[0] or 0
    often = counted.where(F.col("count") * HOT_ONE_IN >= total).select("anchor").collect()  # HOT_ONE_IN at most
    rows = _dealt(places, [r["anchor"] for r in often]).repartition("part")
    rows = rows.select("id", "body", "at", "skip", "part", "known", "checks", F.posexplode("digests").alias("nth", "digest"))
    rows = rows.select("id", "body", "at", "part", "known", "digest", F.get("checks", F.col("nth")).alias("check"), (F.col("at") + F.col("skip") + F.col("nth")).alias("begin"))
    rows = rows.withColumn("first", F.coalesce("known", F.min(place).over(Window.partitionBy("digest", "check", "part"))))
    own = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.body") == F.col("body"))
    later = rows.where(~own | (F.col("begin") >= F.col("first.begin") + min_words)).withColumn("first_id", F.col("first.id"))
    # the windows of a place all hold its anchor, so they overlap and go as one span
    spans = later.groupBy("part", "id", "body", "at").agg(F.min("begin").alias("__begin"), F.max("begin").alias("last"), F.min_by("first_id", "begin").alias("first_id"))
    return spans.select("id", "body", F.col("__begin").alias("begin"), "last", "first_id")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns but the text, then ``cleaned`` and ``removed`` (start, end in characters, first_id)."""
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    id_type = dict(texts.dtypes)["id"]
    with arrow_batches(docs.sparkSession, 512):
        counted = texts.select("text").mapInArrow(_anchors(min_words), "anchor long").groupBy("anchor").count().where("count > 1")
        counted = stored(counted, "anchors")
        places = texts.mapInArrow(_windows(min_words), f"id {id_type}, body long, anchor long, at int, digests array<long>, checks array<int>")
        places = _marked(places, F.col("anchor"), counted, F.col("anchor")).where("__held").drop("__held")
        # dealt by text first: hardly any two spans of a text come from one task
        found = _repeats(places, counted, min_words).repartition("id", "body").groupBy(F.col("id").alias("__id"), F.col("body").alias("__body"))
        found = stored(found.agg(F.collect_set(F.struct("begin", "last", "first_id")).alias("__repeats")), "repeats")
    keep = [c for c in docs.columns if c not in (text, "cleaned", "removed")]
    names = [f"c{i}" for i in range(len(keep))]  # mapInArrow takes no names with dots
    rows = docs.select(*[c.alias(n) for c, n in zip(quoted(keep), names)], F.col(text).alias("__text"), F.xxhash64(text).alias("__hash"), F.col(id_col).alias("__key"))
    rows = _marked(rows, F.xxhash64("__key", "__hash"), found, F.xxhash64("__id", "__body"))
    spans = f"array<struct<start:int,end:int,first_id:{id_type}>>"
    whole = rows.where("NOT __held").select(*names, F.col("__text").alias("cleaned"), F.array().cast(spans).alias("removed"))
    joined = rows.where("__held").join(found, (F.col("__hash") == F.col("__body")) & F.col("__key").eqNullSafe(F.col("__id")), "left")
    joined = joined.select(*names, "__text", "__repeats")
    out = joined.select(*names, F.col("__text").alias("cleaned"), F.lit(None).cast(spans).alias("removed"))
    cleaned = joined.mapInArrow(_clean(min_words, len(keep), [*names, "cleaned", "removed"], _arrow_span(out)), out.schema)
    return cleaned.unionByName(whole).toDF(*keep, "cleaned", "removed")


def _arrow_span(out: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(out.schema["removed"].dataType.elementType)
