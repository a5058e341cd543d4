"""MinHash near-dedup with odd sketches (operator 5).

A document is the set of its distinct ``width``-word shingles. 128 MinHash
samples per set give band keys and an odd sketch. Bands are shaped by the
threshold, so that all of them miss a pair at it with a probability of MISS at
most (20 bands of 5 samples at 0.85: 8e-6; 22 of 4 at 0.8: 9e-6). For the
sketch, every sample flips one bit of a 512-bit map, so the XOR of two maps
tells how many samples differ. Candidate pairs from the bands are first estimated from the popcount
of that XOR and dropped below ``threshold - MARGIN`` (over four standard
deviations), then confirmed on their full sets.

Groups. Documents with one and the same set form a class, and only one member
represents it. Within a bucket, all members are compared with the bucket's
pivot (a star, linear in the bucket), confirmed links are merged into
components, and only members of different components are compared further:
by finer sketches (1024 samples), per pair of chunks first the most promising
pairs of each two components, then, where these did not link them, every pair
that the sketches allow. So groups
of near copies never become all pairs, and no candidate is capped or dropped.
Buckets, pivots, classes and components that hold a large share of the rows
are hot keys: what belongs to them is looked up by broadcast, and the chunks of
a large bucket are dealt over several tasks.

Defined cases: a document without words or text has an empty set and is linked
with nothing; a document with fewer words than ``width`` has its whole sequence
as its only shingle; a null id ranks last; rows that repeat an id are separate
rows here (``drop_near_copies`` keeps or drops them together, but rows without
an id each on their own); other columns
are ignored here and kept there; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_batches, hot_keys, lookup, quoted, stored
from claimlake.llm.graph import components
from claimlake.llm.textscan import mix64, shingle_sets

SAMPLES, SKETCH_WORDS, MISS = 128, 8, 1e-5
SKETCH_BITS = 64 * SKETCH_WORDS
#: Estimates have a standard deviation of about 0.032 at similarity 0.85.
MARGIN = 0.15
#: Samples and 64-bit words of the finer sketches that members of unsettled buckets get (deviation about 0.012).
FINE_SAMPLES, FINE_WORDS, FINE_MARGIN = 1024, 32, 0.05
#: Members of a bucket that one task compares with as many others.
CHUNK = 512
#: Pairs of two components that one pair of chunks offers first.
FIRST = 4
#: Chunks of a bucket that one task compares with all chunks of the bucket.
DEAL = 8
#: Shingles of the sets of often needed classes that are broadcast (64 MB); beyond it they shuffle like the others.
HOT_ITEMS = 1 << 23
#: Rows of one Arrow batch that leave a task.
SLICE = 512
#: The filter that picks the texts to read again has at most this many bits (128 MB).
FILTER_BITS = 1 << 30

_MUL = np.random.default_rng(11).integers(0, 1 << 63, FINE_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(12).integers(0, 1 << 63, FINE_SAMPLES, dtype=np.uint64)
_SALT = mix64(np.arange(1, FINE_SAMPLES + 1, dtype=np.uint64))


def min_hashes(h: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """MinHash values of a set of shingle hashes, a block of the set at a time."""
    out = np.full(samples, np.uint64(0xFFFFFFFFFFFFFFFF))
    block = (1 << 19) // samples
    for a in range(0, len(h), block):
        np.minimum(out, (h[a : a + block, None] * _MUL[:samples] + _ADD[:samples]).min(axis=0), out=out)
    return out


def band_shape(threshold: float) -> tuple[int, int]:
    """(bands, samples in each): the longest bands that miss a pair at ``threshold`` with a probability of MISS at most, and no more than that takes."""
    for size in range(SAMPLES, 1, -1):
        for bands in range(1, SAMPLES // size + 1):
            if (1 - threshold**size) ** bands <= MISS:
                return bands, size
    return SAMPLES, 1


def band_keys(samples: np.ndarray, bands: int, size: int) -> np.ndarray:
    """One 64-bit key per band, different bands never share one."""
    rows = samples[: bands * size].reshape(bands, size)
    key = _SALT[:bands].copy()
    for k in range(size):
        key = mix64(key + rows[:, k])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words."""
    at = (mix64(samples ^ _SALT[: len(samples)]) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def set_key(h: np.ndarray) -> bytes | None:
    """128 bits that tell shingle sets apart; None for the empty set."""
    if not len(h):
        return None
    return np.array([mix64(h).sum(dtype=np.uint64), mix64(h ^ _SALT[0]).sum(dtype=np.uint64)]).tobytes() + len(h).to_bytes(4, "little")


def _signatures(width: int, shape: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                n, keys, bands, sketches = [], [], [], []
                for h in shingle_sets(part.column("text"), width):
                    n.append(len(h))
                    keys.append(set_key(h))
                    samples = min_hashes(h) if len(h) else None
                    bands.append(band_keys(samples, *shape) if len(h) else None)
                    sketches.append(odd_sketch(samples) if len(h) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                    ["row", "id", "n", "set_key", "bands", "sketch"])

    return run


def _per_set(width: int, value):
    """(id, set_key, items) of each text, items being ``value`` of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                sets = list(shingle_sets(part.column("text"), width))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([set_key(h) for h in sets], pa.binary()),
                     pa.array([value(h) for h in sets], pa.list_(pa.int64()))], ["id", "set_key", "items"])

    return run


def estimate(x: Column, y: Column) -> Column:
    """Similarity from two odd sketches: 1 + bits / (4 samples) * ln(1 - 2 odd / bits)."""
    odd = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, SKETCH_WORDS)), F.bit_count(x[0].bitwiseXOR(y[0])))
    inside = F.greatest(1 - 2.0 * odd / SKETCH_BITS, F.lit(1e-9))
    return 1 + SKETCH_BITS / (4.0 * SAMPLES) * F.log(inside)


def _compare(cut: float, first: int | None):
    """Over rows of two chunks: pairs of different components whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("key")[i].as_py()
                rep, label, sketch, bands = zip(*(
                    (np.array(batch.column(f"rep{s}")[i].values), np.array(batch.column(f"label{s}")[i].values),
                     np.array(batch.column(f"sketch{s}")[i].values.flatten()).view(np.uint64).reshape(-1, FINE_WORDS),
                     np.array(batch.column(f"bands{s}")[i].values.flatten()).reshape(len(batch.column(f"rep{s}")[i]), -1)) for s in "xy"), strict=True)
                for a in range(0, len(rep[0]), 64):
                    odd = np.bitwise_count(sketch[0][a : a + 64, None, :] ^ sketch[1][None, :, :]).sum(axis=2, dtype=np.int64)
                    est = 1 + FINE_WORDS * 16.0 / FINE_SAMPLES * np.log(np.maximum(1 - odd / (FINE_WORDS * 32.0), 1e-9))
                    p, q = np.nonzero((est >= cut) & (label[0][a : a + 64, None] != label[1][None, :]))
                    # a pair that meets in several buckets is offered by the first of them only
                    both = bands[0][a + p] == bands[1][q]
                    here = bands[0][a + p, both.argmax(axis=1)] == key
                    p, q = p[here], q[here]
                    if not len(p):
                        continue
                    e, p = est[p, q], p + a
                    if first is not None:  # the best pairs of each two labels
                        la, lb = label[0][p], label[1][q]
                        order = np.lexsort((-e, lb, la))
                        la, lb = la[order], lb[order]
                        new = np.concatenate(([True], (la[1:] != la[:-1]) | (lb[1:] != lb[:-1])))
                        nth = np.arange(len(la)) - np.maximum.accumulate(np.where(new, np.arange(len(la)), 0))
                        order = order[nth < first]
                        p, q = p[order], q[order]
                    yield pa.RecordBatch.from_arrays([pa.array(rep[0][p]), pa.array(rep[1][q])], ["a", "b"])

    return run


def _unsettled(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, label) of the buckets with members of different components."""
    rows = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("label", "rep").alias("label"))
    rows = stored(rows, "bucket-labels")
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    return stored(lookup(rows, mixed, "key", hot_keys(rows, "key")), "mixed-buckets")


def _cross_pairs(rows: DataFrame, fine: DataFrame, cut: float, first: int | None) -> DataFrame:
    """Candidate pairs within unsettled buckets between different components (columns a < b, distinct)."""
    rows = stored(rows.withColumn("cell", F.struct("key", "label")), "bucket-cells")
    per = stored(rows.groupBy("key", "label").count(), "cell-sizes")
    small = F.sum(F.when(F.col("count") <= CHUNK, F.col("count")))
    parts = per.groupBy("key").agg(F.ceil(F.coalesce(small, F.lit(1)) / CHUNK).cast("int").alias("parts"))
    # a large component has chunks of its own; the small ones of a bucket share chunks
    own = F.when(F.col("count") > CHUNK, F.ceil(F.col("count") / CHUNK).cast("int"))
    cells = per.select(F.struct("key", "label").alias("cell"), own.alias("own"))
    rows = lookup(lookup(rows, cells, "cell", hot_keys(rows, "cell")), parts, "key", hot_keys(rows, "key"))
    chunk = F.when(F.col("own").isNotNull(), F.struct(F.col("label").alias("of"), F.pmod(F.xxhash64("rep"), "own").alias("part"))).otherwise(
        F.struct(F.lit(None).cast("long").alias("of"), F.pmod(F.xxhash64("label"), "parts").alias("part")))
    rows = rows.select("key", "rep", "label", chunk.alias("chunk")).join(fine, "rep")
    chunks = stored(rows.groupBy("key", "chunk").agg(
        *(F.collect_list(c).alias(c) for c in ("rep", "label", "sketch", "bands"))), "chunks")
    # a bucket of many chunks is dealt over several tasks: one side by its chunks, the other to all of them
    dealt = chunks.groupBy("key").agg(F.ceil(F.count("*") / DEAL).cast("int").alias("salts"))
    chunks = chunks.join(dealt, "key")
    x, y = (chunks.select("key", "salts", *(F.col(c).alias(f"{c}{s}") for c in ("chunk", "rep", "label", "sketch", "bands"))) for s in "xy")
    x = x.withColumn("salt", F.pmod(F.xxhash64("chunkx"), "salts").cast("int")).drop("salts")
    y = y.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    pairs = x.join(y, ["key", "salt"]).drop("salt").where(
        "(chunkx < chunky OR (chunkx = chunky AND chunkx.of IS NULL)) AND NOT (chunkx.of <=> chunky.of AND chunkx.of IS NOT NULL)")
    with arrow_batches(rows.sparkSession, 16):  # a row holds two chunks
        pairs = pairs.drop("chunkx", "chunky").mapInArrow(_compare(cut, first), "a long, b long")
        return stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cross-pairs")


def _read_again(ends: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text: str, width: int, value) -> DataFrame:
    """(rep, items): ``value`` of the shingle set of each of the classes ``ends`` (rep), from their texts.

    Only these texts are read again: a bitmap filter over hashed ids (at most
    FILTER_BITS) is broadcast into the scan, so other texts are neither
    shuffled nor split into shingles.
    """
    need = stored(reps.join(ends, "rep").select("rep", F.col("id").alias("need_id"), "set_key"), "needed")
    bits = min(FILTER_BITS, 1 << max(20, 5 + need.count().bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    bitmaps = need.groupBy(F.bitmap_bucket_number(slot("need_id")).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot("need_id"))).alias("__bits"))
    pos = F.bitmap_bit_position(slot("id")).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).withColumn("__bucket", F.bitmap_bucket_number(slot("id")))
    texts = texts.join(F.broadcast(bitmaps), "__bucket").where(F.getbit(byte, pos % 8) == 1).select("id", "text")
    sets = texts.mapInArrow(_per_set(width, value), f"id {dict(texts.dtypes)['id']}, set_key binary, items array<long>")
    with arrow_batches(docs.sparkSession, SLICE):
        return stored(need.join(sets, (need["set_key"] == sets["set_key"]) & need["need_id"].eqNullSafe(sets["id"])).select("rep", "items")
                      .dropDuplicates(["rep"]), "sets")


def _confirm(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text: str, width: int, threshold: float) -> DataFrame:
    """The pairs (a, b) that reach the threshold on their full sets."""
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    sets = _read_again(ends, docs, reps, id_col, text, width, lambda h: h.view(np.int64))
    both = pairs
    for end, items in (("a", "x"), ("b", "y")):
        hot = hot_keys(pairs.select(end), end)
        side = sets.select(F.col("rep").alias(end), F.col("items").alias(items))
        held = side.where(hot.holds(end)).agg(F.sum(F.size(items))).first()[0] or 0
        both = lookup(both, side, end, hot) if held <= HOT_ITEMS else both.join(side, end)
    shared = F.size(F.array_intersect("x", "y"))
    linked = 100 * shared >= round(100 * threshold) * (F.size("x") + F.size("y") - shared)
    return stored(both.where(linked).select("a", "b"), "links")


def _marks(docs: DataFrame, row: Column, id_col: str, text: str, width: int, threshold: float) -> DataFrame:
    """``near_groups`` with the ``row`` of each document (``__row``)."""
    cut = threshold - MARGIN
    texts = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = dict(texts.dtypes)["id"]
    with arrow_batches(docs.sparkSession, SLICE):
        rows = stored(texts.mapInArrow(
            _signatures(width, band_shape(threshold)), f"row long, id {id_type}, n long, set_key binary, bands array<long>, sketch array<long>"), "signatures")
    keyed = rows.where("set_key IS NOT NULL").select("row", "id", "n", "set_key")
    classes = keyed.groupBy("set_key").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("best"))
    members = stored(lookup(keyed, classes, "set_key", hot_keys(keyed, "set_key")).select(
        "row", "id", "n", "set_key", F.col("best.row").alias("rep"), "best"), "members")
    reps = stored(rows.select("row", "bands", "sketch").join(
        members.where("row = rep").select("rep", "id", "set_key", "best"), F.col("row") == F.col("rep")).drop("row"), "classes")

    banded = stored(reps.select("rep", F.explode("bands").alias("key")), "bands")
    pivots = banded.groupBy("key").agg(F.count("*").alias("n"), F.min_by("rep", F.xxhash64("rep")).alias("pivot")).where("n > 1")
    buckets = stored(lookup(banded, pivots.select("key", "pivot"), "key", hot_keys(banded, "key")), "buckets")
    sketches = reps.select("rep", "sketch")
    stars = buckets.where("rep != pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    stars = stored(stars, "star-pairs")
    for end, sketch in (("a", "x"), ("b", "y")):  # a bucket's pivot is in all its pairs
        stars = lookup(stars, sketches.toDF(end, sketch), end, hot_keys(stars.select(end), end))
    stars = stored(stars.where(estimate(F.col("x"), F.col("y")) >= cut).select("a", "b"), "stars")
    links = _confirm(stars, docs, reps, id_col, text, width, threshold)
    labels = components(links)
    tested, fine = stars, None
    for first in (FIRST, None):
        rows_left = _unsettled(buckets.select("key", "rep"), labels)
        if fine is None:
            fine = _read_again(rows_left.select("rep").distinct(), docs, reps, id_col, text, width,
                               lambda h: odd_sketch(min_hashes(h, FINE_SAMPLES), FINE_WORDS))
            fine = stored(fine.withColumnRenamed("items", "sketch").join(reps.select("rep", "bands"), "rep"), "fine-sketches")
        pairs = _cross_pairs(rows_left, fine, threshold - FINE_MARGIN, first).join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "untested")
        if pairs.isEmpty():
            continue
        more = _confirm(pairs, docs, reps, id_col, text, width, threshold)
        tested, links = tested.union(pairs), links.union(more)
        if not more.isEmpty():
            labels = components(links)

    of_class = stored(reps.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "best", F.coalesce("label", "rep").alias("label")), "class-labels")
    best = of_class.groupBy("label").agg(F.min("best").alias("component"))
    of_class = lookup(of_class, best, "label", hot_keys(of_class, "label")).select("rep", "component", F.col("best.id").alias("class_id"))
    grouped = lookup(members.drop("best"), of_class, "rep", hot_keys(members, "rep")).select(
        "row", "id", "n", F.col("component.id").alias("component_id"), (F.col("row") == F.col("component.row")).alias("kept"), "class_id")
    alone = rows.where("set_key IS NULL").select("row", "id", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.col("id").alias("class_id"))
    return grouped.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept", "class_id", F.col("row").alias("__row"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, and its class (``class_id``)."""
    return _marks(docs, F.monotonically_increasing_id(), id_col, text, width, threshold).drop("__row")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one document of each group; rows that share an id stay or go together.

    Rows without an id share none: they are numbered, which stores the table once more.
    """
    unknown, row, rows = F.col(id_col).isNull(), F.monotonically_increasing_id(), docs
    if not docs.where(unknown).isEmpty():
        row, rows = F.col("__row"), stored(docs.withColumn("__row", row), "numbered")
    marks = _marks(rows, row, id_col, text, width, threshold)
    gone = marks.groupBy(F.col(id_col).alias("__id"), F.when(unknown, F.col("__row")).alias("__own")).agg(F.max("kept").alias("__kept")).where("NOT __kept")
    same = F.col(id_col) == F.col("__id")
    if rows is not docs:  # one number per row, so rows without an id do not meet under one key
        own = F.when(unknown, F.col("__row"))
        same = F.col(id_col).eqNullSafe(F.col("__id")) & own.eqNullSafe(F.col("__own"))
    return rows.join(gone, same, "left_anti").select(*quoted(docs.columns))
