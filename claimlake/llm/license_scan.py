"""License scans: MinHash bands over text windows (operator 8, built-in functions only).

Templates (a short list, given by the caller) and texts become word shingles:
five words, or a shorter template's whole sequence. For every template length
a text is covered by overlapping windows of that length, an eighth of it
apart. These windows only retrieve templates, by their MinHash bands. For each
template found, the exact containment of its shingles is then taken at every
start nearer to this window than to the next one, and must reach ``threshold``
somewhere; the first start with the largest containment is reported.

A span that contains 0.8 of a template lies at most a 16th of its length from
a window, which so contains 0.71 of it or more: a Jaccard similarity of 0.55.
With 16 bands of one sample such a window misses the template with a
probability below 3e-6.

Templates may be as long as whole licences. Two exact tests keep that cheap.
Windows are only built where a text holds a shingle of some template, and only
kept where the span around them holds as many as ``threshold`` asks for: all
others stay below it. Both ask a bitmap of the templates' shingles (of bounded
size; hashes that meet in a bit let more windows pass and lose none). Texts are
never shuffled; templates are broadcast.

Defined cases: words are runs of a-z and 0-9 after lower-casing; a null or
empty text matches nothing; a template without words is ignored; rows that
repeat an id report together, rows without one each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm.common import stored

WIDTH, BANDS, THRESHOLD = 5, 16, 0.8
#: The bitmap of the templates' shingles has 64 bits or more for each of them (another shingle passes with a
#: probability below 2e-5), and at most this many (8 MB).
MOST_BITS, PROBES = 1 << 26, 4

# Public licence notices and opening paragraphs.
TEMPLATES = (
    ("MIT-notice", "Released under the MIT License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
            "is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights "
                "(defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship "
                "and/or a database (each, a \"Work\")."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
                "version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
                 "any later version."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    ("Apache-2.0-body", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and "
                        "conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" "
                        "shall mean the copyright owner or entity authorized by the copyright owner that is granting the License."),
    ("GPL-2.0-body", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
                     "General Public License is intended to guarantee your freedom to share and change free software--to make sure the "
                     "software is free for all its users. This General Public License applies to most of the Free Software Foundation's "
                     "software and to any other program whose authors commit to using it. (Some other Free Software Foundation software is "
                     "covered by the GNU Lesser General Public License instead.) You can apply it to your programs, too."),
    ("GPL-3.0-body", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for "
                     "most software and other practical works are designed to take away your freedom to share and change the works. By "
                     "contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a "
                     "program--to make sure it remains free software for all its users. We, the Free Software Foundation, use the GNU "
                     "General Public License for most of our software; it applies also to any other work released this way by its authors. "
                     "You can apply it to your programs, too."),
    ("LGPL-3.0-body", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
                      "General Public License, supplemented by the additional permissions listed below."),
)


def _words(text: Column) -> Column:
    return F.split(F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " ")), " ")


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all ``width``-word shingles, by position."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(width)]))


def _samples(shingles: Column) -> Column:
    """BANDS MinHash samples of a set, one per band."""
    def sample(seed: int) -> Column:
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(seed))))

    return F.array(*[sample(seed) for seed in range(BANDS)])


class _Bitmap:
    """Which shingles some template holds, by PROBES bits each: a literal array of longs, made from one string."""

    def __init__(self, wanted: Iterable[int]):
        wanted = {h % (1 << 64) for h in wanted}
        self.mask = min(MOST_BITS, 1 << max(16, (64 * len(wanted)).bit_length())) - 1
        cells = [0] * ((self.mask + 1) // 64)
        for h in wanted:
            for k in range(PROBES):
                slot = h >> (12 * k) & self.mask
                cells[slot // 64] |= 1 << (slot % 64)
        signed = ",".join(str(c - (1 << 64) if c >> 63 else c) for c in cells)
        # one literal for the plan, folded before the job starts
        self.cells = F.split(F.lit(signed), ",").cast("array<bigint>")

    def holds(self, shingle: Column) -> Column:
        met = F.lit(True)
        for k in range(PROBES):
            slot = F.shiftrightunsigned(shingle, 12 * k).bitwiseAND(F.lit(self.mask))
            met = met & (F.getbit(F.get(self.cells, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return met


def _hits(shingles: Column, wanted: _Bitmap) -> Column:
    """Positions of the ``wanted`` shingles."""
    at = F.when(F.size(shingles) > 0, F.sequence(F.lit(0), F.size(shingles) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, lambda p: wanted.holds(F.get(shingles, p)))


def _windows(shingles: Column, hits: Column, width: int, length: int, need: int) -> Column:
    """The windows of ``length`` words, an eighth of it apart, that hold one of the ``hits``.

    ``around`` has the shingles of all spans of that length that start at
    ``low`` to ``high``: nearer to this window than to the next one. ``need``
    is the number of template shingles that a match holds at least.
    """
    step, count = max(1, length // 8), length - width + 1

    def starts(p: Column) -> Column:
        first = F.floor((F.greatest(F.lit(0), p - (length - width)) + step - 1) / step)
        return F.transform(F.sequence(F.least(first, F.floor(p / step)), F.floor(p / step)), lambda g: g * step)

    def window(a: Column) -> Column:
        low, high = F.greatest(a - step // 2, F.lit(0)), a + (step - 1 - step // 2)
        return F.struct(F.lit(length).alias("length"), F.lit(count).alias("count"), F.lit(width).alias("width"), F.lit(need).alias("need"), low.alias("low"), high.alias("high"),
                        F.array_distinct(F.slice(shingles, a + 1, count)).alias("shingles"),
                        F.slice(shingles, low + 1, high - low + count).alias("around"))

    at = F.array_distinct(F.flatten(F.transform(hits, starts)))
    return F.transform(at, lambda a: window(a.cast("int")))


def _best_start() -> Column:
    """(containment, -start) of the first best span from ``low`` to ``high``."""
    def span(a: Column) -> Column:
        shared = F.size(F.array_intersect(F.slice("around", a - F.col("low") + 1, F.col("count")), F.col("template")))
        return F.struct((shared / F.size("template")).alias("containment"), (-a.cast("long")).alias("before"))

    return F.array_max(F.transform(F.sequence("low", "high"), span))


def _once(*cols: Column) -> Column:
    """A struct ``x`` of ``cols``; explode keeps the optimizer from copying a costly expression into every use of it."""
    return F.explode(F.array(F.struct(*cols))).alias("x")


def read_templates(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Templates from a folder (or glob) of text files, one whole licence each, named as the file is.

    The list reaches the driver: it is a list of licences, not of documents.
    """
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), "value")
    return [(r["name"], r["value"]) for r in files.orderBy("name").collect()]


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per (id, license_id) found: containment, start_word, end_word of the first best span."""
    spark = docs.sparkSession
    known = spark.createDataFrame(list(templates), "license_id string, body string").select("license_id", _once(_words(F.col("body")).alias("words")))
    known = known.select("license_id", "x.words").where("size(words) > 0 AND words[0] != ''").withColumn("length", F.size("words"))
    known = known.withColumn("width", F.least("length", F.lit(WIDTH)))
    by_width = F.coalesce(*[F.when(F.col("width") == w, _shingles(F.col("words"), w)) for w in range(1, WIDTH + 1)])
    known = stored(known.select("license_id", "length", "width", by_width.alias("shingles")), "license-templates")
    kept = known.collect()  # templates only
    widths = sorted({r["width"] for r in kept})
    if not kept:
        return docs.select(id_col).limit(0).selectExpr("*", "cast(null as string) license_id", "0D containment", "0L start_word", "0L end_word")
    wanted = {w: _Bitmap(h for r in kept if r["width"] == w for h in r["shingles"]) for w in widths}

    known_id = F.col(id_col)
    own = F.when(known_id.isNull(), F.monotonically_increasing_id())  # rows without an id report one by one
    rows = docs.select(known_id.alias("id"), own.alias("own"), _once(_words(F.col(text)).alias("words"))).select("id", "own", "x.*")
    rows = rows.select("id", "own", _once(*[_shingles(F.col("words"), w).alias(f"s{w}") for w in widths])).select("id", "own", "x.*")
    rows = rows.select("*", _once(*[_hits(F.col(f"s{w}"), wanted[w]).alias(f"h{w}") for w in widths]))
    rows = stored(rows.where(" OR ".join(f"size(x.h{w}) > 0" for w in widths)).select("*", "x.*").drop("x"), "license-candidates")
    need = {(r["width"], r["length"]): math.inf for r in kept}
    for r in kept:
        of = (r["width"], r["length"])
        need[of] = min(need[of], math.ceil(threshold * len(set(r["shingles"])) - 1e-9))
    per_class = [_windows(F.col(f"s{width}"), F.col(f"h{width}"), width, length, n) for (width, length), n in sorted(need.items())]
    windows = rows.select("id", "own", F.explode(F.concat(*per_class)).alias("w")).select("id", "own", "w.*").where("size(shingles) > 0")
    # a span around the window with fewer of the templates' shingles than a match needs holds no match
    enough = F.coalesce(*[F.when(F.col("width") == w, F.size(F.filter("around", wanted[w].holds)) >= F.col("need")) for w in widths])
    windows = windows.where(enough)
    windows = windows.withColumn("samples", _samples(F.col("shingles"))).drop("shingles")
    banded = windows.select("*", F.posexplode("samples").alias("band", "sample"))
    shelf = known.select("license_id", "length", F.array_distinct("shingles").alias("template"), _samples(F.col("shingles")).alias("others"))
    shelf = F.broadcast(shelf.select("*", F.posexplode("others").alias("band", "sample")))
    # a window that meets a template in several bands is verified in the first; no span contains more than all of them together
    first = F.array_position(F.zip_with("samples", "others", lambda x, y: x == y), True) - 1
    found = banded.join(shelf, ["length", "band", "sample"]).where(F.col("band") == first)
    found = found.where(F.size(F.array_intersect("around", "template")) / F.size("template") >= threshold)
    found = found.select("id", "own", "license_id", "length", _once(_best_start().alias("at"))).select("id", "own", "license_id", "length", "x.at.*")
    found = found.where(F.col("containment") >= threshold)
    best = F.max(F.struct("containment", "before", "length")).alias("best")
    return found.groupBy("id", "own", "license_id").agg(best).select(
        F.col("id").alias(id_col), "license_id", F.col("best.containment").alias("containment"), (-F.col("best.before")).alias("start_word"),
        (F.col("best.length") - F.col("best.before")).cast("long").alias("end_word"))
