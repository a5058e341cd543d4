"""Narrow rows for a shuffle."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The way back to a text adds up the lengths before it; further texts of wider rows stay as they are.
MAX_TEXTS = 64


def pack(df: DataFrame, keep: Collection[str] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with its texts in one, and what gives its columns back, by name.

    A row in flight spends eight bytes on every column and pads every text to
    a multiple of eight. Here the texts (but those of ``keep``) lie end to end
    in one binary column, with their lengths in bytes beside them; a NULL has
    a NULL length. The other columns stay as they are. Take the columns back
    above the shuffle or join.
    """
    texts = [f.name for f in df.schema.fields if f.dataType == T.StringType() and f.name not in keep][:MAX_TEXTS]
    if len(texts) < 2:
        return df, {c: F.col(f"`{c}`") for c in df.columns}
    ends = [F.lit(0)]
    for i in range(len(texts)):
        ends.append(ends[-1] + F.coalesce(F.get(F.col("__lengths"), F.lit(i)), F.lit(0)))
    back = {c: F.substring(F.col("__texts"), ends[i] + 1, F.get(F.col("__lengths"), F.lit(i))).cast("string") for i, c in enumerate(texts)}
    raw = [F.col(f"`{c}`").cast("binary") for c in texts]
    packed = df.select(*[f"`{c}`" for c in df.columns if c not in texts],
                       F.concat(*[F.coalesce(c, F.lit(b"")) for c in raw]).alias("__texts"),
                       F.array(*[F.octet_length(c) for c in raw]).alias("__lengths"))
    return packed, {c: back.get(c, F.col(f"`{c}`")) for c in df.columns}
