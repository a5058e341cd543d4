"""Registry answers as Spark jobs over landed JSON.

The reference fetches documents one HTTP request at a time on the driver
and shapes them in Python. Here the documents are rows of a table (one raw
JSON text per row, landed by any fetcher) and the shaping is distributed:
``from_json``/``explode`` for the NPI answers, one join per level for the
ICD hierarchy walk.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.session import cut_lineage, scratch_path

# Fixed values that must equal the reference's: the NPI answer fields read,
# the entity type whose own name is used, and the ICD code type stamped.
NPI_BASIC_FIELDS = (
    "first_name", "last_name", "authorized_official_first_name", "authorized_official_last_name",
    "authorized_official_title_or_position", "organization_name", "last_updated",
)
INDIVIDUAL_TYPE = "NPI-1"
ICD_CODE_TYPE = "ICD-10"

RESULT_SCHEMA = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("enumeration_type", T.StringType()),
    T.StructField("basic", T.StringType()),  # kept as raw JSON text: key presence is tested on it
])
_REJECT = "__rejected"  # where the parser leaves the text of a document that it cannot read
DOC_SCHEMA = T.StructType([T.StructField("results", T.ArrayType(RESULT_SCHEMA)), T.StructField(_REJECT, T.StringType())])
BASIC_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in NPI_BASIC_FIELDS])


def explode_results(raw: DataFrame, body: str = "body", malformed: str = "fail") -> DataFrame:
    """Parse each document once and emit one row per element of ``results``.

    A document without ``results`` or with an empty list emits nothing. One
    that cannot be read (it is not JSON, or has another shape) fails the job,
    so that nothing is lost unseen. With ``malformed="reject"`` it becomes one
    row: ``rejected`` holds its text and ``result`` is NULL; store the output
    and split it on ``rejected``. With ``"skip"`` it emits nothing. Other
    columns of ``raw`` are carried along.
    """
    if malformed not in ("fail", "reject", "skip"):
        raise ValueError(f"unknown malformed {malformed!r}")
    keep = [c for c in raw.columns if c != body]
    parsed = raw.select(*[f"`{c}`" for c in keep],
                        F.from_json(F.col(body), DOC_SCHEMA, {"columnNameOfCorruptRecord": _REJECT}).alias("__doc"))
    text, results = F.col("__doc")[_REJECT], F.col("__doc")["results"]
    if malformed == "fail":
        message = F.concat(F.lit("not a JSON document: "), F.substring(text, 1, 80))
        results = F.when(text.isNotNull(), F.raise_error(message).cast(results_type())).otherwise(results)
    elif malformed == "skip":
        results = F.when(text.isNull(), results)
    else:
        results = F.when(text.isNotNull(), F.array(F.lit(None).cast(RESULT_SCHEMA))).otherwise(results)
    rejected = [text.alias("rejected")] if malformed == "reject" else []
    return parsed.select(*[f"`{c}`" for c in keep], *rejected, F.explode(results).alias("result"))


def results_type() -> T.DataType:
    return DOC_SCHEMA["results"].dataType


def _field(basic_raw: Column, basic: Column, keys: Column, name: str) -> Column:
    """``basic.get(name, '')`` -- an absent key gives '', a JSON null stays NULL."""
    return F.when(F.coalesce(F.array_contains(keys, name), F.lit(False)), basic[name]).otherwise(F.lit(""))


def flatten_registry(raw: DataFrame, batch_date: _dt.date | Column, body: str = "body",
                     malformed: str = "fail") -> DataFrame:
    """NPI answers -> flat rows ``npi_id, first_name, last_name, position,
    organisation_name, last_updated, refreshed_at``.

    Names come from ``basic.first_name/last_name`` for individuals
    (``NPI-1``) and from the authorised official's otherwise (J2; a result
    without a type takes the second branch). Absent fields become ``''``
    while JSON nulls stay NULL, exactly as ``dict.get(k, '')`` does (J3):
    key presence is read with ``json_object_keys`` on the raw ``basic``.
    With ``malformed="reject"`` a column ``rejected`` follows: the text of a
    document that cannot be read, in a row without values, else NULL.
    """
    rows = explode_results(raw, body, malformed)
    r = F.col("result")
    basic_raw = r["basic"]
    basic = F.from_json(basic_raw, BASIC_SCHEMA)
    keys = F.json_object_keys(basic_raw)
    staged = rows.select(r["number"].alias("npi_id"), r["enumeration_type"].alias("etype"),
                         basic.alias("b"), keys.alias("k"), *(["rejected"] if malformed == "reject" else []))
    b, k = F.col("b"), F.col("k")
    individual = F.col("etype") == F.lit(INDIVIDUAL_TYPE)
    ts = batch_date if isinstance(batch_date, Column) else F.lit(batch_date)
    if malformed == "reject":
        kept, none = F.col("rejected").isNull(), F.lit(None).cast("string")
        flat = flatten_fields(individual, basic_raw, b, k, ts)
        return staged.select("npi_id", *[F.when(kept, c).otherwise(none.cast("date") if n == "refreshed_at" else none).alias(n)
                                         for n, c in flat.items()], "rejected")
    return staged.select("npi_id", *[c.alias(n) for n, c in flatten_fields(individual, basic_raw, b, k, ts).items()])


def flatten_fields(individual: Column, basic_raw: Column, b: Column, k: Column, ts: Column) -> dict[str, Column]:
    """The flat columns of one result."""
    return {
        "first_name": F.when(individual, _field(basic_raw, b, k, "first_name"))
        .otherwise(_field(basic_raw, b, k, "authorized_official_first_name")),
        "last_name": F.when(individual, _field(basic_raw, b, k, "last_name"))
        .otherwise(_field(basic_raw, b, k, "authorized_official_last_name")),
        "position": _field(basic_raw, b, k, "authorized_official_title_or_position"),
        "organisation_name": _field(basic_raw, b, k, "organization_name"),
        "last_updated": _field(basic_raw, b, k, "last_updated"),
        "refreshed_at": ts.cast("date"),
    }


def listed_numbers(list_docs: DataFrame, body: str = "body") -> DataFrame:
    """J5 (first half): the ``number`` of every result of the list answers."""
    return explode_results(list_docs, body).select(F.col("result.number").alias("number"))


def detail_for(list_docs: DataFrame, detail_docs: DataFrame, number: str = "number",
               body: str = "body") -> DataFrame:
    """Keep the detail documents whose number was listed (inner join).

    A number listed twice fetches its detail twice in the reference, so the
    result keeps that multiplicity. ``detail_docs`` has one row per fetched
    number (column ``number``) and its raw answer (``body``). Listed numbers
    are counted first (a partial aggregate), so a number listed very many
    times is one join row, expanded afterwards in bounded chunks.
    """
    nums = listed_numbers(list_docs, body).groupBy(F.col("number").alias("__num")).agg(
        F.count(F.lit(1)).alias("__n"))
    joined = detail_docs.join(nums, detail_docs[number] == nums["__num"], "inner").drop("__num")
    return expand_counts(joined)


def edges_from_documents(nodes: DataFrame, url: str = "url", child: str = "child") -> DataFrame:
    """J6 helper: node documents with a ``child`` array -> (``url``, ``child_url``) edges."""
    return nodes.select(F.col(url).alias("url"), F.explode(F.col(child)).alias("child_url"))


def expand_counts(df: DataFrame, n: str = "__n", chunk: int = 1024) -> DataFrame:
    """Repeat each row ``n`` times (and drop ``n``), with arrays of at most
    ``max(chunk, n / chunk)`` elements: first ``ceil(n / chunk)`` chunk rows,
    then up to ``chunk`` copies per chunk row."""
    cols = [c for c in df.columns if c != n]
    chunks = df.select(*cols, F.col(n), F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col(n) - 1) / chunk).cast("long"))).alias("__chunk"))
    size = F.least(F.lit(chunk).cast("long"), F.col(n) - F.col("__chunk") * chunk)
    return chunks.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("__copy")).drop("__copy")


def _stored_level(level: DataFrame) -> tuple[DataFrame, int, int]:
    """A level of the walk written to the checkpoint folder in one job, its nodes and those with children counted."""
    seen, path = Observation(), scratch_path(level.sparkSession, "walk")
    level.observe(seen, F.count(F.lit(1)).alias("nodes"), F.count_if("has_child").alias("inner")).write.parquet(path)
    return level.sparkSession.read.schema(level.schema).parquet(path), seen.get["nodes"], seen.get["inner"]


def _has_cycle(levels: list[DataFrame], edges: DataFrame) -> bool:
    """Whether the nodes that a walk met at several levels hold a cycle.

    Every node of a cycle is met again and again. Among the links between
    repeated nodes those from a node without an incoming link are peeled off,
    level by level: if nothing is left there is no cycle, if nothing more
    comes off there is one.
    """
    inner = union_all([x.filter("has_child").select("url") for x in levels])
    again = inner.groupBy("url").count().filter("count > 1").select("url")
    links = edges.join(again, "url", "left_semi").join(again.withColumnRenamed("url", "child_url"), "child_url", "left_semi")
    left = None
    while True:
        links = cut_lineage(links.select("url", "child_url"))
        n = links.count()
        if n == 0 or n == left:
            return n > 0
        links, left = links.join(links.select(F.col("child_url").alias("url")).distinct(), "url", "left_semi"), n


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def hierarchy_leaves(nodes: DataFrame, edges: DataFrame, roots: DataFrame,
                     max_depth: int | None = None, expand: bool = True) -> DataFrame:
    """Walk ``child`` links from the roots and return the leaves reached.

    ``nodes``: ``url``, ``has_child`` (the document has a ``child`` field,
    even an empty one), ``code``, ``title``. ``edges``: ``url``,
    ``child_url``. ``roots``: ``url``.

    A node without a ``child`` field and with both ``code`` and ``title`` is
    emitted; one with an empty list emits nothing. There is no visited set,
    so a node reached along two paths is emitted twice.

    Links are joined with their child's fields once. Then each level is one
    job: the frontier, kept as (node, number of paths), meets the links, and
    path counts are summed per child (partially aggregated, so a node reached
    from many parents is folded map-side). A level is bounded by the number
    of nodes, however many paths a DAG has, and is stored in the checkpoint
    folder, so a lost executor never replays the walk; leaves are read from
    the stored levels, and copies are produced only at the end (``expand``;
    otherwise a ``paths`` column is returned).

    A cycle raises. It is looked for when the depth has doubled, so after at
    most a few times the depth at which it closes. With ``max_depth`` a
    deeper walk raises too.
    """
    fields = nodes.select("url", "has_child", "code", "title")
    links = edges.join(fields.withColumnRenamed("url", "child_url"), "child_url")
    named = ["has_child", "code", "title"]
    level = roots.groupBy("url").agg(F.count(F.lit(1)).alias("__n")).join(fields, "url")
    levels: list[DataFrame] = []
    links_path = scratch_path(nodes.sparkSession, "links")
    links.write.parquet(links_path)
    links = nodes.sparkSession.read.schema(links.schema).parquet(links_path)
    for depth in count():
        stored, reached, inner = _stored_level(level)
        if reached == 0:
            break
        if max_depth is not None and depth > max_depth:
            raise RuntimeError(f"hierarchy deeper than {max_depth} levels (a cycle?)")
        levels.append(stored)
        if inner == 0:
            break
        if depth >= 4 and depth & (depth - 1) == 0 and _has_cycle(levels, edges):
            raise RuntimeError("hierarchy deeper than any number of levels: it has a cycle")
        step = stored.filter("has_child").select("url", "__n").join(links, "url")
        level = step.groupBy(F.col("child_url").alias("url")).agg(
            F.sum("__n").alias("__n"), F.first(F.struct(*named)).alias("f")).select("url", "__n", "f.*")
    if not levels:
        levels = [stored]
    out = union_all([x.filter(~F.col("has_child") & F.col("code").isNotNull() & F.col("title").isNotNull()).select("url", "code", "title", "__n")
                     for x in levels])
    return expand_counts(out) if expand else out.withColumnRenamed("__n", "paths")


def code_rows_from(leaves: DataFrame, batch_date: _dt.date | Column) -> DataFrame:
    """Leaves -> ICD rows (code, 'ICD-10', ``title.@value``, dates, TRUE)."""
    ts = (batch_date if isinstance(batch_date, Column) else F.lit(batch_date)).cast("date")
    return leaves.select(
        F.col("code").alias("icd_code"),
        F.lit(ICD_CODE_TYPE).alias("icd_code_type"),
        F.col("title").getField("@value").alias("code_description"),
        ts.alias("inserted_date"),
        ts.alias("updated_date"),
        F.lit(True).alias("is_current_flag"),
    )
