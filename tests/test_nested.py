import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from claimlake.operators.nested import (
    code_rows_from,
    detail_for,
    edges_from_documents,
    explode_results,
    flatten_registry,
    hierarchy_leaves,
)
from tests.conftest import rows

DAY = dt.date(2024, 1, 5)


def docs(spark, bodies):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "number string, body string")


def test_flatten_npi_types_and_missing_fields(spark):
    bodies = [
        json.dumps({"results": [{"number": "1", "enumeration_type": "NPI-1",
                                 "basic": {"first_name": "Ann", "last_name": "Lee", "last_updated": "2024-01-01"}}]}),
        json.dumps({"results": [{"number": "2", "enumeration_type": "NPI-2",
                                 "basic": {"authorized_official_first_name": "Bo",
                                           "authorized_official_last_name": "Fox",
                                           "authorized_official_title_or_position": "CEO",
                                           "organization_name": "Clinic", "first_name": "ignored"}}]}),
        json.dumps({"results": [{"number": "3", "enumeration_type": "NPI-1",
                                 "basic": {"first_name": None, "last_name": "Ng"}}]}),  # JSON null stays NULL
        json.dumps({"results": [{"number": "4", "basic": {"authorized_official_first_name": "Di"}}]}),  # no type
        json.dumps({"results": [{"number": "5", "enumeration_type": "NPI-1"}]}),  # no basic at all
        json.dumps({"results": []}),   # empty -> no rows
        json.dumps({"other": 1}),      # missing -> no rows
        "not json",
    ]
    out = rows(flatten_registry(docs(spark, bodies), DAY, malformed="skip"))
    assert out == [
        ("1", "Ann", "Lee", "", "", "2024-01-01", DAY),
        ("2", "Bo", "Fox", "CEO", "Clinic", "", DAY),
        ("3", None, "Ng", "", "", "", DAY),
        ("4", "Di", "", "", "", "", DAY),
        ("5", "", "", "", "", "", DAY),
    ]


def test_explode_results_multiple(spark):
    body = json.dumps({"results": [{"number": "1"}, {"number": "2"}]})
    assert explode_results(docs(spark, [body])).count() == 2


def test_detail_for_keeps_listed_multiplicity(spark):
    listing = docs(spark, [json.dumps({"results": [{"number": "a"}, {"number": "b"}, {"number": "a"}]})])
    detail = spark.createDataFrame([("a", "{}"), ("b", "{}"), ("c", "{}")], "number string, body string")
    assert sorted(r["number"] for r in detail_for(listing, detail).collect()) == ["a", "a", "b"]


def _tree(spark):
    title = lambda s: F.struct(F.lit(s).alias("@value"))
    nodes = spark.createDataFrame([
        ("root", ["a", "b", "empty"], None, None),
        ("a", ["leaf1", "shared"], None, None),
        ("b", ["shared", "nocode"], None, None),
        ("empty", [], None, None),          # empty child list: emits nothing
        ("leaf1", None, "A00", "cholera"),
        ("shared", None, "A01", "typhoid"),  # reached twice: emitted twice
        ("nocode", None, None, "no code"),   # leaf without code: skipped
        ("orphan", None, "A99", "unreachable"),
    ], "url string, child array<string>, code string, t string")
    nodes = nodes.select("url", "child", F.col("child").isNotNull().alias("has_child"), "code",
                         F.when(F.col("t").isNotNull(), F.struct(F.col("t").alias("@value"))).alias("title"))
    return nodes, edges_from_documents(nodes)


def test_hierarchy_leaves(spark):
    nodes, edges = _tree(spark)
    roots = spark.createDataFrame([("root",)], "url string")
    leaves = hierarchy_leaves(nodes, edges, roots)
    assert sorted(r["code"] for r in leaves.collect()) == ["A00", "A01", "A01"]
    codes = code_rows_from(leaves, DAY)
    assert codes.columns == ["icd_code", "icd_code_type", "code_description", "inserted_date", "updated_date",
                             "is_current_flag"]
    assert rows(codes.filter(F.col("icd_code") == "A00")) == [("A00", "ICD-10", "cholera", DAY, DAY, True)]


def test_hierarchy_cycle_raises(spark):
    nodes = spark.createDataFrame([("x", True, None, None), ("y", True, None, None)],
                                  "url string, has_child boolean, code string, title struct<`@value`:string>")
    edges = spark.createDataFrame([("x", "y"), ("y", "x")], "url string, child_url string")
    with pytest.raises(RuntimeError, match="deeper than"):
        hierarchy_leaves(nodes, edges, spark.createDataFrame([("x",)], "url string"), max_depth=5)


def test_malformed_document_fails_the_job(spark):
    with pytest.raises(Exception, match="not a JSON document"):
        flatten_registry(docs(spark, ["{}", "{broken"]), DAY).collect()


def test_deep_chain_is_walked_to_its_end(spark):
    n = 70
    nodes = spark.createDataFrame([(f"n{i}", i < n - 1, f"C{i}", ("t",)) for i in range(n)],
                                  "url string, has_child boolean, code string, title struct<`@value`:string>")
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(n - 1)], "url string, child_url string")
    got = hierarchy_leaves(nodes, edges, spark.createDataFrame([("n0",)], "url string"))
    assert [r["code"] for r in got.select("code").collect()] == [f"C{n - 1}"]


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 3000])
def test_expand_counts(spark, n):
    from claimlake.operators.nested import expand_counts

    df = spark.createDataFrame([("x", n)], "v string, __n long")
    out = expand_counts(df)
    assert out.columns == ["v"] and out.count() == n


def test_hierarchy_many_paths_counts(spark):
    """A ladder DAG: 2^k paths reach the bottom; the frontier stays one row per node."""
    k = 12
    nodes = [(f"n{i}", True, None, None) for i in range(k)] + [(f"m{i}", True, None, None) for i in range(k)]
    nodes += [(f"n{k}", False, "LEAF", "bottom")]
    edges = []
    for i in range(k):
        nxt = f"n{i + 1}"
        edges += [(f"n{i}", nxt), (f"n{i}", f"m{i}"), (f"m{i}", nxt)]
    ndf = spark.createDataFrame(nodes, "url string, has_child boolean, code string, t string").select(
        "url", "has_child", "code", F.when(F.col("t").isNotNull(), F.struct(F.col("t").alias("@value"))).alias("title"))
    edf = spark.createDataFrame(edges, "url string, child_url string")
    roots = spark.createDataFrame([("n0",)], "url string")
    counted = hierarchy_leaves(ndf, edf, roots, expand=False).collect()
    # reached at depths k..2k, one row per depth with a binomial path count
    assert {r["code"] for r in counted} == {"LEAF"} and len(counted) == k + 1
    assert sum(r["paths"] for r in counted) == 2 ** k
    assert hierarchy_leaves(ndf, edf, roots).count() == 2 ** k


def test_rejected_documents_are_output(spark):
    """One parse: a good row, and the text of each document that cannot be read."""
    good = json.dumps({"results": [{"number": "1", "enumeration_type": "NPI-1", "basic": {"first_name": "Ann"}}]})
    raw = docs(spark, [good, "{broken", json.dumps({"results": "none"}), json.dumps({"results": []}), None])
    out = flatten_registry(raw, DAY, malformed="reject")
    assert rows(out.filter("rejected IS NULL").drop("rejected")) == [("1", "Ann", "", "", "", "", DAY)]
    assert rows(out.filter("rejected IS NOT NULL")) == [(None,) * 7 + (t,) for t in (json.dumps({"results": "none"}), "{broken")]
    parsed = explode_results(raw, malformed="reject")
    assert parsed.columns == ["number", "rejected", "result"]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") == 1 and "get_json_object" not in plan
    assert explode_results(raw, malformed="skip").count() == 1


NODE = "url string, has_child boolean, code string, title struct<`@value`:string>"


def test_small_cycle_in_a_large_graph(spark):
    """Three nodes in a ring below a root, beside 100,000 others: found within a few levels."""
    import claimlake.operators.nested as nested_module

    wide = spark.range(100000).select(F.concat(F.lit("w"), "id").alias("url"), F.lit(False).alias("has_child"),
                                      F.concat(F.lit("W"), "id").alias("code"), F.struct(F.lit("t").alias("@value")).alias("title"))
    nodes = spark.createDataFrame([(u, True, None, None) for u in ("root", "x", "y", "z")], NODE).unionByName(wide)
    edges = spark.createDataFrame([("root", "x"), ("x", "y"), ("y", "z"), ("z", "x")], "url string, child_url string").unionByName(
        wide.select(F.lit("root").alias("url"), F.col("url").alias("child_url")))
    levels, real = [], nested_module._stored_level
    nested_module._stored_level = lambda level: levels.append(1) or real(level)
    try:
        with pytest.raises(RuntimeError, match="cycle"):
            hierarchy_leaves(nodes, edges, spark.createDataFrame([("root",)], "url string"))
    finally:
        nested_module._stored_level = real
    assert len(levels) <= 9


def test_paths_of_different_length_are_no_cycle(spark):
    """A DAG whose nodes are met at many levels is walked to its end."""
    k = 9
    nodes = spark.createDataFrame([(f"n{i}", i < k, f"C{i}", ("t",)) for i in range(k + 1)], NODE)
    edges = spark.createDataFrame([(f"n{i}", f"n{j}") for i in range(k) for j in (i + 1, i + 2) if j <= k], "url string, child_url string")
    got = hierarchy_leaves(nodes, edges, spark.createDataFrame([("n0",)], "url string"), expand=False)
    ways = [1, 1]
    for _ in range(k - 1):
        ways.append(ways[-1] + ways[-2])
    assert sum(r["paths"] for r in got.collect()) == ways[k]


def test_walk_from_unknown_or_no_roots(spark):
    nodes, edges = _tree(spark)
    roots = spark.createDataFrame([("nowhere",)], "url string")
    assert hierarchy_leaves(nodes, edges, roots).count() == 0
    assert hierarchy_leaves(nodes, edges, roots.limit(0)).count() == 0
