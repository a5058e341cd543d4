"""Divergence, decontamination and filter audit on small, awkward tables, against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from claimlake.llm import decontamination, filter_audit, source_divergence

DOCS = "doc_id long, text string, lang string, source string, `n.chars` long, row long, cell int, part string, ids string, words string"
ASCII = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TEST_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(20000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen"


def rows():
    rng = random.Random(5)
    vocabulary = ["the", "of", "and", "Ähre", "été", "naïve", "日本", "x", "Mix", "mix", *[f"t{chr(97 + i)}" for i in range(20)]]
    texts = [None, "", " \t\n", "ONE # TWO & three", PASSAGE, f"zero {PASSAGE.upper()}, fourteen", f"a b {PASSAGE} c {PASSAGE}", LONG, LONG, "A" * 500,
             "\x00nul\x00and\x7fdel", "the the the the the the the the the the the the the", "ten nine eight seven six five four three two one"]
    texts += [" ".join(rng.choices(vocabulary, range(40, 10, -1), k=rng.choice([3, 40, 150]))) for _ in range(120)]
    out = [(i, t, [None, "en", "en", "fr", ""][i % 5], [None, "s1", "s2", "s3", "s4", "", "S1"][i % 7]) for i, t in enumerate(texts)]
    out += [out[4], out[4], (None, PASSAGE, "en", "s1"), (None, "alone", "de", "only"), (900, LONG, "de", "long"), (901, None, "xx", "empty"), (902, "", "xx", "s1")]
    return [(*r, 1, 2, 3, "p", "i", "w") for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------ operator 11
def brute_divergence(table, min_docs):
    groups, counts, in_docs = set(), collections.Counter(), collections.defaultdict(set)
    for at, r in enumerate(table):
        text, lang, source = r[1] or "", r[2] or "", r[3] or ""
        groups.add((lang, source))
        for w in TERM.findall(text):
            w = w.translate(ASCII)
            counts[lang, source, w] += 1
            in_docs[lang, w].add(at)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [w for (x, w), d in in_docs.items() if x == lang and len(d) >= min_docs]
        sources = [s for x, s in groups if x == lang]
        total = {w: sum(counts[lang, s, w] for s in sources) for w in kept}
        share = lambda c, of: {w: 1 + 10**9 * (c[w] + 2) // (of + 2 * len(kept)) for w in kept}
        per = {s: {w: counts[lang, s, w] for w in kept} for s in sources}
        p = {s: share(per[s], sum(per[s].values())) for s in sources}
        q = share(total, sum(total.values()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if per[s][w] and p[s][w] > q[w]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("min_docs, block_groups", [(10, 512), (2, 4)])
def test_divergence(docs, min_docs, block_groups):
    got = source_divergence.source_divergence(docs, min_docs=min_docs, block_groups=block_groups)
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows(), min_docs)
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"


def test_divergence_of_nothing(empty):
    assert source_divergence.source_divergence(empty).count() == 0


def test_partial_counts_flush_within_a_bound(spark, monkeypatch):
    import pyarrow as pa

    for name, value in (("PIECE_BYTES", 200), ("MERGE_ROWS", 30), ("HELD_ROWS", 40)):
        monkeypatch.setattr(source_divergence, name, value)
    cols = list(zip(*[[r[2] or "", r[3] or "", r[1] or ""] for r in rows()]))
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["lang", "source", "text"])
    parts = list(source_divergence._partial_counts([batch, batch.slice(3, 50)]))
    assert len(parts) > 1
    got = collections.Counter()
    for part in parts:
        for r in part.to_pylist():
            got[r["lang"], r["source"], r["term"]] += r["n"]
    want = collections.Counter()
    for r in [*rows(), *rows()[3:53]]:
        want.update((r[2] or "", r[3] or "", w.translate(ASCII)) for w in TERM.findall(r[1] or ""))
    assert {k: n for k, n in got.items() if k[2] is not None} == dict(want)
    assert {k[:2] for k in got} == {(r[2] or "", r[3] or "") for r in rows()}


def test_shares_beyond_64_bits():
    count = np.array([9 * 10**9, 12 * 10**9, 0])
    n = int(count.sum())
    assert source_divergence.share(count, n, 3).tolist() == [1 + 10**9 * (int(c) + 2) // (n + 6) for c in count]


# ------------------------------------------------------------------ operator 12
ITEMS = [(1, PASSAGE, "x", "y"), (2, "nine ten eleven", "x", "y"), (3, None, "x", "y"), (4, " . ", "x", "y"), (5, PASSAGE, "x", "y"), (None, "The, THE the the the the the the the the the", "x", "y"),
         (7, "été", "x", "y"), (7, "absent words that occur nowhere at all in any of the texts here", "x", "y"), (8, " ".join(LONG.split()[5000:5100]), "x", "y"),
         (10, "ten nine eight seven six five four three two one", "x", "y")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string, seq string, row string")


def cut(text):
    return [w for w in TEST_WORD.findall((text or "").translate(ASCII))]


def windows_of(table, width):
    for item, text, *_ in table:
        w = cut(text)
        for s in range(max(1, len(w) - width + 1) if w else 0):
            yield "" if item is None else str(item), tuple(w[s : s + width])


def brute_hits(text, windows):
    words = cut(text)
    hit, found = set(), set()
    places = collections.defaultdict(list)
    for i, w in enumerate(words):
        places[w].append(i)
    for item, win in windows:
        for i in places.get(win[0], ()):
            if tuple(words[i : i + len(win)]) == win:
                hit.update(range(i, i + len(win)))
                found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_contamination(docs, items, monkeypatch, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    windows = set(windows_of(ITEMS, 10))
    want = sorted((str(r[0]), *brute_hits(r[1], windows)) for r in rows())
    got = decontamination.contamination(docs, items)
    assert sorted((str(r[0]), *r[1:]) for r in map(tuple, got.collect())) == want
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_passages_and_empty_tables(docs, items, empty):
    got = decontamination.find_passages(docs, items).where("doc_id = 6 AND item_id IN ('1', '5', '2')").collect()
    assert sorted(map(tuple, got)) == sorted([(6, i, a + k, a + k + 9) for i in ("1", "5") for a in (2, 16) for k in range(4)] + [(6, "2", a, a + 2) for a in (10, 24)])
    assert decontamination.contamination(empty, items).count() == 0
    clean = decontamination.contamination(docs, items.limit(0))
    assert clean.where("contaminated OR n_items > 0 OR n_hit > 0").count() == 0 and clean.count() == len(rows())
    assert decontamination.find_passages(docs, items.limit(0)).count() == 0


def test_proximity(spark, docs, items):
    """All words of a window within a span, in any order: which documents and items, against all spans."""
    within = 14
    windows = [(item, set(w)) for item, w in set(windows_of(ITEMS, 10))]
    want = set()
    for r in rows():
        words = cut(r[1])
        held = set(words)
        for item, w in windows:
            if w <= held and any(w <= set(words[a : a + within]) for a in range(max(1, len(words) - within + 1))):
                want.add((r[0], item))
    got = decontamination.find_passages(docs, items, within=within)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert (12, "10") in want and (4, "10") in want  # the same words in reverse
    assert got.where(f"high - low >= {within}").count() == 0


# ------------------------------------------------------------------ operator 13
def fails(table):
    first = {}
    for r in table:
        if r[0] is not None:
            first[r[1] or ""] = min(r[0], first.get(r[1] or "", r[0]))
    for r in table:
        text = r[1] or ""
        words = WORD.findall(text)
        yield r[0], r[2] or "", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                                 bool(re.search(r"[#$%&*|]", text)), r[0] is not None and first[text] < r[0])


def brute_audit(table, labels):
    quality, toxic = {r[0] for r in labels if r[1] == 1}, {r[0] for r in labels if r[2] == 1}
    failed = list(fails(table))
    out, gone = [], collections.Counter()
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        for order in itertools.permutations(range(5)):
            left = mine
            for step, at in enumerate(order):
                removed = [(i, f) for i, f in left if f[at]]
                left = [(i, f) for i, f in left if not f[at]]
                gone[part, at] += len(removed)
                out.append((part, order, step, len(left), len(removed), sum(f[at] for _, f in mine) - len(removed),
                            sum(f[at] and sum(f) == 1 for _, f in mine), sum(i is not None and i in quality for i, _ in removed), sum(i is not None and i in toxic for i, _ in removed)))
    return sorted((p, "".join("ABCDE"[i] for i in o), s + 1, *x, gone[p, o[s]]) for p, o, s, *x in out)


LABELS = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 130, 2)] + [(3, 0, 0), (3, 1, 1), (3, None, None), (None, 1, 1), (4000, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(*r, 9) for r in LABELS], "doc_id long, quality int, toxic int, cell long")


def test_filter_audit(docs, labels, empty):
    got = filter_audit.audit_filters(docs, labels)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows(), LABELS)
    assert filter_audit.audit_filters(empty, labels).count() == 0
    bare = filter_audit.audit_filters(docs, labels.limit(0))
    assert bare.where("good_lost > 0 OR toxic_lost > 0").count() == 0 and bare.count() == got.count()


def test_filter_audit_hot_text_and_id(spark, labels):
    table = [(i, "copy # of THE SAME" if i % 3 == 0 else f"text {i}", "en", None) for i in range(3000)] + [(7, f"id {i}", None, "s") for i in range(1500)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, filter_audit.audit_filters(docs, labels).collect())) == brute_audit(table, LABELS)


def test_steps_of_three_filters():
    rng = np.random.default_rng(1)
    tensor = rng.integers(0, 50, (3, 2, 2, 2))
    table = [((a, b, c), tensor[:, a, b, c]) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    shares = collections.Counter()
    want = []
    for order in itertools.permutations(range(3)):
        for k, at in enumerate(order):
            here = sum(n for f, n in table if f[at] and not any(f[i] for i in order[:k]))
            kept = sum(n[0] for f, n in table if not any(f[i] for i in order[: k + 1]))
            every = sum(n[0] for f, n in table if f[at])
            alone = sum(n[0] for f, n in table if f[at] and sum(f) == 1)
            shares[at] += here[0]
            want.append(("".join("XYZ"[i] for i in order), k + 1, kept, here[0], every - here[0], alone, here[1], here[2], at))
    assert list(filter_audit.steps(tensor, "XYZ")) == [(*w[:-1], shares[w[-1]]) for w in want]
