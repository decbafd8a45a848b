"""Each operator against the plain version of its contract, on edge cases and on a small table."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from estatelens.llm import components, contamination, distribution_rules, fingerprints, licenses, mixing, personal, queries, secret_scan, spans
from tests.llm import brute
from tests.llm.conftest import EDGE_TEXTS, SF, bag, pairs


@pytest.fixture(params=["edge", "small", "nothing"])
def docs(request):
    return request.getfixturevalue(request.param)


@pytest.fixture
def run(spark, docs, monkeypatch):
    """A query over the rows of ``docs`` in place of the table."""
    real = queries.table

    def table(session, folder, name):
        return docs if name == "documents" else real(session, folder, name)

    monkeypatch.setattr(queries, "table", table)
    return lambda query: query(spark, SF)


def test_licenses(run, docs):
    found = run(queries.op1_license_scan)
    got = found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert bag(got) == bag((i, *brute.licenses(t)) for i, t in pairs(docs))
    for r in found.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_license_near_the_template(edge):
    found = {r["doc_id"]: r["spans"] for r in licenses.scan_licenses(edge).collect()}
    assert [(s["label"], s["start"], s["end"]) for s in found[16]] == [("mit", 0, 17)]
    assert 0.8 <= found[16][0]["found"] < 1


def test_personal(run, docs):
    kinds = ("email", "ip", "card", "phone")
    got = run(queries.op3_personal_data).collect()
    wanted = []
    for i, t in pairs(docs):
        counts, digest = brute.personal(t)
        wanted.append((i, *[counts[k] for k in kinds], digest))
    assert bag((r["doc_id"], *[r[f"n_{k}"] for k in kinds], r["base_sha256"]) for r in got) == bag(wanted)


def test_secrets(run, docs):
    kinds = ("assign", "access", "hex")
    got = run(queries.op8_secrets).collect()
    wanted = []
    for i, t in pairs(docs):
        counts, digest = brute.secrets(t)
        wanted.append((i, *[counts[k] for k in kinds], digest))
    assert bag((r["doc_id"], *[r[f"n_{k}"] for k in kinds], r["base_sha256"]) for r in got) == bag(wanted)


def test_near_duplicates(run, docs):
    got = run(queries.op5_near_duplicates).collect()
    assert bag(got) == bag(brute.near_duplicates(pairs(docs)))


def test_contamination(spark, run, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    wanted = brute.contamination(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    assert bag(run(queries.op6_contamination).collect()) == bag(wanted)


def test_contamination_in_sets(spark, edge):
    items = [("a", "one two three"), ("b", "cc by"), ("c", None), (None, "x y"), ("d", ""), ("e", "the cat sat on the mat and the dog sat on the mat")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    wanted = bag((x[0], x[1], x[2], x[3]) for x in brute.contamination(EDGE_TEXTS, items))
    for size in (1_000_000, 2):
        found = contamination.scan_contamination(edge, bench, set_windows=size)
        assert bag(found.select("doc_id", "n_words", "n_hit", F.size("items")).collect()) == wanted


def test_contaminated_spans_go(spark):
    docs = spark.createDataFrame([(1, "Keep This. ONE, two three! and That", 7), (2, None, 8), (3, "clean", 9)], "doc_id int, text string, hits int")
    bench = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    assert bag(contamination.decontaminate(docs, bench, spans=True).collect()) == bag([(1, "Keep This. ! and That", 7), (2, None, 8), (3, "clean", 9)])
    assert bag(contamination.decontaminate(docs, bench).collect()) == bag([(2, None, 8), (3, "clean", 9)])


def test_passages_without_an_item_id(spark):
    """They are hit and removed like others, and name no item."""
    docs = spark.createDataFrame([(1, "and x y too"), (2, "clean")], "doc_id int, text string")
    bench = spark.createDataFrame([(None, "x y"), ("a", "x y too")], "item_id string, text string")
    rows = contamination.scan_contamination(docs, bench).orderBy("doc_id").select("n_hit", "items").collect()
    assert [tuple(r) for r in rows] == [(3, ["a"]), (0, [])]
    assert [r["doc_id"] for r in contamination.decontaminate(docs, bench.where("item_id is null")).collect()] == [2]


def test_contaminated_documents_go_by_one_set_or_several(spark, edge):
    bench = spark.createDataFrame([("a", "one two three"), ("b", "cc by"), ("c", "cat sat on")], "item_id string, text string")
    hit = {(x[0], t) for (_, t), x in zip(EDGE_TEXTS, brute.contamination(EDGE_TEXTS, [tuple(r) for r in bench.collect()])) if x[2]}
    wanted = bag(x for x in EDGE_TEXTS if x not in hit)
    for size in (1_000_000, 1):
        kept = contamination.decontaminate(edge, bench, set_windows=size)
        assert kept.columns == edge.columns
        assert bag(kept.select("doc_id", "text").collect()) == wanted


def test_quality_rules(run, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = run(queries.op7_quality_rules).collect()
    assert bag((r["doc_id"], *[r[n] for n in names]) for r in got) == bag((i, *brute.quality(t)) for i, t in pairs(docs))
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert all(0 <= r[x] <= 1 for r in got for x in ("class_js", "common_js"))


def test_mixing(run, docs):
    got = run(queries.op9_mixing).collect()
    sizes, source = {}, {}
    for r in docs.select("doc_id", "text", "source").collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.spaced_words(r["text"]))
        source[r["doc_id"]] = r["source"]
    targets = brute.targets(sizes) if sizes else {}
    assert bag(r["size"] for r in []) == [] and sorted(r["size"] for r in got) == sorted(
        len(brute.spaced_words(t)) for _, t in pairs(docs)
    )
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    mixed = mixing.mix_sources(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("longest")
    )
    for r in mixed.collect():
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert abs(r["taken"] - r["target"]) <= r["longest"]


def test_mix_is_sorted_and_whole(edge):
    mix = mixing.mixed_documents(edge).collect()
    positions = [r["mix_position"] for r in mix]
    assert positions == sorted(positions) and all(0 <= p <= 1 for p in positions)
    copies = mixing.mix_sources(edge).agg(F.sum("copies")).first()[0]
    assert len(mix) == copies
    assert mixing.mixed_documents(edge).columns == [*edge.columns, "mix_copy", "mix_position"]


def test_schedule_is_inverted(spark):
    shares = spark.range(0, 101).select((F.col("id") / 100).alias("share"))
    for a, b in ((3.0, 1.0), (1.0, 3.0), (1.0, 1.0)):
        for r in shares.select("share", mixing.due_time(F.col("share"), F.lit(a), F.lit(b)).alias("t")).collect():
            due = (a * r["t"] + (b - a) * r["t"] ** 2 / 2) / ((a + b) / 2)
            assert due == pytest.approx(r["share"], abs=1e-12)


@pytest.mark.parametrize("large", [fingerprints.LARGE_FILE, 2])
def test_links_lose_nothing(spark, large):
    """Chains, stars and near misses; with files filed again as well."""
    import random

    draw = random.Random(5)
    fps = set()
    for _ in range(30):
        fp = draw.getrandbits(64)
        fps.add(fp)
        for _ in range(draw.randrange(12)):
            fp ^= sum(1 << b for b in draw.sample(range(64), draw.choice((1, 2, 3, 4))))
            fps.add(fp)
    signed = [(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps]
    links = fingerprints.fingerprint_links(spark.createDataFrame(signed, "fp bigint"), large=large).collect()
    parent = {fp: fp for fp in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = r["src"] % (1 << 64), r["dst"] % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    assert {fp: root(fp) for fp in fps} == brute.components(fps)


def test_trigram_queries():
    query = secret_scan.trigram_query(secret_scan.BASE_RULES[0].pattern)
    assert len(query) == 1 and frozenset({"tok", "oke", "ken"}) in query[0] and frozenset({"api", "pik", "ike", "key"}) in query[0]
    assert secret_scan.trigram_query(secret_scan.BASE_RULES[1].pattern) == [[frozenset({"aki", "kia"})]]
    assert secret_scan.trigram_query(r"[0-9a-f]+") == []
    assert secret_scan.trigram_query(r"(?:abcd)*x") == []
    assert secret_scan.trigram_query(r"abc\d+defg") == [[frozenset({"abc"})], [frozenset({"def", "efg"})]]


def test_redaction(spark, edge):
    docs = spark.createDataFrame([(1, "mail é a@b.cd now +1 (386) 555-3733."), (2, None), (3, "plain")], "doc_id int, text string")
    assert dict(personal.redact_personal(docs).collect()) == {1: "mail é [EMAIL] now [PHONE].", 2: None, 3: "plain"}
    docs = spark.createDataFrame([(1, "x token=abcdefghijklmnop y"), (2, None)], "doc_id int, text string")
    assert dict(secret_scan.redact_secrets(docs).collect()) == {1: "x [ASSIGN] y", 2: None}
    assert personal.redact_personal(edge).columns == edge.columns


def test_keep_one(edge):
    kept = fingerprints.keep_one_of_each(edge).collect()
    wanted = {c for _, _, c in brute.near_duplicates(EDGE_TEXTS)}
    assert sorted(map(repr, (r["doc_id"] for r in kept))) == sorted(map(repr, wanted))


def test_keep_one_without_ids(spark):
    """Each component keeps a row, also where ids are null or stand for several texts."""
    far = "quite another text about the weather in the north"
    rows = [(None, "one two three", 2), (None, "one two three", 1), (None, far, 3), (5, "", 4), (5, None, 4), (5, "x y z", 6), (4, "x y z", 7)]
    kept = fingerprints.keep_one_of_each(spark.createDataFrame(rows, "doc_id int, text string, n int")).collect()
    assert bag((r["doc_id"], r["n"]) for r in kept) == bag([(None, 1), (None, 3), (5, 4), (4, 7)])


def test_divergence(spark):
    rows = [([1.0, 1.0], [2.0, 2.0], 0.0), ([1.0, 0.0], [0.0, 1.0], 1.0), ([0.0, 0.0], [0.0, 0.0], 0.0)]
    docs = spark.createDataFrame(rows, "a array<double>, b array<double>, d double")
    for r in docs.select("d", distribution_rules.jensen_shannon(F.col("a"), F.col("b")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["d"])


def test_spans_merge(spark):
    docs = spark.createDataFrame([("0123456789",)], "text string")
    runs = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(0).alias("rank"), F.lit(b).alias("end"), F.lit(k).alias("kind")) for a, b, k in ((1, 4, "a"), (2, 3, "b"), (3, 6, "c"), (6, 8, "d"))])
    rows = docs.select("text", spans.without_overlap(runs).alias("runs")).select(spans.replaced(F.col("text"), F.col("runs")))
    assert rows.first()[0] == "0[A][D]89"


def test_long_span_lists(spark):
    """More spans than a chunk holds, with runs that go on from one chunk to the next."""
    text = "ab12 é3 " * 1500
    rows = spark.createDataFrame([(text,), ("",), (None,)], "text string")
    digits = spans.placed(F.coalesce("text", F.lit("")), spans.matches(F.coalesce("text", F.lit("")), "[0-9]+"), "[0-9]+")
    found = {r["text"]: r["spans"] for r in rows.select("text", digits.alias("spans")).collect()}
    assert [tuple(s) for s in found[text]] == [(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", text)]
    assert found[""] == found[None] == []

    draw = random.Random(5)
    given = sorted((a, 0, a + draw.choice((1, 2, 3, 900)), draw.choice("xyz")) for a in draw.choices(range(11_000), k=1_200))
    wanted: list[list] = []
    for a, _, b, kind in given:
        if wanted and a < wanted[-1][1]:
            wanted[-1][1] = max(wanted[-1][1], b)
        else:
            wanted.append([a, b, kind])
    out, at = "", 0
    for a, b, kind in wanted:
        out, at = out + text[at:a] + f"[{kind.upper()}]", b
    listed = spark.createDataFrame([(text, given)], f"text string, spans array<{spans.KIND_SPAN}>")
    runs = listed.select("text", spans.without_overlap(F.col("spans")).alias("runs"))
    got = runs.select("runs", spans.replaced(F.col("text"), F.col("runs")).alias("text")).first()
    assert [list(r) for r in got["runs"]] == wanted
    assert got["text"] == out + text[at:]


def test_unfinished_components_are_an_error(spark):
    chain = spark.range(200).selectExpr("id AS src", "id + 1 AS dst")
    assert {r["label"] for r in components.component_labels(chain).collect()} == {0}
    with pytest.raises(RuntimeError, match="not complete"):
        components.component_labels(chain, rounds=2)
