import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewake.llm import common, embeddings, graph, simhash
from tradewake.sources import stored

from .helpers import plain_fingerprint, plain_links, reachable

VECTORS = "vec_id long, embedding array<float>, label int"


def classes(df):
    return {r[0]: r.component_id for r in df.collect()}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(2, 1), (1, 2), (3, 2)], [(i, i + 1) for i in range(1, 40)], [(9, i) for i in range(10, 30)] + [(3, 29)],
    [(i, i // 2) for i in range(2, 60)] + [(70, 71), (None, 3)],
])
def test_lowest_reachable(spark, links):
    found = graph.lowest_reachable(spark.createDataFrame(links, "x long, y long"))
    known = [(a, b) for a, b in links if a is not None and a != b]
    assert {r.node: r.root for r in found.collect()} == reachable({i for pair in known for i in pair}, known)
    assert found.count() == found.select("node").distinct().count()


def test_fingerprint_equals_the_plain_one():
    texts = ["", " \t\n", "One", "a b c d", "A b\tc  D e", "x " * 500, "Ünï CÖDE ÄB ab\x0bcd\x1fe f g h", None]
    assert [simhash.fingerprint(None if t is None else t.encode()) for t in texts] == list(map(plain_fingerprint, texts))


def test_every_pair_within_four_bits_is_linked(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    prints = {b ^ sum(1 << int(i) for i in rng.choice(64, n, replace=False)) for b in base for n in range(7) for _ in range(6)}
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    found = graph.lowest_reachable(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")))
    near = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    wanted = reachable(signed, near)
    assert {r.node: r.root for r in found.collect()} == {i: r for i, r in wanted.items() if i in {x for p in near for x in p}}


def test_long_posting_lists_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "_LIST", 8)
    # One chain of steps of four bits in the last byte and beyond: the same first bytes, so the same lists.
    prints = sorted({(n * 0x0F0F) & 0xFFFF | 0x1234567800000000 for n in range(200)})
    found = graph.lowest_reachable(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")))
    near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4]
    wanted = reachable(prints, near)
    assert {r.node: r.root for r in found.collect()} == {i: wanted[i] for i in {x for p in near for x in p}}


def test_postings_are_not_broadcast(spark):
    """Spark sizes the exploded postings as the fingerprints they come from, and would send them to the driver."""
    prints = stored(spark.range(1000).select(F.xxhash64("id").alias("fp")), "test-prints")
    blocks = simhash._blocks(simhash._postings(prints.union(prints.select(F.col("fp").bitwiseXOR(F.lit(1))))))
    assert not blocks.isEmpty()
    blocks.collect()
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_documents_odd_ones_included(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(5, text, "x"), (3, text.upper(), None), (8, text + " more", "y"), (1, None, "z"), (2, "", "z"), (9, "alone here", "z"),
            (5, text, "x"), (None, text, "n"), (7, "long " * 30_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id == {5: 3, 3: 3, 8: 3, 1: 1, 2: 1, 9: 9, None: 3, 7: 7}
    assert {r.doc_id: r.fp & (2**64 - 1) for r in found} == {i: plain_fingerprint(t) for i, t, _ in rows}
    kept = simhash.one_of_each_class(docs)
    assert kept.columns == docs.columns
    # One row of each class; the one without an id is a copy of 3, 5 and 8.
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [1, 3, 7, 9]
    assert simhash.near_duplicates(docs.filter("false")).isEmpty() and simhash.one_of_each_class(docs.filter("false")).isEmpty()


def test_rows_are_judged_one_by_one(spark):
    """Equal ids with different texts, copies without ids, rows alike, text ids and clashing columns."""
    alone = ["one two three four five six", "seven eight nine ten eleven twelve", "a b c d e f g h"]
    rows = [(5, alone[0]), (5, alone[1]), (None, alone[2]), (None, alone[2]), (None, alone[2]), (7, "x y z"), (7, "x y z"), (8, "x y z"), (9, alone[1])]
    extra = {name: F.lit(name) for name in ("_id", "fp", "k1", "row", "best", "stays", "text_of", "id")}
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(extra).repartition(4)
    wanted = sorted([(5, alone[0]), (5, alone[1]), (None, alone[2]), (7, "x y z")], key=repr)
    kept = simhash.one_of_each_class(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == wanted
    named = docs.withColumn("doc_id", F.concat(F.lit("00"), F.col("doc_id").cast("string")))
    assert sorted(((r.doc_id and int(r.doc_id), r.text) for r in simhash.one_of_each_class(named).collect()), key=repr) == wanted


def test_classes_beyond_a_broadcast_are_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = sorted(simhash.near_duplicates(docs).collect())
    kept = sorted(simhash.one_of_each_class(docs).collect())
    whole = simhash.with_lookup
    monkeypatch.setattr(simhash, "with_lookup", lambda *a, **more: whole(*a, small=0, **more))
    assert sorted(simhash.near_duplicates(docs).collect()) == wanted
    assert sorted(simhash.one_of_each_class(docs).collect()) == kept
    first = {r.component_id for r in wanted}
    assert {r.doc_id for r in kept} == first


def test_a_salted_lookup_is_not_broadcast(spark):
    """Beyond the counted bound, that is, where Spark sizes its repeated rows like single ones."""
    lookup = stored(spark.range(50).select("id", (F.col("id") * 7).alias("seven")), "test-lookup")
    rows = spark.range(400).select((F.col("id") % 60).alias("id"), F.col("id").alias("row"))
    for how, wanted in (("inner", 340), ("left", 400)):
        found = common.with_lookup(rows, lookup, ["id"], F.col("row"), small=49, how=how)
        got = found.collect()
        assert len(got) == wanted and all(r.seven == (7 * r.id if r.id < 50 else None) for r in got)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_fingerprint_as_text(spark):
    rows = spark.createDataFrame([(0,), (-1,), (255,)], "fp long").select(simhash.hex_digits(F.col("fp")).alias("h"))
    assert [r.h for r in rows.collect()] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]


def clusters(rng, sizes, spread=0.02, d=24):
    rows = []
    for size in sizes:
        center = rng.normal(size=d)
        rows += [center + spread * rng.normal(size=d) * np.linalg.norm(center) for _ in range(size)]
    return rows


def check_vectors(spark, rows, **settings):
    found = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, VECTORS), **settings).collect()}
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None, label) for i, v, label in rows]
    links = plain_links([(i, label, v) for i, v, label in rows])
    counts = {i: 0 for i, _, _ in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    assert {i: r.n_links for i, r in found.items()} == counts
    assert {i: r.component_id for i, r in found.items()} == reachable(list(counts), links)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    return links


def test_forest_finds_the_links_of_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(clusters(rng, [1] * 500 + [2] * 60 + [150] + [9] * 10, 0.04))]
    links = check_vectors(spark, rows, leaf_rows=40, fit_rows=120)
    assert len(links) > 1000


def test_clusters_that_cannot_be_split_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "_BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(clusters(rng, [120, 1, 1, 40], 0.01))]
    check_vectors(spark, rows, leaf_rows=20, fit_rows=64)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, None, 1), (9, [], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0], 1), (12, [1.0], 1),
            (13, [1e38, 0.0], 1), (14, [1e-38, 0.0], 1)]
    check_vectors(spark, rows)
    doubled = rows + rows[:3] + [(None, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(doubled, VECTORS).withColumn("v", F.lit("clash")).withColumn("leaf", F.lit(0))
    found = embeddings.near_duplicates(frame).collect()
    assert len(found) == len(rows) and {r.vec_id: r.n_links for r in found}[1] == 4
    assert embeddings.near_duplicates(frame.filter("false")).isEmpty()


def test_recall_on_the_table(spark, sf_dir):
    """Against all pairs; the given table has few links, so some copies with noise are added."""
    rng = np.random.default_rng(4)
    given = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    more = [
        (10_000 + n, [float(x + 0.03 * rng.normal()) for x in v], label)
        for n, (_, v, label) in enumerate(given[:200])
    ]
    check_vectors(spark, given + more, leaf_rows=32)
