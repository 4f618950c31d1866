"""The stages one after another, and the result of the whole, against plain versions on the small tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from tradewake.llm import decontamination, pii, quality, queries, simhash
from tradewake.sources import stored

from ..compare import connect, differences
from . import test_pii
from .helpers import plain_fingerprint, reachable
from .test_tokens import check_pieces


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Documents before the first stage and after each."""
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], sf_dir), f"test-{name}"))
    return frames


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def plain_good(docs, labels):
    """Ids whose score reaches the threshold, from full matrices."""
    matrix = np.array([quality.statistics(t.encode()) for t in docs.values()])
    known = [n for n, i in enumerate(docs) if i in labels]
    marks = np.array([labels[i] for i in docs if i in labels])
    rows = matrix[known]
    spread = quality.RIDGE * rows.var(axis=0) + 1e-9
    both = sum((marks == k).sum() * np.cov(rows[marks == k].T, bias=True) for k in (0, 1)) / len(rows)
    logs = []
    for k in (0, 1):
        part = rows[marks == k]
        cov = (1 - quality.SHRINKAGE) * np.cov(part.T, bias=True) + quality.SHRINKAGE * both + np.diag(spread)
        d = matrix - part.mean(axis=0)
        logs.append(np.log(len(part) / len(rows)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d @ np.linalg.inv(cov) * d).sum(axis=1))
    score = 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / quality.TEMPERATURE, -700, 700)))
    return {i for i, s in zip(docs, score) if s >= quality.THRESHOLD}


def plain_private(text):
    key = corpus_pipeline.PII_KEY

    def digest(kind, value):
        return hashlib.sha256(f"{key}|{kind}|{value}".encode()).hexdigest()

    def new(match):
        value = match[0]
        digits = re.sub(r"\D", "", value)
        fill = lambda d: re.sub(r"\d", "{}", value.replace("{", "")).format(*d)
        if "@" in value:
            return f"u{digest('mail', value.lower())[:24]}@{value.split('@')[-1]}"
        if re.fullmatch("[0-9a-f]{32,}|[0-9A-F]{32,}", value) and not value.isdigit():
            made = (digest("secret", value.lower()) * 3)[: len(value)]
            return made.upper() if value == value.upper() else made
        if value.startswith("+"):
            return fill(digits[0] + test_pii.plain_digits(digits[1:], "phone")) if 8 <= len(digits) <= 15 else value
        if re.fullmatch(r"\d+\.\d+\.\d+\.\d+", value):
            return test_pii.plain_address(value) if all(int(x) < 256 for x in value.split(".")) else value
        return fill(test_pii.plain_card(digits)) if len(digits) >= 13 else value

    return regex.sub(pii._ANY, new, text)


def test_columns_stay_until_the_last_stage(stages):
    assert all(f.columns == stages[0].columns for f in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]


def test_quality_stage(spark, sf_dir, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = texts(stages[1])
    assert set(kept) == plain_good(texts(stages[0]), labels) and 0 < len(kept) < stages[0].count()


def test_near_duplicate_stage(stages):
    before = texts(stages[1])
    prints = {i: plain_fingerprint(t) for i, t in before.items()}
    ids = list(prints)
    near = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = reachable(ids, near)
    assert set(texts(stages[2])) == {i for i in ids if roots[i] == i} and near


def test_decontamination_stage(spark, sf_dir, stages):
    templates = decontamination.Templates()
    bench = [templates.windows(r.text)[:2] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = set()
    for i, text in texts(stages[2]).items():
        at, hashes, *_ = templates.windows(text)
        found = dict(zip(at.tolist(), hashes.tolist()))
        places = {}
        for p, h in found.items():
            places.setdefault(h, []).append(p)
        held = False
        for item_at, item_hashes in bench:
            shifts = {q - p for p, h in zip(item_at.tolist(), item_hashes.tolist()) for q in places.get(h, ())}
            shared = [sum(found.get(p + s) == h for p, h in zip(item_at.tolist(), item_hashes.tolist())) for s in shifts]
            held |= max(shared, default=0) >= 0.8 * len(item_at)
        if not held:
            clean.add(i)
    assert set(texts(stages[3])) == clean


def test_pii_stage(stages, monkeypatch):
    monkeypatch.setattr(test_pii.plain_feistel, "__defaults__", (corpus_pipeline.PII_KEY,))
    before, after = texts(stages[3]), texts(stages[4])
    assert after == {i: plain_private(t) for i, t in before.items()}
    assert before != after


def test_packing_stage_and_the_whole(spark, sf_dir, stages):
    wanted = texts(stages[4])
    pieces = stages[5].collect()
    check_pieces(pieces, wanted)
    assert all(zlib.crc32(np.array(p.token_ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)
    whole = queries.queries()["pipeline"](spark, sf_dir)
    check_pieces(whole.collect(), wanted)


@pytest.mark.parametrize("step", range(5))
def test_stages_take_odd_tables(spark, sf_dir, step):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = corpus_pipeline.STAGES[step][1]
    nothing = stage(spark, docs.filter("false"), sf_dir)
    assert nothing.isEmpty()
    odd = docs.limit(20).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (-1, "", "xx", "s", 0), (-1, "", "xx", "s", 0)], docs.schema)
    ).withColumn("score", F.lit("clash")).withColumn("id", F.lit(None).cast("int"))
    found = stage(spark, odd, sf_dir)
    assert step == 4 or found.columns == odd.columns
    assert found.count() > 0


def python_operators(node, above=0):
    """The most Python operators that stand in one task of a plan, each with a worker of its own."""
    name = node.nodeName()
    below = [node.children().apply(i) for i in range(node.children().size())]
    own = 0 if "Exchange" in name else above + any(word in name for word in ("EvalPython", "InArrow", "InPandas"))
    return max([own, *(python_operators(x, own) for x in below)])


@pytest.mark.parametrize("step", range(5))
def test_a_task_of_a_stage_has_one_python_worker(spark, sf_dir, monkeypatch, step):
    frames = []

    def noted(df, *settings):
        frames.append(df)
        return stored(df, *settings)

    for module in (quality, simhash, decontamination):
        monkeypatch.setattr(module, "stored", noted)
    frames.append(corpus_pipeline.STAGES[step][1](spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = [python_operators(df._jdf.queryExecution().executedPlan()) for df in frames]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert max(found) == (corpus_pipeline.STAGES[step][0] != "pii")


def test_measured_leaves_out_documents_without_a_label(spark):
    texts = [(1, "Some words."), (2, None), (3, ""), (None, "No id."), (1, "Other words."), (4, "Not asked for.")]
    docs = spark.createDataFrame(texts, "name int, body string")
    known = stored(spark.createDataFrame([(1,), (2,), (3,), (5,)], "id int"), "test-ids")
    rows = quality.measured(docs, "name", "body", known)
    assert dict(rows.dtypes) == {"id": "int", "statistics": "array<double>"}
    wanted = [(i, quality.statistics(t and t.encode())) for i, t in texts if i in (1, 2, 3)]
    # The map of the ids may let others through.
    found = sorted((r.id, r.statistics) for r in rows.collect() if r.id in (1, 2, 3))
    assert found == sorted(wanted)
    assert quality.measured(docs.filter("false"), "name", "body", known).isEmpty()


CONTRACT = {
    "op1_embeddings": "vec_id n_links component_id kept",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_simhash": "doc_id fingerprint component_id",
    "op5_language": "doc_id held_out lang_pred score",
    "op6_quality": "doc_id held_out score predicted",
    "op7_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op11_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_spelling": "word form root n n_near form_n",
    "op13_line_dedup": "doc_id n_lines n_dropped kept_sha256",
}


def test_one_query_per_operator_with_the_columns_asked_for(spark, sf_dir):
    registered = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in registered if n != "pipeline") == list(range(1, 14))
    for name, columns in CONTRACT.items():
        found = registered[name](spark, sf_dir)
        assert found.columns[: len(columns.split())] == columns.split()
    kinds = dict(registered["op7_sharding"](spark, sf_dir).dtypes)
    assert (kinds["size"], kinds["text_crc32"], kinds["shard"], kinds["slot"], kinds["grown_shard"]) == ("bigint", "bigint", "int", "bigint", "int")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    assert differences(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) == []
