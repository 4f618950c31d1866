import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewake.llm import sharding


def plain(rows, shards, seed=sharding.SEED):
    """(shard, slot) of each row, by sorting everything."""
    keyed = []
    for i, text, source in rows:
        data = (text or "").encode()
        key = hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        keyed.append(((source is not None, source or ""), key, (i is not None, i or 0), len(data) + 1, zlib.crc32(data)))
    keyed.sort()
    size = Counter(k[0] for k in keyed)
    rank, seen = [], Counter()
    for k in keyed:
        rank.append(((seen[k[0]] + 0.5) / size[k[0]], k[1], k[0], *k[2:]))
        seen[k[0]] += 1
    rank.sort()
    small, more = divmod(len(rows), shards)
    places = [(s, slot) for s in range(shards) for slot in range(small + (s < more))]
    return [(r[3][1] if r[3][0] else None, r[4], r[5], *place) for r, place in zip(rank, places)]


def found(df):
    return [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in df.collect()]


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_a_plain_sort(spark, sf_dir, parts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    wanted = sorted(plain([tuple(r) for r in docs.collect()], 16))
    assert sorted(found(sharding.interleaved(docs.repartition(parts)))) == wanted


def test_every_shard_has_the_mixture(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 600, "big").otherwise("small").alias("source")
    )
    rows = sharding.interleaved(docs, shards=10).groupBy("shard").agg(
        F.count("*").alias("n"), F.count_if(F.col("source") == "big").alias("big")
    ).collect()
    assert all(r.n == 100 and abs(r.big - 60) <= 1 for r in rows)
    other = sharding.interleaved(docs, shards=10, seed=3)
    assert sorted(found(other)) != sorted(found(sharding.interleaved(docs, shards=10)))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "é", None), (None, "x", ""), (4, "y" * 70_000, "a"), (1, None, "a"), (5, "z", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("key", F.lit(1)).withColumn("shard", F.lit("s"))
    for shards in (3, 16):
        got = found(sharding.interleaved(docs, shards=shards))
        assert len(got) == len(rows)
        assert sorted(map(repr, got)) == sorted(map(repr, plain(rows, shards)))
        per_shard = Counter(g[3] for g in got)
        assert max(per_shard.values()) - min(per_shard.get(s, 0) for s in range(shards)) <= 1
        for s, n in per_shard.items():
            assert sorted(g[4] for g in got if g[3] == s) == list(range(n))
    assert sharding.interleaved(docs.filter("false")).isEmpty()
