import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewake.llm import line_dedup

DOCS = "doc_id long, text string"
LONG = "a line that is long enough to count, number "


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain(rows):
    """(id, kept text, lines, dropped) of each row."""
    holders = defaultdict(list)
    for i, text in rows:
        for key in {key_of(line) for line in (text or "").split("\n")}:
            if len(key) >= 40:
                holders[key].append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 5}
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if key_of(line) not in last or last[key_of(line)] == i]
        found.append((i, text and "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(found, key=repr)


def found(df, **more):
    rows = line_dedup.without_repeated_lines(df, **more).select("doc_id", "text", "n_lines", "n_dropped")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"most_bits": 1 << 10}], ids=["", "full filters"])
def test_equals_a_plain_version(spark, more):
    """Filters that are full suspect every line, to the same result."""
    draw = random.Random(2)
    lines = [LONG + str(i) for i in range(40)] + ["short", "", "  ", "x" * 39, "y" * 40, "é" * 39, "ü" * 40, "É" * 40]
    rows = []
    for i in range(200):
        chosen = [draw.choice(lines) for _ in range(draw.randint(0, 12))]
        chosen += [LONG + f"of its own {i}" for _ in range(draw.randint(0, 2))]
        rows.append((i, "\n".join(draw.choice([x, x.upper() if x.isascii() else x, f"\t {x}\r", x]) for x in chosen)))
    df = spark.createDataFrame(rows, DOCS).repartition(6)
    assert found(df, **more) == plain(rows)


def test_a_line_of_a_third_of_all_rows(spark):
    rows = [(i, f"{LONG}common\nrest {i}" if i % 3 == 0 else f"{LONG}{i}\r\n{LONG}{i}") for i in range(900)]
    assert found(spark.createDataFrame(rows, DOCS).repartition(20)) == plain(rows)


def test_a_lookup_too_large_for_a_broadcast_gives_the_same(spark, monkeypatch):
    rows = [(i, f"{LONG}common\n{LONG}{i % 7}\nrest") for i in range(60)]
    whole = line_dedup.with_lookup
    monkeypatch.setattr(line_dedup, "with_lookup", lambda *a: whole(*a, small=0))
    assert found(spark.createDataFrame(rows, DOCS)) == plain(rows)


def test_odd_rows(spark):
    """Null ids and texts, equal ids, repeated rows, a very long text and other columns."""
    common = f"{LONG}1"
    rows = [(None, common), (None, f"{common}\nx"), (None, None), (1, ""), (2, common), (2, f"{common}\nother"), (2, common)]
    rows += [(3, "\n".join([common] * 1000 + ["z" * 1_000_000])), (3, f"\n{common}\n")]
    nulls = [(None, f"{LONG}only without ids\n{i}") for i in range(6)]
    df = spark.createDataFrame(rows + nulls, DOCS)
    assert found(df) == plain(rows + nulls)
    extra = df.withColumns({name: F.lit(9) for name in ("row", "id", "h1", "lost", "of", "kept", "n_lines")})
    assert found(extra) == plain(rows + nulls)
    assert line_dedup.without_repeated_lines(extra).columns == [
        "doc_id", "row", "id", "h1", "lost", "of", "kept", "text", "n_lines", "n_dropped",
    ]


def test_no_rows(spark):
    assert found(spark.createDataFrame([], DOCS)) == []


def test_filters_lose_no_repeat(spark):
    """Of digests dealt over tasks, all that occur twice are in the second filter, and few others."""
    draw = np.random.default_rng(8)
    numbers = draw.integers(-(2**62), 2**62, (3000, 2))
    rows = [tuple(map(int, r)) for r in numbers] + [tuple(map(int, r)) for r in numbers[:500]]
    lines = spark.createDataFrame(rows, "h1 long, h2 long").repartition(7)
    bits = 1 << 16
    kept = line_dedup.suspected(lines, line_dedup.filters_of(lines, bits), bits).distinct().collect()
    assert {tuple(map(int, r)) for r in numbers[:500]} <= {tuple(r) for r in kept} and len(kept) < 600
