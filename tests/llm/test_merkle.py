import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tradewake.llm import merkle
from tradewake.llm.queries import lower_ascii

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """The root, and for each leaf the (siblings before, siblings after) of every level."""
    ways = [[] for _ in leaves]
    at = list(range(len(leaves)))
    row = leaves
    while len(row) > 1:
        for i, way in enumerate(ways):
            run = at[i] - at[i] % 8
            way.append((row[run : at[i]], row[at[i] + 1 : run + 8]))
            at[i] //= 8
        row = [h(*row[i : i + 8]) for i in range(0, len(row), 8)]
    return row[0], ways


def plain_manifest(rows, change):
    groups = {}
    for row in rows:
        groups.setdefault((row[2] is not None, (row[2] or "").encode()), []).append(row)
    trees = []
    for name in sorted(groups):
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        leaves = [plain_leaf(r) for r in members]
        trees.append((members, leaves, *plain_tree(leaves)))
    root, tops = plain_tree([subroot for _, _, subroot, _ in trees])
    found = []
    for (members, leaves, subroot, ways), top in zip(trees, tops):
        for row, leaf, way in zip(members, leaves, ways):
            folded = plain_leaf(change(row))
            for before, after in [*way, *top]:
                folded = h(*before, folded, *after)
            proof = h(*(x for before, after in [*way, *top] for x in [*before, *after]))
            found.append((row[0], leaf, subroot, root, proof, folded))
    return found


def changed(row):
    if row[0] is None or row[0] % 3 or row[4] is None:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))


def found(df):
    rows = merkle.manifest(df, "lang", "doc_id", COLUMNS, {"text": lower_ascii(F.col("text"))}, F.col("doc_id") % 3 == 0)
    return [tuple(r) for r in rows.collect()]


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [513], [1, 2, 700], [1] * 20])
def test_equals_a_plain_tree(spark, sizes):
    rows = [(17 * i + g, "s", f"l{g}", i, f"Text Ä {i}") for g, size in enumerate(sizes) for i in range(size)]
    random.Random(5).shuffle(rows)
    assert in_order(found(spark.createDataFrame(rows, DOCS).repartition(3))) == in_order(plain_manifest(rows, changed))


def test_three_levels_of_blocks(spark):
    """More than 512 * 512 leaves: the blocks' roots fill more than one block themselves."""
    n = 512 * 512 + 3
    df = spark.range(n).select("id", F.lit("x").alias("lang"))
    rows = merkle.manifest(df, "lang", "id", ["id"]).filter(F.col("id").isin(0, 511, 512, n - 1))
    leaves = [plain_leaf([i]) for i in range(n)]
    row, levels = leaves, []
    while len(row) > 1:
        levels.append(row)
        row = [h(*row[i : i + 8]) for i in range(0, len(row), 8)]
    for found_row in rows.collect():
        at, siblings = found_row.id, []
        for level in levels:
            run = at - at % 8
            siblings += level[run:at] + level[at + 1 : run + 8]
            at //= 8
        assert tuple(found_row) == (found_row.id, leaves[found_row.id], row[0], row[0], h(*siblings), row[0])


def test_odd_rows(spark):
    """Nulls in every column, empty and long texts, equal ids and repeated rows."""
    rows = [
        (None, None, None, None, None), (1, "s", "en", 3, ""), (1, "s", "en", 3, ""), (1, "t", "en", 3, "B" * 300_000),
        (3, None, "en", None, None), (6, "s", "", 0, "ÀB\n"), (9, "", None, 1, "1:"), (None, "s", "en", 2, "X"),
    ]
    df = spark.createDataFrame(rows, DOCS)
    extra = df.withColumns({name: F.lit(1) for name in ("tree", "rank", "n", "node", "other", "group", "id", "block", "place")})
    wanted = in_order(plain_manifest(rows, changed))
    assert in_order(found(df)) == wanted
    assert in_order(found(extra)) == wanted
    by_id = {row[0]: row for row in wanted}
    assert by_id[3][5] == by_id[3][3] and by_id[6][5] != by_id[6][3]


def test_no_rows(spark):
    assert found(spark.createDataFrame([], DOCS)) == []


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_places_in_order_of_van_emde_boas(levels):
    """Every place is taken once, the upper half of a tree comes first, and each lower tree is one stretch."""
    def plain(levels):
        """(depth, index) in the order of storage."""
        if levels == 1:
            return [(0, 0)]
        upper = levels // 2
        order = plain(upper)
        for top in range(8**upper):
            order += [(depth + upper, top * 8**depth + index) for depth, index in plain(levels - upper)]
        return order

    for place, (depth, index) in enumerate(plain(levels)):
        assert merkle.address(depth, index, levels) == place


def test_fold_refuses_a_changed_sibling():
    leaves = [h(str(i)) for i in range(100)]
    block = merkle.Block.build(leaves, 3)
    assert block.root() == plain_tree(leaves)[0]
    for i in (0, 63, 64, 99):
        siblings = block.siblings(i)
        assert merkle.fold(leaves[i], i, 100, siblings)[0] == block.root()
        assert merkle.fold(leaves[i], i, 100, siblings[:-1] + ("0" if siblings[-1] != "0" else "1"))[0] != block.root()
