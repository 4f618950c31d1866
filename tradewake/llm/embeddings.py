"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Every tree splits the vectors of a label by random directions at the median, again and again, until a
node holds at most ``leaf_rows``. Vectors close to a split go to both sides, so that a pair which is close
enough to link is seldom torn apart; the width of that overlap follows from the wanted cosine. A pair is
compared in double precision when it shares a leaf of any tree, and linked when its cosine is high enough.
Links found are therefore exact; with the default forest a pair at the threshold is missed about once
in a million when ten or so splits suffice, less for closer pairs.

Scale: each round splits all large nodes by up to four levels at once. The splits of a node are fitted in a
task on a bounded sample of its rows (``fit_rows`` on average) and joined to its rows, so neither the forest nor
any node passes through the driver, and the number of rounds grows with the logarithm of the rows. Copies of a
vector are one entry with a count. A node that cannot be split, such as a cluster of close copies, is dealt
into blocks whose pairs are compared in separate tasks of at most ``2 * _BLOCK`` rows. A pair that
shares several leaves is counted in the one with the lowest number, so counts are summed and pairs are never listed;
what leaves a comparison is a row per vector, with a link to the lowest vector connected to it there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stored
from .common import components
from .graph import lowest_reachable

MIN_COSINE = 0.93
TREES = 8
LEAF_ROWS = 256
FIT_ROWS = 512
_DEPTH = 4  # levels fitted in a round
_BLOCK = 2048
_TRIES = 3  # directions tried for a split
_WIDEST_CHILD = 0.85  # a split must leave less than this share on either side
_MIX = 0x9E3779B97F4A7C15


def _valid(label: Column, vector: Column) -> Column:
    """A label, and a vector of finite numbers that are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(column: pa.ListArray) -> np.ndarray:
    """The vectors as rows of length one, in double precision."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _direction(node: int, place: int, attempt: int, size: int) -> np.ndarray:
    """The random direction of a split; it depends on the node's number only, so it is never stored."""
    x = np.random.default_rng([node & (2**64 - 1), place, attempt]).normal(size=size)
    return x / np.linalg.norm(x)


def _margin(min_cosine: float, size: int) -> float:
    """Half the width of the overlap: half a deviation of the projected distance of a pair at the threshold."""
    return 0.5 * np.sqrt(2 - 2 * min_cosine) / np.sqrt(size)


def _fit(rows: np.ndarray, node: int, weight: float, leaf_rows: int, margin: float) -> list[float]:
    """Thresholds and attempts of a subtree in heap order: (median, attempt) per place, NaN where it ends."""
    model = [np.nan] * (2 * ((1 << _DEPTH) - 1))

    def split(place: int, part: np.ndarray) -> None:
        if place >= (1 << _DEPTH) - 1 or len(part) * weight <= leaf_rows or len(part) < 8:
            return
        for attempt in range(_TRIES):
            at = part @ _direction(node, place, attempt, part.shape[1])
            middle = float(np.median(at))
            left, right = at <= middle + margin, at >= middle - margin
            if max(left.sum(), right.sum()) < _WIDEST_CHILD * len(part):
                model[2 * place], model[2 * place + 1] = middle, attempt
                split(2 * place + 1, part[left])
                split(2 * place + 2, part[right])
                return

    split(0, rows)
    return model


def _route(rows: np.ndarray, node: int, model: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and heap places of the ends they reach; a row in an overlap has several."""
    found: list[tuple[np.ndarray, int]] = []
    waiting = [(0, np.arange(len(rows)))]
    while waiting:
        place, at = waiting.pop()
        if not len(at):
            continue
        if 2 * place >= len(model) or np.isnan(model[2 * place]):
            found.append((at, place))
            continue
        value = rows[at] @ _direction(node, place, int(model[2 * place + 1]), rows.shape[1])
        middle = model[2 * place]
        waiting.append((2 * place + 1, at[value <= middle + margin]))
        waiting.append((2 * place + 2, at[value >= middle - margin]))
    return (
        np.concatenate([at for at, _ in found]),
        np.concatenate([np.full(len(at), place) for at, place in found]),
    )


def _child(node: int, place: int) -> int:
    """The number of an end of a node's subtree."""
    x = ((node & (2**64 - 1)) ^ (place + 1) * 0xBF58476D1CE4E5B9) * _MIX & (2**64 - 1)
    x ^= x >> 31
    return x - 2**64 if x >= 2**63 else x


def _leaves(vectors: DataFrame, trees: int, leaf_rows: int, fit_rows: int, min_cosine: float) -> DataFrame:
    """(v, leaf): the leaves of every vector in all trees."""
    kind = vectors.schema["vector"].dataType.simpleString()

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        # A group is the sample of one node: fit_rows rows on average.
        rows = _units(table.column("vector").combine_chunks())
        weight = table.column("size")[0].as_py() / max(1, len(rows))
        model = _fit(rows, key[0].as_py(), weight, leaf_rows, _margin(min_cosine, rows.shape[1]))
        return pa.table({"node": [key[0].as_py()], "model": pa.array([model], pa.list_(pa.float64()))})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = np.asarray(batch.column("node"))
            picked, child, done = [], [], []
            order = np.argsort(nodes, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(nodes[order])) + 1):
                if not len(at):
                    continue
                node = int(nodes[at[0]])
                model = batch.column("model")[int(at[0])].as_py()
                if model is None or np.isnan(model[0]):
                    picked.append(at)
                    child.append(np.full(len(at), node))
                    done.append(np.ones(len(at), dtype=bool))
                    continue
                rows = _units(batch.column("vector").take(pa.array(at)))
                row, place = _route(rows, node, np.array(model), _margin(min_cosine, rows.shape[1]))
                numbers = {p: _child(node, int(p)) for p in np.unique(place)}
                picked.append(at[row])
                child.append(np.array([numbers[p] for p in place], dtype=np.int64))
                done.append(np.zeros(len(row), dtype=bool))
            if not picked:
                continue
            taken = pa.array(np.concatenate(picked))
            yield pa.RecordBatch.from_pydict({
                "v": batch.column("v").take(taken),
                "vector": batch.column("vector").take(taken),
                "node": pa.array(np.concatenate(child)),
                "done": pa.array(np.concatenate(done)),
            })

    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    state = vectors.select("v", "vector", "label", tree).select(
        "v", "vector", F.xxhash64("tree", "label", F.size("vector")).alias("node"), F.lit(False).alias("done")
    )
    finished = []
    while True:
        going = state.filter(~F.col("done"))
        sizes = stored(
            going.groupBy("node").agg(F.count("*").alias("size")).filter(F.col("size") > leaf_rows), "node-sizes"
        )
        draw = F.pmod(F.xxhash64("v", "node"), F.lit(1 << 20)) < F.lit(float(fit_rows) * (1 << 20)) / F.col("size")
        models = stored(
            going.join(sizes, "node").filter(draw).groupBy("node").applyInArrow(fit, "node long, model array<double>"),
            "splits",
        )
        state = stored(
            going.join(models, "node", "left").mapInArrow(route, f"v long, vector {kind}, node long, done boolean"),
            "tree-nodes",
        )
        finished.append(state.filter("done").select("v", F.col("node").alias("leaf")))
        if state.filter(~F.col("done")).isEmpty():
            break
    result = finished[0]
    for part in finished[1:]:
        result = result.union(part)
    return result


def _compare(min_cosine: float):
    """For a tile of a leaf: per vector its links that are counted here, and the lowest vector connected here."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        leaf, first, second = (part.as_py() for part in key[1:4])
        v = np.asarray(table.column("v"))
        order = np.argsort(v)  # so that the smallest index is the smallest id
        table = table.take(pa.array(order))
        v = v[order]
        rows = _units(table.column("vector").combine_chunks())
        linked = rows @ rows.T >= min_cosine
        if first != second:
            block = np.asarray(table.column("block"))
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        # Pairs that share a leaf with a lower number are counted there.
        lists = table.column("leaves").combine_chunks()
        leaves = np.asarray(lists.flatten())
        owner = np.repeat(np.arange(len(v)), np.diff(np.asarray(lists.offsets)))
        lower = leaves < leaf
        names, place = np.unique(leaves[lower], return_inverse=True)
        counted = linked
        if len(names):
            member = np.zeros((len(v), len(names)), dtype=np.float32)
            member[owner[lower], place] = 1
            counted = linked & (member @ member.T == 0)
        links = (counted * np.asarray(table.column("copies"))[None, :]).sum(axis=1)
        root = components(linked)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(v))))
        return pa.table({"v": v[some], "low": v[root[some]], "links": links[some].astype(np.int64)})

    return compare


def _links(vectors: DataFrame, leaves: DataFrame, min_cosine: float) -> DataFrame:
    """(v, low, links) from every tile of every leaf."""
    every = leaves.groupBy("v").agg(F.collect_set("leaf").alias("leaves"))
    rows = stored(vectors.join(every, "v").withColumn("leaf", F.explode("leaves")), "leaf-rows")
    sizes = rows.groupBy("label", "leaf").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    dealt = rows.join(sizes, ["label", "leaf"]).withColumn("blocks", F.ceil(F.col("size") / _BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    tiles = dealt.select("label", "leaf", "v", "vector", "copies", "leaves", "block", partner).withColumns(
        {"first": F.least("block", "partner"), "second": F.greatest("block", "partner")}
    )
    return tiles.groupBy("label", "leaf", "first", "second").applyInArrow(
        _compare(min_cosine), "v long, low long, links long"
    )


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """(id, n_links, component_id, kept): per vector its direct links and the smallest id it reaches.

    Vectors of the same label and length with a cosine of at least ``min_cosine`` link. A null label, a null
    vector, and one that is empty, all zero, or has null, NaN or infinite numbers link with nothing and are their own
    component. Copies link with each other. An id is a key: repeated rows count once, and of different rows with one
    id the smallest by label and vector stands for it; rows with a null id are left out. Other
    columns have no effect; an empty table gives no rows.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    ).filter(F.col("id").isNotNull())
    single = stored(
        rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*"), "vectors"
    )
    valid = single.filter(_valid(F.col("label"), F.col("vector")))
    distinct = stored(
        valid.groupBy("label", "vector").agg(F.min("id").alias("v"), F.count("*").alias("copies")), "distinct-vectors"
    )
    found = stored(
        _links(distinct, _leaves(distinct, trees, leaf_rows, fit_rows, min_cosine), min_cosine), "vector-links"
    )
    roots = lowest_reachable(found.select("v", "low")).withColumnRenamed("node", "v")
    counts = found.groupBy("v").agg(F.sum("links").alias("links"))
    classes = (
        distinct.join(counts, "v", "left")
        .join(roots, "v", "left")
        .select(
            "label", "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "v").alias("component_id"),
        )
    )
    return (
        single.join(classes, ["label", "vector"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col) == F.col("component_id"))
    )
