"""The k most similar vectors of every vector, by cosine.

A hierarchical k-means tree is fitted on a bounded sample (SAMPLE vectors, more for large tables, MOST_SAMPLE at most) and indexes every vector. A query walks the tree best-bin-first: a
priority queue holds the unopened nodes by the similarity of their centres, the best one is opened next, and a leaf is searched when it comes up.
How many leaves a query visits is calibrated: for CALIBRATION queries the true neighbours are found by brute force over all vectors, and visits
are widened until TARGET of them lie in visited leaves. Subtrees of about CELL_ROWS vectors are cells, the unit of distribution: a query travels
once to each cell that holds leaves it visits. Vectors of one direction are folded together first, so copies cost a few queries, scaled ones too.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qanat.session import cut_lineage, partitions

SAMPLE, MOST_SAMPLE, CALIBRATION, TARGET = 16_384, 1 << 18, 512, 0.985
BRANCHES, LEAF_ROWS, LEAF_SAMPLE, CELL_ROWS, SLICE_QUERIES = 8, 1_024, 12, 32_768, 65_536
DECIMALS, SHORTLIST, DIRECTION = 9, 8, 1e6
_USABLE = "id IS NOT NULL AND vector IS NOT NULL AND exists(vector, x -> x <> 0) AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x))"


@dataclass
class Tree:
    """Nodes in the order of creation, the root first. children is empty for leaves; cell and leaf number the cut and the leaves."""

    centres: np.ndarray
    children: list[list[int]]
    cell_of_leaf: np.ndarray
    leaf_of_node: np.ndarray


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows brought to length 1 in single precision."""
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The cluster of each point; spherical k-means from distant seeds."""
    seeds = [int(rng.integers(len(points)))]
    closest = points @ points[seeds[0]]
    for _ in range(k - 1):
        gap = np.maximum(1e-9, 1 - closest)
        seeds.append(int(rng.choice(len(points), p=gap / gap.sum())))
        closest = np.maximum(closest, points @ points[seeds[-1]])
    centres = points[seeds]
    for _ in range(rounds):
        label = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, points)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return (points @ centres.T).argmax(1)


def fit_tree(sample: np.ndarray, rows: int, leaf_rows: int = LEAF_ROWS, cell_rows: int = CELL_ROWS, seed: int = 7) -> Tree:
    """The tree over unit vectors that stand for `rows` vectors. A node is split until its share of the rows is a leaf's or its sample is small."""
    rng, scale = np.random.default_rng(seed), rows / max(1, len(sample))
    mean = lambda at: sample[at].mean(0) / max(1e-12, float(np.linalg.norm(sample[at].mean(0))))
    everything = np.arange(len(sample))
    centres, children, leaf_of_node, cell_of_leaf, cells = [mean(everything)], [[]], [-1], [], 0
    todo = [(0, everything, -1)]
    while todo:
        node, at, cell = todo.pop()
        if cell < 0 and len(at) * scale <= cell_rows:
            cell, cells = cells, cells + 1
        label = None
        if len(at) * scale > leaf_rows and len(at) >= 2 * LEAF_SAMPLE:
            label = _k_means(sample[at], min(BRANCHES, len(at) // LEAF_SAMPLE), rng)
            label = None if (label == label[0]).all() else label
        if label is None:
            if cell < 0:
                cell, cells = cells, cells + 1
            leaf_of_node[node] = len(cell_of_leaf)
            cell_of_leaf.append(cell)
            continue
        for value in np.unique(label):
            own = at[label == value]
            children[node].append(len(centres))
            todo.append((len(centres), own, cell))
            centres.append(mean(own))
            children.append([])
            leaf_of_node.append(-1)
    return Tree(np.array(centres, np.float32), children, np.array(cell_of_leaf), np.array(leaf_of_node))


def visited_leaves(tree: Tree, queries: np.ndarray, visits: int) -> np.ndarray:
    """The first `visits` leaves of each query (fewer leaves: -1), best bin first; a batch of priority queues, one row of a matrix each."""
    leaves = len(tree.cell_of_leaf)
    out = np.full((len(queries), min(visits, leaves)), -1, np.int32)
    inner = [i for i, c in enumerate(tree.children) if c]
    block = max(16, min(1024, (1 << 22) // len(tree.centres)))
    for start in range(0, len(queries), block):
        similar = queries[start : start + block] @ tree.centres.T
        queue = np.full_like(similar, -np.inf)
        queue[:, 0] = similar[:, 0]
        found = np.zeros(len(similar), np.int64)
        rows = np.arange(len(similar))
        while len(rows):
            node = queue[rows].argmax(1)
            queue[rows, node] = -np.inf
            leaf = tree.leaf_of_node[node]
            at = leaf >= 0
            out[start + rows[at], found[rows[at]]] = leaf[at]
            found[rows[at]] += 1
            for n in np.unique(node[~at]) if inner else ():
                open_ = rows[node == n]
                queue[np.ix_(open_, tree.children[n])] = similar[np.ix_(open_, tree.children[n])]
            rows = rows[found[rows] < out.shape[1]]
    return out


def home_leaf(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf a vector belongs to: the first one its walk reaches by always going down to the nearest child."""
    node = np.zeros(len(vectors), np.int64)
    while True:
        moving = [n for n in np.unique(node) if tree.children[n]]
        if not moving:
            return tree.leaf_of_node[node]
        for n in moving:
            at = np.flatnonzero(node == n)
            own = np.array(tree.children[n])
            node[at] = own[(vectors[at] @ tree.centres[own].T).argmax(1)]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors held as bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def exact_similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision, rounded to DECIMALS."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.round(np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)), DECIMALS)


def _best(queries: np.ndarray, plan: list[tuple[np.ndarray, np.ndarray]], members: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (query, member) of a cell: at least the `wanted` best of each query, ties of the rounded similarity by the members' order.

    plan: (queries, members) of each visited leaf. Members come in the order of their smallest ids.
    """
    q_unit, m_unit = unit(queries), unit(members)
    keep = max(SHORTLIST, wanted + 1)
    best, which = np.full((len(queries), keep), -np.inf, np.float32), np.full((len(queries), keep), -1, np.int32)
    for asked, own in plan:
        for start in range(0, len(asked), 1024):
            part = asked[start : start + 1024]
            near = np.concatenate([q_unit[part] @ m_unit[own].T, best[part]], axis=1)
            top = np.argpartition(near, near.shape[1] - keep, axis=1)[:, near.shape[1] - keep :]
            best[part] = np.take_along_axis(near, top, 1)
            which[part] = np.where(top < len(own), own[np.minimum(top, len(own) - 1)], np.take_along_axis(which[part], np.maximum(top - len(own), 0), 1))
    last = np.partition(best, keep - wanted, axis=1)[:, keep - wanted] - np.float32(2e-6)
    who, at = np.nonzero((best >= last[:, None]) & (which >= 0))
    what = which[who, at]
    torn = np.isfinite(last) & (best.min(1) >= last)  # more may tie than were kept
    if torn.any():
        tied = _among_ties(queries, plan, members, wanted, torn)
        who, what = np.concatenate([who[~torn[who]], tied[0]]), np.concatenate([what[~torn[who]], tied[1]])
    return who, what


def _among_ties(queries: np.ndarray, plan: list[tuple[np.ndarray, np.ndarray]], members: np.ndarray, wanted: int, torn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` best members of the torn queries by exact similarity and order; no more of them are held, however many tie."""
    exact = lambda x: x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    number = np.cumsum(torn) - 1
    value, which = np.full((int(torn.sum()), wanted), np.inf), np.full((int(torn.sum()), wanted), len(members))
    for asked, own in plan:
        part = asked[torn[asked]]
        for start in range(0, len(part), 256):
            q = exact(queries[part[start : start + 256]])
            row = number[part[start : start + 256]]
            for first in range(0, len(own), 4096):
                some = own[first : first + 4096]
                near = np.concatenate([-np.round(q @ exact(members[some]).T, DECIMALS), value[row]], axis=1)
                names = np.concatenate([np.broadcast_to(some, (len(row), len(some))), which[row]], axis=1)
                order = np.lexsort((names, near))[:, :wanted]
                value[row], which[row] = np.take_along_axis(near, order, 1), np.take_along_axis(names, order, 1)
    at, column = np.nonzero(which < len(members))
    return np.flatnonzero(torn)[at], which[at, column]


_RESULT = "k1 long, k2 long, near array<struct<negative: double, id: string>>"
_NEAR = pa.list_(pa.struct([("negative", pa.float64()), ("id", pa.string())]))


def _search_cell(wanted: int, rows: pa.Table) -> pa.Table:
    """The best of one cell (members have a leaf) for those of its members that ask and for visiting queries."""
    leaf, ids = rows["leaf"].to_numpy(), rows["ids"].to_pylist()
    inside, asks = np.flatnonzero(leaf >= 0), np.flatnonzero(rows["asks"].to_numpy(zero_copy_only=False))
    inside = np.array(sorted(inside.tolist(), key=lambda i: ids[i][0]), np.int64)
    empty = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("near", _NEAR)]).empty_table()
    if not len(inside) or not len(asks):
        return empty
    vectors = _matrix(rows["vector"].combine_chunks())
    asking = rows.take(pa.array(asks))
    visits = asking["leaves"].combine_chunks()
    visit_leaf, visitor = visits.flatten().to_numpy(), np.repeat(np.arange(len(asks)), visits.value_lengths().to_numpy(zero_copy_only=False))
    order, own_leaf = np.argsort(visit_leaf, kind="stable"), leaf[inside]
    visit_leaf, visitor = visit_leaf[order], visitor[order]
    plan = [(visitor[a:b], np.flatnonzero(own_leaf == x)) for x in np.unique(own_leaf) for a, b in [np.searchsorted(visit_leaf, [x, x + 1])] if b > a]
    members = vectors[inside]
    who, what = _best(vectors[asks], plan, members, wanted)
    similar = np.concatenate([exact_similarity(vectors[asks][who[i : i + 50_000]], members[what[i : i + 50_000]]) for i in range(0, len(who), 50_000)] or [np.zeros(0)])
    order = np.lexsort((-similar, who))
    who, what, similar = who[order], what[order], similar[order]
    edges = np.searchsorted(who, np.arange(len(asks) + 1)).tolist()
    place, negative = [ids[i] for i in inside[what]], (-similar).tolist()
    counts, values, names = [0], [], []
    for a, b in zip(edges, edges[1:]):
        near = sorted((n, i) for n, many in zip(negative[a:b], place[a:b]) for i in many)[:wanted]
        values += [n for n, _ in near]
        names += [i for _, i in near]
        counts.append(len(values))
    flat = pa.StructArray.from_arrays([pa.array(values, pa.float64()), pa.array(names, pa.string())], fields=list(_NEAR.value_type))
    return pa.table([asking["k1"], asking["k2"], pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat).cast(_NEAR)], schema=empty.schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable rows with two 64-bit hashes of the vector and two of its direction: sums over the places, each with its own odd factor."""
    factors = np.zeros((4, 0), np.uint64)
    for batch in batches:
        lists = batch["vector"]
        size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        value = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        if size.max(initial=0) > factors.shape[1]:
            factors = np.random.default_rng(17).integers(0, 1 << 63, (int(size.max()), 4), np.int64).astype(np.uint64).T * np.uint64(2) + np.uint64(1)
        filled = np.flatnonzero(size)
        begin = (np.cumsum(size) - size)[filled]
        place = np.arange(len(value)) - np.repeat(begin, size[filled])
        norm = np.sqrt(np.add.reduceat(value**2, begin)) if len(value) else np.zeros(0)
        usable = np.isfinite(norm) & (norm > 0)
        ids = batch["id"].is_valid().to_numpy(zero_copy_only=False)[filled]
        with np.errstate(invalid="ignore", divide="ignore"):
            turned = np.rint(np.nan_to_num(value / np.repeat(norm, size[filled]) * DIRECTION)).astype(np.int64).view(np.uint64)
        bits = (value + 0.0).astype(np.float64).view(np.uint64) >> np.uint64(29)  # all that a single-precision number has
        hashes = [np.add.reduceat(x * f[place], begin).view(np.int64) if len(value) else np.zeros(0, np.int64) for x, f in zip((bits, bits, turned, turned), factors)] if len(value) else [np.zeros(0, np.int64)] * 4
        kept = np.flatnonzero(usable & ids)
        take = pa.array(filled[kept])
        yield pa.RecordBatch.from_arrays([batch["id"].take(take), lists.take(take), *(pa.array(h[kept]) for h in hashes)], ["id", "vector", "k1", "k2", "c1", "c2"])


def keyed_vectors(rows: DataFrame) -> DataFrame:
    """id, vector, k1, k2 (of the vector), c1, c2 (of its direction) of rows with an id and a vector of numbers that are not all zero."""
    return rows.select("id", "vector").mapInArrow(_keys, "id string, vector array<float>, k1 long, k2 long, c1 long, c2 long")


def distinct_vectors(rows: DataFrame, wanted: int) -> DataFrame:
    """k1, k2, vector, ids, c1, c2, more: each distinct usable vector of rows (id, vector) with ids that have it.

    Vectors that are null, empty, all zero or hold nulls or NaN are left out, as are rows without an id. (c1, c2) is the direction, to six
    decimals: all of one direction have similarity 1 to each other (to DECIMALS). Of a direction the `wanted` smallest ids are held; `more` says
    that there are others, which are cut off before the shuffle: their neighbours are those smallest ids.
    """
    first = keyed_vectors(rows).withColumn("rank", F.dense_rank().over(Window.partitionBy("c1", "c2").orderBy("id"))).where(F.col("rank") <= wanted + 1)
    first = first.withColumn("more", F.max("rank").over(Window.partitionBy("c1", "c2")) > wanted).where(F.col("rank") <= wanted)
    return first.groupBy("c1", "c2", "k1", "k2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_set("id")).alias("ids"), F.first("more").alias("more"))


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)


def brute_force(distinct: DataFrame, queries: np.ndarray, wanted: int, tree: Tree) -> DataFrame:
    """The nearest `wanted` vectors of each query among all, with the leaf of each: q, similar, leaf. The queries are a bounded set."""
    asked = unit(queries)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own = unit(_vectors(batch.column(0)))
            near = asked @ own.T
            top = np.argpartition(-near, min(wanted, near.shape[1]) - 1, axis=1)[:, :wanted]
            leaf = home_leaf(tree, own)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(asked)), top.shape[1])), pa.array(np.take_along_axis(near, top, 1).ravel().astype(np.float64)), pa.array(leaf[top].ravel().astype(np.int64))], ["q", "similar", "leaf"])

    found = distinct.select("vector").mapInArrow(scan, "q long, similar double, leaf long")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similar"), "leaf"))).where(F.col("rank") <= wanted)


def calibrated_visits(distinct: DataFrame, tree: Tree, k: int, queries: np.ndarray, target: float = TARGET) -> int:
    """How many leaves a query visits so that `target` of the true neighbours of the calibration queries are met."""
    order = visited_leaves(tree, unit(queries), len(tree.cell_of_leaf))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1], dtype=np.int32)[None, :], 1)
    found = brute_force(distinct, queries, k + 1, tree).where("rank > 1").select("q", "leaf").toPandas()  # CALIBRATION x k rows; the first is itself
    needed = np.sort(rank[found["q"].to_numpy(), found["leaf"].to_numpy()]) + 1 if len(found) else np.ones(1, np.int32)
    return int(needed[max(0, int(np.ceil(target * len(needed))) - 1)])


@dataclass
class Index:
    """A fitted tree, how many leaves a query visits, and into how many slices the queries of each cell are cut."""

    tree: Tree
    visits: int
    slices: np.ndarray


def fit_index(distinct: DataFrame, n: int, k: int, target: float = TARGET) -> Index:
    """The index of n distinct vectors of one length. Calibration queries are outside the fitted sample where the table has more than that."""
    size = min(n, MOST_SAMPLE, max(SAMPLE, 3 * n * LEAF_SAMPLE // (2 * LEAF_ROWS)))
    share = min(1.0, 1.2 * (size + CALIBRATION) / n)
    at = F.shiftright("k1", 11)
    drawn = distinct.where(at.between(-(2**52), int(share * 2**53) - 2**52)).orderBy("k1", "k2").limit(size + CALIBRATION).select("vector")  # by hash: the same at every run
    sample = _vectors(drawn.toArrow()["vector"])
    rng = np.random.default_rng(11)
    fitted, asked = (sample[:size], sample[size:]) if len(sample) == size + CALIBRATION else (sample, sample[rng.permutation(len(sample))[:CALIBRATION]])
    tree = fit_tree(unit(fitted), n)
    visits = calibrated_visits(distinct, tree, k, asked, target)
    seen = visited_leaves(tree, unit(fitted[:SAMPLE]), visits)
    cell = np.where(seen >= 0, tree.cell_of_leaf[seen], -1)
    cell.sort(axis=1)
    new = (cell >= 0) & np.c_[np.ones(len(cell), bool), np.diff(cell, axis=1) > 0]
    load = np.bincount(cell[new], minlength=int(tree.cell_of_leaf.max()) + 1) * (n / max(1, len(cell)))
    return Index(tree, visits, np.maximum(1, np.ceil(load / SLICE_QUERIES)).astype(np.int32))


def routed_rows(distinct: DataFrame, index: Index, first_cell: int) -> DataFrame:
    """A row for each cell and slice that a vector visits; in its home cell it is a member (leaf >= 0) of every slice too, and asks in one."""
    shared = distinct.sparkSession.sparkContext.broadcast(index)  # bounded by MOST_SAMPLE

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, slices = shared.value.tree, shared.value.slices
        cells = int(tree.cell_of_leaf.max()) + 1
        for batch in batches:
            if not len(batch):
                continue
            vectors = _vectors(batch["vector"])
            own = unit(vectors)
            home, seen = home_leaf(tree, own), visited_leaves(tree, own, shared.value.visits)
            row = np.repeat(np.arange(len(own)), seen.shape[1])[seen.ravel() >= 0]
            seen = seen.ravel()[seen.ravel() >= 0]
            at_home = tree.cell_of_leaf[home]
            key = row * cells + tree.cell_of_leaf[seen]
            order = np.argsort(key, kind="stable")
            places = np.union1d(key, np.arange(len(own)) * cells + at_home)  # one row out for each vector and cell
            edges = np.searchsorted(key[order], np.append(places, len(own) * cells))
            row, cell = places // cells, places % cells
            inside = at_home[row] == cell
            mine = (batch["k2"].to_numpy()[row] >> 8) % slices[cell]
            copies = np.where(inside, slices[cell], 1)
            at = np.repeat(np.arange(len(row)), copies)
            part = np.where(inside[at], np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies), mine[at])
            leaves = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(seen[order], pa.int32())).take(pa.array(at))
            raw = pa.array([v.tobytes() for v in vectors], pa.binary())
            take = pa.array(row[at])
            ids = batch["ids"].take(pa.array(np.where(inside, row, 0)[at], mask=~inside[at]))
            arrays = [pa.array(cell[at] + first_cell, pa.int32()), pa.array(part, pa.int32()), pa.array(part == mine[at]), batch["k1"].take(take), batch["k2"].take(take), pa.array(np.where(inside, home[row], -1)[at], pa.int32()), leaves, raw.take(take), ids]
            yield pa.RecordBatch.from_arrays(arrays, ["cell", "slice", "asks", "k1", "k2", "leaf", "leaves", "vector", "ids"])

    return distinct.mapInArrow(route, "cell int, slice int, asks boolean, k1 long, k2 long, leaf int, leaves array<int>, vector binary, ids array<string>")


def nearest(rows: DataFrame, k: int = 5, target: float = TARGET) -> DataFrame:
    """(id_a, id_b), id_a < id_b: pairs in which one is among the k nearest of the other.

    rows: id, vector (array<float>). Ties of the rounded similarity go to the smaller id; of more than k + 1 vectors of one direction (to six
    decimals) the smallest ids stand for all. Rows without a usable vector take no part; vectors of different length are never neighbours, each
    length has its own tree. With k or fewer others, all are neighbours; fewer than two rows give no pairs.
    """
    spark, wanted = rows.sparkSession, k + 1
    distinct = cut_lineage(distinct_vectors(rows, wanted))
    lengths = {r["size"]: r["count"] for r in distinct.groupBy(F.size("vector").alias("size")).count().collect()}
    placed, first_cell = None, 0
    for length in sorted(lengths, key=lambda x: (-lengths[x], x)):
        own = distinct.where(F.size("vector") == length) if len(lengths) > 1 else distinct
        index = fit_index(own, lengths[length], k, target)
        routed = routed_rows(own, index, first_cell)
        placed = routed if placed is None else placed.unionByName(routed)
        first_cell += len(index.slices)
    if placed is None:
        return spark.createDataFrame([], "id_a string, id_b string")
    found = placed.groupBy("cell", "slice").applyInArrow(lambda rows: _search_cell(wanted, rows), _RESULT)
    best = found.groupBy("k1", "k2").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, wanted).alias("near"))
    listed = distinct.select("k1", "k2", "ids").join(best, ["k1", "k2"]).select(F.explode("ids").alias("id"), "near")
    others = F.slice(F.filter("near", lambda c: c["id"] != F.col("id")), 1, k)
    pairs = listed.select("id", F.explode(others).alias("c")).select("id", F.col("c.id").alias("other"))
    if distinct.where("more").limit(1).count():
        full = distinct.where("more").groupBy("c1", "c2").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, wanted).alias("ids"))
        rest = keyed_vectors(rows).select("id", "c1", "c2").join(full, ["c1", "c2"]).where("NOT array_contains(ids, id)")
        pairs = pairs.unionByName(rest.select("id", F.explode(F.slice("ids", 1, k)).alias("other")))
    return pairs.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def build_index(rows: DataFrame, path: str, k: int = 5, target: float = TARGET) -> None:
    """Stores an index of rows (id, vector) below path: every usable vector of the most frequent length by its leaf, and the tree.

    Vectors of other lengths go to leaf -1, which every query of their length reads whole.
    """
    distinct = cut_lineage(distinct_vectors(rows, k + 1))
    lengths = {r["size"]: r["count"] for r in distinct.groupBy(F.size("vector").alias("size")).count().collect()}
    length = max(lengths, key=lambda x: (lengths[x], x), default=0)
    index = fit_index(distinct.where(F.size("vector") == length), lengths[length], k, target) if lengths else None
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.full(len(batch), -1, np.int32)
            own = np.flatnonzero(batch["vector"].value_lengths().to_numpy(zero_copy_only=False) == length)
            if len(own) and shared.value is not None:
                leaf[own] = home_leaf(shared.value.tree, unit(_vectors(batch["vector"].take(pa.array(own)))))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["vector"], pa.array(leaf)], ["id", "vector", "leaf"])

    placed = rows.where(_USABLE).select("id", "vector").mapInArrow(place, "id string, vector array<float>, leaf int")
    placed.repartition("leaf").sortWithinPartitions("leaf").write.mode("overwrite").parquet(f"{path}/vectors")
    rows.sparkSession.createDataFrame([(length, bytearray(pickle.dumps(index)))], "length int, index binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")


def search_index(spark: SparkSession, path: str, vector: list[float], k: int = 5) -> DataFrame:
    """id, similarity (to DECIMALS) of the k vectors most similar to the asked one, best first, ties by id, from the leaves it visits.

    Only the leaves' row groups are read. A vector of zeros, of nulls or without values has no neighbours.
    """
    held = spark.read.parquet(f"{path}/tree").first()
    asked = np.array([np.nan if x is None else x for x in vector], np.float64).reshape(1, -1)
    stored = spark.read.parquet(f"{path}/vectors")
    if not np.isfinite(asked).all() or not asked.any():
        stored, leaves = stored.limit(0), [-1]
    elif len(vector) != held["length"]:
        leaves = [-1]
    else:
        index: Index = pickle.loads(held["index"])
        leaves = visited_leaves(index.tree, unit(asked), index.visits)[0].tolist()
    norm = float(np.linalg.norm(asked)) or 1.0
    q = F.array(*(F.lit(float(x)) for x in asked[0] / norm))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    similar = F.round(dot(F.col("vector"), q) / F.sqrt(dot(F.col("vector"), F.col("vector"))), DECIMALS)
    return stored.where(F.col("leaf").isin(leaves) & (F.size("vector") == len(vector))).select("id", similar.alias("similarity")).orderBy(F.desc("similarity"), "id").limit(k)


def measured_recall(rows: DataFrame, found: DataFrame, k: int = 5, one_in: int = 50) -> DataFrame:
    """Recall of found pairs against brute force, for one row in `one_in` (by the hash of its id) against all rows: queries, wanted, met, recall."""
    usable = rows.where(_USABLE).dropDuplicates(["id"])
    asked = usable.where(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0)
    n_blocks = max(1, asked.count() // 2000)
    blocks = asked.select(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(n_blocks)).alias("block"), "id", "vector").groupBy("block").agg(F.collect_list(F.struct("id", "vector")).alias("queries"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for queries, ids, vectors in zip(*(batch[c].to_pylist() for c in ("queries", "ids", "vectors"))):
                q, m, names = np.array([x["vector"] for x in queries], np.float32), np.array(vectors, np.float32), np.array(ids, object)
                near = np.round((q.astype(float) / np.linalg.norm(q.astype(float), axis=1, keepdims=True)) @ (m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)).T, DECIMALS)
                for x, row in zip(queries, near):
                    kept = np.flatnonzero(row >= np.partition(row, -min(k + 1, len(row)))[-min(k + 1, len(row))])
                    top = sorted((-s, i) for s, i in zip(row[kept], names[kept]) if i != x["id"])[:k]
                    yield pa.RecordBatch.from_pydict({"id": [x["id"]] * len(top), "other": [i for _, i in top], "negative": [s for s, _ in top]})

    parts = max(4 * partitions(rows.sparkSession), usable.count() // 4096)
    spread = usable.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).groupBy("part").agg(F.collect_list("id").alias("ids"), F.collect_list("vector").alias("vectors"))
    near = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(blocks, "block").mapInArrow(scan, "id string, other string, negative double")
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("negative", "other"))).where(F.col("rank") <= k)
    wanted = best.select("id", F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b"))
    met = wanted.join(found.withColumn("met", F.lit(1)), ["id_a", "id_b"], "left")
    return met.agg(F.countDistinct("id").alias("queries"), F.count("*").alias("wanted"), F.coalesce(F.sum("met"), F.lit(0)).alias("met")).withColumn("recall", F.col("met") / F.col("wanted"))
