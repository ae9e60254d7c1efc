"""Approximate nearest neighbours by a random-projection forest.

Largest inner product is searched as smallest distance: index vectors get one
more component, sqrt(M^2 - |x|^2) with M the longest norm, queries get a 0
there, and the order of distances is then the order of inner products.

Fitting: the forest is fitted on a bounded sample (``SAMPLE`` vectors, chosen
by hash).  A tree halves the sample again and again at the median of its
projection onto the difference of two random members.  The forest has as many
leaves as the *whole* table needs for ``LEAF_ROWS`` rows a leaf, as far as the
sample can shape them (``DEEPEST`` levels).  Beyond, a leaf is grown further
where its rows are: the task that holds them fits a tree of its own on all of
them, down to ``LEAF_ROWS`` again, and calibrates how many of its leaves a
query visits.

Indexing: every row is routed down every tree.  Rows of equal vectors are one
entry with its smallest ids (a query can return no others), so a vector that a
third of all rows share is one entry.

Searching: a query goes down all trees through one shared priority queue,
ordered by the squared margins it is on the wrong side of; the ``visits`` best
leaves are searched.  Leaves are held in shards (one tree each, a bounded
number of rows; a leaf above ``SHARD_ROWS`` is dealt out to several shards,
which its queries all visit); a shard's queries meet its leaves in blocks of
products, which tell what can be among the best but for rounding; those are
scored again from the two vectors alone, so that a score does not depend on
its block and equal scores are equal.  Each shard answers with its k + 1 best
entries per query by (score, smallest id), which hold the k + 1 best ids, and
the answers are merged by the same order.  ``visits`` is calibrated on the
sample: the fewest leaves at which sample queries find ``RECALL`` of their true
neighbours.  So well clustered vectors look at few leaves and shapeless ones
at many.

Defined results: vectors that are NULL, empty, zero, or hold a NULL, NaN or
infinity take no part, nor do vectors whose length is not the most frequent
one (ties: the shorter); rows without an id take no part; rows of equal id
and vector count once, an id with several vectors may be found for each; fewer
candidates than wanted are all returned if their leaves are visited (with one
leaf always); an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package

SAMPLE = 20_000
TREES = 8
LEAF_ROWS = 256
SHARD_ROWS = 65536  # rows of a shard; the larger, the fewer answers a query gets to merge
RECALL = 0.95
RECALL_INSIDE = 0.98  # of a grown leaf's own neighbours
CALIBRATION_QUERIES = 200
DEEPEST = 10  # at most 1024 leaves a tree: 20 sample vectors each; the shards grow them further
SEED = 20


@dataclass
class Forest:
    depth: int
    norm2: float
    directions: np.ndarray  # (trees, nodes, dimensions + 1)
    cuts: np.ndarray  # (trees, nodes)
    visits: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Index vectors with the component that evens out their norms."""
        rest = np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def route(self, lifted: np.ndarray, tree: int) -> np.ndarray:
        """Leaf of every vector."""
        node = np.zeros(len(lifted), np.int64)
        for _ in range(self.depth):
            right = np.einsum("ij,ij->i", lifted, self.directions[tree, node]) >= self.cuts[tree, node]
            node = 2 * node + 1 + right
        return node - (self.leaves - 1)

    def search(self, queries: np.ndarray, visits: int | None = None) -> Iterator[list[tuple[int, int]]]:
        """Per query the (tree, leaf) pairs to look at, best first."""
        visits = visits or self.visits
        lifted = np.concatenate([queries, np.zeros((len(queries), 1))], 1)
        inner = self.leaves - 1
        # (query, tree, node): signed margins.
        margins = np.einsum("qd,tnd->qtn", lifted, self.directions, optimize=True) - self.cuts[None]
        for row in margins:
            queue = [(0.0, t, 0) for t in range(len(self.cuts))]
            out: list[tuple[int, int]] = []
            while queue and len(out) < visits:
                far, tree, node = heapq.heappop(queue)
                margin = row[tree]
                while node < inner:
                    m = float(margin[node])
                    near, other = (2 * node + 2, 2 * node + 1) if m >= 0 else (2 * node + 1, 2 * node + 2)
                    heapq.heappush(queue, (far + m * m, tree, other))
                    node = near
                out.append((tree, node - inner))
            yield out


def fit(sample: np.ndarray, n_rows: int, norm2: float, k: int, seed: int = SEED, trees: int = TREES, recall: float = RECALL,
        leaf_rows: int = LEAF_ROWS, deepest: int = DEEPEST) -> Forest:
    """Forest and calibrated number of leaves to visit."""
    rng = np.random.default_rng(seed)
    wanted = max(1, -(-n_rows // leaf_rows))
    depth = min((wanted - 1).bit_length(), deepest, max(0, (len(sample) // 8).bit_length() - 1))
    nodes, dims = (1 << depth) - 1, sample.shape[1] + 1
    f = Forest(depth, norm2, np.zeros((trees, nodes, dims)), np.zeros((trees, nodes)), trees << depth)
    lifted = f.lift(sample)
    for t in range(trees):
        at = np.zeros(len(lifted), np.int64)
        for node in range(nodes):
            members = np.flatnonzero(at == node)
            if len(members) >= 2:
                a, b = rng.choice(members, 2, replace=False)
                d = lifted[a] - lifted[b]
            else:
                d = rng.standard_normal(dims)
            length = np.linalg.norm(d)
            d = d / length if length > 0 else d
            p = lifted[members] @ d
            cut = float(np.median(p)) if len(p) else 0.0
            f.directions[t, node], f.cuts[t, node] = d, cut
            at[members] = 2 * node + 1 + (p >= cut)
    f.visits = _calibrated(f, sample, lifted, k, rng, recall)
    return f


def _calibrated(f: Forest, sample: np.ndarray, lifted: np.ndarray, k: int, rng: np.random.Generator, recall: float) -> int:
    trees = len(f.cuts)
    everything = trees * f.leaves
    if len(sample) <= k + 1 or f.depth == 0:
        return everything
    picked = rng.choice(len(sample), min(CALIBRATION_QUERIES, len(sample)), replace=False)
    products = sample[picked] @ sample.T
    products[np.arange(len(picked)), picked] = -np.inf
    best = np.argpartition(-products, k, axis=1)[:, :k]
    leaf = np.stack([f.route(lifted, t) + t * f.leaves for t in range(trees)], 1)
    needed = []
    for i, order in enumerate(f.search(sample[picked], everything)):
        place = np.empty(everything, np.int64)
        place[[t * f.leaves + leaf_ for t, leaf_ in order]] = np.arange(everything)
        needed.append(place[leaf[best[i]]].min(1) + 1)
    return int(np.quantile(np.concatenate(needed), recall, method="higher"))


def usable(vector: Column) -> Column:
    """Not NULL, not empty, all components finite, one of them not 0."""
    v = F.coalesce(vector.cast("array<double>"), F.array().cast("array<double>"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return finite & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    """Vectors, stored as the bytes of the column's own number type, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype("<f8")


def _distinct(dims: int, k: int, kind: str):
    """Per task: each distinct vector with its smallest k + 1 ids, and, for
    queries, nothing is lost as they are read apart."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in it:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims) + 0
            for vec_id, v in zip(batch.column(0).to_pylist(), x, strict=True):
                ids = seen.setdefault(v.tobytes(), [])
                ids.append(vec_id)
                if len(ids) > 8 * (k + 1):
                    seen[v.tobytes()] = sorted(set(ids))[: k + 1]
            if len(seen) > 50_000:
                yield from flush(seen)
                seen = {}
        yield from flush(seen)

    def flush(seen: dict[bytes, list[int]]) -> Iterator[pa.RecordBatch]:
        items = list(seen.items())
        for i in range(0, len(items), 10_000):
            part = items[i : i + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, _ in part], pa.binary()), pa.array([sorted(set(ids))[: k + 1] for _, ids in part], pa.list_(pa.int64()))],
                names=["vector", "ids"])

    return run


class _Best:
    """The best entries of every query, by falling score and rising smallest id."""

    def __init__(self, n: int, keep: int):
        self.score = np.full((n, keep), -np.inf)
        self.least = np.full((n, keep), np.iinfo(np.int64).max)
        self.place = np.full((n, keep), -1, np.int64)

    def merge(self, rows: np.ndarray, at: np.ndarray, place: np.ndarray, score: np.ndarray, least: np.ndarray) -> None:
        """New candidates: number ``at`` of ``rows``, and where the entry is."""
        keep = self.score.shape[1]
        old = np.repeat(np.arange(len(rows)), keep)
        at, score = np.concatenate([old, at]), np.concatenate([self.score[rows].ravel(), score])
        least, place = np.concatenate([self.least[rows].ravel(), least]), np.concatenate([self.place[rows].ravel(), place])
        order = np.lexsort((least, -score, at))
        at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        order = order[rank < keep].reshape(len(rows), keep)
        self.score[rows], self.least[rows], self.place[rows] = score[order], least[order], place[order]


def _grown(x: np.ndarray, members: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, leaf_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A large leaf as smaller ones, with the queries that visit each."""
    rows = x[members]
    f = fit(rows, len(rows), float((rows * rows).sum(1).max()), k, trees=1, recall=RECALL_INSIDE, leaf_rows=leaf_rows)
    leaf = f.route(f.lift(rows), 0)
    visits: list[list[int]] = [[] for _ in range(f.leaves)]
    for part in range(0, len(own), 1024):
        for i, order in zip(own[part : part + 1024].tolist(), f.search(q[own[part : part + 1024]]), strict=True):
            for _, where in order:
                visits[where].append(i)
    for where, queries in enumerate(visits):
        if queries:
            yield members[leaf == where], np.array(queries)


def _in_shard(dims: int, k: int, kind: str, leaf_rows: int):
    """Best k + 1 entries of a shard's leaves for each query that visits them."""

    def run(_key: tuple, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "entry": [], "least": [], "score": []}).astype(
            {"query": "int64", "entry": "int64", "least": "int64", "score": "float64"})
        if not len(entries) or not len(queries):
            return empty
        x = np.frombuffer(b"".join(entries["vector"]), kind).reshape(-1, dims).astype("<f8")
        q = np.frombuffer(b"".join(queries["vector"]), kind).reshape(-1, dims).astype("<f8")
        leaf, least = entries["leaf"].to_numpy(), entries["least"].to_numpy()
        longest, asked_length = np.sqrt((x * x).sum(1).max()), np.sqrt((q * q).sum(1))
        visited = queries["leaves"].to_numpy()
        who = np.repeat(np.arange(len(q)), [len(v) for v in visited])
        where = np.concatenate(visited)
        best = _Best(len(q), k + 1)
        by_leaf = np.argsort(leaf, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(leaf[by_leaf]) != 0])
        for members in np.split(by_leaf, starts[1:]):
            own = who[where == leaf[members[0]]]
            if not len(own):
                continue
            units = _grown(x, members, q, own, k, leaf_rows) if len(members) > 4 * leaf_rows else [(members, own)]
            for rows_of, asking in units:
                block = max(1, (1 << 18) // len(rows_of))
                for part in range(0, len(asking), block):
                    rows = asking[part : part + block]
                    s = q[rows] @ x[rows_of].T
                    both = np.concatenate([best.score[rows], s], 1)
                    cut = -np.partition(-both, k, axis=1)[:, k]
                    # Products of a block are off by a few roundings.
                    at, column = np.nonzero(s >= (cut - 4 * dims * np.finfo(float).eps * longest * asked_length[rows])[:, None])
                    place = rows_of[column]
                    best.merge(rows, at, place, (q[rows[at]] * x[place]).sum(1) + 0.0, least[place])
        a, b = np.nonzero(best.place >= 0)
        place = best.place[a, b]
        return pd.DataFrame({"query": queries["query"].to_numpy()[a], "entry": entries["entry"].to_numpy()[place], "least": least[place],
                             "score": best.score[a, b]})

    return run


def nearest(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding", leaf_rows: int = LEAF_ROWS, deepest: int = DEEPEST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row
    among all rows but its own id."""
    ship_package(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    # Floats are kept as floats where they are stored or moved.
    kind = "<f4" if rows.schema[vector_column].dataType.simpleString() == "array<float>" else "<f8"
    v = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"), is_query.alias("q"))
    v = v.where(F.col("id").isNotNull() & usable(F.col("v")))
    common = v.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common["d"]
    v = v.where(F.size("v") == dims)

    # Distinct vectors, combined in the tasks first: hot vectors shrink there.
    grouped = v.select("id", "v").mapInArrow(_distinct(dims, k, kind), "vector binary, ids array<long>").groupBy("vector").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    entries = materialize(spark, grouped.select(F.monotonically_increasing_id().alias("entry"), "vector", "ids"), "ann-entries")
    asked = v.where(F.coalesce("q", F.lit(False))).select("id", _as_bytes(F.col("v"), kind).alias("vector")).distinct()
    queries = materialize(spark, asked.join(entries.select("entry", "vector"), "vector").select("id", "entry"), "ann-queries")

    norms = entries.select("vector").mapInArrow(_norms(dims, kind), "norm2 double")
    stats = norms.agg(F.count("*").alias("n"), F.max("norm2").alias("m")).first()
    chosen = entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toArrow()  # bounded
    forest = fit(_matrix(chosen["vector"], dims, kind), stats["n"], stats["m"], k, leaf_rows=leaf_rows, deepest=deepest)
    shared = spark.sparkContext.broadcast(forest)  # bounded by TREES, DEEPEST and the dimension
    per_shard = max(1, shard_rows * forest.leaves // max(1, stats["n"]))
    shares = max(1, -(-stats["n"] // (forest.leaves * shard_rows)))  # of a leaf above shard_rows

    def route(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in it:
            lifted = f.lift(_matrix(batch.column(1), dims, kind))
            for t in range(TREES):
                leaf = f.route(lifted, t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_shard(t, leaf, per_shard, f.leaves)), pa.array(leaf), *batch.columns],
                    names=["shard", "leaf", "entry", "vector", "least"])

    def visit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in it:
            for part in range(0, batch.num_rows, 256):
                b = batch.slice(part, 256)
                out: list[tuple[int, list[int], int, bytes]] = []
                for number, vector, order in zip(
                        b.column(0).to_pylist(), b.column(1).to_pylist(), f.search(_matrix(b.column(1), dims, kind)), strict=True):
                    by_shard: dict[int, list[int]] = {}
                    for t, leaf in order:
                        by_shard.setdefault(int(_shard(t, leaf, per_shard, f.leaves)), []).append(leaf)
                    out += [(s, leaves, number, vector) for s, leaves in by_shard.items()]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.int64()),
                     pa.array(columns[3], pa.binary())], names=["shard", "leaves", "query", "vector"])

    index = entries.select("entry", "vector", F.col("ids")[0].alias("least")).mapInArrow(
        route, "shard long, leaf long, entry long, vector binary, least long").withColumn(
        "share", F.pmod(F.xxhash64("entry"), F.lit(shares)))
    distinct_queries = entries.join(queries.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")
    asked_leaves = distinct_queries.mapInArrow(visit, "shard long, leaves array<long>, query long, vector binary").withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<long>")))
    hits = index.groupBy("shard", "share").cogroup(asked_leaves.groupBy("shard", "share")).applyInPandas(
        _in_shard(dims, k, kind, leaf_rows), "query long, entry long, least long, score double")

    # One entry can be found in several trees, each time with the same score.
    few = hits.groupBy("query").agg(F.slice(F.sort_array(F.collect_set(F.struct(
        (-F.col("score")).alias("low"), "least", "entry"))), 1, k + 1).alias("h"))
    pairs = few.select("query", F.explode("h").alias("h")).select("query", F.col("h.low").alias("low"), F.col("h.entry").alias("entry"))
    best = pairs.join(entries.select("entry", "ids"), "entry").groupBy("query").agg(F.sort_array(F.collect_list(F.struct(
        F.col("low").alias("least"), F.col("ids")))).alias("best"))
    answers = best.select("query", F.slice(F.array_sort(F.flatten(F.transform(
        F.slice("best", 1, k + 1), lambda b: F.transform(b["ids"], lambda i: F.struct(b["least"].alias("least"), i.alias("id")))))),
        1, k + 1).alias("best"))
    out = queries.join(answers, queries["entry"] == answers["query"]).select(
        F.col("id").alias("query_id"),
        F.posexplode(F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k)).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"),
                      (-F.col("hit.least")).alias("score"))


def _shard(tree, leaf, per_shard: int, leaves: int):
    return tree * (-(-leaves // per_shard)) + leaf // per_shard


def _as_bytes(v: Column, kind: str) -> Column:
    """The same bytes that ``_distinct`` makes."""

    @F.pandas_udf("binary")
    def pack(s: pd.Series) -> pd.Series:
        return s.map(lambda x: (np.asarray(x).astype(kind) + 0).tobytes())

    return pack(v)


def _norms(dims: int, kind: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = _matrix(batch.column(0), dims, kind)
            yield pa.RecordBatch.from_arrays([pa.array((x * x).sum(1))], names=["norm2"])

    return run
