from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.llm import neighbours as N

from .helpers import CLASHING

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).withColumns({c: F.lit("x") for c in CLASHING})


def exact(rows, queries, k):
    """Brute force: distinct (id, vector) candidates other than the query's id."""
    pool = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, v in queries:
        best = sorted((-float(np.dot(np.array(x, "f4").astype("f8"), np.array(v, "f4").astype("f8"))), i) for i, x in pool if i != q)
        out[q] = [(i, -s) for s, i in best[:k]]
    return out


def got(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def test_query_recall_and_order(spark):
    from carelens.llm.queries import op1_neighbours

    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], "f8")
    ids = np.array([i for i, _ in rows])
    found = got(op1_neighbours(spark, sf))
    assert sorted(found) == sorted(int(i) for i in ids if i % 20 == 0)
    at = {int(i): k for k, i in enumerate(ids)}
    hits = []
    for q, answer in found.items():
        s = x @ x[at[q]]
        s[at[q]] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits.append(len(best & {i for i, _ in answer}) / 20)
        assert len(answer) == 20 and answer == sorted(answer, key=lambda a: (-a[1], a[0]))
        assert all(abs(score - s[at[i]]) < 1e-12 for i, score in answer)
    assert np.mean(hits) >= 0.9


def test_odd_vectors_take_no_part(spark):
    good = [(i, [float(i % 5) + 1, float(i % 3), -1.0]) for i in range(0, 60)]
    odd = [(100, None, 1), (120, [], 1), (140, [0.0, 0.0, 0.0], 1), (160, [1.0, None, 1.0], 1), (180, [float("nan"), 1.0, 1.0], 1),
           (200, [float("inf"), 1.0, 1.0], 1), (220, [1.0, 2.0], 1), (None, [1.0, 1.0, 1.0], 1)]
    df = frame(spark, [(i, v, 1) for i, v in good] + odd + [(0, good[0][1], None)])
    found = got(N.nearest(spark, df, F.col("vec_id") % 20 == 0, k=20))
    want = exact(good, [(i, v) for i, v in good if i % 20 == 0], 20)
    assert sorted(found) == sorted(want)
    for q in want:  # ties in abundance: equal vectors, smaller ids first
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in want[q]])


def test_few_candidates_and_empty_table(spark):
    df = frame(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (2, [-1.0, 0.0], 1)])
    assert got(N.nearest(spark, df, F.col("vec_id") == 0, k=20)) == {0: [(1, 0.5), (2, -1.0)]}
    assert got(N.nearest(spark, df.where("vec_id = 0"), F.lit(True), k=20)) == {}
    assert N.nearest(spark, df.limit(0), F.lit(True)).collect() == []


def test_a_hot_vector_and_unequal_norms(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)]
    rows += [(1000 + i, (rng.standard_normal(4) * rng.uniform(0.1, 9)).astype("f4").tolist()) for i in range(700)]
    df = frame(spark, [(i, v, 1) for i, v in rows]).repartition(6)
    found = got(N.nearest(spark, df, F.col("vec_id") % 100 == 0, k=20))
    want = exact(rows, [(i, v) for i, v in rows if i % 100 == 0], 20)
    assert sorted(found) == sorted(want)
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    # Equal vectors: the smallest ids, in order, after what is nearer.
    hot = [i for i, s in found[0] if s == 30.0 and i < 1000]
    assert len(found[0]) == 20 and hot == list(range(1, len(hot) + 1))


def test_unequal_vectors_of_one_score_go_by_id(spark):
    rows = [(0, [1.0, 0.0])] + [(j, [1.0, float(j)]) for j in range(1, 101)]
    df = frame(spark, [(i, v, 1) for i, v in rows]).orderBy(F.desc("vec_id"))
    found = got(N.nearest(spark, df, F.col("vec_id") == 0, k=20))
    assert found[0] == [(j, 1.0) for j in range(1, 21)]


def test_ties_that_a_product_of_blocks_could_round_apart(spark):
    # Components of many magnitudes, permuted: equal sets of summands.
    rng = np.random.default_rng(4)
    v = (rng.standard_normal(8) * 10.0 ** rng.integers(-3, 4, 8)).tolist()
    rows = [(0, [1.0] * 16)] + [(j, ([0.0] * (j % 9)) + v + [0.0] * (8 - j % 9)) for j in range(1, 200)] + [
        (500 + j, [*v, *([float(j)] * 4), *([-float(j)] * 4)]) for j in range(60)]
    found = got(N.nearest(spark, frame(spark, [(i, v, 1) for i, v in rows]), F.col("vec_id") == 0, k=20))
    want = exact(rows, rows[:1], 20)
    score = {i: float((np.ones((1, 16)) * np.array([v], "f4").astype("f8")).sum(1)[0]) for i, v in rows}
    assert [i for i, _ in found[0]] == [i for _, i in sorted((-score[i], i) for i in score if i)][:20]
    assert len(want[0]) == 20


def test_leaves_are_grown_and_shared_beyond_the_sample(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 8)) * 4
    x = (centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 8))).astype("f4")
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], SCHEMA).repartition(6)
    # Two levels of the forest only: leaves of 1500 rows, dealt to four shards
    # of 400 and grown there to leaves of some 50.
    found = got(N.nearest(spark, df, F.col("vec_id") % 100 == 0, k=20, leaf_rows=50, deepest=2, shard_rows=400))
    assert len(found) == 60
    hits = []
    for q, answer in found.items():
        s = x.astype("f8") @ x[q].astype("f8")
        s[q] = -np.inf
        hits.append(len(set(np.argsort(-s)[:20].tolist()) & {i for i, _ in answer}) / 20)
    assert np.mean(hits) >= 0.9


def test_search_visits_leaves_in_order_of_margins():
    rng = np.random.default_rng(0)
    sample = rng.standard_normal((600, 5))
    f = N.fit(sample, 50_000, float((sample**2).sum(1).max()), 20)
    q = sample[:3]
    for query, order in zip(q, f.search(q, N.TREES * f.leaves), strict=True):
        assert len(order) == len(set(order)) == N.TREES * f.leaves
        lifted = np.r_[query, 0.0]
        far = []
        for tree, leaf in order:  # squared margins on the wrong side, root to leaf
            node, total = leaf + f.leaves - 1, 0.0
            while node:
                parent = (node - 1) // 2
                m = f.directions[tree, parent] @ lifted - f.cuts[tree, parent]
                total += m * m if (m >= 0) != (node == 2 * parent + 2) else 0.0
                node = parent
            far.append(total)
        assert far == pytest.approx(sorted(far))
