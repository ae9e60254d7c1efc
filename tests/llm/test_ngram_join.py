import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from carelens.llm import ngram_join as J
from carelens.llm.components import connected_components

from .helpers import SF, components, empty_docs, odd_docs, odd_rows


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_odd_rows(spark):
    assert got(J.jaccard_components(spark, odd_docs(spark))) == components([(i, t) for i, t, *_ in odd_rows()])


def test_empty_table(spark):
    assert got(J.jaccard_components(spark, empty_docs(spark))) == []


def test_whole_table_against_brute_force(spark):
    from carelens.llm.queries import op2_ngram_join

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op2_ngram_join(spark, SF)) == components(rows)


def near_copies(seed, groups, copies, length=40, edits=4):
    """Chains of edited copies: many pairs close to the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        text = [f"g{g}w{rng.randrange(1000)}" for _ in range(length)]
        for _ in range(copies):
            t = list(rng.choice(rows[-1:])[1].split()) if rows and rng.random() < 0.3 and rows[-1][1].startswith(f"g{g}") else list(text)
            for _ in range(rng.randrange(edits)):
                t[rng.randrange(length)] = f"g{g}w{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("segment", [1024, 8])
def test_near_copies_also_over_segments(spark, monkeypatch, segment):
    """Blocks of one segment, and blocks cut into many segments."""
    monkeypatch.setattr(J, "SEGMENT", segment)
    # Workers get the function by reference: the segment size is a driver matter.
    rows = near_copies(segment, groups=3, copies=40)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(J.jaccard_components(spark, df)) == components(rows)


def test_threshold_is_inclusive(spark):
    w = [f"w{i}" for i in range(11)]  # 7 shingles; dropping the last word leaves 6
    rows = [(1, " ".join(w)), (2, " ".join(w[:-1])), (3, " ".join(w[:-2]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(J.jaccard_components(spark, df)) == components(rows)


def test_pieces_do_not_change_hashes(monkeypatch):
    data = ("ab Cd \n" * 50 + "x" * 700 + " end").encode()
    with np.errstate(over="ignore"):
        whole = J.word_hashes(data)
        monkeypatch.setattr(J, "PIECE_BYTES", 16)
        parts = J.word_hashes(data)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    assert len(set(whole[1].tolist())) == 4


def test_a_common_passage_links_nothing(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, passage + " " + " ".join(f"d{i}t{k}" for k in range(40))) for i in range(60)]
    assert got(J.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == components(rows)


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(20)] + [(500, i) for i in range(501, 600)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    named = {x for a, b in edges if a != b for x in (a, b)}
    found = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in found) == sorted((x, find(x)) for x in named)


def test_a_task_packs_in_bounded_memory(monkeypatch):
    """Many shingles, some in several texts: none is lost, what is copied beside them and one batch stay small."""
    monkeypatch.setattr(J, "FLUSH_TOKENS", 1_000_000)
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 1500))) for _ in range(640)]
    texts += [" ".join(t.split()[:900]) for t in texts[:40]]
    sets = {J._node(s): s for s in J.shingle_sets([t.encode() for t in texts])}
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    out, largest = [], 0
    for b in J._deal(16)(iter([batch])):
        largest = max(largest, b.nbytes)
        out.append(b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    rows = pa.Table.from_batches(out).to_pandas()
    holders = Counter(h for s in sets.values() for h in s.tolist())
    once, sure = rows[~rows.direct], rows[rows.direct]
    assert sorted(np.concatenate([np.frombuffer(x, "<u8") for x in once["hashes"]]).tolist()) == sorted(holders)
    node, size, h = J._unpack(sure)
    assert Counter(zip(node.tolist(), h.tolist(), strict=True)) == Counter(
        (n, x) for n, s in sets.items() for x in s.tolist() if holders[x] > 1)
    assert all(len(sets[n]) == k for n, k in zip(node.tolist(), size.tolist(), strict=True))
    assert all((J._by_node(np.frombuffer(r.nodes, "<i8"), 16) == r.bucket).all() for r in sure.itertuples())
    assert all((J._bucket(np.frombuffer(r.hashes, "<u8"), 16) == r.bucket).all() for r in once.itertuples())
    assert largest < 12 * J.PART_TOKENS and peak < 80 * J.FLUSH_TOKENS
