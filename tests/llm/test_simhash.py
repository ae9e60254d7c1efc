import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from carelens.llm import simhash as S

from .helpers import LONG, empty_docs, odd_docs, odd_rows, words

SF = "/root/testdata/sf0.001"


def plain_print(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Class number of each fingerprint by comparing all."""
    distinct = sorted(set(prints))
    up = {p: p for p in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    a = np.array(distinct, np.uint64)
    for i, p in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= 4).tolist():
            x, y = find(p), find(distinct[j])
            up[max(x, y)] = min(x, y)
    return {p: find(p) for p in distinct}


def whole(rows):
    prints = [plain_print(t) for _, t in rows]
    classes = plain_classes(prints)
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[classes[p]].append(i)
    return sorted(((i, f"{p:016x}", min(least[classes[p]], default=None)) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def neighbourhood(rng, n, spread):
    """Fingerprints scattered over a few centres."""
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 40))]
    out = set()
    while len(out) < n:
        p = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            p ^= 1 << rng.randrange(64)
        out.add(p)
    return sorted(out)


def test_counters_against_popcount():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 640, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 12, 640)]
    y = x ^ np.array(flips, np.uint64)
    for radius in range(8):
        found = S._places(S.within(S.planes(x, 0), S.planes(y, 0), radius))
        assert found.tolist() == np.flatnonzero(np.bitwise_count(x ^ y) <= radius).tolist()


def test_bands_meet_every_pair_in_reach():
    rng = random.Random(5)
    for n in (10, 5_000_000, 10**9, 10**11, 10**13):
        tables = S.bands(n)
        assert len({t for t, _ in tables}) == len(tables)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 4):
                b ^= 1 << bit
            assert any(a & sum(m) == b & sum(m) for _, m in tables)


@pytest.mark.parametrize("segment", [S.SEGMENT, 50])
def test_links_connect_what_all_pairs_connect(spark, segment):
    rng = random.Random(11)
    # One very dense bucket besides scattered ones.
    dense = {0x0123456789ABCDEF ^ (1 << i) ^ (1 << j) for i in range(40, 64) for j in range(40, i)}
    prints = sorted(set(neighbourhood(rng, 800, 9)) | dense)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    found = S.links(spark, spark.createDataFrame([(p,) for p in signed], "fp long"), segment).collect()
    up = {p: p for p in signed}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for r in found:
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4
        x, y = find(r.a), find(r.b)
        up[max(x, y)] = min(x, y)
    classes = plain_classes(prints)
    groups = defaultdict(set)
    for p, s in zip(prints, signed, strict=True):
        groups[classes[p]].add(find(s))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({find(s) for s in signed})
    # Not all pairs are written: at most a spanning set per table.
    if segment == S.SEGMENT:
        assert len(found) <= len(prints) * 5


def test_odd_rows(spark):
    got = S.simhash_components(spark, odd_docs(spark))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == whole([(i, t) for i, t, *_ in odd_rows()])


def test_empty(spark):
    assert S.simhash_components(spark, empty_docs(spark)).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "BATCH", 1000)
    assert S.fingerprint(LONG.encode()) == plain_print(LONG)


def test_whole_query(spark):
    from carelens.llm.queries import op11_simhash

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, op11_simhash(spark, SF).collect()), key=str) == whole(rows)
