import math
import random
import re
from collections import Counter, defaultdict

import pytest

from carelens.llm import lexical as L

from .helpers import CLASHING, SF, duck, empty_docs, odd_docs, odd_rows, same_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(size for _, _, size in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c, size in counts:
            m = 25 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in plain_terms(text) if t in c)
            if s > 0:
                scored.append((-s, doc_id is None, doc_id or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def items_frame(spark, items):
    from pyspark.sql import functions as F

    return spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in (*CLASHING, "query", "term", "rank", "doc_id")})


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def test_terms_and_counts():
    for text in ("", "  ", "a", "B-b_c9", "é1 é", "\x00x\x7fY~Z", "naïve ÉCOLE 12,5 中文字 x🙂y", None):
        raw = (text or "").encode()
        assert [t.decode() for t in L.terms(raw)] == plain_terms(text) and L.n_terms(raw) == len(plain_terms(text))


@pytest.mark.parametrize("shard_terms,blocks,first", [(L.SHARD_TERMS, 256, 256), (300, 3, 1), (40, 1, 5)])
def test_against_all_scores(spark, shard_terms, blocks, first):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary[: rng.randint(2, 60)]) for _ in range(n))
    # Repeated texts give ties, within and across shards.
    docs = [(i, text(rng.choice([1, 3, 3, 8, 20, 60]))) for i in range(300)] + [(1000 + i, "w1 w2 w3 w3") for i in range(30)]
    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(50, "w1 w3"), (50, "w1 w3"), (51, ""), (52, None), (53, "unknown"), (None, "w2 W2")]
    frame = odd_docs(spark, [(i, t, None, None, None) for i, t in docs]).repartition(5)
    index = L.build_index(spark, frame, shard_terms=shard_terms)
    assert got(L.search(spark, index, items_frame(spark, items), k=7, block_queries=blocks, first_docs=first)) == brute(docs, items, 7)


def test_odd_rows(spark):
    items = [(1, "The quick brown fox"), (2, "línea"), (3, "w5x5 w6x6 tail"), (4, "one"), (5, "over other text")]
    index = L.build_index(spark, odd_docs(spark))
    assert got(L.search(spark, index, items_frame(spark, items))) == brute([(i, t) for i, t, *_ in odd_rows()], items, 10)


def test_empty(spark):
    items = items_frame(spark, [(1, "a")])
    assert L.search(spark, L.build_index(spark, empty_docs(spark)), items).count() == 0
    assert L.search(spark, L.build_index(spark, odd_docs(spark)), items.where("false")).count() == 0


def test_strata_are_left_out_by_their_bounds():
    held = [Counter({b"rare": 5, b"common": 1})] * 20 + [Counter({b"common": 1, b"pad": 40 + i}) for i in range(400)]
    lengths = [sum(c.values()) for c in held]
    builder = L._Builder(len(held), sum(lengths))
    for i, c in enumerate(held):
        builder.add(i, lengths[i], c)
    rows = [r for b in builder.rows("s") for r in b.to_pylist()]
    shard = L._Shard(rows[0]["groups"], rows[0]["postings"])
    for r in rows[1:]:
        shard.add(r["term"], r["groups"], r["postings"], L.weight(len(held), r["df"]))
    docs, _, seen = shard.best([(b"rare", 1), (b"common", 1)], 10, first_docs=32)
    assert sorted(shard.ids[docs].tolist()) == list(range(10)) and seen < len(shard.m) / 2


def test_index_has_every_term(spark):
    docs = [(i, t) for i, t, *_ in odd_rows()]
    index = L.build_index(spark, odd_docs(spark), shard_terms=50)
    df = defaultdict(int)
    for r in index.table.where("term IS NOT NULL").select("term", "df").collect():
        df[r.term.decode()] += r.df
    assert df == Counter(t for _, text in docs for t in set(plain_terms(text)))


def test_query_against_sql(spark):
    from carelens.llm.queries import ORACLE_SQL, op12_lexical_search

    same_rows(op12_lexical_search(spark, SF), duck().sql(ORACLE_SQL["op12_lexical_search"]))
