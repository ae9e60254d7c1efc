"""Every stage against a plain version, and on odd rows and empty tables."""

from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from carelens.llm import mixing, secret_scan, toxicity

from .helpers import SF, components, empty_docs, odd_docs, odd_rows
from .test_sql_operators import SECRETS, all_spans

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return Counter(tuple(r) for r in df.select(*DOCUMENT).collect())


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "n-gram Jaccard join", "secret scans", "mixing sources to target weights", "packing"]


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_odd_rows_and_empty_tables(spark, name, stage):
    docs = odd_docs(spark)
    out = stage(spark, docs, SF)
    if name != "packing":
        assert out.columns == docs.columns
    out.collect()
    assert stage(spark, empty_docs(spark), SF).collect() == []


def test_toxicity_drops_what_scores_high(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(spark, docs, spark.read.parquet(f"{sf}/labels.parquet"))
    high = {r.doc_id for r in toxicity.score(spark, docs, model, evidence=False).collect() if r.score >= 0.3}
    kept = {r.doc_id for r in P.drop_toxic(spark, docs, sf).collect()}
    assert high and kept == {r.doc_id for r in docs.collect()} - high


def test_one_document_of_each_component_stays(spark):
    out = rows(P.drop_near_copies(spark, odd_docs(spark), SF))
    source = odd_rows()
    assert not out - Counter(source)
    # Rows without words, and one row of every component, by brute force on
    # row numbers.
    found = components([(k, t) for k, (_, t, *_) in enumerate(source)])
    assert out.total() == len({c for _, _, c in found}) - sum(n == 0 for _, n, _ in found) + len(
        {(source[k][0], source[k][1] or "") for k, n, _ in found if n == 0})
    texts = Counter(t for _, t, *_ in out.elements())
    assert sum(1 for t in texts if t and "quick brown" in t) == 2  # one word apart: 13 of 23 shingles


def masked(text):
    done, parts = 0, []
    for a, _, b in all_spans(text):
        if a >= done:
            parts += [text[done:a], "[REDACTED]"]
        done = max(done, b)
    return "".join(parts) + text[done:] if parts else text


def test_secrets_are_masked_and_documents_stay(spark):
    source = [(i, t, "en", "a", len(t)) for i, t in enumerate(SECRETS)] + odd_rows()
    out = rows(P.mask_secrets(spark, odd_docs(spark, source), SF))
    want = Counter()
    for i, t, lang, s, n in source:
        m = masked(t) if t else t
        want[(i, m, lang, s, n if m == t else len(m))] += 1
    assert out == want
    # What stood in a base span is gone from that document's text.
    for i, t, *_ in source:
        left = " ".join(m or "" for j, m, *_ in out if j == i)
        for a, k, b in all_spans(t or ""):
            if secret_scan.KINDS[k].base and (t or "").count(t[a:b]) == 1 and sum(j == i for j, *_ in source) == 1:
                assert t[a:b] not in left


def test_of_equal_rows_the_first_by_all_columns_stays(spark):
    text = "one two three four five six seven eight"
    same = [(1, text, lang, source, n) for lang, source, n in ((None, "b", 3), ("en", None, 4), ("de", "a", 5), ("de", "a", 5))]
    docs = odd_docs(spark, same + [(2, "other words entirely here now", "en", "a", 1)])
    first = None
    for df in (docs, docs.orderBy("n_chars"), docs.orderBy(F.desc("n_chars")).repartition(4)):
        out = sorted(map(str, P.drop_near_copies(spark, df, SF).select(*DOCUMENT).collect()))
        assert len(out) == 2
        first = first or out
        assert out == first


def test_mixing_repeats_as_the_mix_takes(spark):
    docs = odd_docs(spark)
    taken = Counter()
    for r in mixing.fair_queue(spark, docs).collect():
        taken[r.doc_id, r.source] += r.copies
    out = P.mix_sources(spark, docs, SF)
    assert Counter((r.doc_id, r.source) for r in out.collect()) == +taken


def test_whole_run_by_brute_force(spark):
    """The five stages one after the other by plain means: which documents
    stay, their masked texts, how often the mix takes them, and their ids."""
    import hashlib
    import zlib

    import duckdb
    import numpy as np
    import pandas as pd
    import public_tokenizers
    from tokenizers import Tokenizer

    from carelens.llm import sql

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(spark, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = {(r.doc_id, r.text): r.score for r in toxicity.score(spark, docs, model, carry=("doc_id", "text"), evidence=False).collect()}
    table = [tuple(r) for r in docs.select(*DOCUMENT).collect() if score[r.doc_id, r.text] < toxicity.THRESHOLD]
    assert 0 < len(table) < docs.count()
    # One row of each component: the smallest (id, digest), by row numbers.
    order = sorted(range(len(table)), key=lambda k: (table[k][0], hashlib.md5((table[k][1] or "").encode()).hexdigest(), str(table[k])))
    least, kept = set(), []
    component = {k: c for k, _, c in components([(n, table[k][1]) for n, k in enumerate(order)])}
    for n, k in enumerate(order):
        if component[n] == n or not (table[k][1] or "").split():
            if (table[k][0], table[k][1] or "") not in least:
                least.add((table[k][0], table[k][1] or ""))
                kept.append(table[k])
    kept = [(i, masked(t) if t else t, *rest) for i, t, *rest in kept]
    c = duckdb.connect()
    c.register("documents", pd.DataFrame(kept, columns=DOCUMENT))
    copies = {i: taken // size for i, size, _, _, taken in c.sql(sql.mixing()).select("doc_id, size, source_size, target, taken").fetchall() if taken}
    encoder = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    want = Counter()
    for i, t, *_ in kept:
        if copies.get(i):
            ids = np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            want[i, len(ids)] += copies[i]
            score[i] = ids
    out = P.run(spark, SF).collect()
    pieces, used = Counter(), Counter()
    for r in out:
        assert zlib.crc32(score[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id, r.doc_tokens] += r.length
        used[r.sequence_id] += r.length
    assert pieces == Counter({(i, n): n * k for (i, n), k in want.items()})
    assert all(n == 2048 or n & (n - 1) == 0 for n in used.values())
