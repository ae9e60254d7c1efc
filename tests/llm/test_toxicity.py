import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from carelens.llm import toxicity as T

from .helpers import empty_docs, odd_docs, odd_rows


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("label", F.lit("x"))


def corpus(spark, n=160):
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join(f"plain{(i * 7 + k) % 50}" for k in range(30)) + (" you awful villain" if bad else " my dear friend"), "en", "a", 1))
    return odd_docs(spark, rows + [(1000 + (i or 0), t, lang, s, c) for i, t, lang, s, c in odd_rows()]), labels(
        spark, [(i, 1, int(i % 4 == 0)) for i in range(n)] + [(1, 1, None), (None, 1, 1), (99_999, 1, 1), (4, 0, 0)])


def test_learns_from_its_fold_only(spark):
    docs, known = corpus(spark)
    model = T.fit(spark, docs, known)
    fold = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    assert model.index.ids and not any(fold(i) for i in model.index.ids)
    # Other labels in the held-out fold change nothing.
    flipped = known.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = T.fit(spark, docs, flipped)
    assert other.index.ids == model.index.ids and np.array_equal(other.rates, model.rates)
    out = T.score(spark, docs, model).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 160:
            assert (r.score >= T.THRESHOLD) == (r.doc_id % 4 == 0)
            assert r.neighbours and all(x.label == (r.doc_id % 4 == 0) for x in r.neighbours[:3]) and r.terms
    bare = {r.score for r in out if r.doc_id in (1005, 1006, 1007)}
    assert len(bare) <= 2 and model.no_neighbours in bare


def test_scores_depend_on_the_text_alone(spark):
    docs, known = corpus(spark)
    model = T.fit(spark, docs, known)
    other = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("z"), "doc_id": F.col("doc_id") + 7})
    a = {r.doc_id: r.score for r in T.score(spark, docs, model, evidence=False).where("doc_id is not null").collect()}
    b = {r.doc_id - 7: r.score for r in T.score(spark, other, model, evidence=False).where("doc_id is not null").collect()}
    assert a == b


def test_empty_tables_and_one_class(spark):
    docs, known = corpus(spark, 20)
    for lab in (known.limit(0), known.where("toxic = 0")):
        model = T.fit(spark, docs, lab)
        assert model is None and {r.score for r in T.score(spark, docs, model).collect()} == {0.0}
    model = T.fit(spark, docs, known)
    assert T.score(spark, empty_docs(spark), model).collect() == []
    assert T.fit(spark, empty_docs(spark), known) is None


def test_every_significant_term_is_indexed(spark):
    telling = [f"w{k}" for k in range(2500)]
    rows = [(i, " ".join(telling) if i % 2 else "plain and friendly", "en", "a", 1) for i in range(120)]
    model = T.fit(spark, odd_docs(spark, rows), labels(spark, [(i, 1, i % 2) for i in range(120)]))
    assert set(telling) <= set(model.index.terms)


def test_the_sample_has_one_row_of_an_id(spark):
    """Rows that share an id do not swell the sample; which is taken depends on texts alone."""
    docs, known = corpus(spark, 40)
    hot = odd_docs(spark, [(8, f"another text {k}", "en", "a", 1) for k in range(300)])
    rows = T.examples(docs.unionByName(hot), known).collect()
    assert len(rows) == len({(r.role, r.doc_id) for r in rows})
    again = T.examples(hot.repartition(7).unionByName(docs), known).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_block_max_search_is_exact():
    """Against all cosines, with ties, over many blocks."""
    rng = np.random.default_rng(2)
    terms = {f"t{i}": i for i in range(40)}
    rows = [Counter(rng.choice(40, rng.integers(1, 6)).tolist()) for _ in range(700)]
    idf = rng.uniform(1, 4, 40)
    blank = T.Index(terms, idf, [], np.zeros(0), [])
    vectors = [dict(zip(*(x.tolist() for x in blank.vector(r)), strict=True)) for r in rows]
    postings = [(np.array([n for n, v in enumerate(vectors) if t in v], np.int64), np.array([v[t] for v in vectors if t in v])) for t in range(40)]
    index = T.Index(terms, idf, list(range(700)), np.zeros(700), postings)
    for r in rows[:60]:
        at, w = index.vector(r)
        q = dict(zip(at.tolist(), w.tolist(), strict=True))
        cosines = [(-round(sum(x * q.get(t, 0) for t, x in v.items()), 12), n) for n, v in enumerate(vectors)]
        want = [(-s, n) for s, n in sorted(c for c in cosines if c[0] < 0)[:15]]
        got = index.nearest(at, w)
        assert [n for _, n in got] == [n for _, n in want]
        assert all(math.isclose(a, b, abs_tol=1e-9) for (a, _), (b, _) in zip(got, want, strict=True))


def test_held_out_accuracy(spark):
    from carelens.llm.queries import op7_toxicity

    sf = "/root/testdata/sf0.1"
    out = op7_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").collect()
    hits = Counter((r.toxic, r.predicted) for r in out)
    assert hits[1, 1] / (hits[1, 1] + hits[1, 0]) > 0.88
    assert hits[1, 1] / (hits[1, 1] + hits[0, 1]) > 0.95


def test_a_rare_word_decides(spark):
    """A word that four toxic examples hold and no other document."""
    plain = " ".join(f"plain{k}" for k in range(12))
    rows = [(i, f"{plain} {'awful villain' if i % 2 else 'dear friend'}" + (" grobian" if i in (1, 5, 11, 13) else ""), "en", "a", 1) for i in range(600)]
    known = [(i, 1, i % 2) for i in range(600)]
    docs = odd_docs(spark, rows + [(5001, "Grobian!", "en", "a", 1), (5002, "plain3", "en", "a", 1)])
    model = T.fit(spark, docs, labels(spark, known))
    assert "grobian" in model.index.terms
    out = {r.doc_id: r for r in T.score(spark, docs, model).collect()}
    held = [i for i in (1, 5, 11, 13) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert held and sorted(x.doc_id for x in out[5001].neighbours) == held and out[5001].score >= T.THRESHOLD
    assert "plain3" not in model.index.terms and not out[5002].neighbours  # a stop word


def test_search_is_exact_over_rare_words():
    """Against all cosines, where most terms are in few blocks and weigh little; also queries of such terms alone."""
    rng = np.random.default_rng(5)
    terms = {f"t{i}": i for i in range(900)}
    idf = np.where(np.arange(900) < 30, rng.uniform(1, 4, 900), rng.uniform(0.02, 0.5, 900))
    rows = [Counter([*rng.choice(30, rng.integers(0, 4)).tolist(), *rng.integers(30, 900, rng.integers(1, 25)).tolist()]) for _ in range(900)]
    blank = T.Index(terms, idf, [], np.zeros(0), [])
    plain = [dict(zip(*(x.tolist() for x in blank.vector(r)), strict=True)) for r in rows]
    postings = [(np.array([n for n, v in enumerate(plain) if t in v], np.int64), np.array([v[t] for v in plain if t in v])) for t in range(900)]
    index = T.Index(terms, idf, list(range(900)), np.zeros(900), postings)
    only = [Counter({t: n for t, n in r.items() if t >= 30}) for r in rows[:20]]
    for i, r in enumerate([*rows[:40], *only, Counter({899: 1})]):
        but = i if i < 40 else -1
        at, w = index.vector(r)
        q = dict(zip(at.tolist(), w.tolist(), strict=True))
        cosines = [(-round(sum(x * q.get(t, 0) for t, x in v.items()), 12), n) for n, v in enumerate(plain) if n != but]
        want = [(-s, n) for s, n in sorted(c for c in cosines if c[0] < 0)[:15]]
        got = index.nearest(at, w, but=but)
        assert [n for _, n in got] == [n for _, n in want]
        assert all(math.isclose(a, b, abs_tol=1e-9) for (a, _), (b, _) in zip(got, want, strict=True))


ODD_TEXTS = ["", " ", "a", "A_b-c d\x1ce\x1ff", "Éa b c　d", "KK xİY", "don’t naïve ²½ १", "été กิ \U0001d400\U0001f600z",
             "你好，世界", "àà à", "tab\there\nnl\x85next line", "x" * 300 + "—" + "x" * 300]


def test_words_are_those_of_the_pattern():
    for text in [*ODD_TEXTS, " ".join(ODD_TEXTS), "".join(map(chr, [*range(0xD800), *range(0xE000, 0x3000 + 0xE000)]))]:
        assert T.word_counts(text) == Counter(T._WORD.findall(text.lower()))


def test_counts_against_all_parts_of_every_word():
    """Terms of all kinds; one that is a word, a marked piece and a stem at once counts once a word."""
    words = ["villainous", "villa", "vil", "illai", "an", "^vill", "sane", "ansée", "villainous"]
    kinds = [*words, *(p for w in words for p in T.pieces(w)), *(x for w in words for x in T.stems(w)), "^vil>4", "^vill>64", "^san>8"]
    terms = {t: i for i, t in enumerate(sorted(set(kinds)))}
    counts = T.Counts(terms)
    assert len(counts.pieces) + len(counts.stems) < 2 * len(terms)
    for text in ["Villainous VILLA vil villa", "an ansée sane sane " * 3, "insane " * 40 + "villain vil", *ODD_TEXTS]:
        found = T._WORD.findall(text.lower())
        want: Counter = Counter()
        often: Counter = Counter()
        for w in found:
            want.update(terms[t] for t in {*T.pieces(w), *T.stems(w)} if t in terms)
            often.update(T.stems(w))
        want.update(terms[f"{s}>{n}"] for s, n in T.levels(often, len(found)) if f"{s}>{n}" in terms)
        for _ in range(2):  # also from what is remembered
            assert counts(text) == want


def test_a_search_of_most_blocks_reads_postings_once(monkeypatch):
    """Examples that are all alike leave nothing to prune: no posting is read more often than in the first blocks and once more."""
    terms = {f"t{i}": i for i in range(30)}
    n = 40 * T.BLOCK
    weights = np.full(n, 30**-0.5)
    index = T.Index(terms, np.ones(30), list(range(n)), np.zeros(n), [(np.arange(n), weights)] * 30)
    read = []
    ranges = T._ranges
    monkeypatch.setattr(T, "_ranges", lambda first, end, value: read.append(len(first)) or ranges(first, end, value))
    got = index.nearest(*index.vector(Counter(range(30))))
    assert [x for _, x in got] == list(range(T.NEIGHBOURS))
    # Terms for the bounds, runs of the first blocks, then terms again and not all runs.
    assert read == [30, 30 * T.FIRST_BLOCKS, 30]


def test_term_names_are_taken_as_one_column():
    import numpy as np
    import pyarrow as pa

    names = pa.array(["a", "b", "c"])
    numbers = [np.array([2, 0]), np.zeros(0, np.int64), np.array([1])]
    assert T._named(names, numbers).to_pylist() == [["c", "a"], [], ["b"]]
    assert T._named(names, []).type == pa.list_(pa.string()) and len(T._named(names, [])) == 0
