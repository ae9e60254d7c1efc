"""Small tables with every odd case, and plain versions to compare with."""

import collections
import re

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
TABLES = "documents embeddings benchmark labels conversations".split()

# Columns whose names the operators use inside.
CLASHING = ("node", "size", "key", "found", "row_id", "score", "n", "bucket", "n_words", "kept", "component_id", "taken", "_text", "_t", "id")

BASE = "the quick brown fox jumps over the lazy dog while seven wizards mix potions in a deep dark cave near the sea"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def odd_rows():
    """(doc_id, text, lang, source, n_chars)"""
    texts = [
        (1, BASE), (2, BASE), (2, BASE), (3, BASE.replace("cave", "cove")), (4, BASE.upper()), (5, None), (6, ""), (7, " \t\n "),
        (None, BASE + " again and again"), (None, None), (8, "one two three"), (9, "ONE two  three"), (10, LONG), (11, LONG + " tail"),
        (12, "línea única\nlínea única\nπρώτα 🙂 final"), (5, "other text of the same id with a few more words than before"),
    ]
    out = []
    for k, (i, t) in enumerate(texts):
        out.append((i, t, [None, "en", "fr"][k % 3], [None, "a", "b", "a"][k % 4], None if t is None else len(t)))
    return out


def odd_docs(spark, rows=None):
    from pyspark.sql import functions as F

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    d = spark.createDataFrame(odd_rows() if rows is None else rows, schema)
    return d.withColumns({c: F.lit("x") for c in CLASHING})


def empty_docs(spark):
    return odd_docs(spark, [])


def duck(sf=SF):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def same_rows(df, relation):
    """Multisets of rows, by column name."""
    a, b = df.toPandas(), relation.df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    count = lambda x: collections.Counter(x[cols].astype(str).itertuples(index=False, name=None))
    assert count(a) == count(b)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(rows):
    """Brute force for (id, text) rows: sorted (id, set size, component)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str)
