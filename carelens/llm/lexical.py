"""Ranked lexical search over a length-stratified inverted index.

A document of n terms scores w * (10^9 tf div (1000 tf + 8 m)) for a query
term it holds tf times, m = 25 + (75 n N) div L.  The score depends on the
document only through m and the tfs, so documents of equal m form a stratum.

Index: N and L are counted first (bytes only, no words are built).  Then a
task cuts its documents into shards of a bounded number of terms, numbers a
shard's documents stratum by stratum, and writes one row per shard and term:
groups (stratum, tf, number of documents) and the documents of each group, so
a frequent term is spread over all shards.  A further row per shard (no term)
holds its documents' ids and its strata.  The index is a table; it holds all
terms and serves any queries.

Search: queries are dealt into blocks, their terms joined with the index, and
a task gets one shard's postings of one block's terms.  An impact is computed
once per (term, stratum, tf) group.  For each query the best impacts of its
terms bound every stratum; strata are visited in falling order of bounds, in
rounds that double, until the next bound is below the k-th best score found;
strata of equal bound are visited, so ties stay exact.  A shard answers with
its best k per query; the answers are ranked once more.

Defined results: NULL and empty texts have no term and are not counted in N;
a document without id is ranked after all others of its score; repeated rows
are documents of their own; every query row is answered on its own, repeated
ones too, and one without terms, like an empty table, gives no row; other
columns are ignored.
"""

from __future__ import annotations

import math
import struct
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package

SHARD_TERMS = 4_000_000  # terms (with repeats) of a shard, but for one longer document
SHARD_DOCS = 65_535  # so that 2 bytes number them
BLOCK_QUERIES = 256
FIRST_DOCS = 256  # documents of the strata visited first
NO_ID = np.iinfo(np.int64).max

_TERM_BYTES = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalnum() or b >= 0x80)
# Bytes of terms, A-Z lower-cased, all others blank: every byte of a
# character beyond ASCII belongs to a term.
_FOLD = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if b in _TERM_BYTES else 32 for b in range(256))
_IS_TERM = np.array([b in _TERM_BYTES for b in range(256)])


def terms(text: bytes) -> list[bytes]:
    """Terms of UTF-8 bytes, in order."""
    return text.translate(_FOLD).split()


def n_terms(text: bytes) -> int:
    """Their number, without building them."""
    inside = _IS_TERM[np.frombuffer(text, np.uint8)]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum()) if len(text) else 0


def normaliser(n: int, docs: int, total: int) -> int:
    return 100 - 75 + (75 * n * docs) // total


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass
class Index:
    docs: int  # N
    terms: int  # L
    table: DataFrame  # shard, term, df, groups, postings


def _counts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = total = 0
    for batch in it:
        for t in batch.column(0).to_pylist():
            n = n_terms(t or b"")
            docs, total = docs + (n > 0), total + n
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([total])], names=["docs", "terms"])


INDEX_SCHEMA = "shard string, term binary, df long, groups binary, postings binary"


def _index_shards(docs: int, total: int, shard_terms: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        shard = _Builder(docs, total)
        for batch in it:
            for doc_id, t in zip(batch.column(0), batch.column(1), strict=True):
                counts = Counter(terms(t.as_py() or b""))
                if not counts:
                    continue
                n = counts.total()
                if shard.ids and (shard.size + n > shard_terms or len(shard.ids) >= SHARD_DOCS):
                    yield from shard.rows(f"{task}-{made}")
                    shard, made = _Builder(docs, total), made + 1
                shard.add(doc_id.as_py(), n, counts)
        if shard.ids:
            yield from shard.rows(f"{task}-{made}")

    return run


class _Builder:
    """A shard being filled: flat arrays of 4 bytes a value, no objects."""

    def __init__(self, docs: int, total: int):
        self.docs, self.total, self.size = docs, total, 0
        self.ids: list[int | None] = []
        self.m = array("q")
        self.number: dict[bytes, int] = {}
        self.term, self.tf, self.distinct = array("i"), array("i"), array("i")

    def add(self, doc_id: int | None, n: int, counts: Counter) -> None:
        number = self.number
        self.ids.append(doc_id)
        self.m.append(normaliser(n, self.docs, self.total))
        self.term.extend([number.setdefault(w, len(number)) for w in counts])
        self.tf.extend(counts.values())
        self.distinct.append(len(counts))
        self.size += n

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        m = np.frombuffer(self.m, np.int64)
        order = np.argsort(m, kind="stable")
        strata, stratum = np.unique(m[order], return_inverse=True)
        place = np.empty(len(order), np.uint16)  # a shard has at most 2^16 - 1 documents
        place[order] = np.arange(len(order))
        doc = np.repeat(place, np.frombuffer(self.distinct, np.int32))
        t, tf = np.frombuffer(self.term, np.int32), np.frombuffer(self.tf, np.int32)
        s = stratum.astype(np.uint16)[doc]
        by = np.lexsort((doc, -tf, s, t))
        t, tf, s, doc = t[by], tf[by], s[by], doc[by]
        del by
        new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (s[1:] != s[:-1]) | (tf[1:] != tf[:-1])])
        tf_kind = next(k for k in ("<u1", "<u2", "<u4") if int(tf.max()) < 1 << 8 * int(k[2]))
        groups = s[new].astype("<u2"), tf[new].astype(tf_kind), np.diff(np.r_[new, len(t)]).astype("<u2")
        first_doc = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        first_group = np.searchsorted(new, first_doc)
        doc_ends, group_ends = np.r_[first_doc[1:], len(t)].tolist(), np.r_[first_group[1:], len(new)].tolist()
        first_doc, first_group = first_doc.tolist(), first_group.tolist()
        ids = [self.ids[at] for at in order.tolist()]
        head = (struct.pack("<qqq", len(ids), len(strata), int(tf_kind[2])) + strata.astype("<i8").tobytes() +
                np.bincount(stratum).astype("<i8").tobytes())
        body = np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes() + np.array([i is None for i in ids], np.uint8).tobytes()
        schema = pa.schema([("shard", pa.string()), ("term", pa.binary()), ("df", pa.int64()), ("groups", pa.binary()), ("postings", pa.binary())])
        yield pa.RecordBatch.from_pylist([{"shard": name, "term": None, "df": 0, "groups": head, "postings": body}], schema)
        words = list(self.number)
        for at in range(0, len(words), 10_000):
            part = range(at, min(at + 10_000, len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(part)), pa.array([words[i] for i in part], pa.binary()), pa.array([doc_ends[i] - first_doc[i] for i in part]),
                 pa.array([b"".join(g[first_group[i] : group_ends[i]].tobytes() for g in groups) for i in part], pa.binary()),
                 pa.array([doc[first_doc[i] : doc_ends[i]].tobytes() for i in part], pa.binary())], schema=schema)


def build_index(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                shard_terms: int = SHARD_TERMS) -> Index:
    """The index of all documents, written under the checkpoint folder."""
    ship_package(spark)
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").cast("binary").alias("t"))
    counted = read.select("t").mapInArrow(_counts, "docs long, terms long").agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first()
    n, total = counted["docs"], counted["terms"]
    table = read.mapInArrow(_index_shards(n, max(total, 1), shard_terms), INDEX_SCHEMA)
    return Index(n, total, materialize(spark, table, "lexical-index"))


def _query_terms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = [(q, w, n) for q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
               for w, n in Counter(terms(t or b"")).items()]
        q, w, n = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(w, pa.binary()), pa.array(n, pa.int64())], names=["query", "term", "times"])


class _Shard:
    """One shard's postings of the terms asked for, with impacts."""

    def __init__(self, head: bytes, body: bytes):
        n_docs, n_strata, self.tf_bytes = struct.unpack("<qqq", head[:24])
        self.m = np.frombuffer(head, "<i8", n_strata, 24)
        self.sizes = np.frombuffer(head, "<i8", n_strata, 24 + 8 * n_strata)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = np.frombuffer(body, "<i8", n_docs)
        self.no_id = np.frombuffer(body, np.uint8, n_docs, 8 * n_docs).astype(bool)
        self.postings: dict[bytes, tuple] = {}

    def add(self, term: bytes, groups: bytes, postings: bytes, w: int) -> None:
        n = len(groups) // (4 + self.tf_bytes)
        s, count = np.frombuffer(groups, "<u2", n), np.frombuffer(groups, "<u2", n, len(groups) - 2 * n).astype(np.int64)
        tf = np.frombuffer(groups, f"<u{self.tf_bytes}", n, 2 * n).astype(np.int64)
        worth = w * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.m[s]))  # once per group
        first = np.flatnonzero(np.r_[True, np.diff(s) != 0])  # of each stratum: its largest tf
        at = np.cumsum(count) - count
        begin = np.full(len(self.m), -1)
        begin[s[first]] = at[first]
        end = np.full(len(self.m), -1)
        end[s[first]] = np.r_[at[first][1:], len(postings) // 2]
        best = np.zeros(len(self.m), np.int64)
        best[s[first]] = worth[first]
        self.postings[term] = (np.frombuffer(postings, "<u2"), np.repeat(worth, count), begin, end, best)

    def best(self, wanted: list[tuple[bytes, int]], k: int, first_docs: int = FIRST_DOCS) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the k best, and the number of strata seen."""
        held = [(self.postings[t], n) for t, n in wanted if t in self.postings]
        bound = np.zeros(len(self.m), np.int64)
        for (_, _, _, _, best), n in held:
            bound += n * best
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        upto = np.cumsum(self.sizes[order])
        score = np.zeros(len(self.ids), np.int64)
        docs, least = np.zeros(0, np.int64), 0
        at, want = 0, first_docs
        while at < len(order) and bound[order[at]] >= max(least, 1):
            stop = max(at + 1, int(np.searchsorted(upto, want)))
            stop = min(stop, int(np.searchsorted(-bound[order], -max(least, 1), side="right")))
            seen = order[at:stop]
            for (doc, worth, begin, end, _), n in held:
                b, e = begin[seen], end[seen]
                size = e - b
                if len(seen) == 1:
                    rows = slice(int(b[0]), int(e[0])) if b[0] >= 0 else slice(0, 0)
                else:
                    some = size > 0
                    b, size = b[some], size[some]
                    rows = np.repeat(b - (np.cumsum(size) - size), size) + np.arange(size.sum())
                score[doc[rows]] += n * worth[rows]  # a document once per term
            starts, sizes = self.starts[seen], self.sizes[seen]
            new = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            docs = np.concatenate([docs, new[score[new] > 0]])
            if len(docs) > k:
                docs = docs[np.lexsort((self.ids[docs], self.no_id[docs], -score[docs]))[:k]]
                least = int(score[docs[-1]])
            elif len(docs) == k:
                least = int(score[docs].min())
            at, want = stop, 2 * int(upto[stop - 1])
        docs = docs[np.lexsort((self.ids[docs], self.no_id[docs], -score[docs]))]
        return docs, score[docs], at


def _search_shard(n_docs: int, k: int, first_docs: int):
    def run(_key: tuple, rows: pa.Table) -> pa.Table:
        cols = {c: rows.column(c).to_pylist() for c in ("term", "df", "groups", "postings", "asked")}
        head = next(i for i, t in enumerate(cols["term"]) if t is None)
        shard = _Shard(cols["groups"][head], cols["postings"][head])
        wanted: dict[int, list[tuple[bytes, int]]] = {}
        for i, t in enumerate(cols["term"]):
            if t is None:
                continue
            w = weight(n_docs, cols["df"][i])
            if w == 0:
                continue
            shard.add(t, cols["groups"][i], cols["postings"][i], w)
            for a in cols["asked"][i]:
                wanted.setdefault(a["query"], []).append((t, a["times"]))
        out: list[list] = [[], [], [], []]
        for query, ts in wanted.items():
            docs, scores, _ = shard.best(ts, k, first_docs)
            out[0] += [query] * len(docs)
            out[1] += [None if none else i for i, none in zip(shard.ids[docs].tolist(), shard.no_id[docs].tolist(), strict=True)]
            out[2] += scores.tolist()
        return pa.table({"query": pa.array(out[0], pa.int64()), "doc_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    return run


def search(spark: SparkSession, index: Index, queries: DataFrame, k: int = 10, id_column: str = "item_id", text_column: str = "text",
           block_queries: int = BLOCK_QUERIES, first_docs: int = FIRST_DOCS) -> DataFrame:
    """(id, rank, doc_id, score): the k best documents of every query row."""
    ship_package(spark)
    asked = queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_column).alias("item"),
                           F.col(text_column).cast("string").cast("binary").alias("t"))
    asked = materialize(spark, asked, "lexical-queries")
    blocks = max(1, -(-asked.count() // block_queries))
    wanted = asked.select("query", "t").mapInArrow(_query_terms, "query long, term binary, times long").groupBy(
        F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "term").agg(
        F.collect_list(F.struct("query", "times")).alias("asked"))  # at most a block's queries
    wanted = materialize(spark, wanted, "lexical-terms")
    # Postings of the terms asked for, with the number of documents that hold
    # them; joined on the term, whichever side is small enough to send around.
    vocabulary = wanted.select("term").distinct()
    df = index.table.where("term IS NOT NULL").select("term", "df").join(vocabulary, "term").groupBy("term").agg(F.sum("df").alias("df"))
    df = wanted.join(df, "term")
    held = index.table.where("term IS NOT NULL").drop("df").join(df, "term").select("shard", "block", "term", "df", "groups", "postings", "asked")
    heads = index.table.where("term IS NULL").select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "term", "df", "groups", "postings",
        F.lit(None).cast(wanted.schema["asked"].dataType).alias("asked"))
    found = held.unionByName(heads).groupBy("shard", "block").applyInArrow(
        _search_shard(index.docs, k, first_docs), "query long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "item"), "query").select(F.col("item").alias(id_column), F.col("rank").cast("int"), "doc_id", "score")
