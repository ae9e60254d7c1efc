"""Quality classifier: interpolated modified Kneser-Ney character model.

The model is trained on trusted text (documents labelled as good), all of it.
Its alphabet is open: every code point is a symbol, and a boundary.  An n-gram
is its context (up to ORDER - 1 symbols of 21 bits, a long) and its last symbol.

Counting: every task counts the n-grams of its documents piece by piece, and
the counts are summed by n-gram.  Continuation counts (how many different
symbols stand before an n-gram), the discounts D1, D2, D3+ of every order (from
its counts of counts) and the interpolation weights of every context come from
groupings of those tables, and a join of the n-gram counts with their contexts,
sharded by context, gives each n-gram's discounted share.  All of them stay
distributed tables that grow with the text.

Folds: trusted texts fall into two folds by their hash (copies into the same).
Every table holds the counts of all trusted text and those of either fold side
by side, so that one set of groupings and joins gives three models: one of all,
and for each fold one that has not seen it.

Scoring: the different n-grams of all documents are joined with the shares and
weights of every order, which gives each its log-probabilities.  Up to
``SHARED_GRAMS`` n-grams, by count, these are sent to all tasks, and documents
are scored where they are read.  Beyond, documents go by chunks: a chunk's
n-grams, and which of its texts hold each how often, are packed by shard of the
n-grams and meet the shard's log-probabilities in a cogroup; a text's score is
the sum over shards.  Shards hold about ``SHARD_GRAMS`` n-grams, and chunks are
dealt to as many groups as keep a shard's packed n-grams near ``GROUP_CHARS``
characters' worth, so that neither grows with the input.  Equal texts of a
chunk are scored once; scores come back to documents by a digest of the text.

Thresholds: the perplexities of trusted documents, each by the model that has
not seen its fold, give per language a mergeable histogram over log-perplexity.
A document is kept if its perplexity lies between its language's low and high
quantiles; a trusted one by the perplexity that went into the histogram, any
other by the model of all.  Languages with too few trusted documents use the
histogram of all.

Defined results: empty or NULL text has NULL perplexity and is not kept; a
NULL language uses the thresholds of all; without trusted text nothing is
scored (NULL) and every text that is not empty is kept; repeated rows are scored one by one;
label rows of one document count once, and it is trusted only if all agree;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import materialize, ship_package, text_or_empty

BITS = 21
ALPHABET = 1 << BITS  # symbols: 0 the boundary, 1 unused, code points from 2 on
ORDER = 4
LOW, HIGH = 0.002, 0.995
LEAST_TRUSTED = 50  # documents a language needs for its own thresholds
STEP = 1000  # histogram steps per unit of log-perplexity
CHUNK_CHARS = 1_000_000
DENSE = 1 << 24  # places of a table by code, beyond which codes are sorted instead
CHUNK_TEXTS = 65_536  # their numbers fit 16 bits
SHARD_GRAMS = 250_000
LEAST_SHARDS = 16
GROUP_CHARS = 20_000_000
SHARED_GRAMS = 2_000_000  # 40 bytes each in a task, 80 MB
FOLDS = 2
VIEWS = (0, 1, 2)  # all trusted text, and what is left without fold 0 or 1
MASK_BITS = 1 << 26  # of a filter on ids, 8 MB


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, each preceded by boundaries, and where each
    text's characters end among those of all."""
    codes = [_codes(t) for t in texts]
    gap = np.zeros(ORDER - 1, np.int64)
    return np.concatenate([x for c in codes for x in (gap, c.astype(np.int64) + 2)]), np.cumsum([len(c) for c in codes])


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol, text number, n) of the n-grams of order ORDER ending
    at each character, in the order of the n-grams."""
    s, ends = _symbols(texts)
    names, local = np.unique(s, return_inverse=True)
    size = np.diff(ends, prepend=0)
    first = np.repeat(np.arange(len(texts)) * (ORDER - 1), size) + np.arange(ends[-1])  # of each n-gram
    bits, text_bits = int(len(names) - 1).bit_length(), int(len(texts) - 1).bit_length()
    wide = ORDER * bits + text_bits > 63
    key = np.zeros(len(first), np.int64)
    for k in range(ORDER):
        key = (key << bits) | local[first + k]
        if wide:  # number the beginnings that occur, fewer than characters
            heads, key = np.unique(key, return_inverse=True)
            table = np.concatenate([table[heads >> bits], names[heads & ((1 << bits) - 1), None]], axis=1) if k else names[heads, None]
    key = (key << text_bits) | np.repeat(np.arange(len(texts)), size)
    key, n = np.unique(key, return_counts=True)
    text, key = key & ((1 << text_bits) - 1), key >> text_bits
    parts = table[key].T if wide else [names[(key >> bits * (ORDER - 1 - k)) & ((1 << bits) - 1)] for k in range(ORDER)]
    context = np.zeros(len(key), np.int64)
    for part in parts[:-1]:
        context = (context << BITS) | part
    return context, parts[-1], text, n


def _numbered(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different codes below ``size``, in order, and each code's number."""
    if size > DENSE:
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    different = np.flatnonzero(there)
    number = np.empty(size, np.int32)
    number[different] = np.arange(len(different), dtype=np.int32)
    return different, number[codes]


def _indexed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol) of the different n-grams, in order, the number of
    the n-gram that ends at each character, and where each text's characters
    end.  Codes are numbered again after every symbol, so they stay small
    whatever the alphabet."""
    s, ends = _symbols(texts)
    names, local = _numbered(s, ALPHABET)
    bits = int(len(names) - 1).bit_length()
    first = np.repeat(np.arange(len(texts)) * (ORDER - 1), np.diff(ends, prepend=0)) + np.arange(ends[-1])
    key, table = np.zeros(len(first), np.int64), np.zeros((1, 0), np.int64)
    for k in range(ORDER):
        codes, key = _numbered((key.astype(np.int64) << bits) | local[first + k], len(table) << bits)
        table = np.concatenate([table[codes >> bits], names[codes & ((1 << bits) - 1), None]], axis=1)
    context = np.zeros(len(table), np.int64)
    for part in table.T[:-1]:
        context = (context << BITS) | part
    return context, table[:, -1], key, ends


def _counted_at_once(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, symbol, n) of the n-grams of all texts together."""
    context, symbol, key, _ = _indexed(texts)
    return context, symbol, np.bincount(key, minlength=len(context))


def _chunks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Texts that are not empty, and the values of a second column, some at a time."""
    texts, keys, size = [], [], 0
    for batch in it:
        for x, k in zip(batch.column(0), batch.column(batch.num_columns - 1), strict=True):
            t = x.as_py()
            if t:
                texts.append(t)
                keys.append(k.as_py())
                size += len(t)
            if size >= CHUNK_CHARS or len(texts) == CHUNK_TEXTS:
                yield texts, keys
                texts, keys, size = [], [], 0
    if texts:
        yield texts, keys


N = tuple(f"n{v}" for v in VIEWS)


def _count_grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-grams of (text, fold): counted in all views but that of the own fold."""
    for texts, folds in _chunks(it):
        for fold in sorted(set(folds)):
            context, symbol, n = _counted_at_once([t for t, f in zip(texts, folds, strict=True) if f == fold])
            counts = [n if v == 0 or v - 1 != fold else np.zeros_like(n) for v in VIEWS]
            for k in range(0, len(n), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 100_000]) for x in (context, symbol, *counts)], names=["context", "symbol", *N])


COUNTED = "context long, symbol long, " + ", ".join(f"{n} long" for n in N)


def fold_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def count_grams(texts: DataFrame) -> DataFrame:
    """context, symbol and, per view, n of every n-gram of the one column of texts."""
    return texts.select(F.col(texts.columns[0]), fold_of(F.col(texts.columns[0])).alias("fold")).mapInArrow(
        _count_grams, COUNTED).groupBy("context", "symbol").agg(*[F.sum(n).alias(n) for n in N])


def _ask_grams(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, _ in _chunks(it):
        context, symbol, n = _counted_at_once(texts)
        for k in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 100_000]) for x in (context, symbol, n)], names=["context", "symbol", "n"])


def ask_grams(texts: DataFrame) -> DataFrame:
    """context, symbol and n of every n-gram of the one column of texts."""
    return texts.mapInArrow(_ask_grams, "context long, symbol long, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> list[tuple[float, float, float]]:
    """Modified Kneser-Ney discounts per view, from the counts of counts 1 to 4."""
    row = counts.agg(*[F.count(F.when(F.col(n) == k, 1)).alias(f"{n}_{k}") for n in N for k in (1, 2, 3, 4)]).first()
    out = []
    for n in N:
        n1, n2, n3, n4 = (max(int(row[f"{n}_{k}"]), 1) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        out.append(tuple(min(max(k - (k + 1) * y * b / a, 0.05), k - 0.05) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))))
    return out


def _order_tables(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(context, symbol, shares) and (context, weights) of one order, an array
    by view each: the discounted share of each n-gram in its context, and what
    the context leaves to the order below (everything, where a view has not
    seen it)."""
    cut = {n: F.when(F.col(n) == 0, 0.0).when(F.col(n) == 1, d1).when(F.col(n) == 2, d2).otherwise(d3)
           for n, (d1, d2, d3) in zip(N, discounts(counts), strict=True)}
    contexts = counts.groupBy("context").agg(
        *[F.sum(n).alias(f"total_{n}") for n in N], *[F.sum(cut[n]).alias(f"left_{n}") for n in N])
    over = lambda x, n: F.when(F.col(f"total_{n}") > 0, x / F.col(f"total_{n}"))
    shares = counts.join(contexts, "context").select(
        "context", "symbol", F.array(*[F.coalesce(over(F.col(n) - cut[n], n), F.lit(0.0)) for n in N]).alias("shares"))
    return shares, contexts.select("context", F.array(*[F.coalesce(over(F.col(f"left_{n}"), n), F.lit(1.0)) for n in N]).alias("weights"))


def _shorter(order: int):
    """The context of an n-gram of ``order``, from a longer one."""
    return F.col("context").bitwiseAND((1 << BITS * (order - 1)) - 1).alias("context")


@dataclass
class Model:
    """Per order from 1, the distributed tables (context, symbol, shares) and
    (context, weights), arrays by view."""

    tables: list[tuple[DataFrame, DataFrame]]
    alphabet = range(0x110000)

    def probabilities(self, grams: DataFrame) -> DataFrame:
        """context, symbol and log_p = ln p(symbol | context), by view, of
        different n-grams."""
        p = None
        of = lambda c, v, least: F.coalesce(F.col(c)[v], F.lit(least))
        for order, (shares, weights) in enumerate(self.tables, 1):
            asked = grams.select("context", "symbol") if order == ORDER else grams.select(_shorter(order), "symbol").distinct()
            if order == 1:  # one context
                only = weights.first()["weights"]
                lower = asked.withColumns({"p": F.array(*[F.lit(1.0 / ALPHABET)] * len(VIEWS)), "weights": F.array(*map(F.lit, only))})
            else:
                # An n-gram backs off to its last order - 1 symbols.
                below = p.select(F.col("context").alias("_below"), F.col("symbol"), "p")
                lower = asked.withColumn("_below", _shorter(order - 1)).join(below, ["_below", "symbol"]).drop("_below").join(weights, "context", "left")
            p = lower.join(shares, ["context", "symbol"], "left").select(
                "context", "symbol", F.array(*[of("weights", v, 1.0) * F.col("p")[v] + of("shares", v, 0.0) for v in VIEWS]).alias("p"))
        return p.select("context", "symbol", F.transform("p", lambda x: F.log(F.greatest(x, F.lit(1e-12)))).alias("log_p"))

    def log_probabilities(self) -> Lookup:
        """ln p of any n-gram by the model of all, for a look into small
        models: collects them."""
        return Lookup([({r["context"]: r["weights"][0] for r in w.collect()}, _by_context(s.collect())) for s, w in self.tables])


def _by_context(rows: list) -> dict[int, dict[int, float]]:
    out: dict[int, dict[int, float]] = {}
    for r in rows:
        out.setdefault(r["context"], {})[r["symbol"]] = r["shares"][0]
    return out


class Lookup:
    """ln p by n-gram number (ORDER symbols of BITS bits), or by a slice of
    the numbers of one context."""

    def __init__(self, tables: list[tuple[dict[int, float], dict[int, dict[int, float]]]]):
        self.tables = tables

    def __getitem__(self, at):
        context = int(at.start if isinstance(at, slice) else at) >> BITS
        p = np.full(ALPHABET, 1.0 / ALPHABET) if isinstance(at, slice) else 1.0 / ALPHABET
        for order, (weights, shares) in enumerate(self.tables, 1):
            own = context & ((1 << BITS * (order - 1)) - 1)
            p = p * weights.get(own, 1.0)
            seen = shares.get(own, {})
            if isinstance(at, slice):
                p[list(seen)] += list(seen.values())
            else:
                p += seen.get(int(at) & (ALPHABET - 1), 0.0)
        return np.log(p)


def _trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where(F.col("q") == 1).select(
        F.col("doc_id").cast("long").alias("doc_id"))


def _slot(column: str = "doc_id") -> Column:
    return F.pmod(F.xxhash64(column), F.lit(MASK_BITS))


def _mask(ids: DataFrame) -> np.ndarray:
    """Bits of the hashes of the ids: MASK_BITS of them, whatever their number."""
    slot = _slot() + 1  # buckets count from 1
    rows = ids.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()
    size = MASK_BITS // 8
    out = bytearray(size)
    for r in rows:  # MASK_BITS / 32768 rows of 4 KB at most
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] = r["bits"][: size - at]
    return np.frombuffer(bytes(out), np.uint8)


def _in_mask(spark: SparkSession, ids: DataFrame):
    shared = spark.sparkContext.broadcast(_mask(ids))  # MASK_BITS

    @F.pandas_udf("boolean")
    def held(slot: pd.Series) -> pd.Series:
        at = slot.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7) & 1).astype(bool))

    return held(_slot())


def trusted_documents(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and text of the documents labelled as good, whose texts stay
    where they are read.

    Two filters of fixed size decide by hash: all good ids are in the first,
    and all ids that are in the first without being good are in the second
    (they are found by a join of ids alone).  So a document in the first and not
    in the second is good; the few in both are joined, text and all."""
    spark, good = docs.sparkSession, _trusted_ids(labels)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text")).where((F.col("text") != "") & F.col("doc_id").isNotNull())
    first = _in_mask(spark, good)
    mistaken = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).where(first).join(good, "doc_id", "left_anti")
    second = _in_mask(spark, mistaken)
    near = d.where(first)
    return near.where(~second).unionByName(near.where(second).join(good, "doc_id", "left_semi"))


def train(spark: SparkSession, trusted: DataFrame) -> Model | None:
    """Fit on the ``text`` rows of ``trusted``; None without any."""
    ship_package(spark)
    counts = materialize(spark, count_grams(trusted.select("text")), "kn-counts")
    if counts.isEmpty():
        return None
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: different symbols before the shorter n-gram.
        shorter = levels[-1].groupBy(_shorter(order), "symbol").agg(*[F.count_if(F.col(n) > 0).alias(n) for n in N])
        levels.append(materialize(spark, shorter, "kn-continuations"))
    return Model([tuple(materialize(spark, t, "kn-order") for t in _order_tables(level)) for level in reversed(levels)])


# A chunk's n-grams of a shard: each n-gram and how many of the chunk's texts
# hold it, then the texts' numbers and counts, n-gram after n-gram.  One row of
# a chunk also has the keys of its texts.
PACKED = "slot long, shard long, chunk long, keys binary, contexts binary, symbols binary, holders binary, texts binary, counts binary"
SUMS = "chunk long, keys binary, sums binary"


def _shard(context: np.ndarray, symbol: np.ndarray, n: int) -> np.ndarray:
    h = (context.view(np.uint64) ^ (symbol.astype(np.uint64) << np.uint64(43))) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % n


def _pack(n_shards: int, n_slots: int):
    names = [x.split()[0] for x in PACKED.split(", ")]
    types = [pa.int64()] * 3 + [pa.binary()] * 6

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for every, digests in _chunks(it):
            own = dict(zip(digests, every, strict=True))  # equal texts once
            chunk, number = (task << 32) | number, number + 1
            context, symbol, text, n = _counted(list(own.values()))
            first = np.flatnonzero(np.r_[True, (np.diff(context) != 0) | (np.diff(symbol) != 0)])
            holders = np.diff(np.r_[first, len(n)])
            shard = _shard(context[first], symbol[first], n_shards)
            # n-grams and pairs, shard after shard
            small = np.uint16 if n_shards <= 65536 else np.int64
            by_gram, by_pair = (np.argsort(x.astype(small), kind="stable") for x in (shard, np.repeat(shard, holders)))
            gram_ends = np.cumsum(np.bincount(shard, minlength=n_shards))
            pair_ends = np.cumsum(np.bincount(shard, holders, n_shards).astype(np.int64))
            slot, rows = (chunk * 0x9E3779B97F4A7C15 >> 20) % n_slots, []
            for k in range(n_shards):
                own_grams = by_gram[gram_ends[k - 1] if k else 0 : gram_ends[k]]
                pairs = by_pair[pair_ends[k - 1] if k else 0 : pair_ends[k]]
                if not len(own_grams) and k != chunk % n_shards:
                    continue
                grams, counts = first[own_grams], n[pairs]
                rows.append((
                    slot, k, chunk, b"".join(own) if k == chunk % n_shards else None, context[grams].astype("<i8").tobytes(),
                    symbol[grams].astype("<i4").tobytes(), holders[own_grams].astype("<u2" if len(own) < 65536 else "<u4").tobytes(),
                    text[pairs].astype("<u2").tobytes(), counts.astype("<u1" if not len(counts) or counts.max() < 256 else "<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _sum_shard(_key: tuple, packed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Sums of a shard's log-probabilities by chunk and text."""
    known = known.sort_values(["context", "symbol"])
    contexts, number = np.unique(known["context"].to_numpy(), return_inverse=True)
    grams, log_p = (number << BITS) | known["symbol"].to_numpy(), np.stack(known["log_p"].to_list()) if len(known) else np.zeros((0, len(VIEWS)))
    out = []
    for chunk, keys, raw_context, raw_symbol, raw_holders, raw_text, raw_count in packed.drop(columns=["slot", "shard"]).itertuples(index=False):
        sums = np.zeros(0)
        if raw_context:
            context, symbol = np.frombuffer(raw_context, "<i8"), np.frombuffer(raw_symbol, "<i4").astype(np.int64)
            text = np.frombuffer(raw_text, "<u2")
            at = np.searchsorted(grams, (np.searchsorted(contexts, context) << BITS) | symbol)
            if not (np.array_equal(grams[at] & (ALPHABET - 1), symbol) and np.array_equal(contexts[grams[at] >> BITS], context)):
                raise ValueError("an n-gram of a document has no probability")
            holders, count = _unpack(raw_holders, len(context)), _unpack(raw_count, len(text))
            sums = np.stack([np.bincount(text, np.repeat(log_p[at, v], holders) * count) for v in VIEWS], 1)
        out.append((chunk, keys, sums.astype("<f8").tobytes()))
    return pd.DataFrame(out, columns=["chunk", "keys", "sums"])


def _sum_chunk(rows: pd.DataFrame) -> pd.DataFrame:
    """Each text's sum over all shards."""
    keys = next(k for k in rows["keys"] if k is not None)
    total = np.zeros((len(keys) // 16, len(VIEWS)))
    for raw in rows.sort_values("shard")["sums"]:
        part = np.frombuffer(raw, "<f8").reshape(-1, len(VIEWS))
        total[: len(part)] += part
    return pd.DataFrame({"_key": [keys[i : i + 16] for i in range(0, len(keys), 16)], "_log_p": total.tolist()})


class _Table:
    """Log-probabilities of n-grams in memory."""

    def __init__(self, rows: pa.Table):
        context, symbol = (rows.column(c).to_numpy() for c in ("context", "symbol"))
        order = np.lexsort((symbol, context))
        self.contexts, number = np.unique(context[order], return_inverse=True)
        self.grams = (number << BITS) | symbol[order]
        self.log_p = rows.column("log_p").combine_chunks().flatten().to_numpy().reshape(-1, len(VIEWS))[order].copy()

    def __call__(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.grams, (np.searchsorted(self.contexts, context) << BITS) | symbol)
        if not (np.array_equal(self.grams[at] & (ALPHABET - 1), symbol) and np.array_equal(self.contexts[self.grams[at] >> BITS], context)):
            raise ValueError("an n-gram of a document has no probability")
        return self.log_p[at]


def _score_in_place(shared):
    """The rows as they come, their text replaced by its sums."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: _Table = shared.value
        for batch in it:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            sums = np.full((len(texts), len(VIEWS)), np.nan)
            at = [i for i, t in enumerate(texts) if t]
            while at:
                part, size = [], 0
                while at and size < CHUNK_CHARS:
                    part.append(at.pop())
                    size += len(texts[part[-1]])
                context, symbol, key, ends = _indexed([texts[i] for i in part])
                log_p = table(context, symbol)
                for v in VIEWS:
                    sums[part, v] = np.add.reduceat(log_p[key, v], np.r_[0, ends[:-1]])
            lists = pa.array([None if np.isnan(s[0]) else s.tolist() for s in sums], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "_log_p"])

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model | None, text: str = "text", carry: tuple[str, ...] = ("doc_id", "lang"),
          shared_grams: int | None = None) -> DataFrame:
    """``carry``, n_scored, log_perplexity (per character, by the model of
    all) and unseen (by the model that was trained without the text's fold)."""
    ship_package(spark)
    t = text_or_empty(text)
    key = F.unhex(F.md5(t.cast("binary")))
    d = docs.select(*carry, F.char_length(t).cast("long").alias("n_scored"), fold_of(t).alias("_fold"), key.alias("_key"))
    none = F.lit(None).cast("double")
    unscored = d.select(*carry, "n_scored", none.alias("log_perplexity"), none.alias("unseen"))
    if model is None:
        return unscored
    asked = materialize(spark, ask_grams(docs.select(t.alias("text"))), "kn-asked")
    size = asked.agg(F.count("*").alias("grams"), F.sum("n").alias("chars")).first()
    if not size["grams"]:
        return unscored
    known = materialize(spark, model.probabilities(asked), "kn-probabilities")
    if size["grams"] <= (SHARED_GRAMS if shared_grams is None else shared_grams):
        shared = spark.sparkContext.broadcast(_Table(known.toArrow()))  # of a checked size
        rows = docs.select(*carry, F.char_length(t).cast("long").alias("n_scored"), fold_of(t).alias("_fold"), t.alias("_text"))
        schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_log_p", T.ArrayType(T.DoubleType()))])
        scored = rows.mapInArrow(_score_in_place(shared), schema)
    else:
        scored = d.join(_score_by_shard(spark, docs, t, key, known, size["grams"], size["chars"]), "_key", "left")
    per = lambda x: -x / F.col("n_scored")
    return scored.select(*carry, "n_scored", per(F.col("_log_p")[0]).alias("log_perplexity"),
                         per(F.get("_log_p", F.col("_fold") + 1)).alias("unseen"))


def _score_by_shard(spark: SparkSession, docs: DataFrame, t: Column, key: Column, known: DataFrame, grams: int, chars: int) -> DataFrame:
    """_key, _log_p of every different text."""
    shards = max(LEAST_SHARDS, -(-grams // SHARD_GRAMS))
    slots = -(-chars // (GROUP_CHARS * shards))
    known = known.mapInPandas(_with_shard(shards), "shard long, context long, symbol long, log_p array<double>").withColumn(
        "slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    packed = docs.select(t.alias("text"), key.alias("key")).mapInArrow(_pack(shards, slots), PACKED)
    sums = packed.groupBy("slot", "shard").cogroup(known.groupBy("slot", "shard")).applyInPandas(_sum_shard, SUMS)
    by_text = sums.withColumn("shard", F.xxhash64("sums")).groupBy("chunk").applyInPandas(_sum_chunk, "_key binary, _log_p array<double>")
    # Written, so that a hot text on the other side of the join can be split.
    return materialize(spark, by_text.groupBy("_key").agg(F.min("_log_p").alias("_log_p")), "kn-texts")


def _with_shard(n_shards: int):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in it:
            rows.insert(0, "shard", _shard(rows["context"].to_numpy(), rows["symbol"].to_numpy(), n_shards))
            yield rows

    return run


def thresholds(scored: DataFrame) -> DataFrame:
    """(lang, low, high) in histogram steps from trusted scores; ``all`` marks
    the row over all languages."""
    h = scored.where(F.col("log_perplexity").isNotNull()).select(
        "lang", F.floor(F.col("log_perplexity") * STEP).alias("step")).groupBy("lang", "step").agg(F.count("*").alias("n"))
    both = h.select("lang", F.lit(False).alias("all"), "step", "n").unionByName(
        h.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("all"), "step", "n"))
    w = W.partitionBy("all", "lang")
    c = both.select("*", F.sum("n").over(w).alias("docs"), F.sum("n").over(w.orderBy("step").rowsBetween(W.unboundedPreceding, 0)).alias("upto"))
    return c.groupBy("all", "lang").agg(
        F.max("docs").alias("docs"),
        F.min(F.when(F.col("upto") >= F.col("docs") * LOW, F.col("step"))).alias("low"),
        F.min(F.when(F.col("upto") >= F.col("docs") * HIGH, F.col("step"))).alias("high"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, lang, n_scored, perplexity, kept for every document."""
    model = train(spark, trusted_documents(docs, labels, text))
    scored = score(spark, docs, model, text)
    good = _trusted_ids(labels).select("doc_id", F.lit(True).alias("_trusted"))
    judged = F.when(F.col("_trusted"), F.col("unseen")).otherwise(F.col("log_perplexity")).alias("judged")
    scored = materialize(spark, scored.join(good, "doc_id", "left").select(*scored.columns, judged, F.col("_trusted").isNotNull().alias("trusted")), "kn-scores")
    limits = materialize(spark, thresholds(scored.where("trusted").select("lang", F.col("unseen").alias("log_perplexity"))), "kn-thresholds")
    every = limits.where("all").first()
    own = limits.where(~F.col("all") & (F.col("docs") >= LEAST_TRUSTED) & F.col("lang").isNotNull()).select("lang", "low", "high")
    step = F.floor(F.col("judged") * STEP)
    low, high = (F.coalesce(F.col(c), F.lit(every[c] if every else None).cast("long")) for c in ("low", "high"))
    inside = F.coalesce((step >= low) & (step <= high), F.lit(model is None) & (F.col("n_scored") > 0))
    return scored.join(own, "lang", "left").select(
        "doc_id", "lang", "n_scored", F.exp("log_perplexity").alias("perplexity"), inside.alias("kept"))
