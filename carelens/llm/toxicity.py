"""Toxicity by nearest labelled examples.

A text is a TF-IDF vector over the words of the labelled examples, however
rare; only stop words are none of its terms: those in more than ``STOP_DOCS``
examples, and one in ``COMMON``, that are as frequent under either label
(chi-squared below ``EVEN``).  Word pieces (5 characters, ``^`` and ``$`` marking where a word begins and
ends) and stems (a word's first 3 to 6 letters) are terms beside them where they
tell the labels apart (chi-squared).  A stem that occurs again and again is a
further term for every ``LEVELS`` rate per 1000 words that it reaches, so that a
stem that is harmless once and telling when frequent can be told apart.  A term
weighs its inverse document frequency; one whose chi-squared is below
``SIGNIFICANT`` a share of it, the square of the quotient (at least
``LEAST_SHARE``): words that say little of the label decide where nothing else
does.  A text's nearest examples by *exact*
cosine vote with their similarity; the vote becomes a score by calibration on
labelled documents in their natural proportions (examples among them are scored
without themselves).

Examples are found through a block-max inverted index: a term's postings are
cut into blocks of ``BLOCK`` example numbers, and the largest weight of every
(term, block) that has postings is kept.  A query bounds every block by the sum of its terms'
maxima, searches the blocks of largest bounds, and then the others whose bound
can beat the k-th best found: no example that belongs to the k best is missed.

Bounds: at most ``INDEX_PER_CLASS`` examples of either label and
``CALIBRATION`` calibration documents, chosen by a hash of their id; the
vocabulary is all their words but stop words, and every significant part.  So the model is
bounded by the sample whatever the corpus and is broadcast; documents are scored
where they are, without a shuffle, every whole text.  Scores depend on the text
alone.

Defined results: NULL text is the empty text; texts without any vocabulary
term have no neighbours and get the calibrated rate of such texts; labels that
are NULL or belong to no document teach nothing, several labels of a document
count as toxic if one is; repeated rows are scored one by one; without labels
of both classes every score is 0; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package, text_or_empty

INDEX_PER_CLASS = 3000
CALIBRATION = 6000
SIGNIFICANT = 20.0  # chi-squared from which a term has its full weight
LEAST_DOCS = 4
LEAST_SHARE = 0.02
STOP_DOCS = 60
COMMON = 64
EVEN = 3.84
BLOCK = 64
NEIGHBOURS = 15
FIRST_BLOCKS = 8  # blocks searched before the first pruning
BINS = 10
THRESHOLD = 0.3
PIECE = 5
STEMS = (3, 4, 5, 6)
LEVELS = (4, 6, 8, 11, 16, 23, 32, 64)
_WORD = re.compile(r"\w+")
# Of UTF-8 bytes: ASCII characters that are part of no word become blanks.
_APART = bytes(c if c >= 128 or _WORD.match(chr(c)) else 32 for c in range(256))


def held_out(doc_id: Column) -> Column:
    """The fold that teaches nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(text: str) -> Counter:
    """How often each word of a text (a match of ``_WORD`` in lower case) occurs.

    A text is cut at ASCII characters first, which is quicker than the pattern;
    what has other characters is searched for words afterwards."""
    out = Counter(text.lower().encode().translate(_APART).decode().split())
    if not text.isascii():
        for part in [x for x in out if not x.isascii()]:
            words = _WORD.findall(part)
            if words != [part]:
                n = out.pop(part)
                for word in words:
                    out[word] += n
    return out


def pieces(word: str) -> list[str]:
    """A lower-case word's terms: itself and its marked pieces."""
    marked = f"^{word}$"
    return [word, *{marked[i : i + PIECE] for i in range(len(marked) - PIECE + 1)}]


def stems(word: str) -> list[str]:
    return [f"^{word[:k]}" for k in STEMS if k <= len(word)]


def levels(stem_counts: dict[str, int], n_words: int) -> Iterator[tuple[str, int]]:
    """(stem, level) for every rate that a repeated stem reaches."""
    for stem, n in stem_counts.items():
        if n >= 2:
            for level in LEVELS:
                if n * 1000 < level * n_words:
                    break
                yield stem, level


@dataclass
class Index:
    """Block-max inverted index over unit vectors."""

    terms: dict[str, int]
    idf: np.ndarray  # weight of a term that occurs once
    ids: list[int]
    labels: np.ndarray
    # Per term: example numbers, weights; or all of them as (terms, example numbers, weights), in this order.
    postings: list[tuple[np.ndarray, np.ndarray]] | tuple[np.ndarray, np.ndarray, np.ndarray]
    numbers: np.ndarray = field(init=False)  # all postings, term after term
    posted: np.ndarray = field(init=False)
    runs: np.ndarray = field(init=False)  # where a term's runs start, and the end; a run: its postings in one block
    block: np.ndarray = field(init=False)  # of a run
    block_max: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)  # a run's first posting, and the end

    def __post_init__(self) -> None:
        blocks, terms = -(-len(self.ids) // BLOCK), len(self.terms)
        if isinstance(self.postings, tuple):
            of_term, numbers, self.posted = self.postings
        else:
            of_term = np.repeat(np.arange(len(self.postings)), [len(n) for n, _ in self.postings])
            numbers = np.concatenate([n for n, _ in self.postings] or [np.zeros(0)])
            self.posted = np.concatenate([w for _, w in self.postings] or [np.zeros(0)])
        self.numbers = numbers.astype(np.int32)
        run = of_term.astype(np.int64) * max(1, blocks) + self.numbers // BLOCK
        new = np.flatnonzero(np.diff(run, prepend=-1))
        self.block = (self.numbers[new] // BLOCK).astype(np.int32)
        self.block_max = np.maximum.reduceat(self.posted, new) if len(new) else np.zeros(0)
        self.starts = np.append(new, len(run)).astype(np.int64)
        self.runs = np.searchsorted(of_term[new], np.arange(terms + 1))
        self.postings = []

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights; counts are by term number."""
        return self.weigh(*_by_number(counts))

    def weigh(self, at: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1.0 + np.log(times.astype(float))) * self.idf[at]
        return at, w / np.sqrt((w * w).sum())

    def nearest(self, at: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, but: int = -1) -> list[tuple[float, int]]:
        """(cosine, example number) of the k best other than ``but``, ties to
        smaller numbers."""
        first, end = self.runs[at], self.runs[at + 1]
        runs, by_run = _ranges(first, end, weights)
        block = self.block[runs]
        bound = np.bincount(block, by_run * self.block_max[runs], -(-len(self.ids) // BLOCK))
        order = (-bound).argsort(kind="stable")
        chosen = np.zeros(len(bound), bool)
        chosen[order[:FIRST_BLOCKS]] = True
        got = self._picked(runs, by_run, chosen[block])
        if but >= 0:
            got[but] = 0.0
        found = got[got > 5e-13]
        least = np.partition(found, len(found) - k)[len(found) - k] if len(found) >= k else 0.0
        more = (bound > 0) & (bound >= least - 1e-9) & ~chosen  # the others cannot hold one of the k best
        left = more.sum()
        if 2 * left > len(bound):
            # Most blocks: reading the terms' postings through takes less than picking runs.
            got = self._sums(self.starts[first], self.starts[end], weights)
        elif left:
            got += self._picked(runs, by_run, more[block])
        if but >= 0:
            got[but] = 0.0
        return _best(got, k)

    def _picked(self, runs: np.ndarray, by_run: np.ndarray, here: np.ndarray) -> np.ndarray:
        runs = runs[here]
        return self._sums(self.starts[runs], self.starts[runs + 1], by_run[here])

    def _sums(self, first: np.ndarray, end: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Every example's sum over some ranges of postings."""
        where, weights = _ranges(first, end, weights)
        weights *= self.posted[where]
        return np.bincount(self.numbers[where], weights, len(self.ids))


def _best(got: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (cosine, example number)."""
    hits = (got > 5e-13).nonzero()[0]
    of_hits = got[hits]
    if len(hits) > k:
        near = of_hits >= np.partition(of_hits, len(hits) - k)[len(hits) - k] - 1e-11
        hits, of_hits = hits[near], of_hits[near]
    of_hits = of_hits.round(12)
    order = np.lexsort((hits, -of_hits))[:k]
    return list(zip(of_hits[order].tolist(), hits[order].tolist(), strict=True))


def _by_number(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, ascending, and their counts."""
    at = np.fromiter(counts.keys(), np.int64, len(counts))
    order = np.argsort(at)
    return at[order], np.fromiter(counts.values(), np.int64, len(counts))[order]


def _named(names: pa.Array, numbers: list[np.ndarray]) -> pa.Array:
    """Lists of names, one for each array of their numbers."""
    ends = np.cumsum([0, *map(len, numbers)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), names.take(pa.array(np.concatenate([np.zeros(0, np.int64), *numbers]))))


def _ranges(first: np.ndarray, end: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges, one range after the other, each with its range's value."""
    n = end - first
    ends = n.cumsum()
    numbers = (first - (ends - n)).repeat(n)
    numbers += np.arange(len(numbers))
    return numbers, value.repeat(n)


@dataclass
class Model:
    index: Index
    no_neighbours: float
    edges: np.ndarray  # upper ends of the vote bins
    rates: np.ndarray  # calibrated score of each bin

    def vote(self, found: list[tuple[float, int]]) -> float:
        weights = np.array([s * s for s, _ in found])
        return float((weights * self.index.labels[[n for _, n in found]]).sum() / weights.sum())

    def score(self, found: list[tuple[float, int]]) -> float:
        if not found:
            return self.no_neighbours
        return float(np.interp(self.vote(found), self.edges, self.rates))


class Counts:
    """Vocabulary counts of texts; remembers the terms of common words."""

    def __init__(self, terms: dict[str, int], keep: int = 200_000):
        self.terms, self.keep, self.known = terms, keep, {}
        self.levelled = {t.split(">")[0] for t in terms if ">" in t}
        # What a part of a word can be, apart from the many words.
        self.pieces = {t: n for t, n in terms.items() if len(t) == PIECE}
        self.stems = {t: n for t, n in terms.items() if t[0] == "^" and len(t) - 1 in STEMS}
        self.begins = {t[1 : 1 + STEMS[0]] for t in (*self.stems, *self.levelled)}

    def __call__(self, text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        often: dict[str, int] = {}
        known, counted = self.known, word_counts(text)
        for word, n in counted.items():
            found = known.get(word)
            if found is None:
                found = self._lookup(word)
                if len(known) < self.keep:
                    known[word] = found
            if found:
                for t in found[0]:
                    out[t] = out.get(t, 0) + n
                for stem in found[1]:
                    often[stem] = often.get(stem, 0) + n
        if often:
            for stem, level in levels(often, counted.total()):
                t = self.terms.get(f"{stem}>{level}")
                if t is not None:
                    out[t] = 1
        return out

    def _lookup(self, word: str) -> tuple:
        """(term numbers, stems with levels) of a word, () without any."""
        marked, often = f"^{word}$", ()
        own = set(map(self.pieces.get, [marked[i : i + PIECE] for i in range(len(marked) - PIECE + 1)]))
        own.add(self.terms.get(word))
        if word[: STEMS[0]] in self.begins:
            by_stem = stems(word)
            own.update(map(self.stems.get, by_stem))
            often = tuple(x for x in by_stem if x in self.levelled)
        own.discard(None)
        return (tuple(own), often) if own or often else ()


def _terms_of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of the examples of a task, by label; ``word`` marks
    the terms that occur as words."""
    seen: dict[str, list[int]] = {}
    whole: set[str] = set()
    for batch in it:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            own: set[str] = set()
            often: Counter = Counter()
            words = word_counts(text.as_py())
            whole.update(words)
            for word, n in words.items():
                own.update(pieces(word))
                for stem in stems(word):
                    often[stem] += n
            own.update(often)
            own.update(f"{stem}>{level}" for stem, level in levels(often, words.total()))
            for t in own:
                seen.setdefault(t, [0, 0])[label] += 1
    items = list(seen.items())
    for k in range(0, len(items), 50_000):
        part = items[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in part]), pa.array([n[0] for _, n in part], pa.int64()), pa.array([n[1] for _, n in part], pa.int64()),
             pa.array([t in whole for t, _ in part], pa.bool_())],
            names=["term", "clean", "toxic", "word"])


def examples(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(role, label, doc_id, text): the bounded sample of labelled documents.

    Sampling looks at ids only; texts are fetched for the sample."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi"))
    order = F.md5(F.col("doc_id").cast("string").cast("binary"))
    other = F.md5(F.concat(F.lit("calibration:"), F.col("doc_id").cast("string")).cast("binary"))

    def first(c: int) -> DataFrame:
        return known.where(F.col("label") == c).orderBy(order, "doc_id").limit(INDEX_PER_CLASS)

    index = first(0).unionByName(first(1)).withColumn("role", F.lit("index"))
    rest = known.orderBy(other, "doc_id").limit(CALIBRATION).withColumn("role", F.lit("calibration"))
    both = index.unionByName(rest)
    # At most 2 * INDEX_PER_CLASS + CALIBRATION ids, and one row of each.
    rows = docs.select("doc_id", text_or_empty(text).alias("text")).join(F.broadcast(both), "doc_id")
    own = rows.groupBy("role", "label", "doc_id").agg(F.min(F.struct(F.md5(F.col("text").cast("binary")).alias("digest"), "text")).alias("row"))
    return own.select("role", "label", "doc_id", F.col("row.text").alias("text"))


def chi_squared(clean: Column, toxic: Column, n_clean: int, n_toxic: int) -> Column:
    n, df = n_clean + n_toxic, clean + toxic
    return F.lit(float(n)) * F.pow(toxic * float(n_clean) - clean * float(n_toxic), 2) / (
        F.lit(float(n_clean) * n_toxic) * df * F.greatest(F.lit(float(n)) - df, F.lit(1.0)))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text") -> Model | None:
    """The model, or None without examples of both labels."""
    ship_package(spark)
    sample = materialize(spark, examples(docs, labels, text), "toxicity-examples")
    index = sample.where(F.col("role") == "index")
    size = {r["label"]: r["n"] for r in index.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return None
    df = index.select("label", "text").mapInArrow(_terms_of, "term string, clean long, toxic long, word boolean").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.max("word").alias("word"))
    chi = chi_squared(F.col("clean"), F.col("toxic"), size[0], size[1])
    telling = (F.col("clean") + F.col("toxic") >= LEAST_DOCS) & (chi >= SIGNIFICANT)
    # Bounded by the sample: its words, and its significant parts of words.
    n = size[0] + size[1]
    in_docs = F.col("clean") + F.col("toxic")
    stop = (in_docs > STOP_DOCS) & (in_docs * COMMON > n) & (chi < EVEN)
    # Bounded by the sample; columns, as rows of Python objects would take several times the memory.
    chosen = df.where(telling | (F.col("word") & ~stop)).select(
        "term", (F.log(F.lit(float(n)) / in_docs + 1.0) * F.when(telling, 1.0).otherwise(
            F.greatest(F.lit(LEAST_SHARE), F.pow(F.least(F.lit(1.0), chi / SIGNIFICANT), 2)))).alias("weight")).toArrow()
    chosen = chosen.sort_by("term")
    terms = {t.as_py(): i for i, t in enumerate(chosen.column("term"))}
    idf = chosen.column("weight").to_numpy()

    counted = materialize(spark, sample.select("role", "label", "doc_id", "text").mapInArrow(
        _counts_of(terms), "role string, label int, doc_id long, at array<int>, n array<int>"), "toxicity-vectors")
    # Bounded by the sample: vectors of the examples.
    rows = counted.where((F.col("role") == "index") & (F.size("at") > 0)).select("doc_id", "label", "at", "n").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()
    size_of = rows.column("at").combine_chunks().value_lengths().to_numpy() if len(rows) else np.zeros(0, np.int64)
    at, times = (rows.column(c).combine_chunks().flatten().to_numpy() if len(rows) else np.zeros(0, np.int32) for c in ("at", "n"))
    number = np.repeat(np.arange(len(rows)), size_of)
    weights = (1.0 + np.log(times)) * idf[at]
    weights /= np.sqrt(np.bincount(number, weights * weights, len(rows)))[number]
    by_term = np.lexsort((number, at))
    built = Index(terms, idf, rows.column("doc_id").to_pylist(), rows.column("label").to_numpy().astype(float),
                  (at[by_term], number[by_term], weights[by_term]))
    model = Model(built, 0.0, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    votes, truth, bare = [], [], [0, 0]
    found = counted.where(F.col("role") == "calibration").select("label", "doc_id", "at", "n").mapInArrow(
        _votes_of(spark.sparkContext.broadcast(model)), "label int, doc_id long, bare boolean, vote double")
    for r in sorted(found.collect(), key=lambda r: r["doc_id"]):
        if r["bare"]:
            bare[r["label"]] += 1
        elif r["vote"] is not None:
            votes.append(r["vote"])
            truth.append(r["label"])
    rate = sum(truth) + bare[1]
    base = rate / max(1, len(truth) + sum(bare))
    model.no_neighbours = (bare[1] + base) / (sum(bare) + 1)
    model.edges, model.rates = _calibrate(np.array(votes), np.array(truth, float), base)
    return model


def _calibrate(votes: np.ndarray, truth: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates by vote: binned, shrunk to the base rate, made monotone (pooling
    neighbours that are out of order), then interpolated."""
    if not len(votes):
        return np.array([0.0, 1.0]), np.array([base, 1.0])
    which = np.minimum((votes * BINS).astype(int), BINS - 1)
    pools: list[list[float]] = []  # weight, sum, centre sum
    for b in range(BINS):
        own = which == b
        if own.any():
            pools.append([own.sum() + 1.0, truth[own].sum() + base, votes[own].sum() + votes[own].mean()])
            while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
                last = pools.pop()
                pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


def _votes_of(shared):
    """Votes on calibration documents, examples among them without themselves;
    ``bare`` marks documents without a term."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = {doc_id: i for i, doc_id in enumerate(model.index.ids)}
        for batch in it:
            bare, votes = [], []
            for doc_id, at, n in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                found = model.index.nearest(*model.index.vector(Counter(dict(zip(at, n, strict=True)))), but=number.get(doc_id, -1)) if at else []
                bare.append(not at)
                votes.append(model.vote(found) if found else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bare, pa.bool_()), pa.array(votes, pa.float64())],
                names=["label", "doc_id", "bare", "vote"])

    return run


def _counts_of(terms: dict[str, int]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(terms)
        for batch in it:
            found = [sorted(counts(x.as_py()).items()) for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([[t for t, _ in f] for f in found], pa.list_(pa.int32())),
                 pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32()))],
                names=["role", "label", "doc_id", "at", "n"])

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model | None, text: str = "text",
          carry: tuple[str, ...] = ("doc_id",), evidence: bool = True) -> DataFrame:
    """``carry``, score and, if wanted, the evidence: neighbours (doc_id,
    label, cosine) and the vocabulary terms that the text has."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(spark)
    d = docs.select(*carry, text_or_empty(text).alias("_text"))
    near_type = "array<struct<doc_id:bigint,label:int,cosine:double>>"
    if model is None:
        none = [F.array().cast(near_type).alias("neighbours"), F.array().cast("array<string>").alias("terms")]
        return d.select(*carry, F.lit(0.0).alias("score"), *(none if evidence else []))
    names = to_arrow_schema(d.drop("_text").schema).names
    shared = spark.sparkContext.broadcast(model)  # bounded by the parameters above

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        counts = Counts(m.index.terms)
        by_number = pa.array(list(m.index.terms), pa.string()) if evidence else None
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
        seen: dict[bytes, tuple[float, list]] = {}  # by the text's terms
        for batch in it:
            scores, near, terms = [], [], []
            for x in batch.column(len(names)):
                at, times = _by_number(counts(x.as_py()))
                key = hashlib.blake2b(at.tobytes() + times.tobytes(), digest_size=16).digest()
                if key not in seen:
                    found = m.index.nearest(*m.index.weigh(at, times)) if len(at) else []
                    if len(seen) > 20_000:
                        seen.clear()
                    seen[key] = (m.score(found), found if evidence else [])
                value, found = seen[key]
                scores.append(value)
                if evidence:
                    near.append([{"doc_id": m.index.ids[n], "label": int(m.index.labels[n]), "cosine": s} for s, n in found])
                    terms.append(at)
            more = [pa.array(near, kind), _named(by_number, terms)] if evidence else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(scores, pa.float64()), *more],
                names=[*names, "score", *(["neighbours", "terms"] if evidence else [])])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.drop("_text").schema]
    return d.mapInArrow(run, ", ".join([*fields, "score double", *([f"neighbours {near_type}, terms array<string>"] if evidence else [])]))
