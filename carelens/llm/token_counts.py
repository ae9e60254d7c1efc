"""Token counts as delta-maintained rollups.

``TokenRollup`` keeps additive totals (documents, tokens) by source, language
and tokenizer version under a folder.  Changes arrive in batches of signed
rows: an insert adds (1, n), a delete adds (-1, -n), a revised count adds
(0, new - old).  A batch is folded to one row per group before it is stored,
so storage grows with batches and not with documents, and totals are the sum
of committed folds; they never need the documents again.

Commits are idempotent.  A batch's fold is appended under a fresh attempt id,
then one marker row (batch, attempt) is appended; readers take, per batch, only
the smallest attempt that has a marker.  A batch delivered twice, a writer
that died between the two steps, and two writers of one batch at a time all
count once.

Defined results: NULL source or language are groups of their own; NULL texts
count 0 tokens; repeated rows count as often as they occur; an empty batch is
a valid commit; groups whose totals are all 0 are not listed; columns that the
change table does not need are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, n_words, ship_package, text_or_empty

GROUP = ("source", "lang", "tokenizer")
DEDUPE = "dedupe"  # the batch that deletes exact repeats
CHANGES = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long"


class TokenRollup:
    """``root`` is a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._deltas_schema = "batch_id string, attempt string, source string, lang string, tokenizer string, docs long, tokens long"
        self._marks_schema = "batch_id string, attempt string"
        for name, schema in (("deltas", self._deltas_schema), ("commits", self._marks_schema)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def commits(self) -> DataFrame:
        """batch_id and the attempt that counts."""
        return self._read("commits", self._marks_schema).groupBy("batch_id").agg(F.min("attempt").alias("attempt"))

    def is_committed(self, batch_id: str) -> bool:
        return not self._read("commits", self._marks_schema).where(F.col("batch_id") == batch_id).isEmpty()

    @staticmethod
    def fold(changes: DataFrame) -> DataFrame:
        """Signed totals of a batch by group."""
        op, new, old = F.col("op"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
        docs = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0)
        tokens = F.when(op == "insert", new).when(op == "delete", -old).when(op == "revise", new - old).otherwise(
            F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("NULL")))).cast("long"))
        return changes.select(*GROUP, docs.cast("long").alias("docs"), tokens.cast("long").alias("tokens")).groupBy(*GROUP).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def stage(self, batch_id: str, changes: DataFrame) -> str:
        """Append a batch's fold; it does not count before ``mark``."""
        attempt = uuid.uuid4().hex
        folded = self.fold(changes).select(F.lit(batch_id).alias("batch_id"), F.lit(attempt).alias("attempt"), *GROUP, "docs", "tokens")
        folded.write.mode("append").parquet(f"{self.root}/deltas")
        return attempt

    def mark(self, batch_id: str, attempt: str) -> None:
        self.spark.createDataFrame([(batch_id, attempt)], self._marks_schema).coalesce(1).write.mode("append").parquet(
            f"{self.root}/commits")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Count a batch once; False if it was counted before."""
        if self.is_committed(batch_id):
            return False
        self.mark(batch_id, self.stage(batch_id, changes))
        return True

    def totals(self, apart: str | None = None) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches;
        with a batch ``apart`` also all_docs, all_tokens over the others."""
        d = self._read("deltas", self._deltas_schema).join(self.commits(), ["batch_id", "attempt"])
        sums = [F.sum(c).alias(c) for c in ("docs", "tokens")]
        if apart is not None:
            sums += [F.sum(F.when(F.col("batch_id") != apart, F.col(c)).otherwise(0)).alias(f"all_{c}") for c in ("docs", "tokens")]
        t = d.groupBy(*GROUP).agg(*sums)
        return t.where(reduce(or_, [F.col(c) != 0 for c in t.columns[len(GROUP):]]))


@dataclass(frozen=True)
class BytePairs:
    """A byte-pair vocabulary as a file of base64 ranks (must exist on every
    executor) and its splitting pattern."""

    path: str
    pattern: str

    def load(self):
        import base64

        import tiktoken

        with open(self.path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))


def count_tokens(docs: DataFrame, tokenizer: BytePairs, text: str = "text", carry: tuple[str, ...] = ("doc_id", "source", "lang")) -> DataFrame:
    """``carry``, text_key (a digest of the text), n_bytes, n_words and
    n_tokens of every whole text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    t = text_or_empty(text)
    d = docs.select(*carry, F.sha2(t.cast("binary"), 256).alias("text_key"), F.octet_length(t).cast("long").alias("n_bytes"),
                    n_words(t).alias("n_words"), t.alias("_text"))
    kept = d.drop("_text").schema
    names = to_arrow_schema(kept)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.load()
        for batch in it:
            n = pa.array([count(x.as_py()) for x in batch.column(len(names))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], n], names=[*names.names, "n_tokens"])

    return d.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_tokens long"]))


def rollup_documents(spark: SparkSession, docs: DataFrame, root: str, version: str, tokenizer: BytePairs) -> TokenRollup:
    """Maintain the totals of a document table through its life: every
    document is inserted with exact word counts and an estimated token count
    (a quarter of its bytes), the estimates are revised by exact counts, and
    exact repeats of a text (all but the one of smallest id) are deleted.
    The second batch is delivered twice, as at-least-once delivery may.

    ``totals()`` is then over different texts; ``totals(apart=DEDUPE)`` has
    beside it the totals over every row of the table."""
    counted = materialize(
        spark, count_tokens(docs.withColumn("row_id", F.monotonically_increasing_id()), tokenizer,
                            carry=("row_id", "doc_id", "source", "lang")), "token-counts")
    rollup = TokenRollup(spark, root)
    guess = F.ceil(F.col("n_bytes") / 4).cast("long")
    where = ["source", "lang"]

    def rows(frame: DataFrame, op: str, name: str, new, old) -> DataFrame:
        return frame.select(F.lit(op).alias("op"), *where, F.lit(name).alias("tokenizer"),
                            new.cast("long").alias("tokens"), old.cast("long").alias("old_tokens"))

    none, words, exact = F.lit(None), F.col("n_words"), F.col("n_tokens")
    rollup.commit("load", rows(counted, "insert", "words", words, none).unionByName(rows(counted, "insert", version, guess, none)))
    revised = rows(counted, "revise", version, exact, guess)
    rollup.commit("recount", revised)
    rollup.commit("recount", revised)
    # One representative per text, chosen with map-side combine; the rest go.
    first = counted.groupBy("text_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("f")).select("f.row_id")
    repeats = counted.join(first, "row_id", "left_anti")
    rollup.commit(DEDUPE, rows(repeats, "delete", "words", none, words).unionByName(rows(repeats, "delete", version, none, exact)))
    return rollup
