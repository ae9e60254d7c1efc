"""A corpus pipeline made of the operators in ``carelens.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``
(and any further columns their input has).

* toxicity: documents with a score of ``toxicity.THRESHOLD`` or more go.
* n-gram Jaccard join: of each component one document stays, the one of
  smallest id (of equal ids, of smallest text digest; of equal rows, one).
  Documents without words are linked with nothing and stay.
* secret scans: documents stay, found secrets are masked in their texts (and
  ``n_chars`` is the new length of a masked text).
* mixing: a document comes as often as the mix takes it, 0 to 3 times.
* packing: one row per piece of the training sequences.

NULLs, empty texts, repeated rows and empty tables are handled as the
operators define it; a NULL id is an id like others here.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm import mixing, ngram_join, packing, secret_scan, toxicity
from carelens.llm.common import materialize, read_table

TOKENIZER = "word_bpe_49k.json"


def _whole(docs: DataFrame) -> DataFrame:
    """The row as one column, so that no operator's column clashes with it."""
    return docs.select(F.struct(*docs.columns).alias("doc"), *[c for c in ("doc_id", "source", "text") if c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, _whole(docs), model, carry=("doc",), evidence=False)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The digest tells rows of equal id apart.
    key = F.struct("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    keyed = _whole(docs).withColumn("key", key)
    found = ngram_join.jaccard_components(spark, keyed, id_column="key")
    ids = materialize(spark, found.where(F.col("key") == F.col("component_id")).groupBy("key").agg(F.count("*").alias("n")), "kept-ids")
    if ids.where(F.col("n") > 1).isEmpty():
        return keyed.join(ids.select("key"), "key", "left_semi").select("doc.*")
    # Of rows that are equal in id and text the first stays, by all columns.
    kept = keyed.join(ids, "key")
    first = kept.where("n > 1").groupBy("key").agg(F.min_by("doc", F.to_json("doc", {"ignoreNullFields": "false"})).alias("doc"))
    return kept.where("n = 1").select("doc").unionByName(first.select("doc")).select("doc.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(spark, _whole(docs), carry=("doc",))
    hit = F.size("spans") > 0
    text = secret_scan.redact(F.col("doc.text"), F.col("spans"))
    new = {"text": F.when(hit, F.col("masked")).otherwise(F.col("doc.text")),
           "n_chars": F.when(hit, F.char_length("masked").cast("long")).otherwise(F.col("doc.n_chars"))}
    masked = found.select("doc", "spans", F.when(hit, text).alias("masked"))
    return masked.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.fair_queue(spark, _whole(docs), carry=("doc",))
    return mixed.where(F.col("copies") > 0).select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(spark, docs, public_tokenizers.path(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

# Nearest labelled examples and token ids have no SQL form; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
