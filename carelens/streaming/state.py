"""Feature state that daily batches are merged into.

The three tables that are pulled daily are kept as folds: what their features
need, at the grain of a customer's machine (or of a distinct pair), in a form
in which two folds of the same key merge into one.  A batch is folded by itself
and written as a new *layer*; the rows of a key in all layers are merged into
one where a fold is read, and by ``compact``, which writes all layers as one.

Layers are bucketed, those of machines by machine, so that merging and joining
them exchanges no rows.  A batch's spare parts, of which both folds keep about a
row each, are dealt out by machine and written once for the two.

Commits are exactly-once: one small file per commit lists the layers and the
ids of all batches merged so far.  It is created only if its number is free, so
of two writers one starts over from what the other committed; a batch that is
delivered again is found in the list and changes nothing; layers of a writer
that died are in no list.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.config import FeatureConfig
from carelens.operators import calls, contracts, spares
from carelens.plans import features as FT
from carelens.sources.inputs import Sources
from carelens.sources.sinks import bucket_table, scratch_path, write_buckets
from carelens.sources.versions import DIGITS, _Folder


@dataclass(frozen=True)
class Fold:
    """One kept table: the input it is made of, its keys, how it is made from
    prepared rows, and how columns merge."""

    source: str
    keys: tuple[str, ...]
    make: Callable[[DataFrame, list[str]], DataFrame]
    merge: Mapping[str, Callable[[str], Column]]
    other: Callable[[str], Column] = F.sum

    @property
    def buckets(self) -> tuple[str, ...]:
        """The keys that its layers are bucketed by."""
        return MACHINE if self.keys[:2] == MACHINE else self.keys


MACHINE = ("customer", "serial")
FOLDS: dict[str, Fold] = {
    "calls": Fold("calls", MACHINE, calls.per_machine, calls.MERGE),
    "media": Fold("calls", ("customer", "Medium"), lambda df, _: calls.media(df), {}),
    "contracts": Fold("contracts", MACHINE, lambda df, _: contracts.per_machine(df), contracts.MERGE, F.max),
    "numbers": Fold("contracts", ("customer", "icr"), lambda df, _: contracts.numbers(df), {}),
    "spares": Fold("spares", MACHINE, lambda df, _: spares.machine_fold(df), spares.MERGE),
    "bookings": Fold("spares", (*MACHINE, "item", "booked"), lambda df, _: spares.booking_days(df), {}),
}
PREPARE = {"calls": calls.prepare, "contracts": contracts.prepare, "spares": spares.prepare}
# Inputs whose folds are all by machine and of about as many rows.
DEALT = ("spares",)
# The feature groups that come from these folds alone.
GROUPS = ("calls", "contracts", "repeat_parts", "spare_contracts")


def merge(df: DataFrame, fold: Fold) -> DataFrame:
    """One row per key of folds of the same kind.  NULL keys are keys."""
    rest = [c for c in df.columns if c not in fold.keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*fold.keys).agg(*[fold.merge.get(c, fold.other)(c).cast(df.schema[c].dataType).alias(c) for c in rest])


class FeatureState:
    """The folds under ``root``, on a file system all executors share."""

    def __init__(self, spark: SparkSession, root: str, cfg: FeatureConfig | None = None):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg or FeatureConfig()

    def _commit(self) -> tuple[int, dict]:
        """Number and content of the last complete commit."""
        number, commit = self._last()
        if commit["layers"] and "buckets" not in commit:
            raise ValueError(f"{self.root} has layers of an earlier kind; build it anew")
        return number, commit

    def _last(self) -> tuple[int, dict]:
        folder = _Folder(self.spark, f"{self.root}/commits")
        last = 0
        for name in reversed(folder.names()):
            if name.isdigit():
                last = max(last, int(name))
                try:
                    return last, json.loads(folder.read(name))
                except ValueError:
                    continue  # its writer died
        return last, {"batches": [], "layers": [], "schemas": {}}

    def _rows(self, commit: Mapping, name: str) -> DataFrame | None:
        """A fold's merged rows of all layers.  They are read as the partitions
        of one bucketed table: Spark 4.1 takes a union of bucketed tables for
        bucketed and yet leaves rows of a key apart."""
        layers, fold = commit["layers"], FOLDS[name]
        if not layers:
            return None
        schema = T.StructType.fromJson(commit["schemas"][name])
        paths = {layer: f"{self.root}/layers/{layer}/{name}" for layer in layers}
        rows = self.spark.table(bucket_table(self.spark, f"{self.root}/layers", schema, paths, commit["buckets"], fold.buckets)).select(*schema.names)
        return rows if len(layers) < 2 else merge(rows, fold)

    def _write(self, df: DataFrame, layer: str, name: str, buckets: int) -> None:
        write_buckets(df, f"{self.root}/layers/{layer}/{name}", buckets, FOLDS[name].buckets)

    def _dealt(self, source: str, prepared: DataFrame, buckets: int) -> DataFrame:
        """A batch's prepared rows, written once where several folds by machine read them."""
        if source not in DEALT:
            return prepared
        path = scratch_path(self.spark, f"batch-{source}")
        return self.spark.table(write_buckets(prepared.hint("rebalance", *MACHINE), path, buckets, MACHINE))

    def batches(self) -> list[str]:
        """Ids of the batches merged so far."""
        return list(self._commit()[1]["batches"])

    def apply(self, batch: str, rows: Mapping[str, DataFrame], order: Mapping[str, tuple[str, ...]]) -> bool:
        """Merge one batch: canonical rows of any of the three tables, with
        the columns that give their upstream ``order``.  False, and nothing is
        done, if it was merged before."""
        empty = Sources(*[None] * 6, order=order)
        while True:
            number, commit = self._commit()
            if batch in commit["batches"]:
                return False
            layer, schemas = uuid.uuid4().hex, dict(commit["schemas"])
            buckets = commit.get("buckets") or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            prepared = {t: self._dealt(t, PREPARE[t](empty.with_frames(**{t: df}), self.cfg), buckets) for t, df in rows.items()}
            for name, fold in FOLDS.items():
                if fold.source not in rows:
                    continue
                new = fold.make(prepared[fold.source], list(order.get(fold.source, ())))
                self._write(new, layer, name, buckets)
                schemas[name] = json.loads(new.schema.json())
            for name in schemas:
                if FOLDS[name].source not in rows:  # nothing new
                    self._write(self.spark.createDataFrame([], T.StructType.fromJson(schemas[name])), layer, name, buckets)
            if number == 0 and len(schemas) < len(FOLDS):
                raise ValueError("the first batch must have all three tables, empty ones if need be")
            if self._publish(number + 1, {"batches": [*commit["batches"], batch], "layers": [*commit["layers"], layer],
                                          "schemas": schemas, "buckets": buckets}):
                return True

    def _publish(self, number: int, commit: Mapping) -> bool:
        return _Folder(self.spark, f"{self.root}/commits").create(f"{number:0{DIGITS}d}", json.dumps(commit))

    def compact(self) -> bool:
        """All layers as one; as idempotent as a batch."""
        number, commit = self._commit()
        if len(commit["layers"]) < 2:
            return False
        layer = uuid.uuid4().hex
        for name in FOLDS:
            self._write(self._rows(commit, name), layer, name, commit["buckets"])
        return self._publish(number + 1, {**commit, "layers": [layer]})

    def fold(self, name: str) -> DataFrame:
        """The merged fold of all batches."""
        rows = self._rows(self._commit()[1], name)
        if rows is None:
            raise FileNotFoundError(f"no batch has been merged into {self.root}")
        return rows

    def features(self, src: Sources, columns: Iterable[str] | None = None) -> DataFrame:
        """The feature table: what comes from the daily tables from the folds,
        the rest from ``src`` (installs, call items and prices)."""
        names = list(columns) if columns is not None else FT.FEATURE_NAMES
        return FT._table(_StatePlan(self, src, self.cfg, names), names)


class _StatePlan(FT._Plan):
    def __init__(self, state: FeatureState, src: Sources, cfg: FeatureConfig, names: Iterable[str]):
        super().__init__(src, cfg, names)
        self.state = state
        for node in ("calls", "con", "sp", "con_machine"):
            self.readers[node] = {}

    def group(self, name: str) -> DataFrame:
        s = self.state.fold
        builders = {
            "calls": lambda: calls.from_folds(s("calls"), s("media"), self.cfg),
            "contracts": lambda: contracts.from_folds(s("numbers"), s("contracts"), self.cfg),
            "repeat_parts": lambda: spares.repeats(s("bookings"), s("contracts"), dealt=True),
            "spare_contracts": lambda: spares.contract_lags_and_profitability(s("spares"), s("contracts")),
        }
        return self._get(f"group:{name}", builders[name]) if name in builders else super().group(name)
