"""A durable table of unique keys that a micro-batch merges into without reading all of it.

Layout under one folder: ``recent/<label>`` holds what one batch inserted; ``base/gen=<g>/bucket=<b>`` holds folded
rows by hash of the key; ``marks/<g>.json`` says which generation of each bucket is live and which labels went into it. A mark is
created exclusively and last, so readers see either the state before a fold or the one after it, and a fold that died
half way is simply run again.

A merge reads the key column of the buckets that its batch touches and of the unfolded batches. Batches are folded by
the dozen, which rewrites touched buckets only; what a fold replaced is deleted by the next one, so the number of folders
depends on the number of buckets, not on that of batches. Repeated batches replace themselves, empty ones too.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustflow.operators import dedup
from trustflow.sources import store


@dataclass(frozen=True)
class KeyedTable:
    path: str
    key: str = "event_id"
    buckets: int = 256
    fold_after: int = 12

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def state(self, spark: SparkSession) -> dict:
        """The last mark: gen, live (generation of each bucket) and folded (labels that the live buckets hold by now)."""
        store.make_dirs(spark, f"{self.path}/marks")
        marks = store.data_files(spark, f"{self.path}/marks")
        return store.read_json(spark, f"{self.path}/marks/{max(marks)}") if marks else {"gen": 0, "live": {}, "folded": []}

    def unfolded(self, spark: SparkSession, state: dict) -> list[str]:
        store.make_dirs(spark, f"{self.path}/recent")
        return sorted(set(store.data_files(spark, f"{self.path}/recent")) - set(state["folded"]))

    def _base(self, spark: SparkSession, state: dict, buckets=None) -> list[str]:
        live = {int(b): g for b, g in state["live"].items()}
        return [f"{self.path}/base/gen={live[b]}/bucket={b}" for b in sorted(live if buckets is None else live.keys() & set(buckets))]

    def _recent(self, labels) -> list[str]:
        return [f"{self.path}/recent/{x}" for x in labels]

    def held(self, batch: DataFrame, label: str | None = None) -> DataFrame | None:
        """Keys that the table holds in the buckets of a batch, without those that the same label wrote before."""
        spark = batch.sparkSession
        state = self.state(spark)
        # At most one number per bucket comes back.
        touched = [r[0] for r in batch.select(self._bucket().alias("b")).distinct().collect()]
        paths = self._base(spark, state, touched) + self._recent(x for x in self.unfolded(spark, state) if x != label)
        return spark.read.parquet(*paths).select(self.key) if paths else None

    def merge(self, batch: DataFrame, label: str, order=dedup.ARRIVAL_ORDER) -> None:
        """Inserts the rows whose keys are new, one per key."""
        held = self.held(batch, label)
        new = dedup.first_delivery(batch, self.key, order) if held is None else dedup.insert_only(held, batch, self.key, order)
        new.withColumn("merged_by", F.lit(label)).write.mode("overwrite").parquet(f"{self.path}/recent/{label}")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All rows, with the label that brought each; None before the first merge."""
        state = self.state(spark)
        paths = self._base(spark, state) + self._recent(self.unfolded(spark, state))
        return spark.read.parquet(*paths) if paths else None

    def fold(self, spark: SparkSession, current: str | None = None) -> bool:
        """Moves unfolded batches into buckets once there are ``fold_after`` of them. ``current`` may still be retried and stays."""
        state = self.state(spark)
        labels = [x for x in self.unfolded(spark, state) if x != current]
        if len(labels) < self.fold_after:
            return False
        self._clear(spark, state)
        gen = state["gen"] + 1
        recent = spark.read.parquet(*self._recent(labels)).withColumn("bucket", self._bucket())
        touched = [r[0] for r in recent.select("bucket").distinct().collect()]
        paths = self._base(spark, state, touched)
        rows = recent
        if paths:
            rows = spark.read.parquet(*paths).withColumn("bucket", self._bucket()).unionByName(recent, allowMissingColumns=True)
        (
            rows.repartition("bucket")
            .sortWithinPartitions("bucket", self.key)
            .write.mode("overwrite")
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .partitionBy("bucket")
            .parquet(f"{self.path}/base/gen={gen}")
        )
        live = {**state["live"], **{str(b): gen for b in touched}}
        store.create_json(spark, f"{self.path}/marks/{gen:012d}.json", {"gen": gen, "live": live, "folded": labels})
        return True

    def _clear(self, spark: SparkSession, state: dict) -> None:
        """Deletes what the last mark has replaced: its folded batches, buckets of older generations, older marks."""
        for label in state["folded"]:
            store.delete(spark, f"{self.path}/recent/{label}")
        store.make_dirs(spark, f"{self.path}/base")
        for folder in store.data_files(spark, f"{self.path}/base"):
            gen = int(folder.removeprefix("gen="))
            if gen > state["gen"]:
                continue  # of a fold that died; the next one overwrites it
            held = [b for b in store.data_files(spark, f"{self.path}/base/{folder}") if b.startswith("bucket=")]
            gone = [b for b in held if state["live"].get(b.removeprefix("bucket=")) != gen]
            for bucket in gone if len(gone) < len(held) else [""]:
                store.delete(spark, f"{self.path}/base/{folder}/{bucket}")
        for mark in sorted(store.data_files(spark, f"{self.path}/marks"))[:-1]:
            store.delete(spark, f"{self.path}/marks/{mark}")


@contextmanager
def writer_lease(spark: SparkSession, path: str, owner: str):
    """One writer at a time. The lease of an owner that died is taken up again by the same owner alone."""
    place = f"{path}/_lease.json"
    if store.exists(spark, place):
        holder = store.read_json(spark, place)["owner"]
        if holder != owner:
            raise ValueError(f"{path} is being written by {holder}")
    else:
        store.create_json(spark, place, {"owner": owner})  # exclusive: of two at once one fails here
    try:
        yield
    finally:
        store.delete(spark, place)


def restore(spark: SparkSession, table: KeyedTable, valid: DataFrame, run_id: str) -> dict[str, int]:
    """Reconciliation: valid deliveries whose event the table lacks are merged into it under a lease.

    Reports how many events were expected, stored before, restored by this run and missing after it."""
    with writer_lease(spark, table.path, f"restore-{run_id}"):
        before = table.read(spark)
        had = 0 if before is None else before.count()
        table.merge(valid, f"restore-{run_id}")
        after = table.read(spark).select(table.key)
        counts = valid.select(table.key).distinct().join(after.withColumn("there", F.lit(True)), table.key, "left").agg(
            F.count(F.lit(1)).alias("expected"), F.count_if(F.col("there").isNull()).alias("missing")
        )
        row, stored = counts.first(), after.count()
        return {"expected": row["expected"], "stored_before": had, "restored": stored - had, "missing": row["missing"]}
