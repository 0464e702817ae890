"""Tables laid out by entity, of which a job reads and replaces the touched buckets only.

Layout under one folder: ``data/<label>/bucket=<b>`` holds rows by hash of the entity's key, ``marks/<n>.json`` says
which labels each live bucket consists of, in the order in which they came. A mark is created exclusively and last: readers see
the state before a change or the one after it, a change that died half way is run again under its label, and of two
writers at once one fails. A bucket that a change does not touch keeps its files.

An append adds a label to the buckets it has rows for; a replacement makes its label the only one of the touched
buckets. A label that is in a mark already has been applied, and applying it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustflow.sources import store


@dataclass(frozen=True)
class EntityTable:
    path: str
    key: str
    buckets: int = 256

    def bucket(self):
        """Rows without an entity are in a bucket like any other."""
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def state(self, spark: SparkSession) -> dict | None:
        """The last mark: number, live (labels of each bucket), applied (labels) and schema; None before the first change."""
        store.make_dirs(spark, f"{self.path}/marks")
        marks = store.data_files(spark, f"{self.path}/marks")
        return store.read_json(spark, f"{self.path}/marks/{max(marks)}") if marks else None

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' entities: at most ``buckets`` numbers come to the driver."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of all buckets or of the given ones; None before the first change."""
        state = self.state(spark)
        if state is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        wanted = sorted(map(int, state["live"])) if buckets is None else buckets
        paths = [f"{self.path}/data/{x}/bucket={b}" for b in wanted for x in state["live"].get(str(b), [])]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def append(self, rows: DataFrame, label: str) -> list[int]:
        """Adds rows; returns the buckets that they are in."""
        return self._change(rows, label, None)

    def replace(self, rows: DataFrame, buckets: list[int], label: str) -> list[int]:
        """Makes ``rows`` all that the given buckets hold. Rows of other buckets are an error."""
        return self._change(rows, label, buckets)

    def compact(self, spark: SparkSession, label: str, most: int = 8) -> list[int]:
        """Rewrites the buckets that consist of more than ``most`` labels."""
        state = self.state(spark)
        long = sorted(int(b) for b, labels in state["live"].items() if len(labels) > most) if state else []
        return self.replace(self.read(spark, long), long, label) if long else []

    def clear(self, spark: SparkSession) -> None:
        """Deletes buckets that no mark needs any more and all marks but the last. Run it when readers of earlier marks have ended."""
        state = self.state(spark)
        if state is None:
            return
        for label in store.data_files(spark, f"{self.path}/data"):
            if label not in state["applied"]:
                continue  # of a change that is being written or died
            held = [x for x in store.data_files(spark, f"{self.path}/data/{label}") if x.startswith("bucket=")]
            gone = [x for x in held if label not in state["live"].get(x.removeprefix("bucket="), [])]
            for x in gone if len(gone) < len(held) else [""]:
                store.delete(spark, f"{self.path}/data/{label}/{x}")
        for mark in sorted(store.data_files(spark, f"{self.path}/marks"))[:-1]:
            store.delete(spark, f"{self.path}/marks/{mark}")

    def _change(self, rows: DataFrame, label: str, replaced: list[int] | None) -> list[int]:
        spark = rows.sparkSession
        state = self.state(spark) or {"number": 0, "live": {}, "applied": {}, "schema": None}
        if label in state["applied"]:
            return state["applied"][label]
        place = f"{self.path}/data/{label}"
        (
            rows.withColumn("bucket", self.bucket())
            .repartition("bucket")
            .sortWithinPartitions("bucket", self.key)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(place)
        )
        held = sorted(int(x.removeprefix("bucket=")) for x in store.data_files(spark, place) if x.startswith("bucket="))
        if replaced is not None and not set(held) <= set(replaced):
            raise ValueError(f"{label} has rows of buckets that it does not replace: {sorted(set(held) - set(replaced))}")
        live = {b: labels for b, labels in state["live"].items() if replaced is None or int(b) not in replaced}
        live.update({str(b): [*live.get(str(b), []), label] for b in held})
        buckets = held if replaced is None else sorted(replaced)
        number = state["number"] + 1
        mark = {
            "number": number,
            "live": live,
            "applied": {**state["applied"], label: buckets},
            "schema": state["schema"] or rows.schema.jsonValue(),
        }
        store.create_json(spark, f"{self.path}/marks/{number:012d}.json", mark)
        return buckets


def rebuild(events: EntityTable, facts: EntityTable, affected: DataFrame, build: Callable[[DataFrame], DataFrame], label: str) -> list[int]:
    """Builds the facts of the affected entities anew from their whole history and replaces the buckets they are in.

    ``affected`` has the entity key as a column; both tables share key and number of buckets. Other entities of a touched bucket
    keep their rows, untouched buckets are neither read nor written. An entity that has no events any more loses its
    fact. Returns the buckets that were replaced."""
    if (events.key, events.buckets) != (facts.key, facts.buckets):
        raise ValueError("Events and facts must be laid out alike")
    spark = affected.sparkSession
    ids = affected.select(facts.key).where(F.col(facts.key).isNotNull()).distinct()
    buckets = facts.touched(ids)
    history, kept = events.read(spark, buckets), facts.read(spark, buckets)
    if not buckets or history is None:
        return []
    rows = build(history.join(ids, facts.key, "left_semi"))
    if kept is not None:
        rows = kept.join(ids, facts.key, "left_anti").unionByName(rows)
    return facts.replace(rows, buckets, label)
