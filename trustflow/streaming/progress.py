"""Progress of streaming queries as a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from trustflow.sources import store

PROGRESS_DDL = (
    "query_id STRING, run_id STRING, name STRING, batch_id BIGINT, input_rows BIGINT, "
    "start_offset STRING, end_offset STRING, watermark STRING, dropped_by_watermark BIGINT, reported_at STRING"
)
NAMES = tuple(c.split()[0] for c in PROGRESS_DDL.split(", "))


def _row(p: dict) -> dict:
    sources = p.get("sources", [])
    values = (
        str(p["id"]),
        str(p["runId"]),
        p.get("name"),
        p["batchId"],
        p["numInputRows"],
        json.dumps([s.get("startOffset") for s in sources]),
        json.dumps([s.get("endOffset") for s in sources]),
        p.get("eventTime", {}).get("watermark"),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", [])),
        p.get("timestamp"),
    )
    return dict(zip(NAMES, values, strict=True))


class ProgressLog(StreamingQueryListener):
    """Appends every progress report to an ops folder, one small file each, named by run and report.

    A query itself keeps its last reports only; sums over a long run come from here.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.count = spark, path.rstrip("/"), 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = _row(json.loads(event.progress.json))
        self.count += 1
        store.create_text(self.spark, f"{self.path}/{row['run_id']}-{self.count:09d}.json", json.dumps(row) + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_log(spark: SparkSession, path: str) -> ProgressLog:
    """From now on all queries of the session are logged; ``spark.streams.removeListener`` ends it."""
    store.make_dirs(spark, path)
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log


# Layout of an ops folder: reports as ``<report>.json``, tables of folded reports by date under ``_parts/<part>``, and a
# mark ``_marks/<part>.json`` created last, which says that the part is whole and which earlier parts it replaces.
_STORED = f"{PROGRESS_DDL}, report STRING"
MAX_PARTS = 8


def _marks(spark: SparkSession, path: str) -> dict[str, list[str]]:
    folder = f"{path}/_marks"
    if not store.exists(spark, folder):
        return {}
    names = [n.removesuffix(".json") for n in store.data_files(spark, folder)]
    return {n: store.read_json(spark, f"{folder}/{n}.json")["replaces"] for n in names}


def _live(marks: dict[str, list[str]]) -> list[str]:
    gone = {old for replaced in marks.values() for old in replaced}
    return sorted(marks.keys() - gone)


def _folded(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    ddl = f"{_STORED}, report_date STRING"
    if not parts:
        return spark.createDataFrame([], ddl)
    frames = [spark.read.schema(ddl).parquet(f"{path}/_parts/{p}") for p in parts]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _reports(spark: SparkSession, path: str) -> DataFrame:
    """Whole reports of the folder. One that is still being written has no line end and does not count yet."""
    lines = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
    text = lines.where(F.col("value").endswith("\n")).select(
        F.from_json("value", PROGRESS_DDL).alias("r"), F.col("_metadata.file_name").alias("report")
    )
    return text.select("r.*", "report")


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every report once: folded ones from the parts, the others from their files."""
    path = path.rstrip("/")
    parts = _live(_marks(spark, path))
    folded = _folded(spark, path, parts).drop("report_date")
    fresh = _reports(spark, path)
    if parts:
        # A report whose file outlived its folding, or is folded right now, counts once.
        fresh = fresh.join(folded.select("report"), "report", "left_anti").select(*folded.columns)
    return fresh.unionByName(folded).drop("report")


def compact(spark: SparkSession, path: str, part: str) -> int:
    """Folds the reports that are there into date partitions and gives their number. One writer at a time.

    Reports that arrive meanwhile stay for the next time. The part is read by nobody before its mark is there, and files go
    only after it, so a run that dies loses and doubles nothing; a part name is used once. From ``MAX_PARTS``
    parts on all are folded into one, so files stay bounded by dates.
    """
    path = path.rstrip("/")
    marks = _marks(spark, path)
    if part in marks:
        raise ValueError(f"Part {part} was already made")
    parts = _live(marks)
    held = _folded(spark, path, parts)
    names = [n for n in store.data_files(spark, path) if n.endswith(".json")]
    if names:
        rows = _reports(spark, path)
        rows = rows.withColumn("report_date", F.coalesce(F.substring("reported_at", 1, 10), F.lit("unknown")))
        rows = rows.join(held.select("report"), "report", "left_anti").select(*held.columns)
        replaces = parts if len(parts) + 1 > MAX_PARTS else []
        if replaces:
            rows = rows.unionByName(held)
        target = f"{path}/_parts/{part}"
        rows.repartition("report_date").write.mode("overwrite").partitionBy("report_date").parquet(target)
        store.make_dirs(spark, f"{path}/_marks")
        store.create_json(spark, f"{path}/_marks/{part}.json", {"replaces": replaces})
        parts = _live(_marks(spark, path))
    # Only files that a marked part holds go, also those that an earlier run left behind.
    there = spark.createDataFrame([(n,) for n in names], "report STRING")
    done = [r.report for r in _folded(spark, path, parts).join(there, "report", "left_semi").select("report").distinct().collect()]
    store.delete_all(spark, path, done)
    for old in {o for replaced in _marks(spark, path).values() for o in replaced}:
        store.delete(spark, f"{path}/_parts/{old}")
    return len(done)


def dropped_by_watermark(spark: SparkSession, path: str) -> DataFrame:
    """Rows that each query's watermark dropped, over all its runs and batches."""
    return progress_rows(spark, path).groupBy("query_id", "name").agg(
        F.sum("dropped_by_watermark").alias("dropped_by_watermark"), F.count("*").alias("reports")
    )
