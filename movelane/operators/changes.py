"""Processing only new or changed records: log-based change capture.

A log is cut into partitions (campaigns); inside one, offsets order the rows. A batch is a plan of offset ranges that is
written ahead of the work. ``DurableBatches`` replays the plan of a batch that died, and its sink takes a (key, offset)
once. Two things run on it: ``ingested_by_run``, whose ranges come from the run log and whose offsets are arrivals, and
``IncrementalReader``, whose offsets are positions in a ``ChangeLog``, so that a row written late is never passed over,
whatever time it bears.

Skew: versions of a record are neighbours in one global sort, cut into ranges of equal size wherever a range ends, so a
url that holds a third of all rows is spread over as many tasks as its rows need. Ranges meet records on (campaign,
day), an equi-join that AQE can split.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from movelane.session import cut_lineage, exists, files_of, scratch_path, shared_folder

MICROS_PER_DAY = 86_400_000_000


def latest_entries(log: DataFrame, key: str, version: str) -> DataFrame:
    """The row of each ``key`` with the highest ``version`` (null lowest); rows without a key are dropped.

    Exact repeats collapse; rows that tie on ``version`` but differ are settled by their remaining columns.
    """
    rest = [c for c in log.columns if c not in (key, version)]
    best = F.max_by(F.struct(version, *rest), F.struct(F.col(version).isNotNull(), F.col(version), *[F.col(c).cast("string") for c in rest]))
    return log.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("__r")).select(key, "__r.*")


def batch_plan(runs: DataFrame, stage: str = "ingest", done: str = "succeeded") -> DataFrame:
    """(campaign_id, run_id, after, until): what each successful run has to take; ``after`` is null for the first one.

    A run counts by its last entry. Runs without a start or campaign take nothing. Runs of one campaign that start in
    the same instant are ordered by run_id; the later ones get an empty range.
    """
    last = latest_entries(runs.select("run_id", "campaign_id", "stage", "status", "started_at", "logged_at"), "run_id", "logged_at")
    good = last.filter((F.col("stage") == stage) & (F.col("status") == done) & F.col("started_at").isNotNull() & F.col("campaign_id").isNotNull())
    order = Window.partitionBy("campaign_id").orderBy("started_at", "run_id")
    return good.select("campaign_id", "run_id", F.lag("started_at").over(order).alias("after"), F.col("started_at").alias("until"))


_RUN_SCHEMA = "p long, k string, h0 boolean, h1 long, h2 int, at timestamp, id long, edge boolean, is_first boolean, changed boolean"


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks, in rows sorted by (p, k, at, id), those that differ from the row before; the ends of a partition are edges.

    One batch and one row are held at a time. The first row of a partition is not judged here.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.array(batch.column(i).to_pylist(), dtype=object) for i in range(5)]
        n = batch.num_rows
        before = [np.concatenate([[None if last is None else last[i]], c[:-1]]) for i, c in enumerate(columns)]
        same_key = (columns[0] == before[0]) & (columns[1] == before[1])
        same = (columns[2] == before[2]) & (columns[3] == before[3]) & (columns[4] == before[4])
        changed = ~(same_key & same).astype(bool)
        first = np.zeros(n, dtype=bool)
        if last is None:
            first[0], changed[0] = True, False
        else:
            yield _run_rows(held, np.array([True]), np.array([False]), np.array([False]))
        keep = np.flatnonzero(changed | first)
        held = batch.slice(n - 1, 1)
        last = [c[-1] for c in columns]
        if len(keep):
            yield _run_rows(batch.take(pa.array(keep)), first[keep], first[keep], changed[keep])
    if last is not None:
        yield _run_rows(held, np.array([True]), np.array([False]), np.array([False]))


def _run_rows(rows: pa.RecordBatch, edge, first, changed) -> pa.RecordBatch:
    names = [f.split()[0] for f in _RUN_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(x, pa.bool_()) for x in (edge, first, changed))], names)


def changed_since_previous(items: DataFrame, partition: str = "campaign_id", key: str = "url", at: str = "arrived_at", ident: str = "item_id", content: str = "content_hash") -> DataFrame:
    """(partition, ident, at) of the rows whose content differs from that of the row of the same key just before.

    The first row of a key counts as changed. Null keys and contents are values of their own; rows that arrive in the
    same instant are ordered by ``ident``. Rows without an arrival or partition have no place in this order and are left
    out (``unplaced`` lists them). Only the first and last row of each sorted range meet in one task, two per range.
    """
    rows = items.filter(F.col(at).isNotNull() & F.col(partition).isNotNull()).select(
        F.col(partition).cast("long").alias("p"), F.col(key).alias("k"), F.col(content).isNull().alias("h0"), F.xxhash64(F.col(content)).alias("h1"), F.hash(F.col(content)).alias("h2"), F.col(at).alias("at"), F.col(ident).alias("id")
    )
    order = ["p", "k", "at", "id"]
    judged = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_compare_neighbours, _RUN_SCHEMA))
    edges = judged.filter("edge")
    # A range that holds one row has it as both ends: its first end is judged, its last is what the next one meets.
    line = Window.orderBy(F.asc_nulls_first("p"), F.asc_nulls_first("k"), "at", "id", F.desc("is_first"))
    seen = F.struct("p", "k", "h0", "h1", "h2")
    first = edges.withColumn("v", seen).withColumn("before", F.lag("v").over(line)).filter("is_first").filter(~F.col("v").eqNullSafe(F.col("before")))
    out = judged.filter("changed").select("p", "id", "at").unionByName(first.select("p", "id", "at"))
    return out.select(F.col("p").alias(partition), F.col("id").alias(ident), F.col("at").alias(at))


def unplaced(items: DataFrame, partition: str = "campaign_id", at: str = "arrived_at") -> DataFrame:
    """(reason, rows): how many rows no run can ever take, because they bear no arrival or no partition."""
    reason = F.when(F.col(at).isNull(), "no arrival").when(F.col(partition).isNull(), "no partition")
    return items.select(reason.alias("reason")).filter("reason is not null").groupBy("reason").agg(F.count("*").alias("rows"))


def _day(column: Column) -> Column:
    return F.floor(F.unix_micros(column) / MICROS_PER_DAY)


def assign_batches(changes: DataFrame, plan: DataFrame, first_offset: DataFrame) -> DataFrame:
    """(run_id, item_id): each change in the one range (after, until] of its campaign that holds it.

    ``first_offset`` has the earliest arrival per campaign, where the range of a first run begins.
    """
    bounded = plan.join(first_offset, "campaign_id").withColumn("low", F.coalesce("after", "first_at"))
    ranges = bounded.filter("low <= until").select("campaign_id", "run_id", "after", "until", F.explode(F.sequence(_day(F.col("low")), _day(F.col("until")))).alias("day"))
    found = changes.withColumn("day", _day(F.col("arrived_at"))).join(ranges, ["campaign_id", "day"])
    return found.filter("(after is null or arrived_at > after) and arrived_at <= until").select("run_id", "item_id", "campaign_id", "arrived_at")


class DurableBatches:
    """Numbered batches in a folder: a plan written ahead, its replay after a failure, a sink that takes a row once.

    ``folder`` holds plans/, sink/ (by batch) and commits/. A batch is open from its plan to its commit; ``run`` goes on with
    the open one, on the plan that is there. The sink of a batch is overwritten by its replay; ``key`` tells rows apart.
    """

    def __init__(self, spark: SparkSession, folder: str, key: list[str]):
        self.spark, self.folder, self.key = spark, folder, key

    def committed(self) -> list[str]:
        files, where = files_of(self.spark, f"{self.folder}/commits")
        if not files.exists(where):
            return []
        return sorted(name for name in (s.getPath().getName() for s in files.listStatus(where)) if not name.startswith((".", "_")))

    def plan(self, batch: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/plans/{batch}")

    def last_plan(self) -> DataFrame | None:
        """The plan of the last committed batch."""
        done = self.committed()
        return self.plan(done[-1]) if done else None

    def _commit(self, batch: str) -> None:
        """A commit is written under a temporary name and renamed, so that readers see all of it or nothing."""
        files, draft = files_of(self.spark, f"{self.folder}/commits/.{batch}.{uuid.uuid4().hex}")
        stream = files.create(draft)
        stream.write(bytearray(json.dumps({"batch": batch, "at": dt.datetime.now(dt.timezone.utc).isoformat()}).encode()))
        stream.close()
        if not files.rename(draft, files_of(self.spark, f"{self.folder}/commits/{batch}")[1]):
            raise OSError(f"batch {batch} is committed already")

    def run(self, make_plan: Callable[[], DataFrame], work: Callable[[DataFrame], DataFrame], overlap: Callable[[DataFrame], Column] | None = None) -> DataFrame:
        """One batch: plan (made only if none is complete), work on the plan, sink, commit. Returns the batch's rows.

        ``overlap``, given the plan, says which rows of earlier batches this one could repeat; those are looked up by
        ``key`` and dropped. Without it batches are known to be disjoint.
        """
        batch = f"{len(self.committed()):08d}"
        if not exists(self.spark, f"{self.folder}/plans/{batch}/_SUCCESS"):
            make_plan().write.mode("overwrite").parquet(f"{self.folder}/plans/{batch}")
        plan = self.plan(batch)
        out = work(plan).dropDuplicates(self.key)
        done = self.committed()
        if overlap is not None and done:
            held = self.spark.read.parquet(*[f"{self.folder}/sink/batch={b}" for b in done]).filter(overlap(plan)).select(*self.key)
            out = out.join(held, self.key, "left_anti")
        sink = f"{self.folder}/sink/batch={batch}"
        out.write.mode("overwrite").parquet(sink)
        self._commit(batch)
        return self.spark.read.schema(out.schema).parquet(sink)


def ingested_by_run(raw_items: DataFrame, runs: DataFrame, folder: str | None = None) -> DataFrame:
    """(run_id, item_id): what each successful ingest run takes, whatever failed or was fetched in part between.

    One durable batch over the whole run log: its plan holds the offset ranges of all runs and is written before the log
    is read; if it dies, a call on the same ``folder`` replays that plan, and the sink holds each (run, item) once.
    Without a folder the batch is this call's own. Empty tables give no rows.
    """
    spark = raw_items.sparkSession
    batches = DurableBatches(spark, folder or scratch_path(spark), ["run_id", "item_id"])

    def work(plan: DataFrame) -> DataFrame:
        first = raw_items.filter("campaign_id is not null and arrived_at is not null").groupBy("campaign_id").agg(F.min("arrived_at").alias("first_at"))
        return assign_batches(changed_since_previous(raw_items), plan, first)

    return batches.run(lambda: batch_plan(runs), work).select("run_id", "item_id")


class ChangeLog:
    """An append-only log of segments, folder/segment=<n>; a row's offset is (segment, row), given when it is written.

    A segment appears whole or not at all, so readers never see half of one. Times in the rows play no part.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def segments(self) -> list[int]:
        files, where = files_of(self.spark, self.folder)
        if not files.exists(where):
            return []
        return sorted(int(name[8:]) for name in (s.getPath().getName() for s in files.listStatus(where)) if name.startswith("segment="))

    def append(self, rows: DataFrame) -> int:
        """Writes ``rows`` as the next segment; of two writers at once one raises and may try again."""
        number = (self.segments() or [-1])[-1] + 1
        draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
        rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(draft)
        files, at = files_of(self.spark, draft)
        target = files_of(self.spark, f"{self.folder}/segment={number:08d}")[1]
        if files.exists(target) or not files.rename(at, target):
            files.delete(at, True)
            raise OSError(f"segment {number} was written by someone else")
        return number

    def read(self, after: int, until: int) -> DataFrame | None:
        """The rows of the segments in (after, until], by path: no other segment is opened."""
        paths = [f"{self.folder}/segment={n:08d}" for n in self.segments() if after < n <= until]
        return self.spark.read.option("basePath", self.folder).parquet(*paths) if paths else None


class IncrementalReader:
    """Exactly-once batches of a ``ChangeLog``, with an offset of its own for each partition of the rows.

    A batch takes per partition the segments after the last one it has committed. Partitions may be null, which is one of
    its own; rows need no times. ``work`` must keep the columns segment and row.
    """

    def __init__(self, log: ChangeLog, folder: str | None = None, partition: str = "campaign_id"):
        self.log, self.partition = log, partition
        self.batches = DurableBatches(log.spark, folder or f"{shared_folder(log.spark)}/incremental", ["segment", "row"])

    def _plan(self) -> DataFrame:
        """(partition, after, until) of every partition known so far; only segments since the last plan are opened."""
        before = self.batches.last_plan()
        spark = self.log.spark
        start = -1 if before is None else before.agg(F.max("until")).first()[0]
        start = -1 if start is None else start
        fresh = self.log.read(start, (self.log.segments() or [-1])[-1])
        if fresh is None:
            return before.withColumn("after", F.col("until")) if before is not None else spark.createDataFrame([], f"{self.partition} long, after int, until int")
        top = fresh.groupBy(self.partition).agg(F.max("segment").cast("int").alias("until"))
        if before is None:
            return top.select(self.partition, F.lit(-1).alias("after"), "until")
        old = before.select(F.col(self.partition).alias("_p"), F.col("until").alias("_u"))
        both = top.join(old, F.col(self.partition).eqNullSafe(F.col("_p")), "full")
        name = F.when(F.col("until").isNotNull(), F.col(self.partition)).otherwise(F.col("_p"))
        return both.select(name.alias(self.partition), F.coalesce("_u", F.lit(-1)).alias("after"), F.coalesce("until", "_u").alias("until"))

    def run(self, work: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame | None:
        """One batch; None if the log never held a row."""
        if not self.log.segments():
            return None

        def read(plan: DataFrame) -> DataFrame:
            low, high = plan.filter("after < until").agg(F.min("after"), F.max("until")).first()
            rows = self.log.read(-2 if low is None else low, -1 if high is None else high)
            if rows is None:
                rows = self.log.read(-1, self.log.segments()[0]).limit(0)
            span = plan.select(F.col(self.partition).alias("_p"), "after", "until")
            mine = F.col(self.partition).eqNullSafe(F.col("_p")) & (F.col("segment") > F.col("after")) & (F.col("segment") <= F.col("until"))
            return work(rows.join(span, mine).drop("_p", "after", "until"))

        def overlap(plan: DataFrame) -> Column:
            low = plan.filter("after < until").agg(F.min("after")).first()[0]
            return F.lit(False) if low is None else F.col("segment") > low

        return self.batches.run(self._plan, read, overlap)
