"""Sinks, run keeping and maintenance as set operations: every write is the next state of a table.

Nothing is updated in place. Each function takes the current table and returns the next one (or the rows to append), so
that a rerun gives the same rows and a failed write leaves the old table whole.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from movelane.functions.names import name_hash


def insert_absent(current: DataFrame, batch: DataFrame, key: str, first_by: list[str]) -> DataFrame:
    """The rows of ``batch`` to append: one per key, the first by ``first_by``, where ``current`` has none of that key.

    Rows with a null key are never taken.
    """
    one = batch.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*[c for c in batch.columns if c != key]), F.struct(*first_by)).alias("r"))
    return one.join(current.select(key).distinct(), key, "left_anti").select(key, "r.*").select(*batch.columns)


def upsert(current: DataFrame, batch: DataFrame, key: str, replace: list[str], keep: list[str]) -> DataFrame:
    """The next table: ``replace`` columns from the batch where it has the key, ``keep`` columns only where still null."""
    old = current.select(key, *[F.col(c).alias(f"o_{c}") for c in replace + keep], F.lit(True).alias("o"))
    new = batch.select(key, *[F.col(c).alias(f"n_{c}") for c in replace + keep], F.lit(True).alias("n"))
    both = old.join(new, key, "full")
    pick = [F.when(F.col("n"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in replace] + [F.coalesce(f"o_{c}", f"n_{c}").alias(c) for c in keep]
    return both.select(key, *pick)


def deactivate_missing(current: DataFrame, register: DataFrame, key: str, flag: str = "active") -> DataFrame:
    """The next table: rows whose key the register lacks are inactive, none is deleted."""
    listed = register.select(key).distinct().withColumn("_listed", F.lit(True))
    return current.join(listed, key, "left").withColumn(flag, F.col(flag) & F.col("_listed").isNotNull()).select(*current.columns)


def due(sources: DataFrame, last_polled: DataFrame, now: Column) -> DataFrame:
    """(slug, last_at): active sources never polled, or polled longer ago than their interval; the never polled first."""
    rows = sources.filter("active").join(last_polled, "slug", "left")
    late = F.col("last_at").isNull() | (F.unix_seconds("last_at") + F.coalesce("hours", F.lit(24)) * 3600 <= F.unix_seconds(now))
    return rows.filter(late).select("slug", "last_at").orderBy(F.asc_nulls_first("last_at"), "slug")


def empty_streaks(runs: DataFrame, key: str = "campaign_id") -> DataFrame:
    """(key, streak): how many runs in a row, up to the last, brought nothing; runs that were skipped don't count."""
    counted = runs.filter("status <> 'running'")
    last_yield = counted.groupBy(key).agg(F.max(F.when(F.col("items_fetched") > 0, F.col("started_at"))).alias("last_yield"))
    return counted.join(last_yield, key).groupBy(key).agg(F.count_if((F.col("items_fetched") <= 0) & (F.col("last_yield").isNull() | (F.col("started_at") > F.col("last_yield")))).alias("streak"))


def catch_up_start(runs: DataFrame, now: Column, overlap_days: int = 14, horizon_days: int = 90) -> DataFrame:
    """One row (since): the last success less the overlap, or the horizon before now if nothing ever succeeded."""
    return runs.filter("status = 'succeeded'").agg(F.max("started_at").alias("last")).select(F.coalesce(F.col("last") - F.make_dt_interval(F.lit(overlap_days)), now - F.make_dt_interval(F.lit(horizon_days))).alias("since"))


def erase(tables: dict[str, DataFrame], person: DataFrame, key: str, owned: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The next tables without the rows of a person, and (table, erased) counts for the log.

    ``person`` has the keys to erase; ``owned`` names the column of each table that holds the key. Other rows stay.
    """
    after, counts = {}, []
    for name, frame in tables.items():
        column = owned[name]
        gone = person.select(F.col(key).alias(column)).distinct()
        after[name] = frame.join(gone, column, "left_anti")
        counts.append(frame.join(gone, column, "left_semi").agg(F.count("*").alias("erased")).select(F.lit(name).alias("table"), "erased"))
    log = counts[0]
    for part in counts[1:]:
        log = log.unionByName(part)
    return after, log


def erase_person(person: DataFrame, people: DataFrame, moves: DataFrame, evidence: DataFrame, links: DataFrame, tombstones: DataFrame, salt: str, reason: str, actor: str) -> dict[str, DataFrame]:
    """The next state of every table after the people in ``person`` (person_id) are erased, and the row to log.

    ``people`` is (person_id, canonical_name, name_variants), ``moves`` has move_id, person_id, superseded_by, merged_at and
    review_state, ``evidence`` and ``links`` move_id, ``tombstones`` (name_hash, reason, actor). Links of supersession into
    the erased moves are broken and those moves rejected; what stays of a person is a salted hash of each spelling. The
    log counts and names nobody; without a person it counts nothing.
    """
    gone = person.select("person_id").distinct()
    dead = moves.join(gone, "person_id", "left_semi").select("move_id")
    into = dead.select(F.col("move_id").alias("superseded_by"), F.lit(True).alias("_dead"))
    kept = moves.join(gone, "person_id", "left_anti").join(into, "superseded_by", "left")
    broken = F.coalesce("_dead", F.lit(False))
    changed = {"superseded_by": F.when(~broken, F.col("superseded_by")), "merged_at": F.when(~broken, F.col("merged_at")), "review_state": F.when(broken, "rejected").otherwise(F.col("review_state"))}
    kept = kept.select(*[changed.get(c, F.col(c)).alias(c) for c in moves.columns])
    names = people.join(gone, "person_id", "left_semi").select(F.explode(F.concat(F.array("canonical_name"), F.coalesce("name_variants", F.array().cast("array<string>")))).alias("n")).filter(F.trim("n") != "")
    hashes = names.select(name_hash(F.col("n"), salt).alias("name_hash")).distinct().join(tombstones.select("name_hash"), "name_hash", "left_anti")
    count = lambda rows, name: rows.agg(F.count("*").alias(name))
    one = F.lit(True)
    log = count(dead, "moves_deleted").join(count(evidence.join(dead, "move_id", "left_semi"), "evidence_deleted"), one).join(count(links.join(dead, "move_id", "left_semi"), "sources_unlinked"), one)
    return {
        "people": people.join(gone, "person_id", "left_anti"), "moves": kept, "evidence": evidence.join(dead, "move_id", "left_anti"), "links": links.join(dead, "move_id", "left_anti"),
        "tombstones": tombstones.unionByName(hashes.select("name_hash", F.lit(reason).alias("reason"), F.lit(actor).alias("actor"))), "log": log.select(F.lit(actor).alias("actor"), F.lit(reason).alias("reason"), "*"),
    }


def load_taxonomy(versions: DataFrame, nodes: DataFrame, version: str) -> DataFrame:
    """The next table of versions (version, checksum, is_current) after ``nodes`` (code, name) are loaded as ``version``.

    A version is immutable: loading it again with the same nodes changes nothing, with other nodes raises. A new version
    becomes the only current one. Nodes are a fixed list; their checksum is read by the driver.
    """
    checksum = nodes.agg(F.md5(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "code", "name"))), "|")).alias("c")).first().c
    known = versions.filter(F.col("version") == version).select("checksum").first()
    if known is not None:
        if known.checksum != checksum:
            raise ValueError(f"version {version} is loaded with other content; released versions don't change")
        return versions
    fresh = versions.sparkSession.createDataFrame([(version, checksum, True)], "version string, checksum string, is_current boolean")
    return versions.withColumn("is_current", F.lit(False)).unionByName(fresh)


class RunLedger:
    """A log of runs in a folder: a run is opened when it starts and always closed, with its status and counters.

    ``with ledger.run("ingest", campaign) as counts: counts["items_fetched"] = 3`` appends two entries; an error closes the
    run as failed and goes on.
    """

    SCHEMA = "run_id string, campaign_id long, stage string, status string, started_at timestamp, finished_at timestamp, items_fetched int, items_unchanged int, errors int, logged_at timestamp"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _log(self, *row) -> None:
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    @contextlib.contextmanager
    def run(self, stage: str, campaign: int | None = None):
        ident, started, counts = uuid.uuid4().hex, dt.datetime.now(), {"items_fetched": 0, "items_unchanged": 0, "errors": 0}
        self._log(ident, campaign, stage, "running", started, None, 0, 0, 0, started)
        status = "failed"
        try:
            yield counts
            status = "succeeded"
        except BaseException:
            counts["errors"] += 1
            raise
        finally:
            now = dt.datetime.now()
            self._log(ident, campaign, stage, status, started, now, counts["items_fetched"], counts["items_unchanged"], counts["errors"], now)


def orphans(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents that no child refers to any more."""
    return parents.join(children.select(key).distinct(), key, "left_anti")


def run_state(log: DataFrame) -> DataFrame:
    """The current state of each run: its last entry."""
    order = Window.partitionBy("run_id").orderBy(F.desc("logged_at"))
    return log.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
