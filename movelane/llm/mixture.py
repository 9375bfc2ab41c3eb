"""Mixing sources to target weights as a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]; its integral is the source's target share. The
documents of a source are laid end to end in a pseudo-random order; a document copy that begins at token c of that
line is due when the integrated schedule has asked for c tokens, so inverting the integral gives its position. Sorting
by position (a range partitioning) gives the training order.

The running sum of tokens is two-level: sums inside hash ranges, offsets of the ranges from their totals. No task ever
holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from movelane.llm.encode import token_counts
from movelane.session import cut_lineage

#: Documents per hash range; the number of ranges follows the corpus.
RANGE_ROWS = 20_000


def running_tokens(sized: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``sized`` (source, doc_id, tokens) with ``before``: tokens of the source's documents ahead in its random order."""
    ranges = max(1, -(-sized.count() // range_rows))
    rows = sized.withColumn("h", F.xxhash64(F.lit("order"), "source", "doc_id")).withColumn("range", F.floor((F.col("h") / 2.0**64 + 0.5) * ranges).cast("long"))
    totals = rows.groupBy("source", "range").agg(F.sum("tokens").alias("total"))
    offsets = totals.withColumn("offset", F.sum("total").over(Window.partitionBy("source").orderBy("range")) - F.col("total")).drop("total")
    inside = Window.partitionBy("source", "range").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return summed.join(offsets, ["source", "range"]).select("source", "doc_id", "tokens", (F.col("offset") + F.col("inside")).alias("before"))


def slopes(targets: DataFrame, strength: float = 1.0) -> DataFrame:
    """``targets`` with the slope of each source's schedule share * (1 + slope * (2t - 1)).

    Slopes weighted by share sum to zero, so the weights of a plan sum to one at every t: large sources come early,
    small ones late. ``strength`` in [0, 1] scales them; 0 is a constant mixture.
    """
    plan = targets.groupBy("plan").agg(F.sum(F.col("target_share") * F.col("target_share")).alias("square"), F.max("target_share").alias("largest"))
    raw = 1 - F.col("target_share") / F.col("square")
    steepest = F.greatest(F.lit(1.0), F.col("largest") / F.col("square") - 1)
    return targets.join(plan, "plan").withColumn("slope", F.when(F.col("square") > 0, F.lit(float(strength)) * raw / steepest).otherwise(F.lit(0.0))).drop("square", "largest")


def due_time(fraction: Column, slope: Column) -> Column:
    """t at which the integral t + slope * (t^2 - t) of a schedule of total 1 reaches ``fraction``."""
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), fraction))
    b = 1 - slope
    root = F.sqrt(F.greatest(F.lit(0.0), b * b + 4 * slope * bounded))
    # This form of the solution has no cancellation and covers slope 0.
    return F.when(b + root > 0, 2 * bounded / (b + root)).otherwise(bounded)


def clean_targets(targets: DataFrame) -> DataFrame:
    """One row per plan and source with a share; repeated rows count once, missing limits mean 1, missing factors 1."""
    rows = targets.filter("plan is not null and source is not null and target_share > 0")
    return rows.groupBy("plan", "source").agg(F.max("target_share").alias("target_share"), F.greatest(F.lit(0), F.coalesce(F.max("max_repeats"), F.lit(1))).alias("max_repeats"), F.coalesce(F.max("size_factor"), F.lit(1.0)).alias("size_factor"))


def demands(sized: DataFrame, targets: DataFrame, strength: float = 1.0) -> DataFrame:
    """Per plan and source: tokens available, wanted, and planned within the repeat limit."""
    available = sized.groupBy("source").agg(F.sum("tokens").alias("available"), F.count("*").alias("documents"))
    corpus = available.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("corpus"))
    rows = slopes(clean_targets(targets), strength).join(available, "source", "left").join(F.broadcast(corpus), F.lit(True))
    wanted = F.col("target_share") * F.col("size_factor") * F.col("corpus")
    return rows.select("plan", "source", "target_share", "max_repeats", "slope", F.coalesce("available", F.lit(0)).alias("available"), wanted.alias("wanted"), F.least(wanted, F.col("max_repeats") * F.coalesce("available", F.lit(0)).cast("double")).alias("planned"))


def sized_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(source, doc_id, tokens) of the documents that have a source and at least one token, written once for all uses."""
    texts = documents.filter("source is not null and doc_id is not null").select("doc_id", "source", "text").dropDuplicates(["doc_id"])
    return cut_lineage(texts.select("doc_id", "source").join(token_counts(texts, path), "doc_id").select("source", "doc_id", "tokens"))


def assign_positions(sized: DataFrame, targets: DataFrame, strength: float = 1.0) -> DataFrame:
    """(plan, source, doc_id, copy, tokens, position) of every document copy in use, not yet sorted.

    A source's copies are taken in passes over its documents until its planned tokens are reached (within one document);
    ``position`` is the time in [0, 1] at which the copy is due.
    """
    plan = demands(sized, targets, strength).filter("planned > 0").select("plan", "source", "slope", "available", "planned")
    rows = running_tokens(sized).join(plan, "source")
    passes = F.ceil((F.col("planned") - F.col("before")) / F.col("available")).cast("int")
    copies = rows.filter("before < planned").withColumn("copy", F.explode(F.sequence(F.lit(0), passes - 1)))
    start = F.col("copy") * F.col("available") + F.col("before")
    return copies.select("plan", "source", "doc_id", "copy", "tokens", due_time(start / F.col("planned"), F.col("slope")).alias("position"))


def training_order(documents: DataFrame, targets: DataFrame, path: str | None = None, strength: float = 1.0) -> DataFrame:
    """The copies of ``assign_positions`` in training order: by plan and position, ties by source, document and copy.

    Documents without a text or source are never used; a plan whose sources have no texts has no rows.
    """
    sized = sized_documents(documents, path)
    return assign_positions(sized, targets, strength).orderBy("plan", "position", "source", "doc_id", "copy")


def mixture_report(documents: DataFrame, targets: DataFrame, path: str | None = None, strength: float = 1.0) -> DataFrame:
    """Per plan and source: target share, tokens available, wanted and used, copies, repeats, and the share reached."""
    sized = sized_documents(documents, path)
    used = assign_positions(sized, targets, strength).groupBy("plan", "source").agg(F.sum("tokens").alias("used"), F.count("*").alias("copies"), (F.max("copy") + 1).alias("repeats"))
    rows = demands(sized, targets, strength).join(used, ["plan", "source"], "left").na.fill({"used": 0, "copies": 0, "repeats": 0})
    total = Window.partitionBy("plan")
    share = F.when(F.sum("used").over(total) > 0, F.col("used") / F.sum("used").over(total)).otherwise(F.lit(0.0))
    return rows.select("plan", "source", "target_share", "available", F.round("wanted").cast("long").alias("wanted"), "used", "copies", "repeats", "max_repeats", share.alias("actual_share"))
