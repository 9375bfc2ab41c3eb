"""Best representative of each duplicate group, field by field.

The surviving value of a field comes from the record of the highest authority that states it: trust (tier) before
confidence before currency. Currency is the latest timestamp where there is one. Where timestamps are missing,
``currency_ranks`` reasons: it learns from timestamped records which value of a field follows which, builds the partial
order of the values that meet in a group, and ranks each value by its place in that order.

Each choice is a ``min_by`` over a struct: partial aggregation, no window, no sort, a hot group is combined map-side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Texts that only say a value is missing, after trimming and lower-casing.
MISSING = [
    "n/a", "na", "n.a.", "n.a", "none", "none given", "null", "nil", "nan", "unknown", "not known", "undisclosed",
    "not disclosed", "not stated", "not given", "not specified", "unspecified", "not available", "not provided",
    "unavailable", "to be confirmed", "tbc", "to be announced", "tba", "tbd", "not applicable", "no information",
    "missing", "unstated", "withheld", "confidential", "not reported", "unreported", "keine angabe", "k.a.", "non communiqué",
    "inconnu", "desconocido", "unbekannt", "未知", "不详",
]


def is_stated(value: Column, quality: Column) -> Column:
    """True unless ``value`` is null, blank, only marks, a phrase that says it is missing, or of quality dropped."""
    text = F.lower(F.regexp_replace(value, r"(?U)^[\s.\[\](){}<>*'\"]+|[\s.\[\](){}<>*'\"!]+$", ""))
    bare = F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    word = value.rlike(r"[\p{L}\p{N}]")
    return value.isNotNull() & word & ~text.isin(MISSING) & ~bare.isin(MISSING) & ~F.coalesce(F.lower(F.trim(quality)) == "dropped", F.lit(False))


def tiers(sources: DataFrame) -> DataFrame:
    """slug, tier by the highest register_version of each slug."""
    version = F.struct("register_version", "notes")
    return sources.filter(F.col("config.slug").isNotNull()).groupBy(F.col("config.slug").alias("slug")).agg(F.max_by(F.struct("config.reliability_tier"), version).alias("s")).select("slug", F.col("s.reliability_tier").alias("tier"))


def stated_fields(moves: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per group, field and move that states it, with the move's authority; moves without a group are left out."""
    grouped = moves.filter("group_ref is not null and fields is not null").select(
        "group_ref", "move_id", "source_slug", "extracted_at",
        F.when(F.col("self_confidence") > 1, F.col("self_confidence") / 100).otherwise(F.col("self_confidence")).alias("confidence"),
        F.explode("fields").alias("field_name", "field"),
    )
    stated = grouped.filter(is_stated(F.col("field.value"), F.col("field.quality")))
    return stated.join(tiers(sources).withColumnRenamed("slug", "source_slug"), "source_slug", "left").select("group_ref", "field_name", "move_id", F.col("field.value").alias("value"), "tier", "confidence", "extracted_at")


def transitions(stated: DataFrame) -> DataFrame:
    """(field_name, older, newer, weight): how much more often ``newer`` followed ``older`` than the reverse.

    Learned from all groups whose records carry timestamps: neighbours in time of one group and field.
    """
    dated = stated.filter("extracted_at is not null").groupBy("group_ref", "field_name", "value").agg(F.min("extracted_at").alias("first_at"))
    order = Window.partitionBy("group_ref", "field_name").orderBy("first_at", "value")
    steps = dated.select("field_name", F.lag("value").over(order).alias("older"), F.col("value").alias("newer")).filter("older is not null")
    signed = steps.select("field_name", F.least("older", "newer").alias("x"), F.greatest("older", "newer").alias("y"), F.when(F.col("older") < F.col("newer"), 1).otherwise(-1).alias("n"))
    net = signed.groupBy("field_name", "x", "y").agg(F.sum("n").alias("n")).filter("n <> 0")
    return net.select("field_name", F.when(F.col("n") > 0, F.col("x")).otherwise(F.col("y")).alias("older"), F.when(F.col("n") > 0, F.col("y")).otherwise(F.col("x")).alias("newer"), F.abs("n").alias("weight"))


def chain_depths(edges: list[tuple[str, str]]) -> dict[str, int]:
    """The longest chain of (older, newer) that ends in each value; the values of one cycle count as one and tie."""
    after, before = defaultdict(list), defaultdict(list)
    for older, newer in edges:
        after[older].append(newer)
        before[newer].append(older)
    # Kosaraju, without recursion: by falling time of finish, components come in topological order.
    finished, seen = [], set()
    for root in sorted({*after, *before}):
        stack = [] if root in seen else [(root, iter(after[root]))]
        seen.add(root)
        while stack:
            value, following = stack[-1]
            step = next((x for x in following if x not in seen), None)
            if step is None:
                finished.append(stack.pop()[0])
            else:
                seen.add(step)
                stack.append((step, iter(after[step])))
    depth: dict[str, int] = {}
    for root in reversed(finished):
        if root in depth:
            continue
        members, todo = {root}, [root]
        while todo:
            for x in before[todo.pop()]:
                if x not in depth and x not in members:
                    members.add(x)
                    todo.append(x)
        level = max((depth[x] + 1 for m in members for x in before[m] if x not in members), default=0)
        depth |= dict.fromkeys(members, level)
    return depth


def currency_ranks(values: DataFrame, precedence: DataFrame) -> DataFrame:
    """(group_ref, field_name, value, depth): the longest chain of learned precedences that ends in ``value``.

    Only values that meet in a group take part, so depth 0 is a value that nothing in its group precedes. Chains may be of
    any length; the values of a cycle stay a tie, settled by the caller's next key. The order is sequential, so the
    edges of one group and field are walked in Python: these are the learned pairs among its distinct values, however many
    rows it has, and have to fit in a task.
    """
    values = values.select("group_ref", "field_name", "value").distinct()
    edges = (
        values.withColumnRenamed("value", "newer")
        .join(precedence, ["field_name", "newer"])
        .join(values.withColumnRenamed("value", "older"), ["group_ref", "field_name", "older"])
        .select("group_ref", "field_name", "older", "newer")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A batch holds many groups; each is walked by itself.
        for batch in batches:
            groups, fields, lists = (batch.column(i).to_pylist() for i in range(3))
            rows = [(g, f, value, depth) for g, f, e in zip(groups, fields, lists) for value, depth in chain_depths([(x["older"], x["newer"]) for x in e]).items()]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int32()))], ["group_ref", "field_name", "value", "depth"])

    lists = edges.groupBy("group_ref", "field_name").agg(F.collect_set(F.struct("older", "newer")).alias("e"))
    depth = lists.mapInArrow(walk, "group_ref long, field_name string, value string, depth int")
    return values.join(depth, ["group_ref", "field_name", "value"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))


def surviving_values(moves: DataFrame, sources: DataFrame) -> DataFrame:
    """(group_ref, field_name, move_id, value): the value that survives per group and field.

    Order: lowest tier (null or unregistered last), highest confidence (percentages as fractions, null last), latest
    extracted_at, for records without one the topologically latest value, smallest move_id. Groups in which no record
    states a field give no row for it.
    """
    stated = stated_fields(moves, sources)
    # Currency is reasoned out where a record without a timestamp takes part, from what all timestamped records teach.
    undated = stated.filter("extracted_at is null")
    meeting = stated.join(undated.select("group_ref", "field_name").distinct(), ["group_ref", "field_name"], "left_semi")
    ranks = currency_ranks(meeting, transitions(stated))
    ranked = undated.join(ranks, ["group_ref", "field_name", "value"], "left").unionByName(stated.filter("extracted_at is not null").withColumn("depth", F.lit(0)))
    authority = F.struct(
        F.coalesce("tier", F.lit(2**31 - 1)), -F.coalesce("confidence", F.lit(-1.0)), -F.coalesce(F.unix_micros("extracted_at"), F.lit(-(2**62))), -F.coalesce("depth", F.lit(0)), F.col("move_id")
    )
    return ranked.groupBy("group_ref", "field_name").agg(F.min_by(F.struct("move_id", "value"), authority).alias("s")).select("group_ref", "field_name", "s.move_id", "s.value")
