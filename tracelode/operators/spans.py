"""Trace trees: where each span hangs, how long it worked itself, and what a trace waited for.

A span names its parent. The way to the root is found by pointer doubling: in every round each span that has not
arrived takes over what the span it points to points to, so a chain of a thousand spans needs ten rounds, and each round is one
equi join. What a path carries (its length, whether each step on it was the last to end) is combined on the way.

Spans that come twice count once (``dedupe`` by id, the first by start). A span whose parent is unknown is the root of its own tree,
``orphan``. Spans of a cycle, and those below it, have no root and no depth, ``cycle``. A span without an id is left out; one
without a start or duration takes no time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.functions.measures import count_if
from tracelode.operators.dedupe import keep_first
from tracelode.operators.sliced import Running, running
from tracelode.session import scratch_dir


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clean(spans: DataFrame) -> DataFrame:
    """span_id, parent_id, start and end in milliseconds, is_retry; one row a span."""
    start = F.coalesce("start_ms", F.lit(0)).cast("bigint")
    took = F.greatest(F.coalesce("duration_ms", F.lit(0)).cast("bigint"), F.lit(0).cast("bigint"))
    rows = spans.filter(F.col("span_id").isNotNull()).select(
        "span_id", "parent_id", start.alias("start_ms"), (start + took).alias("end_ms"), F.coalesce("is_retry", F.lit(False)).alias("is_retry")
    )
    return keep_first(rows, ["span_id"], ["start_ms", "end_ms", "parent_id", "is_retry"])


def covered(children: DataFrame) -> DataFrame:
    """parent_id, covered_ms: how long at least one child ran inside its parent.

    A child starts adding to what is running, and its end takes away; time is covered from where the sum leaves 0 to where it is 0 again.
    """
    low, high = F.greatest("start_ms", "from_ms"), F.least("end_ms", "to_ms")
    inside = children.select("parent_id", "span_id", low.alias("low"), high.alias("high")).filter("low < high")
    edges = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("step")), F.struct(F.col("high").alias("at"), F.lit(-1).alias("step"))))
    steps = inside.select("parent_id", "span_id", edges.alias("edge")).select("parent_id", "span_id", "edge.at", "edge.step")
    steps = steps.withColumn("later", -F.col("step"))  # starts before ends
    slices = [(F.floor(F.col("at") / 600_000).cast("bigint"),), (F.floor(F.col("at") / 1000).cast("bigint"),)]
    counted = running(steps, ["parent_id"], slices, ["at", "later", "span_id"], {"open": Running("sum", F.col("step"))})
    begins = F.when((F.col("step") == 1) & (F.col("open") == 1), -F.col("at"))
    ends = F.when((F.col("step") == -1) & (F.col("open") == 0), F.col("at"))
    return counted.groupBy("parent_id").agg(F.sum(F.coalesce(begins, ends)).alias("covered_ms"))


def _last_children(edges: DataFrame) -> DataFrame:
    """The child of each parent that ends last; of several the one that starts last, then the least id."""
    ended = edges.groupBy("parent_id").agg(F.max("end_ms").alias("end_ms"))
    last = edges.join(ended, ["parent_id", "end_ms"])
    started = last.groupBy("parent_id").agg(F.max("start_ms").alias("start_ms"))
    last = last.join(started, ["parent_id", "start_ms"])
    return last.groupBy("parent_id").agg(F.min("span_id").alias("span_id")).select("span_id", F.lit(True).alias("last"))


def _arrived(pointers: DataFrame) -> DataFrame:
    """span_id, root_id, depth, critical for all spans but those that lead into a cycle; these have NULL.

    ``pointers``: span_id, up, depth (steps to ``up``), critical (each of them led to the child that ended last), done (``up`` is a root).
    """
    open_ = pointers.filter("not done").count()
    while open_:
        p = pointers.select(*[F.col(c).alias(f"p_{c}") for c in pointers.columns])
        moved = pointers.filter("not done").join(p, F.col("up") == F.col("p_span_id")).select(
            "span_id",
            F.col("p_up").alias("up"),
            (F.col("depth") + F.col("p_depth")).alias("depth"),
            (F.col("critical") & F.col("p_critical")).alias("critical"),
            F.col("p_done").alias("done"),
        )
        pointers = _kept(pointers.filter("done").unionByName(moved), "pointers")
        left = pointers.filter("not done").count()
        if left == open_:  # every round brings the nearest ones home, so what is left goes round in circles
            break
        open_ = left
    home = F.col("done")
    return pointers.select(
        "span_id", F.when(home, F.col("up")).alias("root_id"), F.when(home, F.col("depth")).alias("depth"), (home & F.col("critical")).alias("critical")
    )


def span_tree(spans: DataFrame) -> DataFrame:
    """One row per span: span_id, parent_id, root_id, depth, state, duration_ms, self_ms, critical, is_retry.

    ``spans``: span_id, parent_id, start_ms, duration_ms, is_retry. ``self_ms`` is the time in which no child ran. ``critical`` spans
    are those that a trace ended with: from the root down always the child that ended last.
    """
    rows = _kept(_clean(spans), "spans")
    parents = rows.select(F.col("span_id").alias("parent_id"), F.col("start_ms").alias("from_ms"), F.col("end_ms").alias("to_ms"))
    edges = _kept(rows.join(parents, "parent_id").select("parent_id", "span_id", "start_ms", "end_ms", "from_ms", "to_ms"), "edges")
    found = edges.select("span_id", F.col("parent_id").alias("up")).join(_last_children(edges), "span_id", "left")
    pointers = rows.select("span_id").join(found, "span_id", "left").select(
        "span_id",
        F.coalesce("up", "span_id").alias("up"),
        F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
        F.when(F.col("up").isNull(), True).otherwise(F.coalesce("last", F.lit(False))).alias("critical"),
        F.col("up").isNull().alias("done"),
    )
    arrived = _arrived(_kept(pointers, "pointers"))
    busy = covered(edges).withColumnRenamed("parent_id", "span_id")
    out = rows.join(arrived, "span_id").join(busy, "span_id", "left").withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    state = F.when(F.col("root_id").isNull(), "cycle").when((F.col("depth") == 0) & F.col("parent_id").isNotNull(), "orphan").otherwise("rooted")
    return out.select(
        "span_id", "parent_id", "root_id", "depth", state.alias("state"), "duration_ms",
        (F.col("duration_ms") - F.coalesce("covered_ms", F.lit(0))).alias("self_ms"), "critical", "is_retry",
    )


def trace_summary(tree: DataFrame) -> DataFrame:
    """One row per root: spans, levels below it, time spans worked themselves, time of the spans the trace ended with, time of retries.

    Spans of cycles have no root and make one row of state ``cycle``.
    """

    def total(what: Column) -> Column:
        return F.coalesce(F.sum(what), F.lit(0)).cast("bigint")

    of_root = F.max(F.when(F.col("depth") == 0, F.when(F.col("state") == "orphan", 1).otherwise(0)))
    return (
        tree.groupBy("root_id")
        .agg(
            of_root.alias("_orphan"),
            F.count("*").alias("spans"),
            F.max("depth").alias("levels"),
            total(F.col("self_ms")).alias("self_ms"),
            total(F.when(F.col("critical"), F.col("self_ms"))).alias("critical_ms"),
            count_if(F.col("is_retry")).alias("retries"),
            total(F.when(F.col("is_retry"), F.col("duration_ms"))).alias("retry_ms"),
        )
        .withColumn("state", F.when(F.col("_orphan") == 1, "orphan").when(F.col("_orphan") == 0, "rooted").otherwise("cycle"))
        .drop("_orphan")
    )
