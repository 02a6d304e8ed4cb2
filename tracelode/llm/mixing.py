"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in the order of a hash of their id, form blocks. With weight w, block
k of a source is released at slot ``floor(k / w)`` and due by ``ceil((k + 1) / w)``; each slot goes to the released block that is due
first. Then no source is ever a whole block ahead of or behind its weight. Weights are exact rationals.

The line of slots is cut into frames of about FRAME blocks (``borders``). At a border each source's block that is under way counts as
before or after it, as many before as there are slots left, chosen so that all release times and deadlines on both sides can still be met. So
each frame is scheduled in a task of its own, and the driver handles one number per frame and source, never a block. A frame is no shorter than
the time in which the source of least weight has a block, so weights a million times apart make frames of a million blocks. The driver plans
with one number per source, however many there are. A caller with more of them than it can hold asks for ``grouped``: a group's borders and
frames are made in tasks, and the groups are scheduled against each other as sources are; a source then stays within two blocks of its weight,
and one that has run out leaves its turns to the others of its group. Which of the two it is never depends on the input.

A caller who names a ``period`` gets weights rounded to its parts instead, and a schedule that repeats after it.

All documents stay. A source that has run out leaves its slots empty, and the others go on in their proportions.
A source of weight 0 comes after all others, equal shares of such sources at a time.
A null source counts as the source ''. A null doc_id sorts as ''. Documents of one id sort by a hash of their text; repeated rows are documents
of their own, in any order. Null, empty and long texts are documents as others are; only their hash is read. No rows give no rows. Extra columns stay as
they are. Two blocks that are due at once go by the names of their sources.
"""

from __future__ import annotations

import heapq
import warnings
from collections.abc import Callable, Sequence
from fractions import Fraction
from math import gcd, lcm
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelode.llm.tables import stored, text_key, whole, whole_document

#: Documents of a block.
BLOCK = 64
#: Blocks of a frame, about, and most numbers (frames times sources) that the driver makes; frames are longer then.
FRAME, NUMBERS = 1 << 15, 1 << 20
#: With more sources than this the driver's share is worth a warning; ``grouped`` makes so many groups.
SOURCES, GROUPS = 2000, 1024
#: Running totals are cut every so many keys.
_SPAN = 4096


def quotas(weights: dict[str, float], period: int) -> dict[str, int]:
    """Slots of each source in a period: at least one, the rest by largest remainder, ties by name."""
    total, spare = sum(weights.values()), period - len(weights)
    share = {s: (w / total if total else 1 / len(weights)) * spare for s, w in weights.items()}
    out = {s: 1 + int(x) for s, x in share.items()}
    order = sorted(share, key=lambda s: (int(share[s]) - share[s], s))
    for s in order[: period - sum(out.values())]:
        out[s] += 1
    return out


def schedule(quota: dict[str, int]) -> list[str]:
    """The source of each slot of a period: earliest deadline first among the released blocks, ties by name."""
    period = sum(quota.values())
    released: list[list[str]] = [[] for _ in range(period)]
    done = dict.fromkeys(quota, 0)
    for s in quota:
        released[0].append(s)
    due: list[tuple[int, str]] = []
    out = []
    for t in range(period):
        for s in released[t]:
            heapq.heappush(due, (-(-(done[s] + 1) * period // quota[s]), s))
        _, s = heapq.heappop(due)
        out.append(s)
        done[s] += 1
        if done[s] < quota[s]:
            released[max(t + 1, done[s] * period // quota[s]) if t + 1 < period else t].append(s)
    return out


def _running(rows: DataFrame, key: str, size: str, *group: str) -> DataFrame:
    """``before``: the sum of ``size`` over smaller keys of the group, in two steps so that no task sees all keys."""
    rows = rows.withColumn("_span", F.floor(F.col(key) / _SPAN))
    spans = rows.groupBy(*group, "_span").agg(F.sum(size).alias("_sum"))
    over = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_base", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*group, "_span").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(spans, [*group, "_span"])
    return rows.withColumn("before", F.col("_base") + F.coalesce(F.sum(size).over(inside), F.lit(0))).drop("_span", "_base")


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, source and k, the document's number in its source by (md5 of the id, id).

    A source is cut into 65,536 slices by the first digits of the md5, so a source with a third of all rows is numbered in parallel.
    """
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col("doc_id").cast("long"), text_key(), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), digest.alias("digest")
    )
    rows = stored(rows.withColumn("slice", F.conv(F.substring("digest", 1, 4), 16, 10).cast("long")), "numbered")
    slices = rows.groupBy("source", "slice").agg(F.count("*").alias("n"))
    slices = _running(slices, "slice", "n", "source").drop("n")
    inside = Window.partitionBy("source", "slice").orderBy("digest", "doc_id", "text_key")
    rows = rows.withColumn("k", F.row_number().over(inside) - 1).join(slices, ["source", "slice"])
    return rows.select("doc_id", "text_key", "source", (F.col("before") + F.col("k")).alias("k"))


def _shares(weights: Sequence[Fraction]) -> list[int]:
    """Integers in the proportions of the weights; equal ones if all weights are 0."""
    if not any(weights):
        return [1] * len(weights)
    scale = lcm(*(w.denominator for w in weights))
    parts = [int(w * scale) for w in weights]
    common = gcd(*parts)
    return [p // common for p in parts]


def _counted(parts: Sequence[int], rest: Sequence[int], total: int) -> list[int]:
    """Of the blocks under way at a border, ``rest / total`` of each done by an even pace, those that count as before it.

    As many as the paces sum up to. So that all deadlines after the border can be met, of the blocks due by any slot
    as many count as their paces sum up to, rounded down. Of these the ones released first are taken, which leaves the most room for what
    is released just before the border. As an even pace keeps all bounds, which are sums over nested sets, whole blocks can.
    """
    under_way = sorted((-(-(total - r) // p), i) for i, (p, r) in enumerate(zip(parts, rest)) if r)
    heap: list[tuple[int, int]] = []
    out: list[int] = []
    pace = 0
    for at, (due, i) in enumerate(under_way):
        heapq.heappush(heap, (-rest[i] // parts[i], i))  # slots from the border to the release, negative
        pace += rest[i]
        if at + 1 == len(under_way) or under_way[at + 1][0] > due:
            while len(out) < pace // total:
                out.append(heapq.heappop(heap)[1])
    return out


def borders(parts: Sequence[int], cuts: Sequence[int]) -> np.ndarray:
    """Blocks of each source before each of the rising slots ``cuts``: a row a cut. Each within one of its weight, summing to the slot."""
    total = sum(parts)
    out = np.zeros((len(cuts), len(parts)), np.int64)
    for i, at in enumerate(cuts):
        whole_, rest = zip(*(divmod(p * at, total) for p in parts))
        out[i] = whole_
        out[i, _counted(parts, rest, total)] += 1
    return out


def frame_cuts(parts: Sequence[int], blocks: Sequence[int], frame: int) -> list[int]:
    """Slots from 0 to the end, between which about ``frame`` blocks lie; empty slots of sources that have run out do not count.

    No block may be under way at two of them, so they are as far apart as the least weight asks.
    """
    total = sum(parts)
    end = max(-(-n * total // p) for n, p in zip(blocks, parts))
    out_at = np.array([n * total / p for n, p in zip(blocks, parts)])
    weight = np.array([p / total for p in parts])
    order = np.argsort(out_at)
    # Blocks up to the time at which one source after another runs out, in between a straight line.
    rate = 1 - np.concatenate([[0], np.cumsum(weight[order])[:-1]])
    times = out_at[order]
    upto = np.cumsum(rate * np.diff(np.concatenate([[0], times])))
    wanted = np.arange(frame, sum(blocks), frame)
    inner = np.interp(wanted, np.concatenate([[0], upto]), np.concatenate([[0], times]))
    cuts, apart = [0], max(-(-total // p) for p in parts)
    for t in map(int, inner):
        if t - cuts[-1] >= apart and end - t >= apart:
            cuts.append(t)
    return [*cuts, end] if end else cuts


def in_frame(parts: Sequence[int], total: int, first: Sequence[int], stop: Sequence[int], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Source, block and slot of the blocks ``first`` to ``stop`` of each source in the slots ``low`` to ``high``, in the order of slots.

    Earliest deadline first, ties by source. Slots in which no block is released are skipped, not walked through.
    """
    at = [int(k) for k in first]
    waiting = [(max(low, at[i] * total // parts[i]), i) for i in range(len(parts)) if at[i] < stop[i]]
    heapq.heapify(waiting)
    n = int(sum(stop) - sum(first))
    who, block, slots = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    due: list[tuple[int, int]] = []
    t = low
    for step in range(n):
        if not due and waiting[0][0] > t:
            t = waiting[0][0]
        while waiting and waiting[0][0] <= t:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(due, (min(high, -((at[i] + 1) * -total // parts[i])), i))
        i = heapq.heappop(due)[1]
        who[step], block[step], slots[step] = i, at[i], t
        at[i] += 1
        t += 1
        if at[i] < stop[i]:
            heapq.heappush(waiting, (max(low, at[i] * total // parts[i]), i))
    return who, block, slots


class Plan(NamedTuple):
    """Frames of sources that are scheduled against each other; ``start`` is the first slot."""

    parts: list[int]
    cuts: list[int]
    #: Blocks of each source before each cut.
    before: np.ndarray
    start: int

    @classmethod
    def of(cls, weights: Sequence[Fraction], blocks: Sequence[int], start: int = 0) -> Plan:
        parts = _shares(weights)
        cuts = frame_cuts(parts, blocks, max(FRAME, -(-sum(blocks) * len(parts) // NUMBERS)))
        return cls(parts, cuts, np.minimum(borders(parts, cuts), np.array(blocks, np.int64)), start)

    def frames(self) -> pd.DataFrame:
        """frame, who, first, stop, low and high of every source that has blocks in a frame."""
        frame, who = np.nonzero(np.diff(self.before, axis=0))
        low, high = np.array(self.cuts[:-1])[frame], np.array(self.cuts[1:])[frame]
        return pd.DataFrame({"frame": frame, "who": who, "first": self.before[:-1][frame, who], "stop": self.before[1:][frame, who], "low": low, "high": high})


def _exact(weight: float) -> Fraction:
    out = Fraction(weight)
    if out < 0:
        raise ValueError(f"negative weight {weight}")
    return out


def _plans(weights: Sequence[Fraction], blocks: Sequence[int]) -> list[tuple[list[int], Plan]]:
    """The sources with a weight, then those without, each with its plan."""
    out, start = [], 0
    for some in ([i for i, w in enumerate(weights) if w > 0], [i for i, w in enumerate(weights) if not w]):
        if some:
            plan = Plan.of([weights[i] for i in some], [blocks[i] for i in some], start)
            out.append((some, plan))
            start = plan.start + plan.cuts[-1]
    return out


def _frame(parts: list[int], start: int, some: list[int], size: np.ndarray, names: list, share: list[float], block: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The blocks of one frame, given its rows of ``Plan.frames``."""
    total = sum(parts)

    def run(own: pd.DataFrame) -> pd.DataFrame:
        who, low, high = own["who"].to_numpy(), int(own["low"].iloc[0]), int(own["high"].iloc[0])
        local, number, slot = in_frame([parts[i] for i in who], total, own["first"].tolist(), own["stop"].tolist(), low, high)
        source = who[local]
        n = np.minimum(block, size[source] - number * block)
        row = [some[i] for i in source]
        columns = {"name": [names[i] for i in row], "weight": [share[i] for i in row], "block": number, "slot": slot + start}
        return pd.DataFrame(columns | {"before": np.cumsum(n) - n + int(own["base"].iloc[0])})

    return run


def _scheduled(spark: SparkSession, names: list, sizes: list[int], wanted: list[Fraction], block: int) -> DataFrame:
    """name, weight, block, slot and before (documents in earlier slots) of every block; ``names`` may be text or numbers."""
    blocks = [-(-n // block) for n in sizes]
    total = sum(wanted)
    share = [float(w / total) if total else 1 / len(names) for w in wanted]
    kind = "string" if isinstance(names[0], str) else "long"
    schema = f"name {kind}, weight double, block long, slot long, before long"
    out, done = [], 0
    for some, plan in _plans(wanted, blocks):
        size = np.array([sizes[i] for i in some], np.int64)
        docs = np.minimum(plan.before * block, size).sum(axis=1) + done  # documents before each cut
        done = int(docs[-1])
        frames = plan.frames()
        frames["base"] = docs[:-1][frames["frame"]]

        run = _frame(plan.parts, plan.start, some, size, names, share, block)
        out.append(spark.createDataFrame(frames).groupBy("frame").applyInPandas(run, schema))
    return out[0] if len(out) == 1 else out[0].union(out[1])


def _scheduled_in_groups(counts: DataFrame, weights: dict[str, float] | None, block: int) -> DataFrame:
    """As _scheduled, of a table of source and n. A group's slots are blocks of the group, which is scheduled among the groups by the sum of its weights."""
    spark = counts.sparkSession
    if weights is None:
        counts = counts.withColumn("asked", _default(F.col("n")))
    else:
        asked = pa.table({"source": pa.array(list(weights), pa.string()), "asked": pa.array([float(_exact(w)) for w in weights.values()], pa.float64())})
        counts = counts.join(spark.createDataFrame(asked), "source", "left").fillna(0.0, ["asked"])
    if counts.agg(F.max("asked")).first()[0] == 0:
        counts = counts.withColumn("asked", F.lit(1.0))
    # Sources of weight 0 are groups of their own, so that these come last as a whole.
    counts = counts.withColumn("group", F.pmod(F.xxhash64("source"), F.lit(GROUPS)) + F.when(F.col("asked") > 0, 0).otherwise(GROUPS))

    def plan(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("source").reset_index(drop=True)
        wanted = [Fraction(w) for w in own["asked"]]
        made = Plan.of(wanted, [-(-int(n) // block) for n in own["n"]])
        out = made.frames()
        for name in ("group", "source", "n", "asked"):
            out[name] = own[name].to_numpy()[out["who"]]
        out["part"] = [str(made.parts[i]) for i in out["who"]]
        out["parts"], out["total"] = str(sum(made.parts)), str(sum(wanted))
        out["turn"] = made.before[:-1].sum(axis=1)[out["frame"]]
        return out

    schema = "frame long, who long, first long, stop long, low long, high long, group long, source string, n long, asked double, part string, parts string, total string, turn long"
    frames = stored(counts.groupBy("group").applyInPandas(plan, schema), "frames")

    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("who")
        parts = [int(p) for p in own["part"]]
        who, number, _ = in_frame(parts, int(own["parts"].iloc[0]), own["first"].tolist(), own["stop"].tolist(), int(own["low"].iloc[0]), int(own["high"].iloc[0]))
        n = np.minimum(block, own["n"].to_numpy()[who] - number * block)
        return pd.DataFrame({"group": own["group"].to_numpy()[who], "turn": np.arange(len(who)) + int(own["turn"].iloc[0]),
                             "source": own["source"].to_numpy()[who], "asked": own["asked"].to_numpy()[who], "block": number, "n": n})

    inner = frames.groupBy("group", "frame").applyInPandas(run, "group long, turn long, source string, asked double, block long, n long")
    groups = frames.groupBy("group").agg(F.first("total").alias("total"), F.sum(F.col("stop") - F.col("first")).alias("blocks")).collect()  # at most 2 * GROUPS
    groups.sort()
    outer = _scheduled(spark, [r["group"] for r in groups], [r["blocks"] for r in groups], [Fraction(r["total"]) if r["group"] < GROUPS else Fraction(0) for r in groups], 1)
    outer = outer.select(F.col("name").alias("group"), F.col("block").alias("turn"), "slot")
    total = float(sum(Fraction(r["total"]) for r in groups))
    blocks = inner.join(outer, ["group", "turn"]).select("source", (F.col("asked") / total).alias("weight"), "block", "n", "slot")
    return _running(stored(blocks, "blocks"), "slot", "n").select("source", "weight", "block", "slot", "before")


def _default(n: Column) -> Column:
    """The square root of a source's documents, to a millionth: a rational of few digits."""
    return F.round(F.sqrt(n.cast("double")) * 1_000_000) / 1_000_000


def _periodic(rows: DataFrame, counts: dict[str, int], weights: dict[str, float] | None, block: int, period: int) -> DataFrame:
    """As _scheduled, with weights rounded to parts of a period; a source that has none given gets the least share, one slot."""
    spark = rows.sparkSession
    wanted = {s: round(n**0.5, 6) if weights is None else float(weights.get(s, 0)) for s, n in counts.items()}
    quota = quotas(wanted, max(period, 4 * len(wanted)))
    total = sum(quota.values())
    turn, table = dict.fromkeys(quota, 0), []
    for slot, s in enumerate(schedule(quota)):
        table.append((s, turn[s], slot, quota[s]))
        turn[s] += 1
    plan = spark.createDataFrame(table, "source string, turn long, first long, quota long")  # as many rows as a period has slots
    blocks = rows.groupBy("source", "block").agg(F.count("*").alias("n"))
    shares = plan.select("source", "quota").distinct()
    blocks = blocks.join(shares, "source").withColumn("turn", F.col("block") % F.col("quota")).drop("quota").join(plan, ["source", "turn"])
    slot = F.floor(F.col("block") / F.col("quota")) * total + F.col("first")
    blocks = blocks.select("source", "block", "n", slot.alias("slot"), (F.col("quota") / total).alias("weight"))
    return _running(stored(blocks, "blocks"), "slot", "n").select("source", "block", "slot", "weight", "before")


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, period: int | None = None, grouped: bool = False) -> DataFrame:
    """doc_id, text_key, source, weight, block, slot, position (0, 1, 2, ... in the mixture) of every row.

    ``weights`` by default are the square roots of the sources' document counts, to a millionth. A source that has none given has weight 0.
    """
    rows = stored(_numbered(docs), "numbered")
    per_source = stored(rows.groupBy("source").agg(F.count("*").alias("n")), "sources")
    n_sources = per_source.count()
    if not n_sources:
        return rows.selectExpr("doc_id", "text_key", "source", "0D AS weight", "k AS block", "k AS slot", "k AS position")
    rows = rows.withColumn("block", F.floor(F.col("k") / block))
    if grouped and period is not None:
        raise ValueError("a period has no groups")
    if n_sources > SOURCES and not grouped:
        warnings.warn(f"{n_sources} sources are scheduled by the driver, one by one", stacklevel=2)
    if grouped:
        blocks = _scheduled_in_groups(per_source, weights, block)
    else:
        counts = {r["source"]: r["n"] for r in per_source.orderBy("source").collect()}
        if period is None:
            names = sorted(counts)
            wanted = [Fraction(round(counts[s] ** 0.5 * 1_000_000)) if weights is None else _exact(weights.get(s, 0)) for s in names]
            blocks = _scheduled(rows.sparkSession, names, [counts[s] for s in names], wanted, block).withColumnRenamed("name", "source")
        else:
            blocks = _periodic(rows, counts, weights, block, period)
    return rows.join(blocks, ["source", "block"]).select(
        "doc_id", "text_key", "source", "weight", "block", "slot", (F.col("before") + F.col("k") % block).alias("position")
    )


def in_order(docs: DataFrame) -> DataFrame:
    """All rows and columns in the order of the mixture: each file holds one stretch of it, sorted."""
    places = mixed(docs).groupBy(F.struct("doc_id", "text_key").alias("at")).agg(F.min("position").alias("position"))
    rows = whole(docs).withColumn("key", whole_document()).join(places, F.col("key") == F.col("at"))
    return rows.repartitionByRange("position").sortWithinPartitions("position").select("row.*")
