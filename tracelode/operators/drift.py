"""Schema drift of semi-structured rows: which fields came when, with which types.

``field_types`` reads payloads: one row per batch and field with the type that all its values in the batch have in common. ``history`` reads
only such rows, so a new batch adds its own rows to a small table and nothing is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Objects inside objects that are looked into; a deeper one is a field of type OBJECT.
DEPTH = 4
# Numbers from narrow to wide.
WIDTHS = {"BIGINT": 1, "DECIMAL": 2, "DOUBLE": 3}


def field_types(rows: DataFrame, batch: str, payload: str = "payload", depth: int = DEPTH) -> DataFrame:
    """batch, field (path with dots), type and records. A field that is null in all rows of a batch is not listed.

    Types are families: a decimal of any digits is DECIMAL, an array of anything ARRAY, and VARIANT what holds several families in a batch.
    """
    spark = rows.sparkSession
    level = rows.select(F.col(batch).alias("batch"), F.lit("").alias("path"), F.col(payload).alias("value"))
    leaves = None
    for d in range(depth):
        inner = spark.sql("SELECT batch, concat(path, key) AS field, e.value FROM {level}, LATERAL variant_explode({level}.value) AS e(pos, key, value)", level=level)
        inner = inner.filter("field IS NOT NULL")  # elements of an array have no name
        inner = inner.withColumn("kind", F.regexp_extract(F.schema_of_variant("value"), r"^[A-Z]+", 0)).filter("kind != 'VOID'")
        closed = inner if d + 1 == depth else inner.filter("kind != 'OBJECT'")
        found = closed.groupBy("batch", "field", "kind").agg(F.count("*").alias("n"))
        leaves = found if leaves is None else leaves.unionByName(found)
        level = inner.filter("kind = 'OBJECT'").select("batch", F.concat("field", F.lit(".")).alias("path"), "value")
    return _common(leaves.groupBy("batch", "field"), F.col("kind"), F.col("n"))


def _common(grouped, kind: Column, n: Column) -> DataFrame:
    """The type that kinds have in common: the widest number, the only kind, or VARIANT."""
    width = F.coalesce(*[F.when(kind == k, w) for k, w in WIDTHS.items()])
    widest = F.max(width)
    others = F.count_distinct(F.when(width.isNull(), kind))
    number = F.coalesce(*[F.when(widest == w, F.lit(k)) for k, w in WIDTHS.items()])
    kinds = F.when((others == 0), number).when((others == 1) & widest.isNull(), F.min(F.when(width.isNull(), kind))).otherwise("VARIANT")
    return grouped.agg(kinds.alias("type"), F.sum(n).alias("records"))


def history(types: DataFrame) -> DataFrame:
    """batch, field, type, records, known (the type of all batches up to this one) and change, a word on what the batch brought.

    ``new``: the field was not there before. ``widened``: numbers of a wider type. ``conflict``: values of another kind than before, or of several
    kinds at once. ``same``: nothing. A field's rows are one per batch, however many records there were.
    """
    before = Window.partitionBy("field").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.collect_set("type").over(before)
    rows = types.withColumn("_seen", seen)
    rows = rows.withColumns({"_before": _merged(F.col("_seen")), "known": _merged(F.array_union("_seen", F.array("type")))})
    change = (
        F.when((F.size("_seen") == 0) & (F.col("type") != "VARIANT"), "new")
        .when((F.col("type") == "VARIANT") & (F.coalesce("_before", F.lit("")) != "VARIANT"), "conflict")
        .when(F.col("known") == F.col("_before"), "same")
        .when(F.col("known") == "VARIANT", "conflict")
        .otherwise("widened")
    )
    return rows.withColumn("change", change).drop("_seen", "_before")


def _merged(types: Column) -> Column:
    widths = F.create_map(*[x for k, w in WIDTHS.items() for x in (F.lit(k), F.lit(w))])
    numbers = F.filter(types, lambda t: t.isin(*WIDTHS))
    wide = F.array_max(F.transform(numbers, lambda t: F.element_at(widths, t)))
    number = F.coalesce(*[F.when(wide == w, F.lit(k)) for k, w in WIDTHS.items()])
    return (
        F.when(F.size(types) == 0, F.lit(None))
        .when(F.size(numbers) == F.size(types), number)
        .when(F.size(types) == 1, F.element_at(types, 1))
        .otherwise("VARIANT")
    )
