"""How many files events are landed in, and which of them the streams take."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracelode.plans import catalog
from tracelode.sources import testdata as td
from tracelode.streaming import bronze, silver

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("lines", [100, 1_000_000])
def test_files_are_as_many_as_days_and_lines_ask_for(spark, monkeypatch, lines):
    monkeypatch.setattr(catalog, "LANDED_LINES", lines)
    events = td.canonical(spark, SF)
    days, rows = events.agg(F.count_distinct("event_date"), F.count("*")).first()
    root = catalog._land(spark, events.repartition(9), "files")
    files = list(Path(f"{root}/logs").rglob("*.gz"))
    assert len(files) <= days + rows / lines + 1
    landed = spark.read.option("recursiveFileLookup", "true").text(f"{root}/logs")
    assert landed.count() == rows


def test_malformed_files_make_no_batches(spark, scratch):
    root = catalog._bronze(spark, SF, "batches")
    found = [f for f in Path(root).rglob("*.parquet") if "malformed=0" in str(f)]
    assert len(found) < len(list(Path(root).rglob("*.parquet")))
    silver.count_tools(silver.bronze_events(spark, root, 1), f"{scratch}/counts", f"{scratch}/checkpoint")
    assert len(list(Path(f"{scratch}/counts").glob("batch_id=*"))) == len(found)
    batch = silver.tool_counts(catalog.norm.normalize(bronze.read_bronze(spark, root)))
    assert sorted(map(str, silver.read_tool_counts(spark, f"{scratch}/counts").collect())) == sorted(map(str, batch.collect()))
