"""Loads with a history: new, changed, renamed, copied and returning files, and loads that stop."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracelode.sources import landing, loads


def put(folder, name, ids, at):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps({"event_name": "user_prompt", "n": i}) + "\n" for i in ids) + "{broken\n")
    os.utime(path, (at, at))
    return path


def ids(df):
    return sorted(r[0] for r in df.select(F.expr("try_variant_get(payload, '$.n', 'int')")).collect())


def load(spark, root):
    return loads.load_new(spark, f"{root}/in", f"{root}/table", "*.jsonl")


def test_loads_of_a_growing_folder_equal_one(spark, scratch):
    put(f"{scratch}/in", "a/1.jsonl", [1, 2], 1_000)
    put(f"{scratch}/in", "a/2.jsonl", [3], 1_000)
    assert load(spark, scratch) == 2 and load(spark, scratch) == 0
    put(f"{scratch}/in", "b/3.jsonl", [4, 5, 5], 2_000)
    put(f"{scratch}/in", "b/same_as_1.jsonl", [2, 1], 2_000)  # the same lines under another name, in another order
    put(f"{scratch}/in", "b/other.txt", [77], 2_000)
    assert load(spark, scratch) == 1
    put(f"{scratch}/in", "a/2.jsonl", [3, 6], 3_000)  # grown
    put(f"{scratch}/in", "c/twin_1.jsonl", [8], 3_000)
    put(f"{scratch}/in", "c/twin_2.jsonl", [8], 3_000)
    assert load(spark, scratch) == 2
    assert ids(loads.read(spark, f"{scratch}/table")) == [1, 2, 3, 4, 5, 5, 6, 8]
    counts = {(r.load_id, r.status): r.files for r in loads.counts(spark, f"{scratch}/table").collect()}
    assert counts == {(0, "loaded"): 2, (1, "loaded"): 1, (1, "same"): 1, (2, "loaded"): 2, (2, "same"): 1}
    once = landing.copy_into(spark, f"{scratch}/in", "*.jsonl").filter(~F.col("file_name").rlike("same_as_1|twin_2"))
    assert ids(once) == ids(loads.read(spark, f"{scratch}/table"))


def test_lines_that_go_and_come_back(spark, scratch):
    put(f"{scratch}/in", "x.jsonl", [1], 1_000)
    load(spark, scratch)
    put(f"{scratch}/in", "x.jsonl", [2], 2_000)
    load(spark, scratch)
    assert ids(loads.read(spark, f"{scratch}/table")) == [2]
    put(f"{scratch}/in", "x.jsonl", [1], 3_000)
    load(spark, scratch)
    assert ids(loads.read(spark, f"{scratch}/table")) == [1]
    put(f"{scratch}/in", "y.jsonl", [1], 4_000)
    put(f"{scratch}/in", "x.jsonl", [], 4_000)  # y holds the lines that x had
    load(spark, scratch)
    assert ids(loads.read(spark, f"{scratch}/table")) == [1]


def test_a_load_that_stops_leaves_nothing(spark, scratch, monkeypatch):
    put(f"{scratch}/in", "1.jsonl", [1], 1_000)
    load(spark, scratch)
    put(f"{scratch}/in", "2.jsonl", [2, 3], 2_000)
    real = landing.copy_into

    def stop(spark, paths):
        rows = real(spark, paths)
        rows.write.mode("overwrite").parquet(f"{scratch}/table/rows/load_id=1")
        raise KeyboardInterrupt

    monkeypatch.setattr(landing, "copy_into", stop)
    with pytest.raises(KeyboardInterrupt):
        load(spark, scratch)
    assert ids(loads.read(spark, f"{scratch}/table")) == [1]
    monkeypatch.setattr(landing, "copy_into", real)
    assert load(spark, scratch) == 1
    assert ids(loads.read(spark, f"{scratch}/table")) == [1, 2, 3]


def test_an_empty_folder(spark, scratch):
    Path(f"{scratch}/in").mkdir(parents=True)
    assert load(spark, scratch) == 0
    assert loads.read(spark, f"{scratch}/table").count() == 0
