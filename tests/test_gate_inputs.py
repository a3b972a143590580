"""How the registered queries build their input files and loads."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gate.files import write_csv_files
from gate.query_loads import _write_gold_files
from gate.query_store import _compacted, _ticker_files
from pricehouse.fixtures import Warehouse


@pytest.fixture
def events(spark, tmp_path):
    """Four ticks each of 300 users; days and kinds differ."""
    k = F.col("id")
    spark.range(1200).select(
        k.alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + (k % 9) * 86_400 + k).alias("ts"), (k % 300).alias("user_id"),
        F.element_at(F.array(*[F.lit(x) for x in ("click", "purchase", "view")]), (k % 3 + 1).cast("int")).alias("event_type"),
        (k % 50 + 10.5).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    return Warehouse(spark, str(tmp_path))


def test_ticker_files_are_written_by_several_tasks(events):
    written = events.spark.read.text(_write_gold_files(events)).select(F.input_file_name().alias("f")).distinct().collect()
    files = [r["f"] for r in written]
    assert len(files) == len({re.search("symbol=([^/]*)/", f)[1] for f in files}) > 200
    assert len({re.search(r"part-(\d+)", f)[1] for f in files}) == 3


def test_compaction_builds_its_bars_once(events, monkeypatch):
    built, price_raw = [], Warehouse.price_raw
    monkeypatch.setattr(Warehouse, "price_raw", lambda self: built.append(1) or price_raw(self))
    phases = {r["phase"]: r["count"] for r in _compacted(events).groupBy("phase").count().collect()}
    assert len(built) == 1 and len(phases) == 3 and len(set(phases.values())) == 1


def test_ticker_files_are_as_sparks_own_writer_has_them(events, spark, tmp_path):
    """The same folders and lines, without a checksum file (and the processes it costs) beside each."""
    rows = spark.createDataFrame(
        [("A/B", "x,y", None, 1.5), ("A/B", 'say "hi"', 2, None), ("C^=%", "", 3, 0.25), (None, "plain", 4, 1e-9)],
        "k STRING, `a text` STRING, n INT, v DOUBLE",
    )
    one = rows.repartition(2, "k").sortWithinPartitions("k", "n")
    write_csv_files(one, str(tmp_path / "mine"), ["k"])
    one.write.partitionBy("k").csv(str(tmp_path / "theirs"), header=True)

    def texts(root):
        return {p.parent.name: p.read_text() for p in root.glob("*/part-*.csv")}

    assert len(texts(tmp_path / "mine")) == 3 and texts(tmp_path / "mine") == texts(tmp_path / "theirs")
    for build in (_write_gold_files, _ticker_files):
        folder = Path(build(events).removeprefix("file:"))
        found = [p for p in folder.rglob("*") if p.is_file()]
        assert len(found) == len({p.parent for p in found}) > 200 and {p.suffix for p in found} == {".csv"}
    write_csv_files(one.where("n < 0"), str(tmp_path / "none"), ["k"])
    assert (tmp_path / "none").is_dir()
