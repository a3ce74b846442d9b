"""The stream source takes a table of one file and a table that is a folder of files."""

import pytest

from roadpulse.streaming.streams import ROCKSDB_PROVIDER, STATE_STORE, events_stream, incident_stream, rocksdb_state, run_available_now
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("files", [0, 3])
def test_stream_reads_files_and_folders(spark, tmp_path, files):
    top = SF_SMALL
    if files:
        top = str(tmp_path / "in")
        spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(files).write.parquet(f"{top}/events.parquet")
    writer = events_stream(spark, top).writeStream.format("memory").queryName(f"events_{files}")
    writer.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert spark.table(f"events_{files}").count() == 1000


def test_restart_takes_only_new_files(spark, tmp_path):
    """Several files a batch, repeated rows, and a second run with the same base folder."""
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet").orderBy("ts")
    first, later = rows.limit(600), rows.subtract(rows.limit(600))
    folder, base = str(tmp_path / "in" / "events.parquet"), str(tmp_path / "out")

    def drain():
        clean = incident_stream(events_stream(spark, str(tmp_path / "in"), max_files=1))
        return run_available_now(clean.select("id"), "restart", base=base)

    first.coalesce(1).write.parquet(folder)
    first.limit(50).coalesce(1).write.mode("append").parquet(folder)  # within the watermark or late: dropped either way
    assert drain().count() == 600
    assert drain().count() == 600
    later.coalesce(1).write.mode("append").parquet(folder)
    out = drain()
    assert out.count() == out.distinct().count() == rows.count()


def test_state_store_setting_is_restored(spark):
    before = spark.conf.get(STATE_STORE, None)
    with rocksdb_state(spark):
        assert spark.conf.get(STATE_STORE) == ROCKSDB_PROVIDER
    assert spark.conf.get(STATE_STORE, None) == before
