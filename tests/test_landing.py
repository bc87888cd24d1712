"""Queries over landing files take all deliveries, the repeated ones too."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import inputs as i
from ledgerline.plans.queries import REGISTRY
from ledgerline.sources import landing
from ledgerline.streaming import bronze

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["full_refresh", "drift_ignore", "lineage"])
def test_all_deliveries_are_ingested(spark, monkeypatch, name):
    counts, read = [], bronze.BronzeLog.read

    def noted(self, *args, **options):
        df = read(self, *args, **options)
        counts.append(df.count())
        return df
    monkeypatch.setattr(bronze.BronzeLog, "read", noted)
    REGISTRY[name](spark, SMALL).count()
    assert set(counts) == {i.raw_transactions(spark, SMALL).count()}


def test_many_files_are_found_some_folders_at_a_time(spark, root, monkeypatch):
    """No list of all paths is ever on the driver: neither of those there nor of those known."""
    for day in range(24):
        folder = f"{root}/landing/{'backfill' if day < 4 else 'daily'}/date_partition={day}"
        os.makedirs(folder)
        for n in range(500):
            with open(f"{folder}/{n}.json", "w") as f:
                f.write("{}")
    os.utime(f"{root}/landing/backfill/date_partition=0/0.json", (0, 0))
    asked, plain = [], landing.listed

    def noted(session, places):
        asked.append(len(places))
        return plain(session, places)
    monkeypatch.setattr(landing, "listed", noted)
    found = landing.LandedFiles(spark, f"{root}/landed")
    found.discover(f"{root}/landing", max_files=900, max_folders=5)
    assert asked == [5, 5, 5, 5, 4]
    per_file = found.read().groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per_file) == 12_000 and max(r["count"] for r in per_file) <= 900
    with open(f"{root}/landing/daily/date_partition=9/late.json", "w") as f:
        f.write("{}")
    os.rename(f"{root}/landing/daily/date_partition=9/1.json", f"{root}/landing/daily/date_partition=9/again.json")
    for _ in range(2):
        found.discover(f"{root}/landing")
        assert found.read().count() == found.read().select("source_file").distinct().count() == 12_002


def test_odd_names_mixed_folders_and_a_missing_landing(spark, root):
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    log.ingest(f"{root}/landing")
    assert log.read().count() == 0
    for name in ("a[1].json", "b{x}*.json", "c d%20?.json", "below/e.json", "_ignored.json"):
        os.makedirs(os.path.dirname(f"{root}/landing/x/{name}"), exist_ok=True)
        with open(f"{root}/landing/x/{name}", "w") as f:
            f.write(json.dumps({"id": name}) + "\n")
    for _ in range(2):
        log.ingest(f"{root}/landing", max_files=2)
        assert sorted(r.id for r in log.read().collect()) == ["a[1].json", "below/e.json", "b{x}*.json", "c d%20?.json"]
    assert log.last_batch() == 1
