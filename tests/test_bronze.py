import csv
import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from ledgerline import contracts as k
from ledgerline.sources import drift
from ledgerline.streaming import bronze


def tx(n, **extra):
    return {"id": str(n), "date": "2010-01-01 00:01:00", "client_id": "1", "card_id": "2", "amount": "$77.00",
            "use_chip": "Swipe Transaction", "errors": None,
            "merchant": {"merchant_id": "5", "merchant_city": "X", "merchant_state": "CA", "zip": "58523.0", "mcc": "5812"},
            **extra}


def put_json(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def put_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f, doublequote=False, escapechar="\\")
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture
def tx_log(spark, root):
    return bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze"), f"{root}/landing"


def test_each_file_once_and_redeliveries_again(tx_log):
    log, landing = tx_log
    put_json(f"{landing}/backfill/year=2010/a.json", [tx(1), tx(2)])
    put_json(f"{landing}/daily/date_partition=2017-01-01/p1.json", [tx(3)])
    log.ingest(landing)
    assert log.read().count() == 3
    log.ingest(landing)
    assert log.read().count() == 3
    put_json(f"{landing}/daily/date_partition=2017-01-01/p2.json", [tx(3)])  # same rows, new name
    log.ingest(landing)
    assert log.read().count() == 4
    put_json(f"{landing}/daily/date_partition=2017-01-01/p2.json", [tx(3), tx(4), tx(5)])  # same name
    os.utime(f"{landing}/daily/date_partition=2017-01-01/p2.json", (4e9, 4e9))
    log.ingest(landing)
    assert log.read().count() == 4
    ignored = log.ignored_corrections(landing).collect()
    assert [r.source_file.rsplit("/", 1)[1] for r in ignored] == ["p2.json"]


def test_rows_keep_text_and_lineage(tx_log):
    log, landing = tx_log
    put_json(f"{landing}/daily/date_partition=2017-01-01/p.json", [tx(1, amount=5.50), tx(2, amount=None)])
    log.ingest(landing)
    one, two = log.read().orderBy("id").collect()
    assert one.amount == "5.50" or one.amount == "5.5"
    assert two.amount is None
    assert json.loads(one.merchant)["zip"] == "58523.0"
    assert one.source_file.endswith("date_partition=2017-01-01/p.json")
    assert one.ingested_at is not None and one.rescued_data is None
    types = {t for c, t in log.read().dtypes if c not in ("ingested_at", "batch_id")}
    assert types == {"string"}


def test_new_column_is_added_from_its_first_row(tx_log):
    log, landing = tx_log
    put_json(f"{landing}/a.json", [tx(1)])
    log.ingest(landing)
    put_json(f"{landing}/b.json", [tx(2, device_type="pos"), tx(3)])
    log.ingest(landing)
    assert {r.id: r.device_type for r in log.read().collect()} == {"1": None, "2": "pos", "3": None}
    assert log.register.versions() == [[*bronze.TRANSACTIONS.columns, "device_type"]]


def test_one_drain_may_widen_many_times(tx_log):
    log, landing = tx_log
    for n in range(6):
        put_json(f"{landing}/{n}.json", [tx(n, **{f"new{n}": "x"})])
    log.ingest(landing, max_files=1)
    assert log.read().count() == 6 and len(log.register.versions()) == 6


def test_files_of_any_age_are_taken(tx_log):
    log, landing = tx_log
    month = 30 * 86400
    for name, age in (("a", 0), ("b", month), ("c", 0), ("d", 20 * month)):
        put_json(f"{landing}/{name}.json", [tx(ord(name))])
        os.utime(f"{landing}/{name}.json", (time.time() - age,) * 2)
        assert [r.source_file[-6:] for r in log.untaken(landing).collect()] == [f"{name}.json"]
        log.ingest(landing)
    log.ingest(landing)
    assert sorted(r.id for r in log.read().collect()) == sorted(str(ord(n)) for n in "abcd")
    assert log.untaken(landing).count() == 0


def test_rescue_fail_and_ignore(spark, root):
    def run(policy):
        log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/{policy}")
        log.ingest(f"{root}/landing", on_new_columns=policy)
        return log

    put_json(f"{root}/landing/a.json", [tx(1), tx(2, device_type="pos", x={"y": [1, 2]})])
    kept = {r.id: r.rescued_data for r in run(drift.RESCUE).read().collect()}
    assert kept["1"] is None
    assert json.loads(kept["2"]) == {"device_type": "pos", "x": '{"y":[1,2]}'}
    assert [r.rescued_data for r in run(drift.IGNORE).read().collect()] == [None, None]
    with pytest.raises(StreamingQueryException, match="device_type"):
        run(drift.FAIL)
    with pytest.raises(ValueError):
        run("other")


def test_broken_line_is_kept(tx_log):
    log, landing = tx_log
    put_json(f"{landing}/a.json", [tx(1), '{"id": "2", broken', ""])
    log.ingest(landing)
    rows = {r.id: r.rescued_data for r in log.read().collect()}
    assert rows["1"] is None
    assert json.loads(rows[None]) == {drift.CORRUPT: '{"id": "2", broken'}


def test_many_unknown_keys_are_rescued(tx_log):
    """Names that are data make no columns and do not stop the feed."""
    log, landing = tx_log
    put_json(f"{landing}/a.json", [{f"k{n}": "v" for n in range(drift.MAX_NEW + 1)}])
    log.ingest(landing)
    put_json(f"{landing}/b.json", [tx(1)])
    log.ingest(landing)
    rows = {r.id: r.rescued_data for r in log.read().collect()}
    assert len(json.loads(rows[None])) == drift.MAX_NEW + 1 and rows["1"] is None
    assert log.register.versions() == []


def test_only_the_first_line_of_a_csv_file_is_its_header(spark, root):
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    os.makedirs(f"{root}/landing")
    header = ",".join(k.CLIENT_COLUMNS)
    with open(f"{root}/landing/a.csv", "w") as f:
        f.write("\n".join([header, "1" + "," * (len(k.CLIENT_COLUMNS) - 1), header, "2,short", "3" + "," * len(k.CLIENT_COLUMNS)]) + "\n")
    log.ingest(f"{root}/landing")
    rows = {r.id: r.rescued_data for r in log.read().collect()}
    assert set(rows) == {"1", "id", "2", "3"}
    assert rows["1"] is None and rows["id"] is None
    assert json.loads(rows["2"])[drift.CORRUPT] == "2,short" and rows["3"] is not None


def test_new_generation_reads_everything_again(spark, root, tx_log):
    log, landing = tx_log
    put_json(f"{landing}/a.json", [tx(1)])
    log.ingest(landing)
    again = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze", generation=2)
    assert again.read().count() == 0
    again.ingest(landing)
    assert (again.read().count(), log.read().count()) == (1, 1)


def test_many_small_batches(tx_log):
    log, landing = tx_log
    for n in range(7):
        put_json(f"{landing}/d{n}/a.json", [tx(n)])
    log.ingest(landing, max_files=2)
    assert sorted(r.id for r in log.read().collect()) == [str(n) for n in range(7)]
    assert sorted((r.batch_id, r.n_rows) for r in log.batches().collect()) == [(0, 2), (1, 2), (2, 2), (3, 1)]


def test_csv_columns_are_bound_by_name(spark, root):
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    names = bronze.CLIENTS.columns
    first = {c: f"{c}-1" for c in names} | {"address": '12 "Main" St, Apt 4', "total_debt": ""}
    second = {c: f"{c}-2" for c in names}
    put_csv(f"{root}/landing/backfill/a.csv", names, [[first[c] for c in names]])
    put_csv(f"{root}/landing/daily/date_partition=2017-01-02/b.csv", names[::-1] + ["segment"],
            [[second[c] for c in names[::-1]] + ["gold"]])
    put_csv(f"{root}/landing/daily/date_partition=2017-01-03/c.csv", names[:3], [["x-3", "y", "z", "extra"]])
    log.ingest(f"{root}/landing")
    got = {r.id: r.asDict() for r in log.read().collect()}
    assert set(got) == {"id-1", "id-2", "x-3"}
    assert got["id-1"]["address"] == '12 "Main" St, Apt 4'
    assert got["id-1"]["total_debt"] in (None, "")
    assert all(got["id-2"][c] == f"{c}-2" for c in names)
    assert got["id-2"]["segment"] == "gold" and got["id-1"]["segment"] is None
    assert got["x-3"]["email"] is None and "extra" in got["x-3"]["rescued_data"]


def test_card_numbers_are_never_stored(spark, root):
    log = bronze.BronzeLog(spark, bronze.CARDS, f"{root}/bronze")
    names = bronze.CARDS.columns
    row = {c: "" for c in names} | {"id": "1", "card_number": "4111222233334444", "cvv": "987"}
    put_csv(f"{root}/landing/a.csv", names, [[row[c] for c in names]])
    put_csv(f"{root}/landing/b.csv", names, [["2"] + [""] * 12 + ["4111222233334444", "987"]])  # overlong line
    log.ingest(f"{root}/landing")
    log.ingest(f"{root}/landing")
    rows = log.read().collect()
    assert len(rows) == 2
    one = next(r for r in rows if r.id == "1")
    assert (one.card_bin, one.card_last4) == ("411122", "4444")
    assert not {"card_number", "cvv", "rescued_data"} & set(log.read().columns)
    for folder, _, names in os.walk(f"{root}/bronze/cards"):
        for name in names:
            data = open(os.path.join(folder, name), "rb").read()
            assert b"4111222233334444" not in data


def test_files_without_rows(spark, root):
    put_json(f"{root}/landing/tx/a.json", ["", " "])
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    log.ingest(f"{root}/landing/tx")
    put_csv(f"{root}/landing/clients/a.csv", bronze.CLIENTS.columns, [])
    put_json(f"{root}/landing/clients/b.csv", [""])
    clients = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    clients.ingest(f"{root}/landing/clients")
    assert (log.read().count(), clients.read().count()) == (0, 0)


def test_short_and_long_csv_lines(spark, root):
    names = bronze.CLIENTS.columns
    put_csv(f"{root}/landing/a.csv", names, [
        ["short"], ["long"] + [""] * len(names) + ["beyond"], ["quoted"] + ["a,b"] * (len(names) - 1)])
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    log.ingest(f"{root}/landing")
    got = {r.id: r.rescued_data for r in log.read().collect()}
    assert json.loads(got["short"]) == {drift.CORRUPT: "short"} and got["quoted"] is None
    assert json.loads(got["long"])[drift.CORRUPT].endswith(",beyond")
