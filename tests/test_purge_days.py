"""The 30-day purge keeps all thirty days."""

import datetime as dt

import __spark_entry__ as entry

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _events(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def test_purge_30_days_keeps_all_thirty_days(spark, tmp_path):
    as_of = dt.datetime(2024, 1, 31)
    ages = {1: dt.timedelta(days=0), 2: dt.timedelta(days=16), 3: dt.timedelta(days=29, hours=23), 4: dt.timedelta(days=30),
            5: dt.timedelta(days=30, seconds=1), 6: dt.timedelta(days=45)}
    rows = [(i, as_of - age, i, "view", 0.0, "{}") for i, age in ages.items()] + [(7, None, 7, "view", 0.0, "{}")]
    sf = _events(spark, str(tmp_path), rows)
    out = entry.queries()["m1_purge_30_days_exec"](spark, sf)
    assert sorted(r.exec_id for r in out.collect()) == [1, 2, 3, 4, 7]
    assert "INTERVAL 30 DAY" in entry.oracle_sql()["m1_purge_30_days_exec"]
