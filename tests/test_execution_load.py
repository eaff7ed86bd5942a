"""The execution load (PL3): results, and each line parsed once."""

import datetime as dt

import duckdb

import __spark_entry__ as entry
from jobscope.plans import jobs as J

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _line(centre, job, order, attempt, start, end, status="Ended Not OK", day="May 20, 2025"):
    return (f'{centre},FLD1,APP,GRP,N1,{job},"{day}","{day.replace(",", "")} {start} PM","{day} {end} PM",{attempt},{status},0,{order}',)


LOAD = [_line("DS-A", "J1", "O1", 1, "03:00:00", "3:10:00"), _line("DS-A", "J1", "O1", 2, "03:20:00", "3:30:00"),
        _line("DS-A", "J1", "O1", 2, "03:15:00", "3:25:00"),                        # replaced: the last end wins
        _line("DS-B", "J1", "O1", 1, "02:00:00", "2:10:00"),                        # an earlier attempt in another centre
        _line("DS-A", "J1", "O1", 3, "04:00:00", "4:10:00", "Ended OK"),            # not failed
        _line("DS-A", "J2", "O2", 1, "01:00:00", "1:10:00", day="May 1, 2025"),     # failed before the ten days
        _line("DS-A", "J2", "O2", 2, "01:20:00", "1:30:00", day="May 1, 2025"),
        _line("DS-A", "J3", "O3", "x", "05:00:00", "5:10:00")]                      # no attempt number


def test_execution_load_results(spark):
    out = J.load_executions(spark.createDataFrame(LOAD, "value string"), "2025-05-25 00:00:00")
    got = sorted((r.data_center, r.job_name, r.rerun_counter or 0, r.runtime_s, r.mttr_s or 0) for r in out["executions"].collect())
    assert got == [("DS-A", "J1", 1, 600, 0), ("DS-A", "J1", 2, 600, 1800), ("DS-A", "J1", 2, 600, 5400), ("DS-A", "J1", 3, 600, 0),
                   ("DS-A", "J2", 1, 600, 0), ("DS-A", "J2", 2, 600, 0), ("DS-A", "J3", 0, 600, 0), ("DS-B", "J1", 1, 600, 0)]
    assert sorted(r.mttr_s for r in out["mttr"].collect()) == [1800, 5400]


def test_execution_load_parses_each_line_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def tell(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    lines = spark.createDataFrame(LOAD, "value string").mapInArrow(tell, "value string")
    out = J.load_executions(lines, "2025-05-25 00:00:00")
    for name in ("executions", "latest", "open", "mttr"):
        out[name].collect()
    assert seen.value == len(LOAD)


def test_execution_load_equals_its_sql_on_equal_times(spark, tmp_path):
    t = dt.datetime(2024, 1, 25, 10)
    rows = [(i, t + dt.timedelta(seconds=i // 2), i % 3, "error" if i % 4 else "view", float(i % 5), "{}") for i in range(60)]
    rows += [(100 + i, dt.datetime(2024, 1, 2, i), 1, "error", 1.0, "{}") for i in range(4)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{sf}/events.parquet")
    got = entry.queries()["pl3_execution_load"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    want = con.execute(entry.oracle_sql()["pl3_execution_load"]).fetchall()
    pos = {c[0]: i for i, c in enumerate(con.description)}
    keys = ["order_id", "rerun_counter", "start_time", "runtime_s", "mttr_s"]

    def plain(v):
        return str(v.replace(tzinfo=None)) if isinstance(v, dt.datetime) else str(v)

    assert (sorted(tuple(plain(r[k]) for k in keys) for r in got.collect())
            == sorted(tuple(plain(r[pos[k]]) for k in keys) for r in want))
