from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicktally.operators.checks import (
    ContractViolation,
    key_violations,
    require_contract,
    width_violations,
)
from clicktally.operators.conversions import conversion_snapshots_by_day
from clicktally.operators.upsert import upsert
from clicktally.plans.jobs import (
    append_click_statistics,
    append_conversion_statistics,
    run_click_consolidation,
    run_click_history,
    run_click_search,
    run_click_statistics,
    run_conversion_consolidation,
    run_conversion_history,
    run_conversion_statistics,
    upsert_click_days,
)
from clicktally.schemas import (
    CLICK_DAILY,
    CLICK_SNAPSHOT,
    CLICK_UPDATES,
    CONVERSION_DAILY,
    CONVERSION_SNAPSHOT,
)
from clicktally.session import delete_path, fresh_path, shared_folder
from clicktally.sinks import (
    append_rows,
    read_daily,
    read_snapshots,
    replace_days,
    stage_days,
    upsert_statement,
    write_snapshots,
)
from clicktally.sources import ClickLayout
from clicktally.streaming import click_stream, run_click_stream
from clicktally.streaming.click_stream import ForeignCounts
from tests.test_clicks import COUNTS, LINES, line, put
from tests.test_conversions import GOLDEN, log_of

AS_OF = datetime(2024, 1, 5, 10, 35)
HOUR = "offer-stream-even/2024/01/05/10"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_click_statistics_and_rejects(spark, tmp_path):
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    layout = ClickLayout(str(tmp_path / "in"))
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    for _ in range(2):
        assert run_click_statistics(spark, layout, AS_OF, out, rejects) == 1
        assert rows(read_snapshots(spark, out, CLICK_SNAPSHOT)) == COUNTS
    assert [row.value for row in spark.read.parquet(f"{rejects}/lines").collect()] == ["C\tx"]

    put(tmp_path / "in", HOUR, "b.gz", LINES[:1])
    later = datetime(2024, 1, 5, 10, 40)
    run_click_statistics(spark, layout, later, out)
    stored = read_snapshots(spark, out, CLICK_SNAPSHOT, AS_OF)
    merged = stored.filter("offer_advertiser_id = 'adv1'")
    assert rows(merged.select("key_dt", "count_of_clicks")) == [
        ("2024-01-05 10:35", 2),
        ("2024-01-05 10:40", 3),
    ]


def test_an_hour_without_files_stores_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    layout = ClickLayout(str(tmp_path))
    assert run_click_statistics(spark, layout, AS_OF, out, str(tmp_path / "r")) == 0
    assert rows(read_snapshots(spark, out, CLICK_SNAPSHOT)) == []


def test_an_hour_without_rejects_writes_none(spark, tmp_path):
    put(tmp_path / "in", HOUR, "a.gz", LINES[:2])
    rejects = tmp_path / "rejects"
    run_click_statistics(
        spark, ClickLayout(str(tmp_path / "in")), AS_OF, str(tmp_path / "out"), str(rejects)
    )
    assert spark.read.parquet(f"{rejects}/lines").count() == 0


def test_history_equals_the_last_runs_of_hours_and_days(spark, tmp_path):
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    put(tmp_path / "in", "offer-stream-odd/2024/01/06/03", "a.gz", LINES[1:])
    layout = ClickLayout(str(tmp_path / "in"))
    runs, history = str(tmp_path / "runs"), str(tmp_path / "history")
    hours = (datetime(2024, 1, 5, 10, 59), datetime(2024, 1, 6, 3, 59))
    for as_of in hours:
        run_click_statistics(spark, layout, as_of, runs)
    run_click_history(spark, layout, *hours, history)
    stored = rows(read_snapshots(spark, history, CLICK_SNAPSHOT))
    assert stored == rows(read_snapshots(spark, runs, CLICK_SNAPSHOT))
    assert len(stored) == 6

    log = log_of(spark, GOLDEN)
    runs, history = str(tmp_path / "c-runs"), str(tmp_path / "c-history")
    for day in (4, 5):
        run_conversion_statistics(log, datetime(2024, 1, day, 23, 59, 59), runs)
    run_conversion_history(log, history)
    stored = rows(read_snapshots(spark, history, CONVERSION_SNAPSHOT))
    assert stored == rows(read_snapshots(spark, runs, CONVERSION_SNAPSHOT))
    assert len(stored) == 3


def test_search_reads_the_whole_day(spark, tmp_path):
    put(tmp_path, HOUR, "a.gz", LINES)
    put(tmp_path, "offer-stream-even/2024/01/05/23", "a.gz", [LINES[1]])
    found = run_click_search(spark, ClickLayout(str(tmp_path)), AS_OF, "s2")
    assert rows(found) == [("off1", "adv1")] * 2


def test_conversion_statistics_and_consolidation(spark, tmp_path):
    snapshots, daily = str(tmp_path / "snapshots"), str(tmp_path / "daily")
    log = log_of(spark, GOLDEN)
    staging = str(tmp_path / "staging")
    for as_of in (datetime(2024, 1, 5, 11), datetime(2024, 1, 5, 12)):
        run_conversion_statistics(log, as_of, snapshots)
        stored = read_snapshots(spark, snapshots, CONVERSION_SNAPSHOT, as_of)
        run_conversion_consolidation(stored, as_of, daily, staging)
    assert stored.count() == 4
    assert rows(read_daily(spark, daily, CONVERSION_DAILY)) == [
        ("2024-01-05", "C", "7", 15.5, 5.0, 10.5, 2),
        ("2024-01-05", "R", "7", 11.0, 5.0, 6.0, 2),
    ]


def snapshot(spark, *rows_):
    return spark.createDataFrame(list(rows_), CLICK_SNAPSHOT.schema)


def test_click_consolidation_leaves_other_days_alone(spark, tmp_path):
    daily, staging = str(tmp_path / "daily"), str(tmp_path / "staging")
    before = snapshot(spark, ("2024-01-04 23:55", "C", "o1", "a", "s", 99))
    run_click_consolidation(before, datetime(2024, 1, 4, 23, 59), daily, staging)
    today = [
        ("2024-01-04 22:00", "C", "o1", "a", "s", 1),
        ("2024-01-05 10:00", "C", "o1", "a", "s", 5),
        ("2024-01-05 10:00", "C", "o2", "a", "s", 6),
    ]
    run_click_consolidation(snapshot(spark, *today), AS_OF, daily, staging)
    later = snapshot(spark, *today, ("2024-01-05 11:00", "C", "o1", "b", "NA", 9))
    expected = [
        ("2024-01-04", "C", "o1", "a", "s", 99),
        ("2024-01-05", "C", "o1", "a", "s", 9),
        ("2024-01-05", "C", "o2", "a", "s", 6),
    ]
    for _ in range(2):
        run_click_consolidation(later, AS_OF, daily, staging)
        assert rows(read_daily(spark, daily, CLICK_DAILY)) == expected


def test_a_replacement_cut_short_is_finished_from_the_staged_days(spark, tmp_path):
    daily, part, staged = (str(tmp_path / name) for name in ("daily", "part", "staged"))
    whole = [("2024-01-05", "C", "o1", "a", "s", 5), ("2024-01-06", "C", "o1", "a", "s", 6)]
    stage_days(spark.createDataFrame(whole[:1], CLICK_DAILY.schema), part)
    replace_days(spark, part, daily, CLICK_DAILY)
    stage_days(spark.createDataFrame(whole, CLICK_DAILY.schema), staged)
    replace_days(spark, staged, daily, CLICK_DAILY)
    assert rows(read_daily(spark, daily, CLICK_DAILY)) == whole


def test_spoilt_snapshots_are_kept_apart(spark, tmp_path):
    rejects = str(tmp_path / "rejects")
    run_click_consolidation(
        snapshot(spark, ("2024-01-05 10:00", "C", None, "a", "s", 5)),
        AS_OF,
        str(tmp_path / "daily"),
        str(tmp_path / "staging"),
        rejects,
    )
    found = spark.read.parquet(f"{rejects}/snapshots").collect()
    assert [row.reason for row in found] == ["no offer"]


def test_contract_of_keys_and_widths(spark):
    fits = snapshot(spark, ("2024-01-05 10:00", "C", "o" * 30, "a", "s", 5))
    require_contract(fits, CLICK_SNAPSHOT)
    wide = snapshot(spark, ("2024-01-05 10:00", "C" * 21, "o" * 31, "a", "s", 5))
    assert [tuple(row)[-3:] for row in width_violations(wide, CLICK_SNAPSHOT).collect()] == [
        ("key_type", 20, 21),
        ("offer_id", 30, 31),
    ]
    for broken in (wide, fits.unionByName(fits)):
        with pytest.raises(ContractViolation):
            require_contract(broken, CLICK_SNAPSHOT)


def test_nothing_is_appended_that_breaks_the_contract(spark):
    row = ("2024-01-05 10:00", "C", "o1", "a", "s", 5)
    with pytest.raises(ContractViolation):
        append_rows(snapshot(spark, row, row), "jdbc:none", CLICK_SNAPSHOT, {})


def test_upsert_statements():
    names = "key_dt, key_type, offer_id, offer_advertiser_id, destination_subid, count_of_clicks"
    staged = "v2_s3_consolidate_stats_staging"
    start = f"INSERT INTO v2_s3_consolidate_stats ({names}) SELECT {names} FROM {staged}"
    assert upsert_statement(CLICK_DAILY, CLICK_UPDATES, "mysql") == (
        f"{start} ON DUPLICATE KEY UPDATE count_of_clicks = {staged}.count_of_clicks"
    )
    assert upsert_statement(CLICK_DAILY, CLICK_UPDATES, "postgresql") == (
        f"{start} WHERE true ON CONFLICT (key_dt, key_type, offer_id)"
        " DO UPDATE SET count_of_clicks = excluded.count_of_clicks"
    )
    with pytest.raises(ValueError):
        upsert_statement(CLICK_DAILY, CLICK_UPDATES, "other")


class Recorder:
    """Stands for the writer of a DataFrame to a database."""

    def __init__(self, monkeypatch):
        self.calls = []
        from pyspark.sql import DataFrameWriter

        def jdbc(writer, url, table, mode=None, properties=None):
            rows = sorted(map(tuple, writer._df.collect()), key=repr)
            self.calls.append((url, table, mode, properties, rows))

        monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)

    def execute(self, statement):
        self.calls.append(statement)


def test_upsert_stages_rows_and_sends_one_statement(spark, monkeypatch):
    database = Recorder(monkeypatch)
    today = [
        ("2024-01-05 10:00", "C", "o1", "a", "s", 5),
        ("2024-01-05 11:00", "C", "o1", "a", "s", 7),
    ]
    upsert_click_days(
        snapshot(spark, *today), AS_OF, "jdbc:x", database.execute, {"user": "u"}, "postgresql"
    )
    staged, statement = database.calls
    assert staged == (
        "jdbc:x",
        "v2_s3_consolidate_stats_staging",
        "overwrite",
        {"user": "u"},
        [("2024-01-05", "C", "o1", "a", "s", 7)],
    )
    assert statement == upsert_statement(CLICK_DAILY, CLICK_UPDATES, "postgresql")


def test_jobs_append_to_a_database(spark, tmp_path, monkeypatch):
    database = Recorder(monkeypatch)
    put(tmp_path, HOUR, "a.gz", LINES)
    append_click_statistics(spark, ClickLayout(str(tmp_path)), AS_OF, "jdbc:x", {})
    append_conversion_statistics(
        log_of(spark, GOLDEN), datetime(2024, 1, 5, 12), "jdbc:x", {}
    )
    clicks, conversions = database.calls
    assert clicks[:3] == ("jdbc:x", "v2_s3_stats", "append") and clicks[4] == COUNTS
    assert conversions[1] == "v2_agg_stats" and len(conversions[4]) == 2


def test_stream_counts_every_file_once(spark, tmp_path):
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    partials, snapshots, progress = (str(tmp_path / name) for name in ("p", "s", "c"))

    def run():
        query = run_click_stream(spark, layout, partials, snapshots, progress, 2)
        query.awaitTermination()
        return rows(read_snapshots(spark, snapshots, CLICK_SNAPSHOT))

    put(root, HOUR, "a.gz", LINES)
    put(root, "offer-stream-even/2024/01/05/11", "a.gz", [line("C", "t1", "adv1", "off1")])
    put(root, "offer-stream-odd/2024/01/05/10", "offer-stream-even.gz", LINES)
    first = [("2024-01-05 10:59", *row[1:]) for row in COUNTS] + [
        ("2024-01-05 11:59", "C", "off1", "adv1", "t1", 1)
    ]
    assert run() == sorted(first)
    assert run() == sorted(first)

    put(root, HOUR, "late.gz", [line("B", "s9", "adv2", "off1")])
    put(root, "offer-stream-odd/2024/01/06/00", "a.gz", [line("C", "u1", "adv1", "off1")])
    second = [row for row in first if row[3] != "adv2"] + [
        ("2024-01-05 10:59", "B", "off1", "adv2", "NA", 2),
        ("2024-01-06 00:59", "C", "off1", "adv1", "u1", 1),
    ]
    assert run() == sorted(second)


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    layout = ClickLayout(str(tmp_path / "in"))
    partials, snapshots, progress = (str(tmp_path / name) for name in ("p", "s", "c"))
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    results = []
    for _ in range(2):
        run_click_stream(spark, layout, partials, snapshots, progress).awaitTermination()
        results.append(rows(read_snapshots(spark, snapshots, CLICK_SNAPSHOT)))
        # A batch whose commit is missing is run again, as after a crash.
        commits = list((tmp_path / "c" / "commits").glob("*0*"))
        assert commits
        for commit in commits:
            commit.unlink()
    assert results[0] == results[1] == [("2024-01-05 10:59", *row[1:]) for row in COUNTS]


def test_shared_folder_is_that_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert fresh_path(spark, "x").startswith(f"{folder}/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_a_repeated_run_replaces_its_own_snapshots_only(spark, tmp_path):
    path = str(tmp_path)
    first = snapshot(spark, ("2024-01-05 10:00", "C", "o1", "a", "s", 5))
    second = snapshot(spark, ("2024-01-05 10:05", "C", "o1", "a", "s", 6))
    for frame in (first, second, first):
        write_snapshots(frame, path, CLICK_SNAPSHOT)
    assert [row[-1] for row in rows(read_snapshots(spark, path, CLICK_SNAPSHOT))] == [5, 6]


def test_two_histories_of_one_day_leave_each_other_alone(spark, tmp_path):
    root, path = tmp_path / "in", str(tmp_path / "out")
    layout = ClickLayout(str(root))
    for hour in (10, 11, 13):
        put(root, f"offer-stream-even/2024/01/05/{hour}", "a.gz", [LINES[1]])
    run_click_history(spark, layout, datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11), path)
    run_click_history(spark, layout, datetime(2024, 1, 5, 13), datetime(2024, 1, 5, 13), path)
    found = [row[0] for row in rows(read_snapshots(spark, path, CLICK_SNAPSHOT))]
    assert found == [f"2024-01-05 {hour}:59" for hour in (10, 11, 13)]


def test_a_repeat_without_rows_empties_its_own_folder(spark, tmp_path):
    root, path = tmp_path / "in", str(tmp_path / "out")
    layout = ClickLayout(str(root))
    for hour in (10, 11):
        put(root, f"offer-stream-even/2024/01/05/{hour}", "a.gz", [LINES[1]])
    first, last = datetime(2024, 1, 5, 10), datetime(2024, 1, 5, 11, 59)
    run_click_history(spark, layout, first, last, path)
    run_click_statistics(spark, layout, AS_OF, path)
    assert read_snapshots(spark, path, CLICK_SNAPSHOT).count() == 3
    put(root, HOUR, "a.gz", [line("C", "s", "", "")])
    run_click_statistics(spark, layout, AS_OF, path)
    run_click_history(spark, layout, first, last, path)
    found = [row[0] for row in rows(read_snapshots(spark, path, CLICK_SNAPSHOT))]
    assert found == ["2024-01-05 11:59"]


def test_stream_history_and_run_of_one_minute_store_one_snapshot(spark, tmp_path):
    root, path = tmp_path / "in", str(tmp_path / "out")
    layout = ClickLayout(str(root))
    put(root, HOUR, "a.gz", LINES)
    end = datetime(2024, 1, 5, 10, 59)
    run_click_history(spark, layout, end, end, path)
    run_click_stream(
        spark, layout, str(tmp_path / "p"), path, str(tmp_path / "c")
    ).awaitTermination()
    run_click_statistics(spark, layout, end, path)
    stored = read_snapshots(spark, path, CLICK_SNAPSHOT)
    assert rows(stored) == [("2024-01-05 10:59", *row[1:]) for row in COUNTS]
    require_contract(stored, CLICK_SNAPSHOT)


def test_null_types_are_set_aside_and_null_keys_match(spark, tmp_path):
    daily, staging = str(tmp_path / "daily"), str(tmp_path / "staging")
    spoilt = snapshot(
        spark,
        ("2024-01-05 10:00", None, "o1", "a", "s", 5),
        ("2024-01-05 10:00", "C", "o2", "a", "s", 6),
    )
    for _ in range(2):
        run_click_consolidation(spoilt, AS_OF, daily, staging, str(tmp_path / "rejects"))
        assert rows(read_daily(spark, daily, CLICK_DAILY)) == [
            ("2024-01-05", "C", "o2", "a", "s", 6)
        ]
    held = spark.createDataFrame([("d", None, "o", "a", "s", 1)], CLICK_DAILY.schema)
    new = spark.createDataFrame([("d", None, "o", "a", "s", 2)], CLICK_DAILY.schema)
    assert rows(upsert(held, new, CLICK_DAILY.key, CLICK_UPDATES)) == [
        ("d", None, "o", "a", "s", 2)
    ]
    reasons = [row.reason for row in key_violations(held, CLICK_DAILY.key).collect()]
    assert reasons == ["null in key"]


def test_the_next_run_finishes_a_replacement_that_died(spark, tmp_path, monkeypatch):
    from clicktally.sinks import tables

    daily, staging = str(tmp_path / "daily"), str(tmp_path / "staging")
    early = snapshot(spark, ("2024-01-05 09:00", "C", "o1", "a", "s", 5))
    run_click_consolidation(early, AS_OF, daily, staging)
    replace = tables._replace_folders

    def die(frame, path, folders):
        import shutil

        shutil.rmtree(f"{path}/key_dt=2024-01-05")
        raise RuntimeError("died between delete and move")

    monkeypatch.setattr(tables, "_replace_folders", die)
    middle = snapshot(spark, ("2024-01-05 10:00", "C", "o2", "a", "s", 6))
    with pytest.raises(RuntimeError):
        run_click_consolidation(middle, datetime(2024, 1, 5, 10, 36), daily, staging)
    monkeypatch.setattr(tables, "_replace_folders", replace)
    late = snapshot(spark, ("2024-01-05 11:00", "C", "o3", "a", "s", 7))
    run_click_consolidation(late, datetime(2024, 1, 5, 11, 35), daily, staging)
    assert [row[2] for row in rows(read_daily(spark, daily, CLICK_DAILY))] == ["o1", "o2", "o3"]


def test_a_stream_refuses_partials_of_another_checkpoint(spark, tmp_path):
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    put(root, HOUR, "a.gz", LINES)
    partials, snapshots = str(tmp_path / "p"), str(tmp_path / "s")
    for _ in range(2):
        run_click_stream(
            spark, layout, partials, snapshots, str(tmp_path / "c1")
        ).awaitTermination()
    with pytest.raises(ForeignCounts):
        run_click_stream(spark, layout, partials, snapshots, str(tmp_path / "c2"))


def test_stream_rejects_broken_lines_and_files_in_the_wrong_stream(spark, tmp_path):
    root, rejects = tmp_path / "in", str(tmp_path / "rejects")
    layout = ClickLayout(str(root))
    put(root, HOUR, "a.gz", LINES)
    put(root, HOUR.replace("even", "odd"), "b.gz", LINES[:1])
    paths = [str(tmp_path / name) for name in ("p", "s", "c")]
    run_click_stream(spark, layout, *paths, rejects_path=rejects).awaitTermination()
    found = spark.read.parquet(rejects).groupBy("reason").count().collect()
    assert {row.reason: row["count"] for row in found} == {
        "fewer than 7 tokens": 1,
        "wrong stream": 1,
    }


def test_a_batch_reads_the_last_counts_of_the_hours_it_touched(spark, tmp_path):
    def counts(hour, clicks, batch):
        return (f"2024/01/05/{hour}", "o", "a", clicks, "C", "s", "2024-01-05", hour, "w", batch)

    held = [counts("10", 1, 0), counts("10", 3, 2), counts("10", 9, 5), counts("11", 4, 2)]
    path = str(tmp_path / "counts")
    schema = click_stream.STORED_SCHEMA
    click_stream._write_counts(spark.createDataFrame(held, schema), path)
    stored = spark.read.schema(schema).parquet(path)
    new = spark.createDataFrame([counts("10", 1, 5)[:6]], click_stream.COUNTS_SCHEMA)
    found = click_stream.counts_before(stored, new, "w", 5)
    assert [row.clicks for row in found.collect()] == [3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "(batch#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "Semi" in plan


def test_counts_of_an_hour_are_kept_for_the_last_two_batches(spark, tmp_path):
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    paths = [str(tmp_path / name) for name in ("p", "s", "c")]
    for number in range(4):
        put(root, HOUR, f"{number}.gz", [line("B", "s9", "adv2", "off1")])
        run_click_stream(spark, layout, *paths).awaitTermination()
    kept = sorted(path.name for path in (tmp_path / "p").glob("*/*/*/*") if path.is_dir())
    assert kept == ["batch=2", "batch=3"]
    found = rows(read_snapshots(spark, paths[1], CLICK_SNAPSHOT))
    assert found == [("2024-01-05 10:59", "B", "off1", "adv2", "NA", 4)]


def test_search_and_history_keep_their_rejects(spark, tmp_path):
    root, rejects = tmp_path / "in", str(tmp_path / "rejects")
    layout = ClickLayout(str(root))
    put(root, HOUR, "a.gz", LINES)
    run_click_search(spark, layout, AS_OF, "s2", f"{rejects}/search")
    run_click_history(spark, layout, AS_OF, AS_OF, str(tmp_path / "out"), f"{rejects}/history")
    for path in (f"{rejects}/search", f"{rejects}/history/lines"):
        assert [row.value for row in spark.read.parquet(path).collect()] == ["C\tx"]


def test_rows_that_break_the_contract_end_a_run_or_are_set_aside(spark, tmp_path):
    root, path, rejects = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rejects")
    layout = ClickLayout(str(root))
    put(root, HOUR, "a.gz", [line("C", "s", "adv", "o" * 31), line("C", "s", "adv", "o1")])
    with pytest.raises(ContractViolation):
        run_click_statistics(spark, layout, AS_OF, path)
    run_click_statistics(spark, layout, AS_OF, path, rejects)
    assert [row[2] for row in rows(read_snapshots(spark, path, CLICK_SNAPSHOT))] == ["o1"]
    found = spark.read.parquet(f"{rejects}/v2_s3_stats").collect()
    assert [row.reason for row in found] == ["too long: offer_id"]


def test_values_of_dimensions_are_stored_as_rows(spark, tmp_path):
    values = str(tmp_path / "values")
    as_of = datetime(2024, 1, 5, 12)
    run_conversion_statistics(log_of(spark, GOLDEN), as_of, str(tmp_path / "s"), values_path=values)
    found = spark.read.parquet(values)
    stored = read_snapshots(spark, str(tmp_path / "s"), CONVERSION_SNAPSHOT).collect()
    for row in stored:
        for name in ("affiliates", "geo", "zones"):
            wanted = found.filter((F.col("key_type") == row.key_type) & (F.col("dimension") == name))
            listed = {r.value for r in wanted.filter(F.col("offer_id") == row.offerid).collect()}
            assert listed == set(filter(None, row[name].split("#")))


def test_days_are_those_of_utc_in_any_time_zone(spark):
    log = log_of(spark, GOLDEN).selectExpr(
        "* except (conversion_time, redshift_time)",
        "cast(conversion_time as timestamp) as conversion_time",
        "cast(redshift_time as timestamp) as redshift_time",
    )
    wanted = rows(conversion_snapshots_by_day(log))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(conversion_snapshots_by_day(log)) == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_intermediate_tables_are_deleted_and_nothing_else_is(spark, tmp_path):
    import pathlib

    folder = pathlib.Path(shared_folder(spark))
    before = set(folder.iterdir())
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    run_click_statistics(spark, ClickLayout(str(tmp_path / "in")), AS_OF, str(tmp_path / "out"))
    assert set(folder.iterdir()) == before
    for path in (str(tmp_path), shared_folder(spark), f"{shared_folder(spark)}/"):
        with pytest.raises(ValueError):
            delete_path(spark, path)


def test_staged_copies_and_notes_do_not_outlive_their_run(spark, tmp_path):
    daily, staging = str(tmp_path / "daily"), tmp_path / "staging"
    for minute in (35, 36):
        seen = snapshot(spark, ("2024-01-05 10:00", "C", "o1", "a", "s", minute))
        run_click_consolidation(seen, datetime(2024, 1, 5, 10, minute), daily, str(staging))
        held = [path for path in staging.rglob("*") if path.is_file() and path.name[0] not in "._"]
        assert held == []
    assert [row.count_of_clicks for row in read_daily(spark, daily, CLICK_DAILY).collect()] == [36]
