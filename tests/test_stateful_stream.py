"""The stream with a state store against the one that keeps its counts in folders."""

import shutil
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicktally.plans.jobs import run_click_history
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.sinks import read_snapshots
from clicktally.sources import ClickLayout
from clicktally.streaming import run_click_stream, run_stateful_stream, stateful_counts
from tests.test_clicks import LINES, line, put

DAY = "offer-stream-even/2024/01/05"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def places(tmp_path):
    """The folders of a stream: layers, snapshots, checkpoint and rejects."""
    return [str(tmp_path / name) for name in ("layers", "snapshots", "checkpoint", "rejects")]


def run(spark, layout, places, **options):
    *paths, rejects = places
    query = run_stateful_stream(spark, layout, *paths, rejects_path=rejects, **options)
    query.awaitTermination()
    return read_snapshots(spark, places[1], CLICK_SNAPSHOT)


def deliver(root, times):
    """Three deliveries: new hours, files of hours that were counted before, broken lines."""
    for time in times:
        for hour in range(8, 12 + time):
            put(root, f"{DAY}/{hour:02}", f"{time}.gz", LINES[time:] + [line("B", f"s{time}", "adv2", "off1")])
        put(root, "offer-stream-odd/2024/01/05/10", f"{time}.gz", LINES[:1])


def test_three_runs_equal_the_folders_of_counts(spark, tmp_path, places):
    layout = ClickLayout(str(tmp_path / "in"))
    folders = [str(tmp_path / name) for name in ("counts", "other", "progress")]
    for time in range(3):
        deliver(tmp_path / "in", [time])
        stored = rows(run(spark, layout, places, files_per_batch=3))
        run_click_stream(spark, layout, *folders, rejects_path=f"{folders[0]}-r").awaitTermination()
        assert stored == rows(read_snapshots(spark, folders[1], CLICK_SNAPSHOT))
        assert len(stored) >= 12
    rejects = [spark.read.parquet(path) for path in (places[3], f"{folders[0]}-r")]
    found, wanted = (Counter(map(tuple, r.select("value", "hour", "reason").collect())) for r in rejects)
    assert found == wanted and {reason for _, _, reason in found} == {"wrong stream", "fewer than 7 tokens"}


@pytest.mark.parametrize("step", ["_newest", "write_snapshots", "join_layers"])
def test_a_killed_batch_is_run_again(spark, tmp_path, places, monkeypatch, step):
    layout = ClickLayout(str(tmp_path / "in"))
    deliver(tmp_path / "in", [0])
    run(spark, layout, places)
    deliver(tmp_path / "in", [1])

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(stateful_counts, step, killed)
        with pytest.raises(Exception, match="killed"):
            run(spark, layout, places)
    stored = rows(run(spark, layout, places))
    history = str(tmp_path / "history")
    run_click_history(spark, layout, datetime(2024, 1, 5), datetime(2024, 1, 5, 23), history)
    assert stored == rows(read_snapshots(spark, history, CLICK_SNAPSHOT))


def test_files_of_closed_hours_are_set_aside(spark, tmp_path, places):
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    put(root, f"{DAY}/08", "a.gz", LINES[:2])
    put(root, f"{DAY}/20", "a.gz", LINES[:2])
    stored = rows(run(spark, layout, places, delay="3 hours"))
    put(root, f"{DAY}/08", "late.gz", LINES)
    put(root, f"{DAY}/17", "just.gz", LINES[:1])
    put(root, f"{DAY}/18", "in-time.gz", LINES[:2])
    after = rows(run(spark, layout, places, delay="3 hours"))
    assert {row[0][11:13] for row in set(after) - set(stored)} == {"18"}
    assert set(stored) <= set(after)
    rejects = spark.read.parquet(places[3]).filter("reason = 'hour closed'")
    assert Counter(row.hour[-2:] for row in rejects.collect()) == {"08": len(LINES), "17": 1}


def test_layers_of_an_hour_are_joined(spark, tmp_path, places, monkeypatch):
    monkeypatch.setattr(stateful_counts, "MOST_LAYERS", 2)
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    for time in range(6):
        put(root, f"{DAY}/08", f"{time}.gz", [LINES[time % 2], line("C", f"t{time}", f"adv{time}", "off")])
        stored = rows(run(spark, layout, places))
        folders = list((tmp_path / "layers" / "day=2024-01-05" / "hour_of_day=08").glob("*/*"))
        assert len(folders) <= 4
    assert sum(row[-1] for row in stored) == 12
    history = str(tmp_path / "history")
    run_click_history(spark, layout, datetime(2024, 1, 5), datetime(2024, 1, 5, 23), history)
    assert stored == rows(read_snapshots(spark, history, CLICK_SNAPSHOT))


@pytest.mark.parametrize("left", [[], [1, 2]])
def test_a_joined_layer_is_whole_before_others_go(spark, tmp_path, left):
    """A batch that died while it deleted layers finds the joined one and deletes the rest."""
    path = str(tmp_path / "layers")

    def layer(batch, joined=0):
        held = [("2024/01/05/08", f"o{batch % 3}", "a", batch, "C", "s")]
        if joined:
            held = [("2024/01/05/08", f"o{b % 3}", "a", b, "C", "s") for b in range(batch - 2, batch + 1)]
        frame = spark.createDataFrame(held, stateful_counts.COUNTS_SCHEMA)
        stateful_counts._store(frame, path, F.lit(batch).cast("long"), joined)

    batches = range(1, 12) if not left else left
    for batch in batches:
        layer(batch)
    if left:
        layer(11, 1)
        for batch in range(3, 12):
            layer(batch)
            shutil.rmtree(f"{path}/day=2024-01-05/hour_of_day=08/batch={batch}/joined=0")
        for batch in range(5, 12):
            layer(batch)
    layer(12)
    layers = stateful_counts._layers(spark, path)
    wanted = rows(stateful_counts._newest(layers))
    stateful_counts.join_layers(spark, layers, path, 12)
    after = stateful_counts._layers(spark, path)
    assert rows(stateful_counts._newest(after)) == wanted
    assert rows(after.select("batch", "joined").distinct()) == [(11, 1), (12, 0)]


def test_a_batch_writes_one_file_for_each_hour(spark, tmp_path, places):
    layout = ClickLayout(str(tmp_path / "in"))
    for hour in range(8, 12):
        put(tmp_path / "in", f"{DAY}/{hour:02}", "a.gz", [line("C", "s", f"adv{i}", f"off{i}") for i in range(40)])
    assert run(spark, layout, places).count() == 160
    for path in places[:2]:
        assert len(spark.read.parquet(path).inputFiles()) == 4
