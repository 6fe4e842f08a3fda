"""Late click files: the ledger, the hours that are counted again, and runs that die."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clicktally.plans import late_files
from clicktally.plans.jobs import run_click_history
from clicktally.plans.late_files import read_ledger, run_late_hours
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.sinks import read_snapshots
from clicktally.sources import ClickLayout
from tests.test_clicks import LINES, line, put

SPAN = (datetime(2024, 1, 5, 8), datetime(2024, 1, 6, 3, 30))
ODD, EVEN = "offer-stream-even/2024/01/05", "offer-stream-odd/2024/01/06"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


@pytest.fixture
def run(spark, tmp_path):
    layout = ClickLayout(str(tmp_path / "in"))
    out, ledger, rejects = (str(tmp_path / name) for name in ("out", "ledger", "rejects"))

    def now():
        hours = run_late_hours(spark, layout, *SPAN, out, ledger, rejects)
        history = str(tmp_path / "history")
        run_click_history(spark, layout, *SPAN, history)
        stored = rows(read_snapshots(spark, out, CLICK_SNAPSHOT))
        assert stored == rows(read_snapshots(spark, history, CLICK_SNAPSHOT))
        return hours

    now.ledger = ledger
    return now


def test_only_hours_with_new_files_are_counted(spark, tmp_path, run):
    root = tmp_path / "in"
    assert run() == []
    put(root, f"{ODD}/08", "a.gz", LINES)
    put(root, f"{ODD}/23", "a.gz", LINES[:2])
    put(root, f"{EVEN}/03", "a.gz", LINES[1:])
    assert run() == ["2024/01/05/08", "2024/01/05/23", "2024/01/06/03"]
    assert run() == []
    put(root, f"{ODD}/23", "late.gz", LINES[2:])
    put(root, f"{ODD}/09", "late.gz", [line("C", "s", "adv9", "off9")])
    # Neither a file of another stream nor one outside the range is looked at.
    put(root, "offer-stream-odd/2024/01/05/08", "b.gz", LINES)
    put(root, f"{EVEN}/04", "b.gz", LINES)
    assert run() == ["2024/01/05/09", "2024/01/05/23"]
    assert run() == []
    assert read_ledger(spark, run.ledger, *SPAN).select("path").distinct().count() == 5


def test_a_changed_file_is_counted_again(tmp_path, run):
    root = tmp_path / "in"
    put(root, f"{ODD}/08", "a.gz", LINES[:1])
    put(root, f"{ODD}/09", "a.gz", LINES[:1])
    assert run() == ["2024/01/05/08", "2024/01/05/09"]
    put(root, f"{ODD}/08", "a.gz", LINES)
    assert run() == ["2024/01/05/08"]
    # An hour that has lost its clicks is emptied.
    put(root, f"{ODD}/09", "a.gz", ["C\tx"])
    assert run() == ["2024/01/05/09"]
    assert run() == []


@pytest.mark.parametrize("step", ["write_snapshots", "note_files"])
def test_a_run_that_dies_is_made_up_for(tmp_path, run, monkeypatch, step):
    put(tmp_path / "in", f"{ODD}/08", "a.gz", LINES)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(late_files, step, killed)
        with pytest.raises(RuntimeError, match="killed"):
            run()
    assert run() == ["2024/01/05/08"]
    assert run() == []


def test_the_listing_reads_no_file(spark, tmp_path):
    put(tmp_path, f"{ODD}/08", "a.gz", LINES)
    layout = ClickLayout(str(tmp_path))
    files = late_files.list_click_files(spark, layout, layout.hour_glob(SPAN[0]))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    (row,) = files.collect()
    assert row.hour == "2024/01/05/08" and row.length == (tmp_path / ODD / "08" / "a.gz").stat().st_size
    days = read_ledger(spark, str(tmp_path / "none"), *SPAN)
    assert days.filter(F.col("hour").isNotNull()).count() == 0
