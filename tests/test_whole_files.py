"""Click files that break off: told as rejects, while the others are counted whole."""

import gzip
import io
import random
from datetime import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clicktally.plans.jobs import run_click_statistics
from clicktally.plans.late_files import read_ledger, run_late_hours
from clicktally.schemas import CLICK_SNAPSHOT
from clicktally.sinks import read_snapshots
from clicktally.sources import ClickLayout, whole_files
from clicktally.sources.whole_files import unpack_to_end
from tests.test_clicks import COUNTS, LINES, line, put

AS_OF = datetime(2024, 1, 5, 10, 35)
HOUR = "offer-stream-even/2024/01/05/10"
CUT = "the file ends before its data does"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def packed(values):
    return gzip.compress("".join(value + "\n" for value in values).encode(), mtime=0)


def clicks(number, seed=0):
    rng = random.Random(seed)
    return [line("C", f"s{rng.random()}", f"adv{rng.randrange(9)}", "off") for _ in range(number)]


def lenient(data):
    """Whole lines and whether it breaks off, by the library's own reader, one byte at a time."""
    read = b""
    try:
        with gzip.open(io.BytesIO(data)) as file:
            while byte := file.read(1):
                read += byte
    except (EOFError, OSError, gzip.zlib.error):
        return read.count(b"\n"), True
    return read.count(b"\n"), not data


@pytest.mark.parametrize("piece, unpacked", [(1, 1), (7, 50), (1 << 20, 1 << 22)])
def test_every_cut_is_found(monkeypatch, piece, unpacked):
    monkeypatch.setattr(whole_files, "PIECE", piece)
    monkeypatch.setattr(whole_files, "UNPACKED", unpacked)
    data = packed(clicks(8)) + packed([]) + packed(LINES)
    for end in range(0, len(data) + 1, 1 if piece > 1 else 13):
        lines, reason = unpack_to_end(memoryview(data[:end]))
        wanted, breaks = lenient(data[:end])
        assert (reason is not None) == breaks
        assert lines <= 14 and (breaks or lines == wanted)
    assert unpack_to_end(memoryview(data + bytes(20))) == (14, None)
    spoilt = bytearray(data)
    spoilt[len(data) // 3] ^= 255
    assert unpack_to_end(memoryview(bytes(spoilt)))[1] is not None
    assert unpack_to_end(memoryview(b"no gzip at all"))[1] is not None


def test_a_cut_file_is_set_aside_and_the_others_are_counted_whole(spark, tmp_path):
    root, out, rejects = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "rejects")
    put(root, HOUR, "a.gz", LINES)
    many = packed(clicks(5000))
    (root / HOUR / "cut one.gz").write_bytes(many[: len(many) // 2])
    (root / HOUR / "empty.gz").write_bytes(packed([]))
    (root / HOUR / "spoilt=1.gz").write_bytes(b"no gzip at all")
    layout = ClickLayout(str(root))
    for _ in range(2):
        assert run_click_statistics(spark, layout, AS_OF, out, rejects) == 1
        assert rows(read_snapshots(spark, out, CLICK_SNAPSHOT)) == COUNTS
        found = spark.read.parquet(f"{rejects}/files")
        name = F.substring_index("path", "/", -1)
        cut, spoilt = rows(found.select(name, "hour", "lines", "reason"))
        assert cut[:2] == ("cut one.gz", "2024/01/05/10") and cut[3] == CUT
        assert 2000 < cut[2] < 3000
        assert spoilt[:3] == ("spoilt=1.gz", "2024/01/05/10", 0)
    assert [row.value for row in spark.read.parquet(f"{rejects}/lines").collect()] == ["C\tx"]

    # The next run finds the files whole.
    (root / HOUR / "cut one.gz").write_bytes(many)
    (root / HOUR / "spoilt=1.gz").write_bytes(packed(["C\ty"]))
    assert run_click_statistics(spark, layout, AS_OF, out, rejects) == 2
    counted = read_snapshots(spark, out, CLICK_SNAPSHOT).agg(F.sum("count_of_clicks")).first()[0]
    assert counted == 5000 + 4
    assert spark.read.parquet(f"{rejects}/files").count() == 0


def test_without_a_path_for_rejects_the_failure_stands(spark, tmp_path):
    data = packed(clicks(50))
    folder = tmp_path / "in" / HOUR
    folder.mkdir(parents=True)
    (folder / "cut.gz").write_bytes(data[:-9])
    with pytest.raises((PySparkException, Py4JJavaError)):
        run_click_statistics(spark, ClickLayout(str(tmp_path / "in")), AS_OF, str(tmp_path / "out"))
    assert rows(read_snapshots(spark, str(tmp_path / "out"), CLICK_SNAPSHOT)) == []


def test_another_failure_stands(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    out = tmp_path / "out"
    out.write_text("a file where the folder should be")
    with pytest.raises((PySparkException, Py4JJavaError)):
        run_click_statistics(
            spark, ClickLayout(str(tmp_path / "in")), AS_OF, str(out), str(tmp_path / "r")
        )


def test_an_hour_of_cut_files_only_stores_nothing(spark, tmp_path):
    folder = tmp_path / "in" / HOUR
    folder.mkdir(parents=True)
    (folder / "cut.gz").write_bytes(packed(clicks(50))[:-9])
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    assert run_click_statistics(spark, ClickLayout(str(tmp_path / "in")), AS_OF, out, rejects) == 0
    assert rows(read_snapshots(spark, out, CLICK_SNAPSHOT)) == []
    assert spark.read.parquet(f"{rejects}/files").count() == 1


def test_late_hours_wait_for_cut_files(spark, tmp_path):
    root = tmp_path / "in"
    layout = ClickLayout(str(root))
    out, ledger, rejects = (str(tmp_path / name) for name in ("out", "ledger", "rejects"))
    span = (datetime(2024, 1, 5, 8), datetime(2024, 1, 5, 12))
    put(root, HOUR, "a.gz", LINES)
    data = packed(clicks(40))
    (root / HOUR / "b.gz").write_bytes(data[:200])

    def now():
        return run_late_hours(spark, layout, *span, out, ledger, rejects)

    hour = ["2024/01/05/10"]
    for _ in range(2):
        assert now() == hour
        assert read_ledger(spark, ledger, *span).select("path").distinct().count() == 1
        assert read_snapshots(spark, out, CLICK_SNAPSHOT).count() == 3
    (root / HOUR / "b.gz").write_bytes(data)
    assert now() == hour
    assert now() == []
    counted = read_snapshots(spark, out, CLICK_SNAPSHOT).agg(F.sum("count_of_clicks")).first()[0]
    assert counted == 44
