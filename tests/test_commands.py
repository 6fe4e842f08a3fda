from clicktally.__main__ import main
from clicktally.schemas import CLICK_DAILY, CLICK_SNAPSHOT, CONVERSION_DAILY, CONVERSION_SNAPSHOT
from clicktally.sinks import BucketedDays, read_bucketed_days, read_daily, read_snapshots
from tests.test_clicks import LINES, put
from tests.test_conversions import GOLDEN, log_of

HOUR = "offer-stream-even/2024/01/05/10"


def test_click_jobs(spark, tmp_path, capsys):
    put(tmp_path / "in", HOUR, "a.gz", LINES)
    root, snapshots = str(tmp_path / "in"), str(tmp_path / "snapshots")
    daily, staging = str(tmp_path / "daily"), str(tmp_path / "staging")
    at = ["--as-of", "2024-01-05T10:35"]
    main(["click-statistics", *at, "--root", root, "--snapshots", snapshots])
    assert "1 lines rejected" in capsys.readouterr().out
    assert read_snapshots(spark, snapshots, CLICK_SNAPSHOT).count() == 3
    main(
        ["consolidate-clicks", *at, "--snapshots", snapshots, "--daily", daily]
        + ["--staging", staging]
    )
    assert read_daily(spark, daily, CLICK_DAILY).count() == 2
    bucketed = str(tmp_path / "bucketed")
    main(
        ["consolidate-clicks", *at, "--snapshots", snapshots, "--daily", bucketed]
        + ["--buckets", "4"]
    )
    table = BucketedDays(bucketed, CLICK_DAILY, 4)
    stored = read_bucketed_days(spark, table).select(*CLICK_DAILY.columns)
    assert stored.exceptAll(read_daily(spark, daily, CLICK_DAILY)).count() == 0
    assert stored.count() == 2
    found = str(tmp_path / "found")
    main(["search", *at, "--root", root, "--out", found, "s2"])
    assert [row.value for row in spark.read.text(found).collect()] == ["off1,adv1"]
    copy = str(tmp_path / "copy")
    main(["copy", *at, "--root", root, "--copy", copy])
    main(["search", *at, "--root", root, "--copy", copy, "--out", found, "s3"])
    assert [row.value for row in spark.read.text(found).collect()] == ["off1,adv2"]
    ledger = str(tmp_path / "ledger")
    for wanted in ("1 hours counted", "0 hours counted"):
        main(["late-hours", *at, "--root", root, "--snapshots", snapshots, "--ledger", ledger])
        assert wanted in capsys.readouterr().out


def test_conversion_jobs(spark, tmp_path):
    log, snapshots, daily = (str(tmp_path / name) for name in ("log", "snapshots", "daily"))
    frame = log_of(spark, GOLDEN)
    frame.selectExpr(
        "* except (conversion_time, redshift_time)",
        "cast(conversion_time as timestamp) as conversion_time",
        "cast(redshift_time as timestamp) as redshift_time",
    ).write.parquet(log)
    at = ["--as-of", "2024-01-05T14:00:00+02:00"]
    main(["conversion-statistics", *at, "--log", log, "--snapshots", snapshots])
    main(
        ["consolidate-conversions", *at, "--snapshots", snapshots, "--daily", daily]
        + ["--staging", str(tmp_path / "staging")]
    )
    # All conversions are loaded by then, so the refresh and the run over the day see the same.
    later = ["--as-of", "2024-01-05T14:00:05+02:00", "--log", log, "--snapshots"]
    whole, refreshed = str(tmp_path / "whole"), str(tmp_path / "refreshed")
    main(["conversion-statistics", *later, whole])
    main(["conversion-refresh", *later, refreshed, "--totals", str(tmp_path / "totals")])
    stored = [read_snapshots(spark, path, CONVERSION_SNAPSHOT) for path in (whole, refreshed)]
    assert sorted(map(tuple, stored[0].collect())) == sorted(map(tuple, stored[1].collect()))
    assert stored[1].count() == 2
    rows = read_daily(spark, daily, CONVERSION_DAILY).orderBy("key_type").collect()
    assert [(row.key_type, row.roi, row.click_count) for row in rows] == [
        ("C", 10.5, 2),
        ("R", 6.0, 2),
    ]
