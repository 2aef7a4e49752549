"""Snapshot intake as an AvailableNow file stream."""

import datetime as dt

from ledgerline.sources.store import TableStore
from ledgerline.streaming.intake import start_intake


def test_landed_snapshots_are_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    root = str(tmp_path / "wh")
    ticks = iter([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)])
    (landing / "players_1.csv").write_text(
        "id,registration_date,registration_type,country\n1,2023-01-01,vip,DE\n2,2023-01-02,standard,FR\n"
    )
    start_intake(spark, root, "players", str(landing), clock=lambda: next(ticks)).awaitTermination()
    raw = TableStore(spark, root).read_raw("players")
    assert raw.count() == 2
    # a second snapshot: player 1 moved, player 2 unchanged, player 3 new; header order differs
    (landing / "players_2.csv").write_text(
        "country,id,registration_date,registration_type\nFR,1,2023-01-01,vip\nFR,2,2023-01-02,standard\nUS,3,2023-02-01,vip\n"
    )
    start_intake(spark, root, "players", str(landing), clock=lambda: next(ticks)).awaitTermination()
    raw = TableStore(spark, root).read_raw("players")
    assert raw.count() == 4
    assert sorted((r["id"], r["country"]) for r in raw.filter("loaded_at = timestamp'2024-01-02'").collect()) == [
        ("1", "FR"),
        ("3", "US"),
    ]
    # nothing new landed: the stream takes no file twice
    start_intake(spark, root, "players", str(landing), clock=lambda: next(ticks)).awaitTermination()
    assert TableStore(spark, root).read_raw("players").count() == 4
