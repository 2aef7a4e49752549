"""Loads lose and repeat nothing: several files, equal times, undated and future rows, crashed loads."""

import datetime as dt

import pytest
from ledgerline.plans.job import load_table
from ledgerline.session import ensure_session
from ledgerline.sources.store import LoadOrderError, TableStore
from ledgerline.streaming.intake import start_intake

PLAYERS = "id,registration_date,registration_type,country\n"


def _day(n, micro=0):
    return dt.datetime(2024, 1, n, 0, 0, 0, micro)


def _rates_header(spark):
    from ledgerline.schemas import RAW_TABLES

    return ",".join(RAW_TABLES["currency_rates"].columns) + "\n"


def _rate_row(spark, day, value):
    from ledgerline.schemas import RAW_TABLES

    cfg = RAW_TABLES["currency_rates"]
    return ",".join(day if c == cfg.date_column else "EUR" if "currency" == c else value for c in cfg.columns) + "\n"


def test_folder_of_files_appends_only_changes(spark, tmp_path):
    src = tmp_path / "players"
    src.mkdir()
    (src / "a.csv").write_text(PLAYERS + "1,2023-01-01,vip,DE\n2,2023-01-01,vip,FR\n")
    (src / "b.csv").write_text(PLAYERS + "1,2023-01-01,vip,US\n")
    store = TableStore(spark, str(tmp_path / "wh"))
    assert load_table(store, "players", str(src), _day(1))["inserted_rows"] == 3
    assert load_table(store, "players", str(src), _day(2))["inserted_rows"] == 2  # 1 goes to DE and back to US again
    latest = [tuple(r) for r in store.read_raw("players").filter("id = '2'").select("country").collect()]
    assert latest == [("FR",)]


def test_two_loads_within_a_second(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    for n, country in enumerate(("DE", "FR")):
        (tmp_path / f"{n}.csv").write_text(PLAYERS + f"1,2023-01-01,vip,{country}\n")
        load_table(store, "players", str(tmp_path / f"{n}.csv"), _day(1, n))
    assert store.read_raw("players").count() == 2
    assert load_table(store, "players", str(tmp_path / "1.csv"), _day(1, 1))["inserted_rows"] == 0
    with pytest.raises(LoadOrderError):
        load_table(store, "players", str(tmp_path / "0.csv"), _day(1, 1))


def test_undated_and_future_rows_are_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    header = _rates_header(spark)
    (tmp_path / "ok.csv").write_text(header + _rate_row(spark, "2023-12-30", "1.5"))
    (tmp_path / "undated.csv").write_text(header + _rate_row(spark, "2023-12-30", "1.5") + _rate_row(spark, "", "1.6"))
    (tmp_path / "future.csv").write_text(header + _rate_row(spark, "2034-01-01", "1.5"))
    load_table(store, "currency_rates", str(tmp_path / "ok.csv"), _day(1))
    with pytest.raises(Exception, match="without a readable"):
        load_table(store, "currency_rates", str(tmp_path / "undated.csv"), _day(2))
    with pytest.raises(LoadOrderError):
        load_table(store, "currency_rates", str(tmp_path / "future.csv"), _day(2))
    assert load_table(store, "currency_rates", str(tmp_path / "ok.csv"), _day(3))["inserted_rows"] == 0


def test_crash_before_the_commit_stores_nothing_twice(spark, tmp_path, monkeypatch):
    (tmp_path / "p.csv").write_text(PLAYERS + "1,2023-01-01,vip,DE\n2,2023-01-01,vip,FR\n")
    (tmp_path / "q.csv").write_text(PLAYERS + "3,2023-01-01,vip,DE\n")
    root = str(tmp_path / "wh")

    def crash(*_):
        raise RuntimeError("died")

    for day, again in ((1, 1), (2, 3)):  # repeated at the same time, and at a later one
        source = str(tmp_path / ("p.csv" if day == 1 else "q.csv"))
        with monkeypatch.context() as m:
            m.setattr(TableStore, "_commit", crash)
            with pytest.raises(RuntimeError):
                load_table(TableStore(spark, root), "players", source, _day(day))
        load_table(TableStore(spark, root), "players", source, _day(again))
    rows = TableStore(spark, root).read_raw("players").collect()
    assert sorted(r["id"] for r in rows) == ["1", "2", "3"]


def test_one_delivery_has_one_window(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    header = _rates_header(spark)
    (landing / "a.csv").write_text(header + _rate_row(spark, "2023-12-30", "1.5"))
    (landing / "b.csv").write_text(header + _rate_row(spark, "2022-01-01", "1.6"))
    start_intake(spark, str(tmp_path / "wh"), "currency_rates", str(landing), clock=lambda: _day(1)).awaitTermination()
    assert TableStore(spark, str(tmp_path / "wh")).read_raw("currency_rates").count() == 2


def test_missing_snapshot_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_table(TableStore(spark, str(tmp_path / "wh")), "players", str(tmp_path / "none.csv"), _day(1))


def test_bad_values_raise_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    ensure_session(spark)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.sql("SELECT cast('x' AS BIGINT)").collect()
