"""Logger files with all their quirks, tables, continuous ingest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from permeate.schema import column_name
from permeate.sources.logs import files_without_header, read_logs, readable, text_lines, unreadable_counts
from permeate.sources.tables import file_info, load_parquet, save_log
from permeate.streaming.ingest import DAILY_LOW, SET_ASIDE, STATISTICS, _on_days, current_slopes, ingest_new_files, stored_log
from permeate.operators.fouling import daily_low
from permeate.operators.quality import band_filter
from permeate.functions.regression import fit_lines
from permeate.operators.rolling import time_statistics
from permeate.schema import bands_for


def write(folder, name, header, rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["\t".join(header), *["\t".join(r) for r in rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_files_are_combined_by_column_name(spark, tmp_path):
    unit = tmp_path / "skid7"
    write(unit, "a.tsv", ["TimeStamp", " TMP ", "Permeability TC", "PV FIL DIR."],
          [["2026-01-28 03:30:04 48", "1.5", "7", "1"], ["2026-01-28 03:30:09 5", "NaN", "", "0"], ["broken", "3", "9", "1"]])
    write(unit, "b.tsv", ["Permeability TC", "TMP", "TimeStamp", "Active program number"],
          [["8.25", "2.5", "2026-01-28 03:30:14", "10.0"], ["8.25", "2.5", "2026-01-28 03:30:14", "10.0"]])
    (unit / "notes.txt").write_text("TimeStamp\tTMP\n2026-01-28 03:30:04\t99\n")
    log = read_logs(spark, str(tmp_path))
    assert set(log.columns) == {"unit_id", "ts", "ts_raw", "us", "seq", "tmp", "perm_tc", "pv_fil_dir", "program"}
    rows = readable(log).orderBy("us").collect()
    assert [(r.tmp, r.perm_tc, r.pv_fil_dir, r.program) for r in rows] == [
        (1.5, 7.0, 1.0, None), (None, None, 0.0, None), (2.5, 8.25, None, 10), (2.5, 8.25, None, 10)
    ]
    assert rows[0].ts == dt.datetime(2026, 1, 28, 3, 30, 4, 480_000) and rows[1].ts.microsecond == 500_000
    assert {r.unit_id for r in rows} == {"skid7"}
    assert unreadable_counts(log).first().unreadable == 1
    assert log.filter("ts is null").first().ts_raw == "broken"


def test_names_that_fall_together_are_told_apart(spark, tmp_path):
    write(tmp_path / "u", "a.tsv", ["TimeStamp", "P-1", "P 1", "%%", "TMP"], [["2026-01-28 03:30:04", "1", "2", "3", "4"]])
    row = read_logs(spark, str(tmp_path)).first()
    assert {row.p_1, row.p_1_2} == {1.0, 2.0} and row.column == 3.0 and row.tmp == 4.0


def test_half_stamps_and_infinite_readings_are_missing(spark, tmp_path):
    stamps = ["2026", "2026-01-28", "2026-01-28 03:30", "2026-02-30 03:30:00", "2026-01-28 03:30:04 late", "2026-01-28 03:30:04"]
    write(tmp_path / "u", "a.tsv", ["TimeStamp", "TMP"], [[t, "Infinity"] for t in stamps])
    log = read_logs(spark, str(tmp_path))
    assert unreadable_counts(log).first().unreadable == 5
    assert log.filter("tmp is not null").count() == 0


def test_files_without_header_are_listed(spark, tmp_path):
    write(tmp_path / "u", "a.tsv", ["TimeStamp", "TMP"], [["2026-01-28 03:30:04", "1"]])
    (tmp_path / "u" / "b.tsv").write_text("2026-01-28 03:30:09\t2\n2026-01-28 03:30:14\t3\n")
    found = files_without_header(text_lines(spark, str(tmp_path))).collect()
    assert [(r.file.rsplit("/", 1)[-1], r.n_lines) for r in found] == [("b.tsv", 2)]


def test_a_file_without_header_does_not_stop_ingest(spark, tmp_path):
    inbox, store = tmp_path / "inbox", str(tmp_path / "store")
    rows = [[f"2026-01-28 03:{m:02d}:04", "1.5", "7", "12", "11"] for m in range(60)]
    rows[7][1] = "1e300"
    header = ["TimeStamp", "TMP", "Permeability TC", "Flux", "01-TIT-01"]
    (inbox / "u").mkdir(parents=True)
    (inbox / "u" / "bad.tsv").write_text("no header here\n")
    ingest_new_files(spark, str(inbox), store)
    write(inbox / "u", "good.tsv", header, rows)
    ingest_new_files(spark, str(inbox), store)
    assert stored_log(spark, store).count() == 60
    assert spark.read.parquet(f"{store}/{SET_ASIDE}").count() == 1
    assert "PartitionFilters: [isnotnull(day" in _on_days(
        stored_log(spark, store), stored_log(spark, store).select("unit_id", "day").distinct()
    )._jdf.queryExecution().toString()


def test_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_logs(spark, str(tmp_path / "empty"))


def test_column_names():
    assert column_name(" Mem. retention ") == "mem_retention"
    assert column_name("PV FIL DIR.") == "pv_fil_dir"
    assert column_name("01-TIT-01") == "temp_c"


def test_log_by_unit_and_day(spark, tmp_path):
    rows = [(u, i * 40_000_000_000, i, float(i)) for i in range(10) for u in ("a", "b")]
    log = spark.createDataFrame(rows, "unit_id string, us long, seq long, tmp double")
    path = str(tmp_path / "log")
    save_log(log, path, "gzip")
    back = load_parquet(spark, path, ["unit_id", "us", "tmp"])
    assert back.count() == 20 and back.columns == ["unit_id", "us", "tmp"]
    info = file_info(spark, path).first()
    assert info.n_rows == 20 and info.n_columns == 5 and info.size_mb > 0


def logger_rows(start_day, days, offset):
    rows = []
    for i in range(days * 24):
        stamp = dt.datetime(2026, 1, 1 + start_day) + dt.timedelta(minutes=60 * i + offset)
        rows.append([stamp.strftime("%Y-%m-%d %H:%M:%S"), f"{2 + (i * 7 % 11) / 10}", f"{8 + (i * 5 % 13) / 10}"])
    return rows


def test_ingest_in_steps_equals_one_batch(spark, tmp_path):
    inbox, store = tmp_path / "inbox" / "u1", str(tmp_path / "store")
    header = ["TimeStamp", "TMP", "Permeability TC"]
    write(inbox, "1.tsv", header, logger_rows(0, 4, 0))
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    assert stored_log(spark, store).count() == 96
    # A late file touches days that are already there, another adds new ones.
    write(inbox, "2.tsv", [header[1], header[0], header[2]], [[r[1], r[0], r[2]] for r in logger_rows(1, 2, 30)])
    write(inbox, "3.tsv", header, logger_rows(4, 3, 0))
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    log = stored_log(spark, store)
    assert log.count() == 96 + 48 + 72

    log = log.select("unit_id", "us", "seq", "tmp", "perm_tc")
    want = time_statistics(log.drop("perm_tc"), ["tmp"], ("24h",))
    got = spark.read.parquet(f"{store}/{STATISTICS}").select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0

    good = band_filter(log, bands_for(log.columns))
    slope, whole = current_slopes(spark, store).first(), fit_lines(good, "tmp").first()
    assert slope.n == whole.n and slope.slope == pytest.approx(whole.slope, rel=1e-9)
    low = spark.read.parquet(f"{store}/{DAILY_LOW}").select("unit_id", "us", "daily_value", "n")
    assert low.exceptAll(daily_low(good).select(*low.columns)).count() == 0
    assert low.select(F.sum("n")).first()[0] == good.count()


def program_rows(start_day, days, offset, step):
    rows = []
    for i in range(days * 24):
        stamp = dt.datetime(2026, 1, 1 + start_day) + dt.timedelta(minutes=60 * i + offset)
        program = 10 if (i + start_day * 24) % step < step - 2 else (21 if i % 2 else 32)
        rows.append([stamp.strftime("%Y-%m-%d %H:%M:%S"), f"{2 + (i * 7 % 11) / 10}", f"{8 + (i * 5 % 13) / 10}", str(program)])
    return rows


def test_cycles_kept_up_to_date_equal_the_batch_periods(spark, tmp_path):
    """Three batches, the second late: runs cross midnights, and late rows split and join runs."""
    from permeate.operators.cycles import filtration_periods
    from permeate.operators.ordering import row_index
    from permeate.streaming.ingest import current_periods

    header = ["TimeStamp", "TMP", "Permeability TC", "Active program number"]
    for unit in ("u1", "u2"):
        write(tmp_path / "inbox" / unit, "1.tsv", header, program_rows(0, 3, 0, 7 if unit == "u1" else 30))
    store = str(tmp_path / "store")
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    write(tmp_path / "inbox" / "u1", "2.tsv", header, program_rows(1, 1, 30, 5))
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    write(tmp_path / "inbox" / "u2", "3.tsv", header, program_rows(3, 2, 0, 30))
    write(tmp_path / "inbox" / "u1", "3.tsv", header, program_rows(3, 2, 0, 7))
    ingest_new_files(spark, str(tmp_path / "inbox"), store)
    log = stored_log(spark, store).select("unit_id", "us", "seq", "program")
    want = filtration_periods(row_index(log))
    got = current_periods(spark, store).select(*want.columns)
    assert want.count() > 10 and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_a_backlog_is_refreshed_in_few_steps(spark, tmp_path):
    """Nine batches that all touch the same days; a run that is ended leaves its batches to the next."""
    from permeate.streaming.ingest import refresh

    header = ["TimeStamp", "TMP", "Permeability TC"]
    for i in range(9):
        write(tmp_path / "inbox" / "u1", f"{i}.tsv", header, logger_rows(0, 1, i))
    store, taken, rows = str(tmp_path / "store"), [], []

    def ended(session, store, batch):
        if len(taken) == 2:
            raise RuntimeError("ended")
        taken.append(batch.count())

    with pytest.raises(Exception, match="ended"):
        ingest_new_files(spark, str(tmp_path / "inbox"), store, max_files=1, on_batch=ended)

    def noted(session, store, batch):
        rows.append(batch.count())
        refresh(session, store, batch)

    ingest_new_files(spark, str(tmp_path / "inbox"), store, max_files=1, on_batch=noted)
    assert taken == [24, 24] and sum(rows) == 7 * 24 and len(rows) <= 4
    log = stored_log(spark, store).select("unit_id", "us", "seq", "tmp")
    want = time_statistics(log, ["tmp"], ("24h",))
    got = spark.read.parquet(f"{store}/{STATISTICS}").select(*want.columns)
    assert got.count() == want.count() == 9 * 24
    assert got.exceptAll(want).count() == 0
