import json

import pytest
from pyspark.sql import functions as F

from meterflow.sources import extracts
from meterflow.streaming import ingest

NAMES = ["MONTH", "YEAR", "CONSUMER_NO"]
HEADER = "MONTH|YEAR|CONSUMER_NO|\n"


def write(path, name, text, encoding="utf-8"):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text, encoding=encoding)
    return str(path)


def test_literal_text_survives(spark, tmp_path):
    folder = write(tmp_path / "a", "x.txt", HEADER + "1|2025|NA|\n||  |\n", "utf-8-sig")
    rows = extracts.read_extract(spark, folder, NAMES).select(*NAMES, "_trailing").collect()
    assert [tuple(r) for r in rows] == [("1", "2025", "NA", ""), ("", "", "  ", "")]


@pytest.mark.parametrize(
    "text",
    [
        "MONTH|YEAR|CONSUMER|\n1|2025|7|\n",
        "YEAR|MONTH|CONSUMER_NO|\n1|2025|7|\n",
        "MONTH|YEAR|CONSUMER_NO\n1|2025|7|\n",
        HEADER + "1|2025|7\n",
        HEADER + "1|2025|7||\n",
        HEADER + "1|2025|7|\n1,2025,7\n",
    ],
)
def test_malformed_files_stop_the_read(spark, tmp_path, text):
    folder = write(tmp_path / "a", "x.txt", text)
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        extracts.read_extract(spark, folder, NAMES).collect()


def month(m):
    return HEADER + f"{m}|2025|a|\n{m}|2025|b|\n"


def test_history(spark, tmp_path):
    folder = tmp_path / "raw"
    for m in (1, 2, 3):
        write(folder, f"512LDG{m}2025.txt", month(m))
    rows = extracts.require_valid_extract(extracts.load_history(spark, str(folder), NAMES))
    assert {(r.PERIOD, r.CONSUMER_NO) for r in rows.collect()} == {
        (f"2025-0{m}", c) for m in (1, 2, 3) for c in "ab"
    }


def test_history_refuses_gaps_names_and_wrong_months(spark, tmp_path):
    gap = tmp_path / "gap"
    for m in (1, 3):
        write(gap, f"512LDG{m}2025.txt", month(m))
    with pytest.raises(ValueError, match="2025-02 missing"):
        extracts.load_history(spark, str(gap), NAMES)
    write(tmp_path / "name", "512LDG132025.txt", month(1))
    with pytest.raises(ValueError, match="unexpected files"):
        extracts.load_history(spark, str(tmp_path / "name"), NAMES)
    wrong = write(tmp_path / "wrong", "512LDG12025.txt", month(2))
    with pytest.raises(ValueError, match="another period"):
        extracts.require_valid_extract(extracts.load_history(spark, wrong, NAMES))


def test_full_header_has_ninety_names():
    from meterflow import schema

    assert len(schema.EXTRACT_HEADER) == len(set(schema.EXTRACT_HEADER)) == 90
    assert set(schema.NUMERIC_FIELDS + schema.DATE_FIELDS) <= set(schema.EXTRACT_HEADER)
    assert len(schema.NUMERIC_FIELDS) == 42 and len(schema.DATE_FIELDS) == 10 and len(schema.NONNEGATIVE_FIELDS) == 16


def panel(spark, rows):
    return spark.createDataFrame(rows, "consumer_no int, ord int, v double")


def test_arrivals_must_continue_the_history(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    first = panel(spark, [(1, 10, 1.0), (2, 10, 2.0), (1, 11, 3.0)])
    first.write.parquet(landing)
    ingest.ingest_new(spark, landing, out, state, first.schema)
    assert spark.read.parquet(out).count() == 3
    panel(spark, [(1, 13, 1.0)]).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="do not continue the history"):
        ingest.ingest_new(spark, landing, out, state, first.schema)
    assert spark.read.parquet(out).count() == 3


def test_replayed_batch_is_written_once(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = panel(spark, [(1, 10, 1.0), (1, 11, 2.0)])
    ingest.append_periods(batch, 0, out)
    ingest.append_periods(batch, 0, out)
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(ValueError, match="repeated key"):
        ingest.append_periods(panel(spark, [(1, 12, 1.0), (1, 12, 2.0)]), 1, out)
    with pytest.raises(ValueError, match="do not continue"):
        ingest.append_periods(panel(spark, [(1, 11, 1.0)]), 1, out)


def test_doubled_quotes_and_empty_months(spark, tmp_path):
    folder = write(tmp_path / "q", "x.txt", HEADER + '1|2025|"a ""x""|b"|\n')
    assert extracts.read_extract(spark, folder, NAMES).first().CONSUMER_NO == 'a "x"|b'
    write(tmp_path / "q2", "x.txt", HEADER + '1|2025|"a\nb"|\n')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        extracts.read_extract(spark, str(tmp_path / "q2"), NAMES).collect()
    raw = tmp_path / "raw"
    for m in (1, 2, 3):
        write(raw, f"512LDG{m}2025.txt", month(m) if m < 3 else HEADER)
    with pytest.raises(ValueError, match="2025-03"):
        extracts.require_valid_extract(extracts.load_history(spark, str(raw), NAMES))


def test_every_bad_file_and_period_is_named(spark, tmp_path):
    names = [f"notes{k}.txt" for k in range(30)]
    for name in names:
        write(tmp_path / "bad", name, month(1))
    with pytest.raises(ValueError) as error:
        extracts.load_history(spark, str(tmp_path / "bad"), NAMES)
    assert all(name in str(error.value) for name in names)


def test_fingerprints_do_not_depend_on_splits(spark, tmp_path):
    lines = [f"line {k} of the file" for k in range(30_000)]
    write(tmp_path / "a", "f.txt", "\n".join(lines) + "\n")
    write(tmp_path / "b", "f.txt", "\n".join(lines) + "\n")
    write(tmp_path / "b", "other.txt", "x" * 3_000_000 + "\n")
    swapped = list(lines)
    swapped[9_000], swapped[21_000] = swapped[21_000], swapped[9_000]
    write(tmp_path / "c", "f.txt", "\n".join(swapped) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        status = lambda x, y: {r.file_name: r.status for r in extracts.extract_fingerprint(spark, str(tmp_path / x), str(tmp_path / y)).collect()}
        assert status("a", "b") == {"f.txt": "identical", "other.txt": "only_second"}
        assert status("a", "c") == {"f.txt": "different"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_loading_summary_counts_repeats_and_connections(spark):
    """A repeated month, an unknown and a changed connection date, a late joiner; empty panels give no month."""
    rows = [
        (1, 24300, "2024-01-01"), (1, 24301, "2024-01-01"), (1, 24301, "2024-01-01"),
        (2, 24300, None), (2, 24301, "2025-09-01"), (3, 24301, "2025-01-01"), (3, 24303, "2025-02-01"),
    ]
    df = spark.createDataFrame(rows, "consumer_no int, ord int, connection_date string").withColumn("connection_date", F.to_date("connection_date"))
    row = extracts.loading_summary(df).first()
    assert (row.status, row.file_count, row.total_rows, row.unique_consumers) == ("passed_with_warnings", 3, 7, 3)
    assert (row.first_actual_month, row.latest_actual_month, row.next_prediction_month) == ("2025-01", "2025-04", "2025-05")
    assert (row.duplicate_consumer_month_rows, row.late_joiner_consumers, row.unverifiable_connection_date_rows) == (2, 1, 1)
    assert (row.inconsistent_connection_date_consumers, row.rows_before_connection) == (1, 1)
    assert json.loads(row.files) == [
        {"period": "2025-01", "rows": 2, "consumers": 2}, {"period": "2025-02", "rows": 4, "consumers": 3}, {"period": "2025-04", "rows": 1, "consumers": 1},
    ]
    checks, summary = extracts.chronology_check(df).first(), extracts.loading_summary(df)
    assert (checks.n_rows, checks.late_joiners, checks.rows_before_connection) == (7, 1, 1)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan  # the panel itself is not read again
    nothing = extracts.loading_summary(df.limit(0)).first()
    assert (nothing.file_count, nothing.unique_consumers, nothing.latest_actual_month, nothing.files) == (0, 0, None, "[]")
