"""Monthly delimited extracts: strict reading, coverage and structural checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow import schema
from meterflow.functions.scalars import flag, is_blank, month_ordinal, period_text, to_number
from meterflow.session import materialize

ARTIFACT = "_trailing"
# Stands for the empty trailing header name while the file is parsed. A control character
# cannot occur in a billing field, so no value is mistaken for it.
_EMPTY_NAME = "\x01"


def read_extract(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str] = tuple(schema.EXTRACT_HEADER)
) -> DataFrame:
    """Strict all-text read of pipe-delimited files, one pass.

    The reader itself checks the header of every file against `names` plus the empty trailing
    name, and stops at the first record with too few or too many fields. Blanks stay blanks,
    'NA' stays a value, a byte-order mark is dropped. Names are compared without regard to
    case unless spark.sql.caseSensitive is set. A quote inside a quoted field is doubled. A quoted
    line break is refused, so that files stay splittable, and lines without any character are skipped.
    """
    fields = [*names, _EMPTY_NAME]
    rows = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in fields]))
        .option("sep", "|")
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", _EMPTY_NAME)
        .option("columnPruning", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv([path] if isinstance(path, str) else list(path))
    )
    return rows.select(
        *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in names],
        F.coalesce(F.col(f"`{_EMPTY_NAME}`"), F.lit("")).alias(ARTIFACT),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def write_extract(df: DataFrame, path: str, names: Sequence[str], partition: str | None = None) -> None:
    """Write text columns in the extract format, trailing delimiter included."""
    rows = df.select(*([partition] if partition else []), *names, F.lit("").alias(""))
    writer = rows.write.option("header", True).option("sep", "|").option("emptyValue", "").option("nullValue", "")
    (writer.partitionBy(partition) if partition else writer).csv(path)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of the files below a folder; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            F.col("path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("bytes"),
        )
    )


def discover_periods(files: DataFrame, pattern: str = schema.EXTRACT_FILE_PATTERN) -> DataFrame:
    """Period of each file name; other .txt names and other file types are told apart."""
    name = F.col("file_name")
    year = F.regexp_extract(name, pattern, 2).try_cast("int")
    month = F.regexp_extract(name, pattern, 1).try_cast("int")
    status = (
        F.when(name.rlike(pattern), "ok")
        .when(F.lower(name).endswith(".txt"), "unexpected_name")
        .otherwise("not_txt")
    )
    return files.withColumns(
        {
            "status": status,
            "ord": F.when(status == "ok", (year * 12 + month - 1).cast("int")),
        }
    ).withColumn("period", period_text(F.col("ord")))


def period_coverage(records: DataFrame, first: int, last: int, ord: str = "ord") -> DataFrame:
    """One row per expected or observed period: records and missing / extra / duplicate / ok."""
    spark = records.sparkSession
    expected = spark.range(first, last + 1).select(F.col("id").cast("int").alias("ord"), F.lit(True).alias("_expected"))
    observed = records.groupBy(F.col(ord).alias("ord")).agg(F.count("*").alias("n_records"))
    n = F.coalesce("n_records", F.lit(0))
    wanted = flag(F.col("_expected"))
    return expected.join(observed, "ord", "full").select(
        "ord",
        period_text(F.col("ord")).alias("period"),
        n.alias("n_records"),
        F.when(n == 0, "missing").when(~wanted, "extra").when(n > 1, "duplicate").otherwise("ok").alias("status"),
    )


def period_agreement(df: DataFrame, ord: str = "ord", month: str = "MONTH", year: str = "YEAR") -> DataFrame:
    """Per file period: rows, and rows whose MONTH/YEAR are invalid or name another period."""
    m, y = to_number(F.col(month)), to_number(F.col(year))
    agrees = flag((m == F.pmod(F.col(ord), F.lit(12)) + 1) & (y == F.floor(F.col(ord) / 12)))
    return df.groupBy(ord).agg(
        F.count("*").alias("n_rows"), F.count_if(~agrees).alias("wrong_period_rows")
    )


def key_and_artifact_check(df: DataFrame, key: str, artifact: str = ARTIFACT) -> DataFrame:
    """One row: rows, blank keys, content in the trailing field."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(is_blank(F.col(key))).alias("blank_keys"),
        F.count_if(F.col(artifact) != "").alias("artifact_values"),
    )


def file_counts(df: DataFrame, by: Sequence[str], key: str, n_columns: int) -> DataFrame:
    """Rows, columns and distinct consumers of each file."""
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.lit(n_columns).alias("column_count"),
        F.count_distinct(key).alias("unique_consumers"),
    )


def combine_periods(*months: DataFrame, ordered_by: Sequence[str] = ()) -> DataFrame:
    """Stack months by column name. Order is kept per partition only: a panel is never sorted whole."""
    combined = months[0]
    for month in months[1:]:
        combined = combined.unionByName(month)
    return combined.sortWithinPartitions(*ordered_by) if ordered_by else combined


def _connection_columns(ord: str) -> list[Column]:
    connection = month_ordinal(F.col("connection_date"))
    return [
        F.count("*").alias("n"),
        F.count_if(connection.isNull()).alias("unverifiable"),
        F.count_if(F.col(ord) < connection).alias("before"),
        F.min(connection).alias("first_connection"),
        F.max(connection).alias("last_connection"),
    ]


def _chronology_row(consumers: DataFrame, first_month: Column) -> DataFrame:
    return consumers.agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_consumers"),
        F.sum("unverifiable").alias("unverifiable_rows"),
        F.sum("before").alias("rows_before_connection"),
        F.count_if(F.col("first_seen") < F.col("first_connection")).alias("first_seen_before_connection"),
        F.count_if(F.col("first_connection") != F.col("last_connection")).alias("inconsistent_consumers"),
        F.count_if(F.col("first_seen") > first_month).alias("late_joiners"),
    )


def chronology_check(df: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """One row on connection dates against observed months, from per-consumer aggregates."""
    consumers = df.groupBy(key).agg(*_connection_columns(ord), F.min(ord).alias("first_seen"))
    return _chronology_row(consumers, df.agg(F.min(ord)).scalar())


def loading_summary(df: DataFrame, key: str = "consumer_no", ord: str = "ord") -> DataFrame:
    """Status and totals of a combined panel; `files` lists the counts per period as JSON.

    The panel is read once: rows are merged by consumer and period, and this narrow table is stored. The rows by period,
    as many as the calendar has, are stored as well, and consumers are aggregated from the merged rows.
    """
    merged = materialize(df.groupBy(key, ord).agg(*_connection_columns(ord)), "consumer_months")
    periods = merged.groupBy(ord).agg(
        F.sum("n").alias("rows"),
        F.count(key).alias("consumers"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("repeated"),
    )
    of_period = F.struct(period_text(F.col(ord)).alias("period"), "rows", "consumers")
    span = materialize(
        periods.agg(
            F.min(ord).alias("lo"),
            F.max(ord).alias("hi"),
            F.count(ord).alias("n"),
            F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"),
            F.to_json(F.sort_array(F.collect_list(of_period))).alias("files"),
        ),
        "span",
    )
    span = span.select(F.struct("*")).scalar()
    consumers = merged.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("n", "unverifiable", "before")],
        F.min("first_connection").alias("first_connection"),
        F.max("last_connection").alias("last_connection"),
        F.min(ord).alias("first_seen"),
    )
    return _chronology_row(consumers, span.getField("lo")).select(
        F.when(F.col("unverifiable_rows") > 0, "passed_with_warnings").otherwise("passed").alias("status"),
        span.getField("n").alias("file_count"),
        F.col("n_rows").alias("total_rows"),
        F.col("n_consumers").alias("unique_consumers"),
        period_text(span.getField("lo")).alias("first_actual_month"),
        period_text(span.getField("hi")).alias("latest_actual_month"),
        period_text(span.getField("hi") + 1).alias("next_prediction_month"),
        span.getField("repeated").alias("duplicate_consumer_month_rows"),
        F.col("late_joiners").alias("late_joiner_consumers"),
        F.col("unverifiable_rows").alias("unverifiable_connection_date_rows"),
        F.col("inconsistent_consumers").alias("inconsistent_connection_date_consumers"),
        "rows_before_connection",
        span.getField("files").alias("files"),
    )


def extract_fingerprint(
    spark: SparkSession, first: str, second: str, name_pattern: str = r"([^/]+)$"
) -> DataFrame:
    """Compare two copies of the extracts: one row per file present in either folder.

    `name_pattern` takes the file's name out of its path.

    Line by line and split by split, so a large file is never held by one task. Each line's hash is
    weighed by its position in the file, so a changed order shows as well. Positions count the lines
    of the earlier splits: where a file is split makes no difference.
    """
    def digest(folder: str, side: str) -> DataFrame:
        lines = (
            spark.read.option("recursiveFileLookup", True)
            .text(folder)
            .select(
                F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1).alias("file_name"),
                F.col("_metadata.file_size").alias("bytes"),
                F.col("_metadata.file_block_start").alias("block"),
                # Position inside the task: the low 33 bits of the generated id.
                F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"),
                F.pmod(F.xxhash64("value"), F.lit((1 << 62) - 57)).cast("decimal(20,0)").alias("h"),
            )
        )
        position = F.col("i").cast("decimal(11,0)")
        splits = lines.groupBy("file_name", "block").agg(
            F.max("bytes").alias("bytes"),
            F.count("*").alias("lines"),
            F.sum("h").alias("s0"),
            F.sum(F.pmod(F.col("h"), F.lit((1 << 31) - 1)) * position).alias("s1"),
            F.sum(F.pmod(F.col("h"), F.lit((1 << 31) - 1))).alias("s2"),
            F.min("i").alias("i0"),
        )
        # A file has one row for each of its splits here.
        before = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        splits = splits.withColumn("base", F.coalesce(F.sum("lines").over(before), F.lit(0)).cast("decimal(12,0)"))
        weighted = F.col("s1") + F.col("s2") * (F.col("base") - F.col("i0").cast("decimal(12,0)"))
        return splits.groupBy("file_name").agg(
            F.max("bytes").alias(f"{side}_bytes"),
            F.sum("lines").alias(f"{side}_lines"),
            F.sum("s0").alias(f"_{side}_s0"),
            F.sum(weighted.cast("decimal(38,0)")).alias(f"_{side}_s1"),
        )

    def same(column: str):
        return F.col(column.format("first")) == F.col(column.format("second"))

    equal = same("{}_bytes") & same("{}_lines") & same("_{}_s0") & same("_{}_s1")
    return (
        digest(first, "first")
        .join(digest(second, "second"), "file_name", "full")
        .select(
            "file_name",
            "first_lines",
            "second_lines",
            F.when(F.col("second_lines").isNull(), "only_first")
            .when(F.col("first_lines").isNull(), "only_second")
            .when(equal, "identical")
            .otherwise("different")
            .alias("status"),
        )
    )


def require_clean_periods(coverage: DataFrame) -> None:
    """Stop on any missing, extra or duplicated period and name all of them (runs a job)."""
    bad = coverage.filter("status <> 'ok'").orderBy("ord").collect()
    if bad:
        raise ValueError("period coverage: " + ", ".join(f"{r.period} {r.status}" for r in bad))


def load_history(spark: SparkSession, folder: str, names: Sequence[str] = tuple(schema.EXTRACT_HEADER)) -> DataFrame:
    """Discover, check coverage and read every monthly extract below a folder."""
    files = discover_periods(list_files(spark, folder)).select("path", "file_name", "status", "ord")
    wrong = files.filter("status <> 'ok'").orderBy("file_name").collect()
    if wrong:
        raise ValueError("unexpected files: " + ", ".join(r.file_name for r in wrong))
    span = files.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).first()
    if span.lo is None:
        raise ValueError(f"no extracts below {folder}")
    require_clean_periods(period_coverage(files, span.lo, span.hi))
    rows = read_extract(spark, folder, names)
    name = F.regexp_replace(F.col("_source_file"), r"^.*/", "")
    found = (
        discover_periods(rows.withColumn("file_name", name))
        .drop("status", "_source_file")
        .withColumnRenamed("period", "PERIOD")
    )
    # The periods of the files go along, so that the row checks can name one without a row.
    return found.withMetadata("PERIOD", {"periods": [r.ord for r in files.select("ord").distinct().orderBy("ord").collect()]})


def require_valid_extract(df: DataFrame, key: str = "CONSUMER_NO", artifact: str = ARTIFACT) -> DataFrame:
    """Return `df` after the row-level checks of a loaded history (runs two jobs)."""
    row = key_and_artifact_check(df, key, artifact).first()
    periods = period_agreement(df).collect()
    wrong = sum(r.wrong_period_rows for r in periods)
    expected = df.schema["PERIOD"].metadata.get("periods", []) if "PERIOD" in df.columns else []
    empty = sorted(set(expected) - {r.ord for r in periods})
    if not row.n_rows or row.blank_keys or row.artifact_values or wrong or empty:
        raise ValueError(
            f"rows={row.n_rows}, blank keys={row.blank_keys}, trailing values={row.artifact_values}, "
            f"rows of another period={wrong}, months without a row={[f'{o // 12}-{o % 12 + 1:02}' for o in empty]}"
        )
    return df
