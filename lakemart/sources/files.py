"""Reading files and tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.operators.columns import conform, quoted, unify_schema


def _list(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def scan_parquet(spark: SparkSession, paths: str | Iterable[str], schema: StructType | str | None = None,
                 **options) -> DataFrame:
    """Parquet with a declared schema: no inference pass, missing columns read as NULL, int32 widens to int64."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).parquet(*_list(paths))


def scan_years(spark: SparkSession, root: str, years: Iterable[int], schema: StructType | None = None,
               skip: Iterable[int] = (), extra: Sequence[str] = ()) -> DataFrame:
    """Per-year folders ``root/<year>`` without the skipped ones, plus single files."""
    skipped = set(skip)
    folders = [f"{root}/{y}" for y in years if y not in skipped]
    return scan_parquet(spark, [*folders, *extra], schema, recursiveFileLookup="true")


def scan_glob(spark: SparkSession, pattern: str, schema: StructType | None = None) -> DataFrame:
    return scan_parquet(spark, pattern, schema)


def scan_days(facts: DataFrame, days: DataFrame, time: str, year: str = "year", date: str = "date") -> DataFrame:
    """The rows of a table partitioned by ``year`` that fall on the given days, with the days' other columns.

    The join is on the year too, so that a filter on the days prunes the years that are read while the query runs; ``days``
    has one row per date. Rows without a time fall on no day.
    """
    calendar = days.withColumn("_day", quoted(date)).withColumn("_year", F.year(quoted(date))).drop(date)
    same = (facts[year] == calendar["_year"]) & (F.to_date(facts[time]) == calendar["_day"])
    return facts.join(calendar, same).drop("_day", "_year")


def scan_recursive(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    return scan_parquet(spark, root, schema, recursiveFileLookup="true")


def scan_merged(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Files with differing column sets, read as the union of their columns."""
    return scan_parquet(spark, paths, mergeSchema="true")


def data_files(spark: SparkSession, paths: str | Iterable[str], pattern: str = "*.parquet") -> list[str]:
    """Names of the files below the paths; nothing is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return sorted(listed.load(_list(paths)).inputFiles())


def _merged_schema(spark: SparkSession, files: Sequence[str]) -> StructType | None:
    """All columns of the files, by Spark's own job over their footers; None where a column's type differs."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        return None


#: Where Spark's writer leaves the schema in a Parquet footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _footers() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each file's schema as text, from its footer alone; null where only Spark can open the file."""
    def signature(path: str) -> str | None:
        try:
            system, name = pyarrow.fs.FileSystem.from_uri(path)
            with system.open_input_file(name) as file:
                schema = pq.read_schema(file)
        except (OSError, ValueError):  # also what pyarrow raises for a scheme that it does not know
            return None
        own = (schema.metadata or {}).get(SPARK_SCHEMA)
        return own.decode() if own else str(schema.remove_metadata())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([signature(p) for p in batch["path"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["number"], texts], ["number", "signature"])

    return run  # travels by value, so workers need not have this package


def footer_census(spark: SparkSession, files: Sequence[str]) -> tuple[list[tuple[StructType, list[str]]], list[str]]:
    """Files by the exact schema in their footers, and the files whose footers only Spark can open.

    One job reads all footers on the executors, whatever order the schemas come in; files that Spark did not write cost one
    more, small, for each schema.
    """
    listed = spark.createDataFrame(list(enumerate(files)), "number int, path string")
    found: dict[str | None, list[str]] = {}
    for number, signature in listed.mapInArrow(_footers(), "number int, signature string").collect():
        found.setdefault(signature, []).append(files[number])
    unread = found.pop(None, [])
    return [(StructType.fromJson(json.loads(signature)) if signature.startswith("{") else
             spark.read.parquet(own[0]).schema, own) for signature, own in found.items()], unread


def _agreeing(groups: Iterable[tuple[StructType, list[str]]]) -> list[tuple[StructType, list[str]]]:
    """Groups of files put together as long as no column has two types."""
    out: list[tuple[StructType, list[str]]] = []
    for found, own in groups:
        for k, (known, others) in enumerate(out):
            types = {f.name: f.dataType for f in known}
            if all(types.get(f.name, f.dataType) == f.dataType for f in found):
                wider = StructType([*known, *(f for f in found if f.name not in types)])
                out[k] = (wider, others + own)
                break
        else:
            out.append((found, own))
    return out


def _halved(spark: SparkSession, files: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files by schema, halved until Spark can merge each part: a few jobs for each change of the schema."""
    if not files:
        return []
    schema = _merged_schema(spark, files)
    if schema is not None:
        return [(schema, list(files))]
    half = len(files) // 2
    return _agreeing(_halved(spark, files[:half]) + _halved(spark, files[half:]))


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files by schema: within a group, columns may be missing but none has two types.

    A census of the footers tells the schemas apart in one job; where only Spark can open the files, Spark's own merge does,
    over halves of the files until they agree.
    """
    known, unread = footer_census(spark, files)
    return _agreeing(known + _halved(spark, unread))


def scan_drifted(spark: SparkSession, paths: str | Iterable[str], target: StructType) -> DataFrame:
    """Files below the paths as one table of type ``target``, whatever columns and types each file has.

    Every file is read by its own types and cast; the plan has as many branches as there are conflicting schemas, not
    as there are files or folders.
    """
    groups = schema_groups(spark, data_files(spark, paths))
    return unify_schema([scan_parquet(spark, files, schema) for schema, files in groups], target)


def scan_csv(spark: SparkSession, paths: str | Iterable[str], **options) -> DataFrame:
    """CSV with a header, every column as text."""
    return spark.read.options(header="true", **options).csv(_list(paths))


def scan_csv_inferred(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """CSV with types inferred, at the price of one more pass over the data."""
    return scan_csv(spark, paths, inferSchema="true")


def scan_csv_dialect(spark: SparkSession, paths: str | Iterable[str], schema: StructType | str | None = None,
                     sep: str = ",", line_sep: str | None = "\n", quote: str = '"', trim: bool = True) -> DataFrame:
    """A named CSV format: short rows are filled with NULL, surplus fields dropped; the codec follows the extension."""
    blank = str(trim).lower()
    options = {"header": "true", "sep": sep, "quote": quote, "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": blank, "ignoreTrailingWhiteSpace": blank}
    if line_sep:
        options["lineSep"] = line_sep
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).csv(_list(paths))


def trim_text(df: DataFrame) -> DataFrame:
    """Trim every text column, as the Parquet file format of the warehouse does on load."""
    return df.select(*[F.trim(quoted(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else quoted(f.name)
                       for f in df.schema])


def _misfits(df: DataFrame, target: StructType) -> Column:
    """Whether a row holds a value that does not fit its column."""
    by_name = {c.lower(): c for c in df.columns}
    bad = F.lit(False)
    for f in target:
        source = by_name.get(f.name.lower())
        if source is not None:
            bad = bad | (quoted(source).isNotNull() & quoted(source).try_cast(f.dataType).isNull())
    return bad


def bulk_load(df: DataFrame, target: StructType, on_error: str = "continue") -> DataFrame:
    """Fit read rows into a declared table, matching columns by name without case.

    ``continue`` leaves out rows holding a value that does not fit its column (see :func:`load_report`); ``abort``
    raises on one. Files that cannot be read at all are left out when the reader is given ``ignoreCorruptFiles``.
    """
    if on_error == "abort":
        return conform(df, target, strict=True)
    if on_error != "continue":
        raise ValueError("on_error must be 'continue' or 'abort'")
    return conform(df.filter(~_misfits(df, target)), target)


#: Column that holds a line which is no row of its file, as it stands there.
MALFORMED = "_corrupt_record"


def scan_csv_lines(spark: SparkSession, paths: str | Iterable[str], columns: Sequence[str], **options) -> DataFrame:
    """CSV with a header and known columns, every column as text; a line with too few or too many fields is kept whole in
    :data:`MALFORMED`, which is NULL for all others."""
    schema = StructType([StructField(c, StringType()) for c in (*columns, MALFORMED)])
    settings = {"header": "true", **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    reader = spark.read.options(**settings)
    return reader.schema(schema).csv(_list(paths))


def load_or_quarantine(df: DataFrame, target: StructType, path: str) -> tuple[DataFrame, DataFrame]:
    """Split read rows, in one pass and one write, into those that fit a declared table and those that do not.

    The first frame has the target's columns. The second has ``problems``, an array of (column, value, reason), and
    ``row``, the whole row as JSON text; a malformed line (see :func:`scan_csv_lines`) has no column and is its own value.
    Every row is in exactly one of them. Both are read from ``path``, where other columns of ``df`` are not kept.
    """
    spark, by_name = df.sparkSession, {c.lower(): c for c in df.columns}

    def problem(bad: Column, column: str | None, value: Column, reason: str) -> Column:
        return F.when(bad, F.struct(F.lit(column).cast("string").alias("column"), value.cast("string").alias("value"),
                                    F.lit(reason).alias("reason")))

    found = [problem(quoted(MALFORMED).isNotNull(), None, quoted(MALFORMED), "malformed line")] * (MALFORMED in df.columns)
    for f in target:
        if (source := by_name.get(f.name.lower())) is not None:
            value = quoted(source)
            misfit = value.isNotNull() & value.try_cast(f.dataType).isNull()
            found.append(problem(misfit, f.name, value, f"not a {f.dataType.simpleString()}"))
        if not f.nullable:
            missing = F.lit(True) if source is None else quoted(source).isNull()
            found.append(problem(missing, f.name, F.lit(None), "missing"))
    problems = F.filter(F.array(*found), lambda p: p.isNotNull()) if found else F.expr(
        "cast(array() as array<struct<column: string, value: string, reason: string>>)")
    whole = [quoted(c) for c in df.columns if c != MALFORMED]
    fitted = conform(df, target).schema
    # Names of the target may be those of the source, so both travel in structs of their own.
    split = df.select(problems.alias("problems"), F.to_json(F.struct(*whole)).alias("row"), F.struct(*[
        F.lit(None).cast(f.dataType).alias(f.name) if (source := by_name.get(f.name.lower())) is None
        else quoted(source).try_cast(f.dataType).alias(f.name) for f in fitted]).alias("fitted"))
    good = F.size("problems") == 0
    split.select(F.when(good, F.col("fitted")).alias("fitted"), F.when(~good, F.col("problems")).alias("problems"),
                 F.when(~good, F.col("row")).alias("row"), good.alias("loaded")
                 ).write.mode("overwrite").partitionBy("loaded").parquet(path)
    kept = f"fitted {fitted.simpleString()}, problems array<struct<column: string, value: string, reason: string>>, row string"
    written = spark.read.schema(f"{kept}, loaded boolean").parquet(path)
    return written.filter("loaded").select("fitted.*"), written.filter("NOT loaded").select("problems", "row")


def load_report(df: DataFrame, target: StructType) -> DataFrame:
    """``(file, rows_parsed, rows_loaded, rows_rejected)`` of what :func:`bulk_load` makes of a frame read from files."""
    bad = _misfits(df, target)
    return df.select(F.col("_metadata.file_path").alias("file"), bad.alias("bad")).groupBy("file").agg(
        F.count("*").alias("rows_parsed"), F.count_if(~F.col("bad")).alias("rows_loaded"),
        F.count_if("bad").alias("rows_rejected"))


def list_files(spark: SparkSession, location: str, pattern: str | None = None) -> DataFrame:
    """Files below a location: ``(path, length, modified)``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(location).select("path", "length", F.col("modificationTime").alias("modified"))


def ingest_files(spark: SparkSession, files: Sequence[str], database: str = "default") -> DataFrame:
    """Save each CSV file, whole, as a table named after it; returns the column types. The loop is over names only."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    types = []
    for path in files:
        table = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
        rows = scan_csv_inferred(spark, path)
        rows.write.mode("overwrite").saveAsTable(f"{database}.{table}")
        types += [(table, f.name, f.dataType.simpleString()) for f in rows.schema]
    return spark.createDataFrame(types, "table string, column string, type string")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
