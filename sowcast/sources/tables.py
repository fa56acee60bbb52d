"""CSV and Parquet tables.

CSV columns are matched by name. Files whose header differs from that of the others
are refused, or read by their own headers where ``mixed_headers`` is asked for; then
files that lack a column are refused, by name. One
line is one record, so that large files can be split; values with line breaks are
refused by the writer and read only where ``multi_line`` is asked for, which reads
each file in one task. A value that its column's type cannot hold is null, and
:func:`unreadable_rows` tells which rows have some.
"""

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sowcast.functions.calendar import service_date
from sowcast.functions.clock import clock_time
from sowcast.operators.relational import keep_selected
from sowcast.sources import schemas


# Quotes inside values are doubled, as other CSV tools do, and blanks are kept.
_CORRUPT = "_corrupt_record"
FAST_GZIP = {"zlib.compress.level": "BEST_SPEED"}  # a fifth of the time for a quarter more bytes
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _with_schema(
    spark: SparkSession, path: str | list[str], schema: str, multi_line: bool, header: Sequence[str] | None = None
) -> DataFrame:
    """All columns that the schema names, and the lines that do not fit it."""
    reader = spark.read.options(**_CSV, multiLine=multi_line)
    types = {f.name: f.dataType for f in StructType.fromDDL(schema)}
    names = reader.csv(path).columns if header is None else header
    # Spark matches CSV columns by position, so take the order from the header line
    in_file_order = [StructField(name, types.get(name, StringType())) for name in names]
    columns = StructType([*in_file_order, StructField(_CORRUPT, StringType())])
    options = {"enforceSchema": False, "columnNameOfCorruptRecord": _CORRUPT}
    return reader.options(**options).schema(columns).csv(path).select(*types, _CORRUPT)


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[str, str]:
    """The first line of every file that is not empty.

    Each file, or part of one, is a task of its own here, which stops after the first
    batch of lines; only the part that begins a file answers. So large files are not read.
    """
    probe = spark.newSession()  # whose settings can differ from the caller's
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            probe.conf.set(key, value)
    probe.conf.set("spark.sql.files.openCostInBytes", probe.conf.get("spark.sql.files.maxPartitionBytes"))
    first = F.struct("_metadata.file_path", "_metadata.file_block_start").alias("of")

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of = batch.column(1)[0].as_py()
                if of["file_block_start"] == 0:
                    yield pa.RecordBatch.from_pydict({"file": [of["file_path"]], "header": [batch.column(0)[0].as_py()]})
                return

    lines = probe.read.text(path).select("value", first)
    return dict(map(tuple, lines.mapInArrow(first_line, "file STRING, header STRING").collect()))


def _by_header(spark: SparkSession, path: str | list[str], schema: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. The driver sees a line per file, and names those files
    to Spark's reader. Files that lack a column of the schema are refused."""
    wanted = StructType.fromDDL(schema).names
    files: dict[tuple[str, ...], list[str]] = {}
    lacking: list[str] = []
    for file, line in file_headers(spark, path).items():
        header = next(csv.reader([line.removeprefix("\ufeff")]), [])
        names = tuple(name.strip() for name in header)
        if absent := [name for name in wanted if name not in names]:
            lacking.append(f"{file} lacks {', '.join(absent)}")
        elif len(set(names)) < len(names):
            lacking.append(f"{file} repeats a name")
        else:
            files.setdefault(names, []).append(file)
    if lacking:
        more = f" and {len(lacking) - 5} more files" if len(lacking) > 5 else ""
        raise ValueError(f"headers that do not fit: {'; '.join(sorted(lacking)[:5])}{more}")
    return files


def _csv_rows(spark: SparkSession, path: str | list[str], schema: str, multi_line: bool, mixed_headers: bool) -> DataFrame:
    if not mixed_headers:
        return _with_schema(spark, path, schema, multi_line)
    files = sorted(_by_header(spark, path, schema).items())
    if not files:  # nothing but empty files
        return spark.createDataFrame([], f"{schema}, {_CORRUPT} STRING")
    return reduce(DataFrame.union, [_with_schema(spark, f, schema, multi_line, h) for h, f in files])


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = None,
    multi_line: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """CSV with a header. Columns are matched to the schema by name; without a
    schema the types are inferred, which reads the input twice."""
    if schema is None:
        return spark.read.options(**_CSV, inferSchema=True, enforceSchema=False, multiLine=multi_line).csv(path)
    return _csv_rows(spark, path, schema, multi_line, mixed_headers).drop(_CORRUPT)


def unreadable_rows(
    spark: SparkSession, path: str | list[str], schema: str, multi_line: bool = False, mixed_headers: bool = False
) -> DataFrame:
    """The rows of which :func:`read_csv` reads some value as null, with their ``line``."""
    rows = _csv_rows(spark, path, schema, multi_line, mixed_headers)
    # values are checked when they are parsed, so ask for all, whatever the caller wants
    parsed = F.length(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns])) >= 0
    return rows.where(F.col(_CORRUPT).isNotNull() & parsed).withColumnRenamed(_CORRUPT, "line")


def read_weather_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_WEATHER)


def read_history_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.HISTORY)


def read_plants_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.PLANTS)


def read_sun_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sun times with checked types: a date, and times of day as ``HH:mm:ss``."""
    clocks = ("sunrise", "sunset", "morning_twilight", "evening_twilight")
    return read_csv(spark, path, schemas.SUN_TIMES).select(
        "city",
        service_date("date").alias("date"),
        *[clock_time(c).alias(c) for c in clocks],
        "solar_noon",
        "day_length",
    )


def write_csv(df: DataFrame, path: str, single_file: bool = False, multi_line: bool = False, compression: str = "none") -> None:
    """Replace a CSV directory. ``single_file`` is for small exports only. Fails on
    text with line breaks unless ``multi_line`` says that readers can cope. Files with
    ``compression`` are read by one task each, and gzip is asked for speed."""
    if not multi_line:
        df = df.select(
            *[
                _one_line(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                for f in df.schema
            ]
        )
    (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**_CSV, compression=compression, **FAST_GZIP).csv(path)


def _one_line(name: str) -> Column:
    text = F.col(f"`{name}`")
    refused = F.raise_error(F.lit(f"a line break in {name}: write and read it with multi_line"))
    return F.when(text.rlike("[\r\n]"), refused.cast("string")).otherwise(text)


def write_table(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table. Sorting inside the files lets later reads skip
    row groups by city and date; it needs no shuffle."""
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.mode("overwrite").parquet(path)


CITY_PART = "city_part"


def _city_part(city: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(city), F.lit(parts)).cast("int")


def clustered_by_city(df: DataFrame, parts: int, order: Sequence[str] = ("date",)) -> DataFrame:
    """The rows with ``city_part``, a hash of the city, dealt out and sorted by it, the city
    and the order: each city lies in few tasks, and one that holds most rows in several."""
    dealt = df.withColumn(CITY_PART, _city_part(F.col("city"), parts))
    keys = [CITY_PART, "city", *order]
    return dealt.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_by_city(df: DataFrame, path: str, parts: int = 64, order: Sequence[str] = ("date",)) -> None:
    """Replace a Parquet table by one with a folder for each hash of the city, so that
    questions about some cities read those folders only. Ranges need a sample of the
    input, which is computed twice unless it is stored."""
    clustered_by_city(df, parts, order).write.mode("overwrite").partitionBy(CITY_PART).parquet(path)


def read_cities(spark: SparkSession, path: str, cities: DataFrame, schema: str, parts: int = 64) -> DataFrame:
    """The rows of such a table for the cities of a selection, of any size. Folders in
    which none of them can lie are not listed among the files to read: the driver asks
    for the selection's folders first, of which there are ``parts`` at most."""
    wanted = cities.select(_city_part(F.col("city"), parts)).distinct().collect()
    columns = StructType.fromDDL(schema).names
    table = spark.read.schema(f"{schema}, {CITY_PART} INT").parquet(path)
    rows = table.where(F.col(CITY_PART).isin([r[0] for r in wanted])).select(*columns)
    return keep_selected(rows, cities, ["city"])


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Replace a catalogued Parquet table at ``path`` by one whose rows lie in a file for
    each hash of the keys. Joins and aggregates on all the keys then read it without a
    shuffle; the other side of a join is dealt out by its buckets. The keys should be
    unique or nearly so, since a bucket is read by one task, which nothing splits."""
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def register_bucketed(spark: SparkSession, table: str, path: str, schema: str, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    """Such a table, in a session whose catalogue does not know it: with the schema, keys
    and buckets it was written by."""
    by = ", ".join(f"`{key}`" for key in keys)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(table)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet. Given a schema, no job is spent on reading file footers for it."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)
