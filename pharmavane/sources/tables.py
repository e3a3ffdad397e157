"""Parquet tables: one directory per entity, partitioned by year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pharmavane.functions import casts, names
from pharmavane.functions.names import year_list
from pharmavane.operators.skew import same_keys, stage
from pharmavane.schemas import RAW_SCHEMAS


def read_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


LINEAGE = T.StructType([
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("source_file_path", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])


def read_entity(
    spark: SparkSession, base: str, entity: str, years: str | None = None, lineage: bool = False
) -> DataFrame:
    """All years of an entity, or the listed ones, as one table.

    The year filter prunes directories. Years match whole, after trimming.
    The raw layer's schema is declared, so no file footer is read to plan.
    With ``lineage`` its columns are kept, null in files without them.
    """
    kept = LINEAGE.fields if lineage else []
    schema = T.StructType([*RAW_SCHEMAS[entity].fields, *kept, T.StructField("year", T.StringType())])
    table = spark.read.schema(schema).parquet(f"{base}/{entity}").select(*schema.names)
    picked = year_list(years)
    return table.filter(F.col("year").isin(picked)) if picked else table


def read_years(
    spark: SparkSession, path: str, years: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Like ``read_entity`` for a table with any schema (such as a cleaned one).

    ``schema`` is only needed for a table that has lost its last row, and so its files.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.parquet(path).withColumn("year", F.col("year").cast("string"))
    picked = year_list(years)
    return table.filter(F.col("year").isin(picked)) if picked else table


def read_tree(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """An entity laid out as ``{base}/{entity}/{year}/{file}.parquet``."""
    return spark.read.parquet(f"{base}/{entity}/*/*")


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Files whose columns differ but whose shared columns agree in type."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def read_drifted(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """Tables whose shared columns differ in type, all columns as strings.

    Paths of equal schema are read together, so the union has one branch per
    distinct schema, however many paths there are. One footer is read per
    path to plan: pass directories (say, one per year), not single files. A
    column that a table lacks is null.
    """
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)

    def as_strings(group: list[str]) -> DataFrame:
        table = spark.read.parquet(*group)
        return table.select(
            *[
                (casts.to_string(n) if n in table.columns else F.lit(None).cast("string")).alias(n)
                for n in columns
            ]
        )

    tables = [as_strings(group) for group in groups.values()]
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged


def rows_from(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table from values in the program."""
    return spark.createDataFrame(rows, schema)


def last_run(spark: SparkSession, out: str) -> DataFrame:
    """``(what, reason, n)`` of the latest ingest run into ``out``."""
    runs = spark.read.parquet(f"{out}/_runs").withColumn("at", F.col("_metadata.file_modification_time"))
    latest = runs.agg(F.max_by("run_id", "at").alias("run_id"))
    return runs.join(F.broadcast(latest), "run_id").select("what", "reason", "n")


def source_files(df: DataFrame) -> DataFrame:
    """The files behind a table read from files, with the year and stem of each."""
    return (
        df.select(F.col("_metadata.file_path").alias("path"))
        .distinct()
        .select("path", file_year("path").alias("year"), names.path_stem(F.col("path")).alias("stem"))
    )


def file_year(path: str) -> Column:
    """The year directory of a file: ``.../year=2004/x`` or ``.../2004/x``."""
    folder = F.split_part(F.col(path), F.lit("/"), F.lit(-2))
    return F.regexp_replace(folder, "^year=", "")


def years_present(df: DataFrame) -> DataFrame:
    return df.select("year").distinct()


def write_by_year(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    max_records: int = 5_000_000,
    rebalance: bool = False,
    within: tuple[str, ...] = (),
) -> None:
    """One directory per year; overwriting replaces only the years written.

    With ``within`` there is a directory for each value of these columns in a year,
    and overwriting replaces only those written.

    Tasks write the partitions they already hold, so no year, however large,
    is moved to one task; ``max_records`` bounds the size of a file. Where
    tasks hold many years each, ``rebalance`` gathers the years first to avoid
    small files; adaptive execution splits a year that is too large.
    """
    if rebalance:
        df = df.hint("rebalance", F.col("year"), *map(F.col, within))
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy("year", *within)
        .parquet(path)
    )


def partition_files(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``(path, folder, *columns)`` of the data files of a partitioned table; no file is opened.

    Empty for a table that is not there yet.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in ["path", "folder", *columns]))
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    )

    def value(column: str) -> Column:
        text = F.regexp_extract("folder", f"/{column}=([^/]*)", 1)
        # Spark writes special characters of a value as %XX, and a null as this name.
        plain = F.try_url_decode(F.regexp_replace(text, r"\+", "%2B"))
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", plain).alias(column)

    return listed.select("*", *map(value, columns))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _remove(spark: SparkSession, folders: Iterable[str]) -> int:
    """Delete folders in whichever store they are; returns how many."""
    removed = 0
    for folder in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        removed += where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return removed


def replace_partitions(
    df: DataFrame, path: str, scanned: DataFrame | None = None, within: tuple[str, ...] = (), **options
) -> int:
    """Write by year, and drop what the partitions of everything scanned held before.

    ``scanned`` names partitions by some of ``year`` and ``within``: all those that this run
    looked at, whether or not they gave rows; None stands for the whole table. Partitions with
    rows are replaced by the write. The drop list is the rest: partitions scanned whose files
    are still there after the write. It comes from two listings of file names, so no row is
    read again; a run that stops before the drop is put right by the next. Returns the number
    of partitions dropped.
    """
    spark = df.sparkSession
    columns = ["year", *within]
    before = partition_files(spark, path, columns)
    if scanned is not None:
        keys = [c for c in columns if c in scanned.columns]
        named = scanned.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()
        before = before.alias("t").join(named.alias("s"), same_keys("t", "s", keys), "left_semi")
    before = stage(before.select("path", "folder"), "listing")
    write_by_year(df, path, within=within, **options)
    left = before.join(partition_files(spark, path, []).select("path"), "path", "left_semi")
    return _remove(spark, (row.folder for row in left.select("folder").distinct().toLocalIterator()))


def publish(df: DataFrame, path: str, within: tuple[str, ...] = (), **options) -> int:
    """Write a table by year to its target address; returns the rows written, counted as they pass."""
    written = Observation()
    write_by_year(df.observe(written, F.count("*").alias("rows")), path, within=within, **options)
    return written.get["rows"]


def write_files(df: DataFrame, path: str, files: int = 4, mode: str = "overwrite") -> None:
    """An even spread over a fixed number of files, for a small table."""
    df.repartition(files).write.mode(mode).parquet(path)


def write_new(df: DataFrame, path: str) -> None:
    """Fails if the target exists."""
    df.write.mode("errorifexists").parquet(path)


def write_model_table(df: DataFrame, name: str, key: str, buckets: int = 512, spread: bool = False) -> None:
    """A modelled table by year, bucketed by its join key.

    Facts bucketed alike on ``patientid`` join and group on it without a
    shuffle. The rows are spread by the key first, so each task writes its
    own bucket of every year, and a year has as many files as buckets.
    With ``spread`` they already are, over that number of tasks or a multiple.
    """
    (
        (df if spread else df.repartition(buckets, key))
        .write.mode("overwrite")
        .partitionBy("year")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )


def replace_model_years(
    df: DataFrame, name: str, key: str, years: list[str], buckets: int, spread: bool = False
) -> None:
    """Replace some years of a modelled table; those that get no row are dropped.

    ``buckets`` is that of the table, ``spread`` as above. Other years are neither read nor touched.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(name).columns if c != "year"]
    written = Observation()
    rows = df if spread else df.repartition(buckets, key)
    rows = rows.select(*columns, "year").observe(written, F.collect_set("year").alias("years"))
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)
    wrote = set(written.get["years"])  # within ``years``
    there = {row.partition for row in spark.sql(f"show partitions {name}").collect()}
    for year in years:
        if year not in wrote and f"year={year}" in there:
            spark.sql(f"alter table {name} drop partition (year = '{year}')")


def append_new(df: DataFrame, name: str, key: str) -> None:
    """Add the rows whose key the table lacks; the keys of the table are all that is read of it."""
    spark = df.sparkSession
    fresh = df.join(spark.table(name).select(key), key, "left_anti").select(*spark.table(name).columns)
    stage(fresh, "fresh").write.mode("append").saveAsTable(name)


def inspect(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows in no set order, as a table; the schema is ``df.schema``."""
    return df.limit(rows)
