"""Job: landed report files to the raw patient, drug and reaction tables.

    spark-submit --py-files pharmavane.zip jobs/ingest.py --index I --landing L --out O [--year 2004,2005]

Only the files of the wanted years are opened, once. The parsed reports are stored nested, and the
three tables are cut from that store, each reading only its own fields.
Batches label the rows; they do not split the run into jobs.
"""

from __future__ import annotations

import re
import uuid
from argparse import ArgumentParser
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pharmavane.operators import extract, manifest, quality
from pharmavane.operators.skew import join_small, stage
from pharmavane.session import build_session, run_scope
from pharmavane.sources import index, large, reports, tables

BATCH_CAP_MB = 13_000
MAX_FILE = (1 << 31) - 1024  # what Spark's reader takes as one value
LARGE_FILE = 1 << 28  # bytes from which plain and gzipped JSON is read in splits and as a stream
_STREAMED = r"\.json(\.gz)?$"  # names of files that can be


def select_files(
    files: DataFrame, batches: DataFrame, years: str | None, cap_mb: float
) -> DataFrame:
    """The files to read: ``(file, year, batch_id)``, each address once.

    A year above the cap is packed file by file; a file above it by itself
    stays in with no batch, so none is left out.
    """
    listed = manifest.select_years(manifest.with_partition(files), years)
    by_year = batches.select("partition_id", F.col("batch_id").cast("string").alias("_year_batch"))
    by_file = manifest.batch_oversized_years(listed, cap_mb).select(
        "seq", F.concat_ws("-", "partition_id", "batch_id").alias("_file_batch")
    )
    return (
        listed.join(by_year, "partition_id", "left")
        .join(by_file, "seq", "left")
        .groupBy("file")
        .agg(
            F.min_by("partition_id", "seq").alias("year"),
            F.min_by(F.coalesce("_year_batch", "_file_batch"), "seq").alias("batch_id"),
        )
    )


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """``(path, length, relative)`` of the landed files; no content is read."""
    root = urlsplit(landing).path.rstrip("/") + "/"
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
        .load(landing)
        .select("path", "length")
    )
    return found.withColumn("relative", F.substr("path", F.instr("path", F.lit(root)) + len(root)))


def match_landed(selected: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Selected files with their landed ``path``, and ``(source_file, error)`` of the others.

    A landed file belongs to the address that ends with its whole path below the
    landing folder; of several such paths the longest counts. Two addresses that
    meet in one landed file are both faults, as is a zip of more than ``MAX_FILE`` bytes.
    """
    parts = F.split(F.regexp_replace("file", "^[A-Za-z0-9+.-]+://[^/]*/", ""), "/")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "/"))
    keyed = selected.select("file", "year", "batch_id", F.posexplode(ends).alias("cut", "relative"))
    longest = keyed.join(landed, "relative").groupBy("file").agg(
        *[F.min_by(c, "cut").alias(c) for c in ("year", "batch_id", "path", "length", "relative")]
    )
    owners = longest.groupBy("path").agg(F.count("*").alias("owners"))
    fault = (
        F.when(F.col("path").isNull(), F.lit("did not land"))
        .when(F.col("owners") > 1, F.lit("several listed files have this path"))
        .when((F.col("length") > MAX_FILE) & ~F.col("relative").rlike(_STREAMED), F.lit("larger than 2 GB"))
    )
    found = selected.select("file").join(longest, "file", "left").join(owners, "path", "left").withColumn("error", fault)
    found = stage(found, "matched")
    bad = found.filter("error IS NOT NULL").select(F.coalesce("path", "file").alias("source_file"), "error")
    return found.filter("error IS NULL").select("path", "relative", "length", "year", "batch_id"), bad


def scan_matched(spark: SparkSession, matched: DataFrame, large_from: int = LARGE_FILE) -> DataFrame:
    """Parsed reports and faults of the matched files.

    The key of a report is that of its file's path below the landing folder, ``relative``, so
    it is the same wherever the files land. Only these files are opened. Their paths go through the driver, as the paths of
    any scan do; contents go straight from the reader to the scan, into no join.

    Plain and gzipped JSON of ``large_from`` bytes or more is scanned by ``large``, which gives
    the same rows and has no limit of size.
    """
    kind = F.when(F.col("length") < large_from, "whole").when(F.col("relative").endswith(".json"), "plain")
    kind = kind.when(F.col("relative").endswith(".json.gz"), "zipped").otherwise("whole")
    paths: dict[str, list[str]] = {"whole": [], "plain": [], "zipped": []}
    for row in matched.select("path", kind.alias("kind")).collect():
        paths[row.kind].append(_literal(row.path))
    if paths["whole"]:
        files = spark.read.format("binaryFile").load(paths["whole"])
    else:
        files = spark.createDataFrame([], "path string, content binary")
    scanned = reports.scan_report_files(files)
    if paths["plain"] or paths["zipped"]:
        scanned = scanned.unionByName(large.scan_large_files(spark, paths["plain"], paths["zipped"]))
    known = matched.drop("length").withColumnRenamed("path", "source_file")
    scanned = join_small(scanned, known, "source_file", "left")
    scanned = extract.parse_reports(scanned, file="relative")
    scanned = scanned.withColumn("misshapen", F.col("error").isNull() & extract.misshapen(F.col("report_json")))
    return scanned.withColumn("report_json", F.when(F.col("misshapen"), F.col("report_json")))


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def ingest(
    spark: SparkSession,
    index_path: str,
    landing: str,
    out: str,
    years: str | None = None,
    cap_mb: float = BATCH_CAP_MB,
    large_from: int = LARGE_FILE,
) -> DataFrame:
    """Write the raw tables, faults and misshapen reports; returns the batch summary.

    A file's rows replace those of an earlier run over it, in every year and also where the
    file has none of an entity any more, and leave other files' rows alone. A file that cannot
    be read keeps the rows of the run before. Faults and misshapen reports are kept for each
    run, ``_batches`` too, and ``_runs`` says for each what was read, written and left out (see
    ``run_summary``).
    """
    with run_scope(spark):
        return _ingest(spark, index_path, landing, out, years, cap_mb, large_from)


def _ingest(
    spark: SparkSession, index_path: str, landing: str, out: str, years: str | None, cap_mb: float, large_from: int
) -> DataFrame:
    listed = index.read_index_files(spark, index_path)
    batches = stage(manifest.run_plan(listed, years, cap_mb), "batches")
    selected = stage(select_files(listed, batches, years, cap_mb), "selected")
    matched, absent = match_landed(selected, landed_files(spark, landing))
    scanned = stage(scan_matched(spark, matched, large_from), "reports")
    whole, faults = reports.split_scanned(scanned)
    good, odd = whole.filter("NOT misshapen"), whole.filter("misshapen")
    unread = faults.filter(~F.col("error").startswith(reports.LONG_REPORT)).select(F.col("source_file").alias("path"))
    read = matched.join(unread, "path", "left_anti").select(_file_id())
    dropped = {}
    for entity, cut in extract.EXTRACTORS.items():
        keys = good.select("patientid", "source_file", "relative", "batch_id", "year", "report")
        rows = cut(keys, keep=("source_file", "relative", "batch_id", "year"))
        rows = quality.with_lineage(rows, F.col("batch_id"), F.col("source_file"))
        rows = rows.withColumn("file_id", _file_id()).drop("source_file", "relative")
        dropped[entity] = tables.replace_partitions(rows, f"{out}/{entity}", read, within=("file_id",), rebalance=True)
    summary = manifest.batch_summary(batches)
    run_id = uuid.uuid4().hex
    run = F.lit(run_id).alias("run_id")
    for name, rows in {
        "_faults": faults.unionByName(absent).select("*", run),
        "_misshapen": odd.select("source_file", "pos", "report_json", "year", "batch_id", run),
        "_batches": summary.select("*", run),
        "_runs": run_summary(scanned, faults.unionByName(absent), dropped).select("*", run),
    }.items():
        rows.write.mode("append").partitionBy("run_id").parquet(f"{out}/{name}")
    # Read back from the target: the intermediate tables end with the run.
    known = spark.read.schema(StructType(summary.schema.fields).add("run_id", "string")).parquet(f"{out}/_batches")
    return known.filter(F.col("run_id") == run_id).drop("run_id")


def _file_id() -> Column:
    return F.sha2("relative", 256).substr(1, 16).alias("file_id")


def run_summary(scanned: DataFrame, faults: DataFrame, dropped: dict[str, int]) -> DataFrame:
    """``(what, reason, n)``: what a run read and wrote, and what it left out and why."""
    good = scanned.filter("error IS NULL")
    read = good.filter("NOT misshapen").agg(
        F.count("*").alias("reports"),
        F.count_distinct("source_file").alias("files with reports"),
        F.sum(F.coalesce(F.size("report.patient.drug"), F.lit(0))).alias("drugs"),
        F.sum(F.coalesce(F.size("report.patient.reaction"), F.lit(0))).alias("reactions"),
    ).unpivot([], ["reports", "files with reports", "drugs", "reactions"], "reason", "n")
    kind = F.when(F.col("error").startswith(reports.LONG_REPORT), reports.LONG_REPORT).otherwise(
        F.regexp_extract("error", "^([A-Za-z]+Error|[A-Za-z ]+|BadZipFile)", 1)
    )
    parts = [
        read.select(F.lit("read").alias("what"), "reason", F.coalesce("n", F.lit(0)).cast("long").alias("n")),
        faults.groupBy(kind.alias("reason")).agg(F.count("*").alias("n")).select(F.lit("fault").alias("what"), "reason", "n"),
        good.filter("misshapen").agg(F.count("*").alias("n")).select(F.lit("set aside").alias("what"), F.lit("misshapen report").alias("reason"), "n"),
    ]
    gone = [("partition dropped", entity, int(n)) for entity, n in dropped.items()]
    parts.append(scanned.sparkSession.createDataFrame(gone, "what string, reason string, n long"))
    return reduce(DataFrame.unionByName, parts)


def main(argv: list[str] | None = None) -> None:
    parser = ArgumentParser(description=__doc__)
    parser.add_argument("--index", required=True, help="landed download index (JSON)")
    parser.add_argument("--landing", required=True, help="folder of landed report files")
    parser.add_argument("--out", required=True, help="folder of the raw tables")
    parser.add_argument("--year", default="", help="comma-separated years; all if empty")
    parser.add_argument("--batch-mb", type=float, default=BATCH_CAP_MB)
    args = parser.parse_args(argv)
    spark = build_session("pharmavane-ingest")
    ingest(spark, args.index, args.landing, args.out, args.year, args.batch_mb).show()
    tables.last_run(spark, args.out).orderBy("what", "reason").show(100, truncate=False)


if __name__ == "__main__":
    main()
