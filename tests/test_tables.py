"""Tables, quality and the three jobs, end to end on files."""

from __future__ import annotations

import gzip
import json
import zipfile
from pathlib import Path

import pytest
from helpers import pairs
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pharmavane.operators import clean, quality, star
from pharmavane.plans import clean as clean_job
from pharmavane.plans import ingest as ingest_job
from pharmavane.plans import model as model_job
from pharmavane.schemas import RAW_COLUMNS, RAW_SCHEMAS
from pharmavane.session import shared_dir
from pharmavane.sources import tables


def test_years_are_pruned_and_match_whole(spark, table, tmp_path):
    rows = table("patientid reactionmeddrapt reactionoutcome year", *[(str(n), "T", "1", str(1999 + n % 4)) for n in range(20)])
    tables.write_by_year(rows, f"{tmp_path}/reaction")
    picked = tables.read_entity(spark, str(tmp_path), "reaction", "2000, 2002")
    assert {y for (y,) in pairs(tables.years_present(picked), "year")} == {"2000", "2002"}
    assert tables.read_entity(spark, str(tmp_path), "reaction", "20").count() == 0
    assert tables.read_entity(spark, str(tmp_path), "reaction", "").count() == 20
    plan = picked._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1][:60]
    files = tables.source_files(tables.read_entity(spark, str(tmp_path), "reaction"))
    assert {y for (y,) in pairs(files, "year")} == {"1999", "2000", "2001", "2002"}


def test_overwriting_one_year_keeps_the_others(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    tables.write_by_year(table("v year", ("a", "2001"), ("b", "2002")), path)
    tables.write_by_year(table("v year", ("c", "2002")), path)
    assert sorted(pairs(tables.read_years(spark, path), "v", "year")) == [("a", "2001"), ("c", "2002")]


def test_year_and_file_tree(spark, table, tmp_path):
    for year in ("2004", "2005"):
        tables.write_files(table("v", "a", "b"), f"{tmp_path}/drug/{year}/part", files=2)
    assert tables.read_tree(spark, str(tmp_path), "drug").count() == 4
    with pytest.raises(AnalysisException):
        tables.write_new(table("v", "a"), f"{tmp_path}/drug/2004/part")


def test_drifted_and_merged(spark, table, tmp_path):
    tables.write_new(table("Name Age:int City", ("Alice", 30, "New York")), f"{tmp_path}/1")
    tables.write_new(table("Name Age City", ("Bob", "x", "Boston")), f"{tmp_path}/2")
    tables.write_new(table("Name Age:int City", ("Cid", None, "Rome")), f"{tmp_path}/3")
    tables.write_new(table("Name", "Dan"), f"{tmp_path}/4")
    got = tables.read_drifted(spark, [f"{tmp_path}/{n}" for n in range(1, 5)], ["Name", "Age", "City"])
    assert sorted(pairs(got, "Name", "Age", "City"), key=str) == [
        ("Alice", "30", "New York"), ("Bob", "x", "Boston"), ("Cid", None, "Rome"), ("Dan", None, None),
    ]
    merged = tables.read_merged(spark, f"{tmp_path}/1", f"{tmp_path}/4")
    assert sorted(pairs(merged, "Name", "Age"), key=str) == [("Alice", 30), ("Dan", None)]


def raw(table, entity, **values):
    columns = RAW_COLUMNS[entity]
    return table(" ".join(columns), tuple(values.get(c) for c in columns))


def test_cleaned_columns(table):
    patient = clean.clean_patient(raw(table, "patient", patientid="p", patientonsetage="12.7", patientonsetageunit="801", seriousnessdeath="2"))
    row = patient.first().asDict()
    assert row["patientage(yrs)"] == 12.0 and row["seriousnessdeath"] is False and row["serious"] is None
    assert dict(patient.dtypes)["patientage(yrs)"] == "float"
    drug = clean.clean_drug(raw(table, "drug", patientid="p", drugstructuredosagenumb="0.1", drugstructuredosageunit="002"))
    assert dict(drug.dtypes)["drugstructuredosage(mg)"] == "double"
    assert drug.first()["drugstructuredosage(mg)"] == 0.00010000000149011613
    assert dict(drug.dtypes)["drugstartdate"] == "date"
    assert clean.clean_path(patient, "data/pq/other").columns == patient.columns
    assert clean.clean_path(raw(table, "reaction", reactionoutcome="5"), "data/pq/reaction").first()["reactionoutcome"] == "Fatal"


def test_quarantine_loses_no_row(spark, table, tmp_path):
    rows = table(
        "patientid patientsex patientweight receivedate",
        ("a", "1", "70", "20050101"), ("b", "x", "70", "2005"), ("c", None, "N/A", "20051399"), ("d", "2", None, None),
    )
    types = {"patientsex": "int", "patientweight": "float", "receivedate": "date"}
    good, bad = quality.split_bad(rows, types)
    assert sorted(pairs(good, "patientid")) == [("a",), ("d",)]
    assert sorted(pairs(bad, "patientid", "bad_columns")) == [
        ("b", ["patientsex"]), ("c", ["patientweight", "receivedate"]),
    ]
    _, lacking = quality.split_bad(rows, {**types, "serious": "int"})
    assert lacking.count() == 4
    quality.write_split(rows, types, f"{tmp_path}/split")
    assert spark.read.parquet(f"{tmp_path}/split").groupBy("quarantined").count().count() == 2
    with pytest.raises(ValueError):
        quality.check_columns(rows, ["serious"])


def report(n, drugs, terms):
    return {
        "safetyreportid": str(n), "serious": "1", "receivedate": "20050316",
        "patient": {
            "patientonsetage": "70", "patientonsetageunit": "801",
            "drug": [{"medicinalproduct": d, "drugstartdate": "200501", "drugadministrationroute": "048"} for d in drugs],
            "reaction": [{"reactionmeddrapt": t, "reactionoutcome": "5"} for t in terms],
        },
    }


def scratch_files(spark):
    return {path for path in Path(shared_dir(spark)).rglob("*") if path.is_file()}


def test_jobs_end_to_end(spark, tmp_path):
    landing = tmp_path / "landing"
    entries = []
    for year, name, rows in [
        ("2004", "drug-0001.json.zip", [report(1, ["A", "B"], ["X"]), report(2, ["A"], [])]),
        ("2004", "drug-0002.json.zip", [report(3, [], ["Y"])]),
        ("2005", "drug-0001.json.zip", [report(4, ["C", "C"], ["X", "Z"])]),
        ("2005", "drug-0002.json.zip", None),
    ]:
        folder = landing / f"{year}q1"
        folder.mkdir(parents=True, exist_ok=True)
        if rows is None:
            (folder / name).write_bytes(b"PK broken")
        else:
            with zipfile.ZipFile(folder / name, "w") as archive:
                archive.writestr("x.json", json.dumps({"results": rows}))
        entries.append({"display_name": f"{year} Q1 (part 1 of 2)", "file": f"https://files.example/{year}q1/{name}", "size_mb": "6"})
    index_path = tmp_path / "index.json"
    index_path.write_text(json.dumps({"results": {"drug": {"event": {"total_records": 4, "partitions": entries}}}}))

    raw_dir, cleaned = f"{tmp_path}/raw", f"{tmp_path}/cleaned"
    before = scratch_files(spark)
    summary = ingest_job.ingest(spark, str(index_path), str(landing), raw_dir, "2004,2005", cap_mb=13)
    assert scratch_files(spark) == before  # and the summary can still be read
    assert pairs(summary.orderBy("batch_id"), "batch_id", "n_items", "total_size_mb") == [(1, 1, 12.0), (2, 1, 12.0)]
    count = lambda e, y=None: tables.read_entity(spark, raw_dir, e, y).count()
    assert [count(e) for e in ("patient", "drug", "reaction")] == [4, 5, 4]
    assert count("patient", "2004") == 3
    assert spark.read.parquet(f"{raw_dir}/_faults").count() == 1
    lineage = spark.read.parquet(f"{raw_dir}/drug")
    assert lineage.filter("source_file_path is null or ingestion_timestamp is null").count() == 0
    assert {b for (b,) in pairs(lineage, "batch_id")} == {"1", "2"}

    clean_job.clean(spark, raw_dir, cleaned, "", quarantine=f"{tmp_path}/quarantine")
    assert scratch_files(spark) == before
    patient = tables.read_years(spark, f"{cleaned}/patient")
    drug = tables.read_years(spark, f"{cleaned}/drug", "2005")
    assert drug.filter("source_file_path LIKE '%2005q1/drug-0001.json.zip' AND batch_id = '2'").count() == 2
    assert pairs(drug.drop("patientid"), "medicinalproduct", "drugadministrationroute", "year") == [("C", "Oral", "2005")] * 2
    assert pairs(patient.agg(F.count_if("serious").alias("n"), F.min("patientage(yrs)").alias("a")), "n", "a") == [(4, 70.0)]

    model_job.build_model(spark, cleaned, "staging", buckets=4)
    model_job.build_model(spark, cleaned, "staging", years="2005")
    assert scratch_files(spark) == before
    facts = spark.table("staging.fact_drug")
    assert facts.count() == 4 and spark.table("staging.fact_reaction").count() == 4
    # The calendar spans the dates of the drugs too: 1 January to 16 March 2005.
    assert spark.table("staging.dim_date").count() == 75
    # Tables bucketed alike join without moving a row.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.join(spark.table("staging.dim_patient").select("patientid", "patientsex"), "patientid")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_oversized_year_is_packed_by_file(spark, table):
    files = table("seq:long display_name file size_mb", (0, "2004 a", "u/x/f0", "6"), (1, "2004 b", "u/x/f1", "6"), (2, "2005 a", "u/y/f2", "3"), (3, "2006 a", "u/z/f3", "99"))
    from pharmavane.operators import manifest

    picked = ingest_job.select_files(files, manifest.run_plan(files, None, 8.0), None, 8.0)
    assert sorted(pairs(picked, "file", "year", "batch_id")) == [
        ("u/x/f0", "2004", "2004-1"), ("u/x/f1", "2004", "2004-2"), ("u/y/f2", "2005", "1"), ("u/z/f3", "2006", None),
    ]


def land(landing, name, rows):
    path = landing / name
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("x.json", json.dumps({"results": rows}))


def listing(path, *names):
    entries = [{"display_name": f"{n[:4]} Q1 (part 1 of 9)", "file": f"https://h.example/drug/event/{n}", "size_mb": "6"} for n in names]
    path.write_text(json.dumps({"results": {"drug": {"event": {"total_records": 1, "partitions": entries}}}}))
    return str(path)


def test_later_files_of_a_year_join_the_earlier_ones(spark, tmp_path):
    landing, out = tmp_path / "landing", f"{tmp_path}/raw"
    land(landing, "event/2004q1/a.json.zip", [report(1, ["A"], ["X"]), report(2, ["A"], [])])
    first = listing(tmp_path / "1.json", "2004q1/a.json.zip", "2004q1/gone.json.zip")
    ingest_job.ingest(spark, first, str(landing), out)
    land(landing, "event/2004q2/a.json.zip", [report(3, ["B"], ["Y"]), "text", {"patient": "text"}])
    land(landing, "event/2005q1/a.json.zip", [report(4, ["C"], [])])
    second = listing(tmp_path / "2.json", "2004q2/a.json.zip", "2005q1/a.json.zip")
    ingest_job.ingest(spark, second, str(landing), out, "2004")
    ids = lambda: sorted(i for (i,) in pairs(tables.read_entity(spark, out, "patient"), "safetyreportid"))
    assert ids() == ["1", "2", "3"]
    land(landing, "event/2004q1/a.json.zip", [report(5, ["A"], ["X"])])
    ingest_job.ingest(spark, first, str(landing), out)
    assert ids() == ["3", "5"]
    faults = spark.read.parquet(f"{out}/_faults")
    assert pairs(faults.groupBy("error").agg(F.count("*"), F.count_distinct("run_id")), "error", "count(1)") == [("did not land", 2)]
    assert sorted(pairs(spark.read.parquet(f"{out}/_misshapen"), "pos", "report_json")) == [(1, '"text"'), (2, '{"patient": "text"}')]


def test_only_wanted_files_are_opened(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "2004q1/a.json.zip", [report(1, [], [])])
    (landing / "2005q1").mkdir()
    (landing / "2005q1" / "a.json.zip").write_bytes(b"broken")
    landed = ingest_job.landed_files(spark, str(landing))
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    listed = spark.createDataFrame(
        [("https://h/x/2004q1/a.json.zip", "2004", "1"), ("https://h/y/2004q1/a.json.zip", "2004", "1"), ("https://h/x/2005q1/a.json.zip", "2005", "1")],
        "file string, year string, batch_id string",
    )
    matched, bad = ingest_job.match_landed(listed, landed)
    assert [p.split("/")[-2] for (p,) in pairs(matched, "path")] == ["2005q1"]
    assert {e for (e,) in pairs(bad, "error")} == {"several listed files have this path"}
    one, none = ingest_job.match_landed(listed.filter("file LIKE '%/x/2004%'"), landed)
    scanned = ingest_job.scan_matched(spark, one)
    assert none.count() == 0 and pairs(scanned, "year", "error") == [("2004", None)]


def test_files_read_in_splits_give_the_same_tables(spark, tmp_path):
    """Plain and gzipped files are scanned whole or in splits and streams; zips always whole."""
    landing = tmp_path / "landing"
    texts = [json.dumps({"results": [report(100 * k + n, ["A, B", "C"], ["X"]) for n in range(9)]}) for k in range(4)]
    for folder in ("2004q1", "2005q1"):
        (landing / folder).mkdir(parents=True)
    (landing / "2004q1" / "a.json").write_text(texts[0])
    (landing / "2005q1" / "b.json.gz").write_bytes(gzip.compress(texts[1].encode()))
    (landing / "2005q1" / "c.json").write_text(texts[2][:-40])
    land(landing, "2005q1/d.json.zip", [report(9, ["D"], ["Z"])])
    listed = listing(tmp_path / "1.json", "2004q1/a.json", "2005q1/b.json.gz", "2005q1/c.json", "2005q1/d.json.zip")
    found = []
    for large_from in (0, 1 << 28):
        out = f"{tmp_path}/raw-{large_from}"
        ingest_job.ingest(spark, listed, str(landing), out, large_from=large_from)
        got = [sorted(map(str, tables.read_entity(spark, out, e).drop("ingestion_timestamp").collect())) for e in ("patient", "drug", "reaction")]
        found.append((got, pairs(spark.read.parquet(f"{out}/_faults"), "source_file")))
    assert found[0] == found[1]
    assert [len(rows) for rows in found[0][0]] == [19, 37, 19]
    assert [path.split("/")[-1] for (path,) in found[0][1]] == ["c.json"]


def test_a_new_version_leaves_nothing_of_the_old(spark, tmp_path):
    """A file first with, then without reactions; its cleaned rows and quarantine follow."""
    landing, out = tmp_path / "landing", f"{tmp_path}/raw"
    bad = report(7, ["B"], ["Z"])
    bad["patient"]["patientweight"] = "heavy"
    land(landing, "2004q1/a.json.zip", [report(1, ["A"], ["X"]), report(2, [], ["Y"]), bad])
    land(landing, "2004q2/b.json.zip", [report(3, ["C"], ["X"])])
    land(landing, "2005q1/c.json.zip", [report(4, ["D"], ["X"])])
    listed = listing(tmp_path / "1.json", "2004q1/a.json.zip", "2004q2/b.json.zip", "2005q1/c.json.zip")
    ingest_job.ingest(spark, listed, str(landing), out)

    def state(years=""):
        clean_job.clean(spark, out, f"{tmp_path}/clean", years, quarantine=f"{tmp_path}/bad")
        raw = [tables.read_entity(spark, out, e) for e in ("patient", "drug", "reaction")]
        cleaned = [tables.read_years(spark, f"{tmp_path}/clean/{e}", schema=schemas[e]) for e in ("patient", "drug", "reaction")]
        bad_rows = tables.read_years(spark, f"{tmp_path}/bad/patient", schema=schemas["bad"])
        counts = lambda t: dict(pairs(t.groupBy("year").count(), "year", "count"))
        return [counts(t) for t in raw], [counts(t) for t in cleaned], counts(bad_rows)

    clean_job.clean(spark, out, f"{tmp_path}/clean", "", quarantine=f"{tmp_path}/bad")
    schemas = {e: spark.read.parquet(f"{tmp_path}/clean/{e}").schema for e in ("patient", "drug", "reaction")}
    schemas["bad"] = spark.read.parquet(f"{tmp_path}/bad/patient").schema
    both = [{"2004": 4, "2005": 1}, {"2004": 3, "2005": 1}, {"2004": 4, "2005": 1}]
    assert state() == (both, both, {"2004": 1})

    land(landing, "2004q1/a.json.zip", [report(1, ["A"], []), report(2, [], [])])
    land(landing, "2005q1/c.json.zip", [report(4, ["D"], [])])
    ingest_job.ingest(spark, listed, str(landing), out)
    told = {(w, r): n for w, r, n in pairs(tables.last_run(spark, out), "what", "reason", "n")}
    assert told["read", "reports"] == 4 and told["read", "reactions"] == 1
    assert [told["partition dropped", e] for e in ("patient", "drug", "reaction")] == [0, 0, 2]
    fewer = [{"2004": 3, "2005": 1}, {"2004": 2, "2005": 1}, {"2004": 1}]
    raw, cleaned, bad_rows = state("2005")  # only 2005 is cleaned again
    assert raw == fewer and cleaned == [both[0], both[1], {"2004": 4}] and bad_rows == {"2004": 1}
    assert state() == (fewer, fewer, {})

    # A file that cannot be read keeps what the run before wrote; one that moves to another year leaves its old one.
    (landing / "2004q1" / "a.json.zip").write_bytes(b"PK broken")
    moved = tmp_path / "2.json"
    entries = [{"display_name": f"{y} Q1 (part 1 of 9)", "file": f"https://h.example/drug/event/{n}", "size_mb": "6"} for y, n in (("2004", "2004q1/a.json.zip"), ("2006", "2004q2/b.json.zip"))]
    moved.write_text(json.dumps({"results": {"drug": {"event": {"total_records": 1, "partitions": entries}}}}))
    ingest_job.ingest(spark, str(moved), str(landing), out)
    assert state()[0] == [{"2004": 2, "2005": 1, "2006": 1}, {"2004": 1, "2005": 1, "2006": 1}, {"2006": 1}]
    told = {(w, r): n for w, r, n in pairs(tables.last_run(spark, out), "what", "reason", "n")}
    assert told["fault", "BadZipFile"] == 1


def test_keys_outlive_a_move(spark, tmp_path):
    found = []
    for root in ("here", "there/deep"):
        land(tmp_path / root, "event/2004q1/a.json.zip", [report(1, ["A"], ["X"]), report(2, ["B"], [])])
        listed = listing(tmp_path / "i.json", "2004q1/a.json.zip")
        ingest_job.ingest(spark, listed, str(tmp_path / root), f"{tmp_path}/raw-{len(found)}")
        found.append([
            sorted(map(tuple, tables.read_entity(spark, f"{tmp_path}/raw-{len(found)}", e).collect()), key=str) for e in ("patient", "drug", "reaction")
        ])
    assert found[0] == found[1] and len(found[0][0]) == 2
    # The same file from the other root replaces the rows it gave before.
    ingest_job.ingest(spark, listed, f"{tmp_path}/there/deep", f"{tmp_path}/raw-0")
    assert tables.read_entity(spark, f"{tmp_path}/raw-0", "patient").count() == 2


def test_only_what_was_scanned_is_dropped(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    rows = table("v year file_id", ("a", "2001", "f/1 +%"), ("b", "2001", None), ("c", None, "f2"), ("d", "2003", "f3"))
    assert tables.replace_partitions(rows, path, within=("file_id",)) == 0
    scanned = table("file_id", "f/1 +%", None, "f3")
    assert tables.replace_partitions(table("v year file_id", ("e", "2003", "f3")), path, scanned, ("file_id",)) == 2
    left = spark.read.parquet(path).select("v", F.col("year").cast("string"), "file_id")
    assert sorted(pairs(left, "v", "year", "file_id"), key=str) == [("c", None, "f2"), ("e", "2003", "f3")]
    assert tables.replace_partitions(rows.limit(0), path, None, ("file_id",)) == 2


def test_model_of_one_year_reads_only_that_year(spark, tmp_path):
    landing, out, cleaned = tmp_path / "landing", f"{tmp_path}/raw", tmp_path / "clean"
    names = ["2004q1/a.json.zip", "2005q1/b.json.zip", "2006q1/c.json.zip"]
    for k, name in enumerate(names):
        land(landing, name, [report(10 * k + n, ["A", f"D{k}"], ["X", f"T{k}"]) for n in range(4)])
    listed = listing(tmp_path / "i.json", *names)

    def cleaned_of(years=""):
        ingest_job.ingest(spark, listed, str(landing), out, years)
        clean_job.clean(spark, out, str(cleaned), years)

    def model(database):
        found = {}
        for name in (*model_job.FACTS, "dim_drug", "dim_reaction", "dim_date"):
            kept = [c for c in spark.table(f"{database}.{name}").columns if c not in tables.LINEAGE.names]
            found[name] = sorted(map(str, spark.table(f"{database}.{name}").select(*sorted(kept)).collect()))
        return found

    cleaned_of()
    model_job.build_model(spark, str(cleaned), "by_year", buckets=4)
    late = report(99, ["NEW"], ["X", "OTHER"])
    late["receivedate"] = "20061231"
    land(landing, names[1], [report(10, ["A", "D1"], ["X", "T1"]), late])
    land(landing, names[2], [report(20, ["D2"], [])])
    cleaned_of("2005,2006")
    # What is set aside cannot be read: a run that looked at 2004 would lose it.
    for entity in ("patient", "drug", "reaction"):
        (cleaned / entity / "year=2004").rename(cleaned / f"{entity}-2004")
    model_job.build_model(spark, str(cleaned), "by_year", years="2005, 2006")
    for entity in ("patient", "drug", "reaction"):
        (cleaned / f"{entity}-2004").rename(cleaned / entity / "year=2004")
    model_job.build_model(spark, str(cleaned), "whole", buckets=4)
    grown, whole = model("by_year"), model("whole")
    for name in model_job.FACTS:
        assert grown[name] == whole[name] and len(grown[name])
    assert set(grown["dim_drug"]) >= set(whole["dim_drug"]) and len(grown["dim_drug"]) == len(set(grown["dim_drug"])) == 5
    assert set(grown["dim_reaction"]) - set(whole["dim_reaction"]) == {r for r in grown["dim_reaction"] if "'T2'" in r}
    assert grown["dim_date"] == whole["dim_date"]
    years = dict(pairs(spark.table("by_year.fact_reaction").groupBy("year").count(), "year", "count"))
    assert years == {"2004": 8, "2005": 4}
    files = {f.rsplit("/", 1)[-1].split("_")[1].split(".")[0] for f in spark.table("by_year.fact_drug").inputFiles()}
    assert len(files) <= 4


def cleaned_rows(table):
    """Patients of two years, and drugs and reactions of theirs, of nobody's and of a report with most rows."""
    patient = table(
        "patientid safetyreportid receivedate serious year",
        *[(f"p{n}", f"s{n}" if n % 3 else None, f"200{4 + n % 2}0101", "1", f"200{4 + n % 2}") for n in range(20)],
    )
    owners = [f"p{n % 7}" for n in range(40)] + ["p3"] * 60 + ["nobody", None]
    year = {f"p{n}": f"200{4 + n % 2}" for n in range(20)}
    drug = table(
        "patientid medicinalproduct activesubstancename drugstartdate year",
        *[(who, f"D{n % 5}" if n % 11 else None, f"S{n % 2}", f"2004{1 + n % 9:02}10", year.get(who, "2004")) for n, who in enumerate(owners)],
    )
    reaction = table(
        "patientid reactionmeddrapt reactionoutcome year",
        *[(who, f"T{n % 4}", str(n % 7) if n % 3 else None, year.get(who, "2004")) for n, who in enumerate(owners)],
    )

    def whole(rows, entity):
        kept = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string").alias(f.name) for f in RAW_SCHEMAS[entity].fields]
        return clean.CLEANERS[entity](rows.select(*kept, "year"), keep=("year",))

    return whole(patient, "patient"), whole(drug, "drug"), whole(reaction, "reaction")


@pytest.mark.parametrize("heavy", [5, 100_000])
def test_facts_are_sent_once(spark, table, monkeypatch, heavy):
    """One exchange for each side gives the merge, the join and the buckets; also where a report is merged first."""
    monkeypatch.setattr(star, "HEAVY_REPORT", heavy)
    patient, drug, reaction = cleaned_rows(table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make, child in ((star.fact_drug, drug), (star.fact_reaction, reaction)):
            sent = make(patient, child, ("year",), 3)
            if heavy == 100_000:
                plan = sent._jdf.queryExecution().executedPlan().toString()
                assert plan.count("Exchange hashpartitioning") == 2
            want = make(patient, child, ("year",))
            assert sorted(map(str, sent.collect())) == sorted(map(str, want.collect()))
            assert sent.agg(F.sum("n_mentions")).first()[0] == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_of_many_rows_are_written_by_several_tasks(spark, table, tmp_path, monkeypatch):
    for entity, rows in zip(("patient", "drug", "reaction"), cleaned_rows(table)):
        tables.write_by_year(rows, f"{tmp_path}/{entity}")
    model_job.build_model(spark, str(tmp_path), "one_task", buckets=2)
    monkeypatch.setattr(model_job, "TASK_ROWS", 10)
    model_job.build_model(spark, str(tmp_path), "many_tasks", buckets=2)
    model_job.build_model(spark, str(tmp_path), "many_tasks", years="2005")
    for name in model_job.FACTS:
        want, got = (sorted(map(str, spark.table(f"{d}.{name}").collect())) for d in ("one_task", "many_tasks"))
        assert got == want and got
    files = [f.rsplit("/", 1)[-1].split("_")[1].split(".")[0] for f in spark.table("many_tasks.dim_patient").inputFiles()]
    assert len(set(files)) == 2 and len(spark.table("one_task.dim_patient").inputFiles()) <= 4
