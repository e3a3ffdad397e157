"""Report files: scanning, faults, extraction, keys."""

from __future__ import annotations

import gzip
import io
import json
import random
import tracemalloc
import zipfile

import pyarrow as pa
import pytest
from helpers import pairs
from pyspark.sql import functions as F

from pharmavane.operators import extract
from pharmavane.schemas import DRUG_COLUMNS, PATIENT_COLUMNS, REACTION_COLUMNS
from pharmavane.sources import reports

REPORTS = [
    {
        "safetyreportid": "100",
        "serious": "1",
        "receivedate": "20050316",
        "patient": {
            "patientsex": "2",
            "serious": "2",
            "seriousnessdeath": "1",
            "drug": [
                {"medicinalproduct": "ASPIRIN é", "activesubstance": {"activesubstancename": "ACID"}},
                {"medicinalproduct": "B", "activesubstance": None},
                {"medicinalproduct": "C \"quoted\" ]}, {"},
            ],
            "reaction": [{"reactionmeddrapt": "Nausea", "reactionoutcome": "1"}],
        },
    },
    {"patient": {"safetyreportid": "101", "drug": [], "reaction": None}},
    {"safetyreportid": "102"},
    {"safetyreportid": "103", "patient": None},
]
TEXT = json.dumps({"meta": {"results": {"total": 4}}, "results": REPORTS}, ensure_ascii=False, indent=1)


@pytest.mark.parametrize("chunk", [1, 3, 50, 1 << 20])
def test_pieces_of_any_size(monkeypatch, chunk):
    monkeypatch.setattr(reports, "_CHUNK", chunk)
    got = [json.loads(t) for t in reports.iter_reports(TEXT.encode())]
    assert got == REPORTS


def test_many_reports(monkeypatch):
    monkeypatch.setattr(reports, "_CHUNK", 64)
    rng = random.Random(5)
    many = [{"n": n, "text": "é{[\"\\" * rng.randrange(40)} for n in range(300)]
    text = json.dumps({"results": many}, ensure_ascii=False)
    assert [json.loads(t) for t in reports.iter_reports(text.encode())] == many


@pytest.mark.parametrize(
    "content",
    [b"", b"random data", b'{"meta": 1}', TEXT[:-200].encode(), TEXT.replace(']}, {', ']}, {]').encode()[:-9], b'{"results": [{"a": "\xff"}]}'],
)
def test_faults(content):
    with pytest.raises(Exception):
        list(reports.iter_reports(content))


def test_an_invalid_report_is_set_aside_with_its_position(table):
    """Marks tell where a report ends; whether it is JSON is found when it is parsed."""
    texts = ['{"a": 1}', '{"a" 1}', '{"a": tru}', '{"a": 1,}', '{"a": "\\q"}', '{"b": "\\\\"}']
    got = list(reports.iter_reports(('{"results": [%s]}' % ", ".join(texts)).encode()))
    assert got == texts
    _, bad = extract.split_unparsed(table("pos report_json", *[(str(n), t) for n, t in enumerate(got)]))
    assert sorted(pos for (pos,) in pairs(bad, "pos")) == ["1", "2", "3", "4"]


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_marks_agree_with_a_parser(monkeypatch, seed, chunk):
    """Random texts with brackets, quotes and backslashes inside strings, cut anywhere."""
    monkeypatch.setattr(reports, "_CHUNK", chunk)
    rng = random.Random(seed)

    def value(depth):
        kind = rng.randrange(7 if depth < 4 else 4)
        if kind == 0:
            return "".join(rng.choice('[]{},"\\\\ \n\té日') for _ in range(rng.randrange(12)))
        if kind in (1, 2, 3):
            return rng.choice([None, True, -1.5e-3, 7, "", "\\", '"'])
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {str(value(9)): value(depth + 1) for _ in range(rng.randrange(4))}

    entries = [value(0) for _ in range(60)]
    whole = {"meta": value(1), "results": entries, "after": value(1)}
    text = json.dumps(whole, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
    assert [json.loads(t) for t in reports.iter_reports(text.encode())] == entries


def zipped(*texts):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for n, text in enumerate(texts):
            archive.writestr(f"{n}.json", text)
    return packed.getvalue()


def test_every_member_of_a_zip():
    texts = ['{"results": [{"a": 1}]}', '{"results": []}', '{"results": [{"a": 2}, {"a": 3}]}']
    assert [json.loads(t)["a"] for t in reports.iter_reports(zipped(*texts))] == [1, 2, 3]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_only_the_top_level_array(monkeypatch, chunk):
    monkeypatch.setattr(reports, "_CHUNK", chunk)
    text = '{"meta": {"results": [7], "x": "]}\\\\\\""}, "n": -1.5e3, "results": [{"a": 1}, 12], "after": [[{}], "\\"results"]} '
    assert list(reports.iter_reports(text.encode())) == ['{"a": 1}', "12"]


@pytest.mark.parametrize("text", [
    '{"results": [{}]', '{"results": [{}]} x', '{"results": {}}', '{"x": "open', '{"results": [{}], "x": [', "[]",
    '{"results": [{} {}]}', '{"meta": {"results": []}}',
])
def test_broken_texts(text):
    with pytest.raises(ValueError):
        list(reports.iter_reports(text.encode()))


def test_damage_after_the_array_is_found():
    content = bytearray(zipped('{"results": [{"a": 1}], "rest": "' + "".join(map(str, range(300_000))) + '"}'))
    content[len(content) // 2] ^= 255
    with pytest.raises(Exception):
        list(reports.iter_reports(bytes(content)))


@pytest.mark.parametrize("text", ['{"x": [' + "1," * 15_000_000, '{"results": [{"a" 1' + "x" * 30_000_000])
def test_bad_files_stay_small_in_memory(text):
    content = zipped(text)
    del text
    tracemalloc.start()
    with pytest.raises(ValueError):
        list(reports.iter_reports(content))
    assert tracemalloc.get_traced_memory()[1] < 16 << 20
    tracemalloc.stop()


def test_empty_results(table, spark):
    assert list(reports.iter_reports(b'{"results": []}')) == []


def write_files(folder):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / "a.json.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a.json", TEXT)
    (folder / "b.json.gz").write_bytes(gzip.compress(TEXT.encode()))
    (folder / "c.json").write_text(TEXT, encoding="utf-8")
    (folder / "d.json.zip").write_bytes((folder / "a.json.zip").read_bytes()[:200])
    (folder / "e.json").write_text(TEXT[:300], encoding="utf-8")


def test_files_of_all_kinds(spark, tmp_path):
    write_files(tmp_path / "in")
    good, faults = reports.split_scanned(reports.read_report_files(spark, str(tmp_path / "in")))
    stem = F.element_at(F.split("source_file", "/"), -1)
    counts = dict(pairs(good.groupBy(stem.alias("f")).count(), "f", "count"))
    assert counts == {"a.json.zip": 4, "b.json.gz": 4, "c.json": 4}
    assert sorted(f for (f,) in pairs(faults.select(stem.alias("f")), "f")) == ["d.json.zip", "e.json"]


def test_a_long_report_is_a_fault_by_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reports, "MAX_REPORT", 1 << 19)
    monkeypatch.setattr(reports, "_CHUNK", 1 << 16)
    long = json.dumps({"a": ['"]}\\', "x" * (1 << 22), {}]})
    whole = zipped('{"results": [{"a": 1}, %s, {"a": 2}], "meta": {}}' % long, '{"results": [{"a": 3}]}')
    cut = gzip.compress(('{"results": [{"a": 1}, %s' % long).encode())
    files = pa.RecordBatch.from_pydict({"path": ["whole", "cut"], "content": [whole, cut]})
    rows = pa.Table.from_batches(reports._scan_batches(iter([files])))
    assert [r["error"] is None for r in rows.to_pylist() if r["source_file"] == "whole"] == [True, False, True, True]
    good, faults = reports.split_scanned(spark.createDataFrame(rows))
    assert sorted(pairs(good, "source_file", "pos", "report_json")) == [
        ("whole", 0, '{"a": 1}'), ("whole", 2, '{"a": 2}'), ("whole", 3, '{"a": 3}'),
    ]
    assert sorted(pairs(faults, "source_file", "error")) == [
        ("cut", "ValueError: the end in place of one of ,]"),
        ("cut", "long report at position 1: a value of more than 524288 bytes"),
        ("whole", "long report at position 1: a value of more than 524288 bytes"),
    ]


def parsed(table, texts):
    rows = [("f", str(i), t) for i, t in enumerate(texts)]
    df = table("source_file pos report_json", *rows)
    return extract.parse_reports(df.withColumn("pos", F.col("pos").cast("long")))


def test_extraction(table):
    df = parsed(table, [json.dumps(r) for r in REPORTS])
    patient = extract.extract_patient(df)
    drug = extract.extract_drug(df)
    reaction = extract.extract_reaction(df)
    assert patient.columns == PATIENT_COLUMNS
    assert drug.columns == DRUG_COLUMNS
    assert reaction.columns == REACTION_COLUMNS
    # The report's own field wins; a field only under the patient is used.
    assert sorted(pairs(patient, "safetyreportid", "serious", "seriousnessdeath"), key=str) == [
        ("100", "1", "1"), ("101", None, None), ("102", None, None), ("103", None, None),
    ]
    assert sorted(pairs(drug, "medicinalproduct", "activesubstancename"), key=str) == [
        ("ASPIRIN é", "ACID"), ("B", None), ('C "quoted" ]}, {', None),
    ]
    assert pairs(reaction, "reactionmeddrapt", "reactionoutcome") == [("Nausea", "1")]
    keys = {k for (k,) in pairs(patient, "patientid")}
    assert len(keys) == 4
    assert {k for (k,) in pairs(drug, "patientid")} | {k for (k,) in pairs(reaction, "patientid")} <= keys


def test_keys_repeat(table):
    one = pairs(parsed(table, ["{}", "{}"]), "patientid")
    assert one == pairs(parsed(table, ["{}", "{}"]), "patientid")
    assert len(set(one)) == 2


def test_unparsed(table):
    whole = ["{}", '{"a": 1}', '{"patient": null}', '{"patient": {"drug": [], "reaction": [{}]}}', '{"patient": {"drug": [{"a": 1}, {"b": {}}]}}']
    broken = ['{"a": ', "5", '"text"', "[]", "", None, '{"patient": "text"}', '{"patient": []}', '{"patient": {"drug": {}}}', '{"patient": {"reaction": [1]}}', '{"patient": {"drug": [{}, 5]}}']
    good, bad = extract.split_unparsed(table("report_json", *whole, *broken))
    assert sorted(t for (t,) in pairs(good, "report_json")) == sorted(whole) and bad.count() == len(broken)


def test_native_json_reader(spark, tmp_path):
    write_files(tmp_path / "in")
    paths = [str(tmp_path / "in" / n) for n in ("b.json.gz", "c.json")]
    native = reports.read_report_json(spark, paths)
    assert native.count() == 8
    scanned, _ = reports.split_scanned(reports.read_report_files(spark, paths))
    ours = extract.extract_drug(extract.parse_reports(scanned))
    theirs = extract.extract_drug(native)
    columns = DRUG_COLUMNS[1:]
    assert sorted(pairs(ours, *columns), key=str) == sorted(pairs(theirs, *columns), key=str)


SHORT = ['{"results": [{"a": 1}, [2], "x", -1.5e3]} ', ' {\n"results" : [ {"a": "]}\\\\\\""} ,\t{"é": {}} ] }\n', '{"results": [{"a": "\\ud800"}]}']
OTHER = [
    '{"results": []}', '{"results": [ ]}', '{"results": [{"a" 1}, {"b": 2}]}', '{"results": [{"a": tru}]}', '{"results": [{"a": 1},]}',
    '{"results": [{}]} x', '{"results": [{}]', '{"results": [{}', '{"results": [{} {}]}', '{"results": [{}], "results": [{}, 2]}',
    '{"meta": {}, "results": [{"a": 1}]}', "", "[]", '{"results": [1], "x": ',
]


def test_short_files_give_what_the_cursor_gives(monkeypatch):
    texts = [t.encode() for t in SHORT + OTHER] + [b'{"results": [{"a": "\xff"}]}', gzip.compress(SHORT[0].encode()), zipped(*SHORT)]
    files = pa.RecordBatch.from_pydict({"path": [str(n) for n in range(len(texts))], "content": texts})
    short = list(reports._scan_rows([files]))
    assert [reports._short_entries(t) is not None for t in texts] == [True] * len(SHORT) + [False] * (len(texts) - len(SHORT))
    monkeypatch.setattr(reports, "_SHORT", -1)
    assert short == list(reports._scan_rows([files]))


def test_faults_of_a_query_come_from_one_scan(spark, tmp_path):
    """Good files, faults and the list of broken files are read from what one scan has stored."""
    from pharmavane.plans import registry

    spark.range(1, 31).selectExpr(
        "id as o_orderkey", "id as o_custkey", "timestamp '1995-01-01' as o_orderdate"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    found = registry.scan_faults(spark, str(tmp_path))
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(f"report-{n}", "good" if n % 10 else "fault") for n in range(1, 31)}
    assert {tuple(r) for r in found.collect()} == want and found.count() == 30
