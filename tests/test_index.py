"""Landed indexes, scanned entry by entry."""

from __future__ import annotations

import json

import pytest
from helpers import pairs

from pharmavane.sources import index, reports

ENTRIES = [{"display_name": f"200{k} Q1 (part 1 of 2)", "file": f"f{k} ]}}\\\" é", "size_mb": None if k == 2 else str(k), "more": [{}]} for k in range(5)]


def landed(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("chunk", [1, 40, 1 << 20])
def test_entries_with_positions(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(reports, "_CHUNK", chunk)
    event = {"partitions": ENTRIES, "export_date": [1, "]"], "total_records": 12}
    other = {"partitions": [{"file": "not ours"}]}
    path = landed(tmp_path / "i.json", {"meta": {"results": 1}, "results": {"food": {"event": other}, "drug": {"label": other, "event": event}}})
    found = index.read_index_files(spark, path)
    same = index.index_files(index.check_index(index.read_index(spark, path)))
    assert found.columns == same.columns == ["total_records", "seq", "display_name", "file", "size_mb"]
    expected = [(12, k, e["display_name"], e["file"], e["size_mb"]) for k, e in enumerate(ENTRIES)]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, same.collect())) == expected


def test_many_entries(spark, tmp_path):
    entries = [{"file": str(k)} for k in range(30_000)]
    path = landed(tmp_path / "i.json", {"results": {"drug": {"event": {"partitions": entries}}}})
    found = index.read_index_files(spark, path)
    assert found.count() == 30_000 and found.filter("file != seq OR total_records IS NOT NULL").isEmpty()
    assert pairs(found.agg({"seq": "max"}), "max(seq)") == [(29_999,)]


@pytest.mark.parametrize("text", ["", "{}", '{"meta": 1}', "[]", '{"results": {"drug": {"event": {"partitions": [{}', '{"results": 5}', "{} {}"])
def test_no_index(spark, tmp_path, text):
    with pytest.raises(ValueError):
        index.read_index_files(spark, landed(tmp_path / "i.json", text))
