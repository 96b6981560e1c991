"""Enveloped documents, cut at any byte, against the json module."""

import json
import random

import pytest

from helpers import rows
from quartermaster.sources import enveloped as E
from quartermaster.sources.documents import read_enveloped, scan_documents

NASTY = ['}', '{"', '\\', '\\"', ']', '}{][', 'a\nb', 'é漢😀', '', '\\\\"}', '{"items": [']


def document(rng, n):
    items = []
    for i in range(n):
        e = {"id": f"i{i}", "name": rng.choice(NASTY) + rng.choice(NASTY)}
        if rng.random() < 0.5:
            e["sub"] = [{"x": rng.choice(NASTY), "items": [{"id": "no"}]} for _ in range(rng.randrange(3))]
        if rng.random() < 0.2:
            e["bag"] = {rng.choice(NASTY): {}}
        items.append(e)
    other = {"items": [{"id": "other"}], "s": rng.choice(NASTY)}
    return items, {"errors": [other], "data": {"before": [other], "items": items, "after": {"items": [{"id": "no"}]}}, "more": other}


def by_ranges(text: str, path, cuts) -> list[str]:
    """The two passes over records dealt to byte ranges at will."""
    records = text.split("}")
    if not records[-1]:
        records.pop()  # the reader gives no empty last record
    cuts = sorted({c % (len(records) + 1) for c in cuts} | {0, len(records)})
    ranges = [records[a:b] for a, b in zip(cuts, cuts[1:])]
    summaries = []
    for start, part in enumerate(ranges):
        ends = []
        for inside in (False, True):
            lx = E.Lexer(len(path) + 1, inside)
            for r in part:
                lx.run(r + "}")
            ends.append({"in_string": lx.in_string, "low": lx.low, "height": lx.height, "brackets": [f[0] for f in lx.frames],
                         "keys": [f[1] for f in lx.frames]})
        summaries.append({"file": 7, "start": start, "outside": ends[0], "inside": ends[1]})
    states = E._states(summaries, len(path) + 1)
    import pyarrow as pa
    found = []
    for start, part in enumerate(ranges):
        batch = pa.RecordBatch.from_pydict({"file": [7] * len(part), "start": [start] * len(part), "value": part})
        for b in E._elements(tuple(path), states)(iter([batch])):
            found += b.to_pylist()
    out, pieces = [], []
    for r in found:
        if r["kind"] == E.WHOLE:
            assert not pieces
            out.append(r["text"])
        else:
            pieces.append(r["text"])
            if r["kind"] == E.END:
                out.append("".join(pieces))
                pieces = []
    assert not pieces
    return out


def test_any_cut(spark):
    rng = random.Random(8)
    for k in range(300):
        items, doc = document(rng, rng.randrange(8))
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1])) + rng.choice(["", "\n", "  \n"])
        got = by_ranges(text, ("data", "items"), [rng.randrange(1000) for _ in range(rng.randrange(6))])
        assert [json.loads(x) for x in got] == items, text


def test_other_paths():
    assert by_ranges('[{"a": 1}, {"a": {"b": 2}}]', (), [1]) == ['{"a": 1}', '{"a": {"b": 2}}']
    assert by_ranges('{"x": {"y": {"z": [{"a": 1}]}}}', ("x", "y", "z"), [2]) == ['{"a": 1}']
    assert by_ranges('{"items": [{"a": 1}]}', ("data", "items"), []) == []
    assert by_ranges('{"items": [{"a": 1}]}\n{"items": [{"a": 2}]}\n', ("items",), [1, 2]) == ['{"a": 1}', '{"a": 2}']


@pytest.mark.parametrize("text", ['{"items": [{"a": 1}, 5, {"a": 2}]}', '{"items": [{"a": 1}, null]}', '{"items": [[{"a": 1}]]}',
                                  '{"items": ["x", {"a": 1}]}', '{"items": [{"a": 1}', '{"items": [{"a": 1}\n', '{"items": [{"a": "1'])
def test_broken_documents_fail(text):
    with pytest.raises(ValueError):
        by_ranges(text, ("items",), [1])


@pytest.mark.parametrize("text", ['[{"a": 1}', '[{"a": 1}\n', '[{"a": 1},', '[{"a": 1'])
def test_a_list_that_ends_too_early_fails(text):
    with pytest.raises(ValueError):
        by_ranges(text, (), [1])


def test_a_file_of_many_ranges(spark, tmp_path):
    """Several tasks read one file; positions count through it."""
    rng = random.Random(9)
    items, doc = document(rng, 400)
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 10
        got = read_enveloped(spark, str(tmp_path), "items", "pos bigint, id string, name string, sub array<struct<x:string>>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [(i, e["id"], e["name"], [x["x"] for x in e["sub"]] if "sub" in e else None) for i, e in enumerate(items)]
    flat = sorted((r["pos"], r["id"], r["name"], None if r["sub"] is None else [x["x"] for x in r["sub"]]) for r in got)
    assert flat == sorted(want * 2)


def test_an_element_longer_than_ranges(spark, tmp_path):
    big = {"id": "big", "name": "x" * 9000, "sub": [{"x": "y}" * 2000}]}
    (tmp_path / "one.json").write_text(json.dumps({"data": {"items": [{"id": "a"}, big, {"id": "z"}]}}), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = read_enveloped(spark, str(tmp_path), "items", "id string, name string, sub array<struct<x:string>>")
        assert [(r["pos"], r["id"]) for r in sorted(got.collect())] == [(0, "a"), (1, "big"), (2, "z")]
        assert got.filter("id = 'big'").first()["sub"][0]["x"] == "y}" * 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_broken_element_fails(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"data": {"items": [{"id": "a"}, {"id" 5}]}}', encoding="utf-8")
    with pytest.raises(Exception):
        read_enveloped(spark, str(tmp_path), "items", "id string").collect()


def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a", "n": 1}\n\nno json\n{"id": "b", "n": "text"}\n{"id": "c"}\n', encoding="utf-8")
    good, bad = scan_documents(spark, str(tmp_path), "id string, n int")
    assert rows(good) == sorted([("a", 1), ("c", None)], key=repr)
    assert sorted(r["line"] for r in bad.collect()) == ["no json", '{"id": "b", "n": "text"}']
    assert all(r["file"].endswith("x.jsonl") for r in bad.collect())
    good, bad = scan_documents(spark, str(tmp_path / "x.jsonl"), "id string, n string")
    assert good.count() == 3 and bad.count() == 1


def test_a_lookup_file_with_a_repeated_key_fails(spark, tmp_path):
    from quartermaster.functions.labels import label
    from quartermaster.sources.tables import read_lookup
    (tmp_path / "l.csv").write_text("k,v\na,1\na,2\nb,3\n", encoding="utf-8")
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    with pytest.raises(Exception):
        label(df, "x", read_lookup(spark, str(tmp_path), "k string, v int"), "k", "v", "label").collect()
