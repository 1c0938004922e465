"""Records cut in many blocks, against Python's csv and json."""
import csv
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsops.plans.datasets import csv_problems, validate_file
from newsops.sources import files, records as R


@pytest.fixture(params=[300, 1 << 27])
def split(spark, request):
    """Splits of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "1")
    yield request.param
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def cell(rng):
    size = rng.choice([0, 1, 3, 20, 90])
    return "".join(rng.choice(["a", "é", " ", ",", "\n", '"', "\r\n", "word", '""', "{", "}", "\\"]) for _ in range(size))


def csv_text(rng, rows, end):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["text", "label", "importance", "correlations"])
    for row in rows:
        writer.writerow(row)
        if rng.random() < 0.1:
            out.write(end)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_in_any_split(spark, split, tmp_path, end):
    rng = random.Random(end)
    want = []
    for f in range(3):
        rows = [[f"{i} " + cell(rng), rng.choice(["positive", ""]), cell(rng), cell(rng)] for i in range(20)]
        (tmp_path / f"news_2025010{f + 1}.csv").write_bytes(csv_text(rng, rows, end).encode())
        want += [(f"news_2025010{f + 1}.csv", i + 2, *(x or None for x in row)) for i, row in enumerate(rows)]
    got = files.read_labelled_csv(spark, str(tmp_path), multiline="split", with_file=True)
    rows = [(r["file"], r["line_number"], r["text"], r["label"], r["importance"], r["correlations"]) for r in got.collect()]
    assert sorted(rows) == sorted(want)
    raw, ends = R.cut(spark, str(tmp_path), R.Csv())
    assert not ends.where("unclosed").count() and {r["cells"] for r in raw.collect()} == {4}
    if split < 1000:
        assert R.blocks(spark, str(tmp_path), R.Csv()).where("inside").count() > 5


def test_split_reading_equals_reading_whole_files(spark, split, tmp_path):
    rng = random.Random(3)
    rows = [[cell(rng).replace("\r\n", "\n") or "x", "neutral", "", ""] for _ in range(30)]
    (tmp_path / "news_20250101.csv").write_text(csv_text(rng, rows, "\n"))
    for empty in ("null", "string"):
        one = files.read_labelled_csv(spark, str(tmp_path), empty=empty).collect()
        many = files.read_labelled_csv(spark, str(tmp_path), empty=empty, multiline="split").collect()
        assert sorted(map(str, one)) == sorted(map(str, many))


@pytest.mark.parametrize("indent", [None, 1])
def test_json_arrays_in_any_split(spark, split, tmp_path, indent):
    rng = random.Random(indent or 7)
    rows = [{"text": f"{i} " + cell(rng), "label": rng.choice(["positive", None]), "more": {"a": [{"b": cell(rng)}, 1]}} for i in range(36)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:24], indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps(rows[24:], indent=indent, ensure_ascii=True) + "\n")
    (tmp_path / "c.json").write_text("[]")
    got, ends = R.cut(spark, str(tmp_path), R.Json())
    assert sorted((json.loads(r["raw"], strict=False) for r in got.collect()), key=str) == sorted(rows, key=str)
    assert not ends.where("unclosed").count()
    one = files.read_labelled_json(spark, str(tmp_path / "a.json"), split=True).select("text", "label").collect()
    assert sorted(map(tuple, one)) == sorted(((r["text"], r["label"]) for r in rows[:24]), key=lambda r: r[0])


def test_broken_files(spark, split, tmp_path):
    body = "text,label\n" + "".join(f'"row {i}, it says ""x""\nand more",positive\n' for i in range(40))
    (tmp_path / "good.csv").write_text(body)
    (tmp_path / "wide.csv").write_text(body + '"a,b",positive,more\nx,positive,"c\n",d\n')
    (tmp_path / "open.csv").write_text(body + '"never closed,positive\nlast,neutral\n')
    (tmp_path / "cut.json").write_text('[{"text": "a"}, {"text": "b')
    got = {r["file"].rsplit("/", 1)[-1]: (r["bad_rows"], r["unclosed"]) for r in csv_problems(spark, str(tmp_path / "*.csv")).collect()}
    assert got == {"wide.csv": (2, False), "open.csv": (0, True)}
    got, ends = R.cut(spark, str(tmp_path / "cut.json"), R.Json())
    assert [r["raw"] for r in got.collect()] == ['{"text": "a"}'] and ends.first()["unclosed"]
    for name, kind in (("wide", "csv_parse_error"), ("open", "csv_parse_error"), ("absent", "file_not_found")):
        issues, report = validate_file(spark, str(tmp_path / f"{name}.csv"))
        assert [i["type"] for i in issues.collect()] == [kind] and not report.first()["validation_success"]
    issues, report = validate_file(spark, str(tmp_path / "good.csv"))
    assert report.first()["total_samples"] == 40 and report.first()["validation_success"]


def test_quotes_within_cells_open_nothing(spark, split, tmp_path):
    (tmp_path / "a.csv").write_text('text,label\n5" pipe,positive\nsay "hi" now,neutral\n"x" y,negative\n' * 30)
    got, ends = R.cut(spark, str(tmp_path / "a.csv"), R.Csv())
    assert got.count() == 120 and not ends.first()["unclosed"]
    assert got.where(F.col("number") == 2).first()["raw"] == '5" pipe,positive'


def test_strings_are_held_a_slice_at_a_time(monkeypatch):
    """A batch of long rows becomes Python strings in bounded parts, whole and in order."""
    monkeypatch.setattr(R, "SLICE_BYTES", 1000, raising=False)
    values = ["x" * n for n in (400, 500, 300, 5000, 0, 10, 990)] + [None] + ["é" * 300] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(values)), pa.array([0] * 9 + [7] * (len(values) - 9)), pa.array(values)], names=["file", "block", "value"])
    parts = list(R._by_block([batch, batch.slice(0, 0)]))
    assert [v for _, p in parts for v in p] == values and {k for k, _ in parts} == {("f", 0), ("f", 7)}
    assert all(len(p) == 1 or sum(len((v or "").encode()) for v in p) <= 1000 for _, p in parts)
