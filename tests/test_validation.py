"""Dataset files through the validator, end to end."""
import pytest

from newsops.operators.dedup import duplicate_lines
from newsops.operators import validate as V
from newsops.plans.datasets import validate, validate_file
from newsops.sources import files


def check(spark, tmp_path, body, max_length=100, min_samples=5, name="news_20250101.csv"):
    path = tmp_path / name
    path.write_text(body, encoding="utf-8")
    issues, report = validate_file(spark, str(path), max_length, min_samples)
    return issues.collect(), report.first()


def kinds(issues, kind):
    return sorted((i["line_number"] or 0) for i in issues if i["type"] == kind)


def test_valid_file(spark, tmp_path):
    body = "text,label\n" + "".join(
        f'"A sentence about markets number {i}",{lab}\n'
        for i, lab in enumerate(["positive", "negative", "neutral"] * 2))
    issues, report = check(spark, tmp_path, body)
    assert issues == [] and report["validation_success"]
    assert (report["total_samples"], report["valid_samples"]) == (6, 6)
    assert report["label_distribution"] == "negative=2;neutral=2;positive=2"


def test_wrong_columns(spark, tmp_path):
    issues, report = check(spark, tmp_path, "title,sentiment\nabc,positive\ndef,negative\n")
    assert not report["validation_success"] and kinds(issues, "missing_columns") == [0]
    assert "Colonnes manquantes" in [i["message"] for i in issues if i["type"] == "missing_columns"][0]


def test_invalid_labels_have_lines(spark, tmp_path):
    body = ("text,label\nfirst valid text,positive\nsecond text here,pos\nthird text here,BAD\n"
            "fourth text here,NEUTRAL\nfifth text here,maybe\n")
    issues, report = check(spark, tmp_path, body)
    assert kinds(issues, "invalid_label") == [3, 4, 6] and report["error_count"] == 3
    assert report["total_samples"] is None


def test_empty_text(spark, tmp_path):
    issues, _ = check(spark, tmp_path, 'text,label\n"",positive\n"   ",negative\nsome longer text,neutral\n')
    assert kinds(issues, "empty_text") == [2, 3] and kinds(issues, "missing_text") == []
    assert kinds(issues, "very_short_text") == [3]


def test_missing_text_when_empty_cells_are_null(spark):
    rows = spark.createDataFrame([(1, None, "positive"), (2, None, "bad"), (3, "long enough text", "neutral")],
                                 "n int, text string, label string")
    rows = rows.selectExpr("'f' as file", "text", "label", "cast(n + 1 as bigint) as line_number")
    issues = validate(rows)[0].collect()
    assert kinds(issues, "missing_text") == [2] and kinds(issues, "invalid_label") == [3]


def test_duplicates(spark, tmp_path):
    body = ("text,label\nthe same long text,positive\nanother long text,negative\nthe same long text,neutral\n"
            "another long text,negative\nunique long text,neutral\n")
    issues, report = check(spark, tmp_path, body)
    messages = sorted(i["message"] for i in issues if i["type"] == "duplicate_text")
    assert messages == ["Texte dupliqué sur 2 lignes (première: 2): 'the same long text...'",
                        "Texte dupliqué sur 2 lignes (première: 3): 'another long text...'"]
    assert report["duplicates"] == 2


def test_lengths(spark, tmp_path):
    body = f"text,label\n{'A' * 150},positive\nX,negative\nnormal length text,neutral\nanother normal text,positive\n"
    issues, report = check(spark, tmp_path, body)
    assert kinds(issues, "text_too_long") == [2] and kinds(issues, "very_short_text") == [3]
    assert kinds(issues, "all_caps_text") == [2] and report["validation_success"]


def test_class_balance(spark, tmp_path):
    labels = ["positive"] * 8 + ["negative", "neutral"]
    body = "text,label\n" + "".join(f"this is text number {i},{lab}\n" for i, lab in enumerate(labels))
    issues, report = check(spark, tmp_path, body)
    over = [i["message"] for i in issues if i["type"] == "overrepresented_class"]
    assert over == ["Classe 'positive' sur-représentée: 8 (80.0%)"] and report["validation_success"]


def test_too_few_and_report_lines(spark, tmp_path):
    issues, _ = check(spark, tmp_path, "text,label\nsome long text,positive\nother long text,BAD\n")
    assert kinds(issues, "insufficient_samples") == [0]
    frame = validate_file(spark, str(tmp_path / "news_20250101.csv"))[0]
    order = ["section", "pos", "phase", "line_number"]
    lines = [r["line"] for r in V.issue_lines(frame, "file").orderBy(*order).collect()]
    assert lines[0] == "❌ 1 ERREUR(S) CRITIQUE(S):" and lines[1] == ""
    assert any("(ligne 3)" in x for x in lines) and lines[-1].startswith("💡")


def test_missing_and_broken_files(spark, tmp_path):
    issues, report = validate_file(spark, str(tmp_path / "absent.csv"))
    assert [i["type"] for i in issues.collect()] == ["file_not_found"]
    assert not report.first()["validation_success"]
    issues, report = check(spark, tmp_path, "text,label\na,positive\nb,positive,extra\n")
    assert [i["type"] for i in issues] == ["csv_parse_error"] and report["error_count"] == 1


def test_header_only(spark, tmp_path):
    issues, report = check(spark, tmp_path, "text,label\n")
    assert {i["type"] for i in issues} == {"empty_dataset", "no_valid_labels"}
    assert not report["validation_success"]


def test_duplicate_groups_are_one_issue_at_any_size(spark):
    """Lines far apart make one issue; the long table lists them all."""
    rows = spark.range(25_000).selectExpr(
        "'f' as file", "id + 2 as line_number",
        "case when id in (0, 20000) then 'the same text here' when id % 3 = 1 then 'often' else concat('text ', id) end as text")
    found = {r["message"] for r in V.duplicate_issues(rows, "file").collect()}
    assert found == {"Texte dupliqué sur 2 lignes (première: 2): 'the same text here...'",
                     "Texte dupliqué sur 8333 lignes (première: 3): 'often...'"}
    listed = duplicate_lines(rows, "file").groupBy("group_size").count().collect()
    assert {tuple(r) for r in listed} == {(2, 2), (8333, 8333)}


def test_line_numbers_over_split_files(spark, tmp_path):
    """A file read in many blocks is numbered like one read whole."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for f in range(2):
        body = "text,label\n" + "".join(f"file {f} row {i} with some text,neutral\n" for i in range(3000))
        (tmp_path / f"news_2025010{f + 1}.csv").write_text(body)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        rows = files.read_labelled_csv(spark, str(tmp_path), multiline=False, with_file=True)
        assert rows.select("_block").distinct().count() > 2
        got = files.with_line_number(rows).select("text", "line_number").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 6000
    assert all(int(r["text"].split()[3]) + 2 == r["line_number"] for r in got)


@pytest.mark.parametrize("count,share", [(1, "12.5"), (5, "62.5")])
def test_percent_text(spark, count, share):
    from pyspark.sql import functions as F

    assert spark.range(1).select(V._percent(F.lit(count) / F.lit(8))).first()[0] == share


@pytest.mark.parametrize("columns", [["text"], ["label"], ["text", "label"], ["importance"], ["label", "importance"], []])
def test_repair_report_on_any_columns(spark, columns):
    from newsops.operators.stats import repair_report

    rows = spark.createDataFrame([("f", "x" * 600, "positive", "critique"), ("f", "short", "BAD", "none"), ("f", "short", "neutral", "critique")],
                                 "file string, text string, label string, importance string").select("file", *columns)
    for got in (repair_report(rows, "file").first(), repair_report(rows).first()):
        assert got["long_texts"] == ("text" in columns) and got["duplicates"] == ("text" in columns)
        assert got["invalid_labels"] == ("label" in columns) and got["invalid_importances"] == ("importance" in columns)
        assert got["is_valid"] == (not columns) and got["text_length_max"] == (600 if "text" in columns else 0)
