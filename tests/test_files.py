import argparse
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallygraph.__main__ import run_linreg
from tallygraph.sources import bad_csv_rows, read_documents, read_numeric_csv, write_named


def test_bad_rows_are_reported_with_their_files(spark, tmp_path):
    (tmp_path / "one.csv").write_text("1,2,3\n4,5\n\n6,x,8\n")
    (tmp_path / "two.csv").write_text("1, 2 ,3\n1,2,3,4\n,,\n")
    found = bad_csv_rows(spark, str(tmp_path), ["y", "a", "b"]).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["block_start"], r["record"]) for r in found) == [
        ("one.csv", 0, "4,5"), ("one.csv", 0, "6,x,8"), ("two.csv", 0, "1,2,3,4"),
    ]
    with pytest.raises(ValueError, match="_record"):
        bad_csv_rows(spark, str(tmp_path), ["_record"])
    with pytest.raises(Exception, match="MALFORMED"):
        read_numeric_csv(spark, str(tmp_path), ["y", "a", "b"]).collect()


def test_names_of_files_come_back(spark, tmp_path):
    rows = [("a b+c%.txt", "x"), ("a b+c%.txt", "y"), ("é=1", ""), ("é=1", "z")]
    lines = spark.createDataFrame(rows, "name string, text string")
    for folder in ("left", "right"):
        write_named(lines, str(tmp_path / folder), "name", "text")
    found = read_documents(spark, f"{tmp_path}/left,{tmp_path}/right")
    assert sorted(map(tuple, found.collect())) == sorted(rows * 2)
    with pytest.raises(ValueError, match="slash"):
        write_named(lines.withColumn("name", F.lit("a/b")), str(tmp_path / "bad"), "name", "text")


def test_a_large_name_is_dealt_over_files(spark, tmp_path):
    rows = [("big", f"line {i % 50} {'x' * 20}") for i in range(400)] + [("small", ""), ("more1", "z")]
    lines = spark.createDataFrame(rows, "name string, text string").repartition(4)
    folders = write_named(lines, str(tmp_path / "out"), "name", "text", piece_bytes=1000)
    files = [f for folder in folders for f in Path(folder).iterdir() if f.name == "big"]
    assert len(files) == len(folders) >= 5 and max(f.stat().st_size for f in files) < 6000
    assert (tmp_path / "out" / "more1").read_text() == "z\n"
    found = sorted((r["doc_id"], r["text"]) for r in read_documents(spark, folders).collect())
    assert found == sorted(rows)


def test_coefficients_are_printed(spark, tmp_path, capsys):
    (tmp_path / "in.csv").write_text("1,0\n3,1\n5,2\n7,3\n")
    run_linreg(spark, argparse.Namespace(input=str(tmp_path / "in.csv"), output=str(tmp_path / "out")))
    printed = capsys.readouterr().out
    assert "Columns: 2" in printed
    lines = [line.split("|")[1:3] for line in printed.splitlines() if line.startswith("|")]
    assert {k.strip(): round(float(v), 9) for k, v in lines[1:]} == {"intercept": 1.0, "x1": 2.0}
