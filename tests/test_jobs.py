import math

import pytest

from tallygraph.__main__ import main


def text_of(folder):
    return [line for part in sorted(folder.glob("part-*")) for line in part.read_text().splitlines()]


@pytest.fixture(autouse=True)
def keep_session(spark):
    """The jobs use the running session."""


@pytest.fixture()
def corpus(tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    (folder / "a.txt").write_text("the cat\nThe dog\n")
    (folder / "b.txt").write_text("the bird\n")
    (folder / "empty.txt").write_text("")
    return folder


def test_wordcount_and_tf(spark, corpus, tmp_path):
    main(["wordcount", str(corpus), str(tmp_path / "counts")])
    assert sorted(text_of(tmp_path / "counts")) == [
        "bird\tb.txt\t1", "cat\ta.txt\t1", "dog\ta.txt\t1", "the\ta.txt\t2", "the\tb.txt\t1",
    ]
    main(["tf", str(corpus), str(tmp_path / "tf")])
    found = {(r.word, r.doc_id): r.tf for r in spark.read.parquet(str(tmp_path / "tf")).collect()}
    assert found["the", "a.txt"] == pytest.approx(math.log10(2) + 1)


def test_tfidf_and_search(corpus, tmp_path):
    main(["tfidf", str(corpus), str(tmp_path / "tf"), str(tmp_path / "scores")])
    main(["search", str(tmp_path / "scores"), str(tmp_path / "hits"), "THE", "cat", "the"])
    hits = dict(line.split("\t") for line in text_of(tmp_path / "hits"))
    the = math.log10(1 + 3 / 2)
    assert list(hits) == ["a.txt", "b.txt"]
    assert float(hits["a.txt"]) == pytest.approx((math.log10(2) + 1) * the + math.log10(1 + 3 / 1))
    assert float(hits["b.txt"]) == pytest.approx(the)


def test_pagerank(tmp_path):
    (tmp_path / "dump.txt").write_text(
        "<title>A</title><text>[[B]]</text>\n\n<title>B</title><text>[[B]] [[red]]</text>\n"
    )
    main(["pagerank", str(tmp_path / "dump.txt"), str(tmp_path / "ranked")])
    lines = text_of(tmp_path / "ranked")
    assert [line.split("\t")[0] for line in lines] == ["B", "A"]
    assert lines[1] == "A\t0.15000000000000002"


def test_linreg(tmp_path, capsys):
    (tmp_path / "yx.csv").write_text("".join(f"{1 + 2 * x},{x}\n" for x in range(10)))
    main(["linreg", str(tmp_path / "yx.csv"), str(tmp_path / "betas")])
    betas = dict(line.split("\t") for line in text_of(tmp_path / "betas"))
    assert {k: float(v) for k, v in betas.items()} == pytest.approx({"intercept": 1.0, "x1": 2.0})
    assert "Columns: 2" in capsys.readouterr().out


def test_unknown_job(capsys):
    with pytest.raises(SystemExit):
        main(["nothing"])
