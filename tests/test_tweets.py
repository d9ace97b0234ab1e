import random

import pytest
from pyspark.errors import AnalysisException

from caseflow.schemas import RAW_TWEET
from caseflow.sources.tweets import read_tweets, scan_csv

HEADER = ",".join(RAW_TWEET.names) + "\n"


def write(path, body, encoding="utf-8"):
    path.write_bytes((HEADER + body).encode(encoding))
    return str(path)


def texts(df):
    return {row["tweet_id"]: row["text"] for row in df.collect()}


@pytest.mark.parametrize("split", [False, True])
def test_edges(spark, tmp_path, split):
    path = write(tmp_path / "t.csv", "".join([
        '1,a,True,x,"two\nlines",,\n',
        '2,a,True,x,"a ""quoted"" word",,\n',
        '3,a,True,x,café \U0001f44d,,\n',
        '4,a,True,x,,,\n',
        '5,a,True,x,"",,\n',
        '6,a,True,x,NA,,\n',
        '7,a,True,x,"  blanks  ",,\n',
        '8,a,True,x,"comma, and\r\nwindows line",,9\n']))
    assert texts(read_tweets(spark, path, split_files=split)) == {
        "1": "two\nlines", "2": 'a "quoted" word', "3": "café \U0001f44d", "4": None, "5": None,
        "6": "NA", "7": "  blanks  ", "8": "comma, and\r\nwindows line"}


def test_latin1(spark, tmp_path):
    path = write(tmp_path / "t.csv", "1,a,True,x,café,,\n", "latin-1")
    assert texts(read_tweets(spark, path, encoding="ISO-8859-1")) == {"1": "café"}
    with pytest.raises(ValueError):
        read_tweets(spark, path, encoding="ISO-8859-1", split_files=True)


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_tweets(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize("piece", [64, 257, 4096])
def test_split_files_equal_whole_files(spark, tmp_path, piece):
    """Records of any length over pieces of any length, in two files."""
    rng = random.Random(piece)
    for name in ("a", "b"):
        body = []
        for i in range(400):
            words = rng.choices(["x", "\n", '""', ",", "long " * 30, "é", "\n\n"], k=rng.randint(0, 8))
            body.append(f'{name}{i},u,True,x,"{"".join(words)}",,{i}\n')
        write(tmp_path / f"{name}.csv", "".join(body))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        whole = sorted(map(tuple, read_tweets(spark, str(tmp_path)).collect()), key=str)
        spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        split = read_tweets(spark, str(tmp_path), split_files=True)
        assert sorted(map(tuple, split.collect()), key=str) == whole
        assert len(whole) == 800
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_scan_infers_types(spark, tmp_path):
    (tmp_path / "s.csv").write_text("author,n\nx,1\ny,2\n")
    assert scan_csv(spark, str(tmp_path / "s.csv")).dtypes == [("author", "string"), ("n", "int")]


def test_split_with_quotes_inside_unquoted_fields(spark, tmp_path):
    body = []
    for i in range(60):
        text = ['5" nails', 'a "b" c', '"two\n5"" lines"', "plain", '"x, ""y"""', 'ends with "'][i % 6]
        body.append(f"{i},u,True,x,{text},,\n")
    path = write(tmp_path / "t.csv", "".join(body))
    whole = sorted(map(tuple, read_tweets(spark, path).collect()), key=str)
    conf = {"spark.sql.files.maxPartitionBytes": 128, "spark.sql.files.openCostInBytes": 0}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        split = read_tweets(spark, path, split_files=True)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # Other pieces would be planned by now; the rows are those of the stored ones.
    assert sorted(map(tuple, split.collect()), key=str) == whole and len(whole) == 60
