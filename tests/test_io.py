import json

from tamiz.sources import files
from tamiz.sources.articles import ArticleSource, FileClient, find_collection
from tamiz.streaming import incremental


def test_text_files(spark, tmp_path, rows):
    (tmp_path / "p1.txt").write_bytes(b"a\r\nb\xffc")
    (tmp_path / "p2.md").write_text("x")
    assert rows(files.texts(spark, str(tmp_path))) == [("p1", "a\nbc")]


def test_csv_round_trip(spark, tmp_path, rows):
    d = spark.createDataFrame([('a "x", y', "l1\nl2"), ("b", None)], "t string, u string")
    files.write_csv(d, str(tmp_path / "c"), ["t", "u"])
    assert rows(files.csv_table(spark, str(tmp_path / "c"), "t string, u string")) == rows(d)
    assert files.csv_table(spark, str(tmp_path / "none"), "t string").count() == 0


def test_json_array(spark, tmp_path, rows):
    d = spark.createDataFrame([(2, '{"a":2}'), (1, '{"a":1}')], "k int, task string")
    files.one_json_file(d, "k", str(tmp_path / "a.json"))
    assert [x["a"] for x in json.loads((tmp_path / "a.json").read_text())] == [1, 2]
    assert rows(files.json_array(spark, str(tmp_path / "a.json"), "a int")) == [(1,), (2,)]
    assert files.json_array(spark, str(tmp_path / "none.json"), "a int").count() == 0


def test_articles(spark, tmp_path, rows):
    docs = [
        {"pid": "S1", "title": "T", "abstract": {"es": "a", "en": "b"}, "publication_date": "2001-05-01", "license": {"url": "u"}, "fulltexts": {"html": {"es": "http://x"}}},
        {"code": "S2", "publication_date": "2002-01-01", "domain": "d.example"}, {"publication_date": "2002-02-01"}, {"pid": "S3", "publication_date": "2009-01-01"},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, docs)))
    (tmp_path / "collections.json").write_text(json.dumps([{"code": "chl", "name": "Chile"}, {"code": "prx", "name": "Perú"}]))
    assert find_collection(FileClient(str(tmp_path)), "peru", "per") == "prx" and find_collection(FileClient(str(tmp_path)), "zzz", "per") == "per"
    spark.dataSource.register(ArticleSource)
    d = spark.read.format("articles").options(place=str(tmp_path), from_year="2001", until_year="2003").load()
    assert d.rdd.getNumPartitions() == 3
    assert rows(d, "pid", "resumen", "licencia", "html_url") == [("S1", "a b", "u", "http://x"), ("S2", None, None, "http://d.example/scielo.php?script=sci_arttext&pid=S2")]


def test_incremental(spark, tmp_path, rows):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "pid string, v int").write.parquet(src)
    incremental.append_new(spark, src, "pid string, v int", out, state, "pid").awaitTermination()
    spark.createDataFrame([("b", 9), ("c", 1)], "pid string, v int").write.mode("append").parquet(src)
    for _ in range(2):
        incremental.append_new(spark, src, "pid string, v int", out, state, "pid").awaitTermination()
    assert rows(spark.read.parquet(out), "pid") == [("a",), ("b",), ("c",)]
