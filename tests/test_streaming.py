import json
import os

from pyspark.sql import functions as F

from millrace.streaming import ingest


def test_ingest(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    rec = lambda **kv: json.dumps(kv) + "\n"
    (src / "a.jsonl").write_text(rec(instruction="Identify noun", input="a", output="b") * 2 + "junk\n" + rec(balanda="x", english="y"))
    run = lambda: ingest.write(ingest.first_arrivals(ingest.records(spark, str(src))), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (src / "b.jsonl").write_text(rec(instruction="Identify noun", input="a", output="b") + rec(instruction="i", output="o"))
    run()
    got = sorted((r.instruction, r.input, r.output) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("Identify the Balanda noun", "a", "b"), ("Translate from Balanda to English", "x", "y"), ("i", "", "o")]


def test_windowed_counts(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    (src / "a.jsonl").write_text(json.dumps({"instruction": "Explain x", "input": "", "output": "o"}) + "\n")
    q = ingest.counts(ingest.records(spark, str(src))).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.sql("select * from w").select("_source", "_itype", F.col("n")).collect()
    assert [tuple(x) for x in r] == [("a.jsonl", "explain", 1)]
