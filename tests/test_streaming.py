"""The row-wise steps on a stream give what they give on a table."""

from sluice.streaming.stateless import clean_stream, drop_resent


def test_stream_equals_batch(spark, tmp_path):
    rows = [("AAAA,0001", "2,900", "25/12/2023 10:00", "yes", "call 1"), ("n/a", "1", "", "no", "x"),
            ("AAAA-0002", "x", "bad", "maybe", "a@b.org"), ("AAAA-0001", "2,900", "25/12/2023 10:00", "yes", "call 1")]
    schema = "uid string, bw string, at string, twin string, note string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    types = {"bw": "numeric", "at": "datetime", "twin": "boolean"}
    want = clean_stream(spark.read.parquet(str(tmp_path / "in")), types).collect()
    assert len(want) == 3 and want[0]["uid"] == "AAAA-0001" and want[0]["bw"] == 2900.0
    stream = clean_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), types)
    q = stream.writeStream.format("memory").queryName("cleaned").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("cleaned").collect())) == sorted(map(str, want))
    timed = stream.selectExpr("*", "cast(at as timestamp) as seen")
    q = drop_resent(timed, "seen", ["uid", "seen"]).writeStream.format("memory").queryName("once").start()
    q.processAllAvailable()
    q.stop()
    assert [r["uid"] for r in spark.table("once").filter("seen IS NOT NULL").collect()] == ["AAAA-0001"]
