from tessera.operators import band_counts


def test_band_counts_on_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(17, "x ring"), (30, "ring"), (70, "ring"), (30, "bolt")], "v int, t string").write.parquet(
        str(src)
    )
    stream = spark.readStream.schema("v int, t string").parquet(str(src))
    out = band_counts(stream, "v", "t", "ring")
    q = out.writeStream.outputMode("complete").format("memory").queryName("bands_stream").start()
    try:
        q.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table("bands_stream").collect())
    finally:
        q.stop()
    assert got == [("Adults", 1), ("Children", 1), ("Elderly", 1)]


def test_code_tokens_on_a_stream(spark, tmp_path):
    from tessera.operators import explode_codes

    src = tmp_path / "docs"
    spark.createDataFrame([("a b  a",), ("b\tc",)], "text string").write.parquet(str(src))
    stream = spark.readStream.schema("text string").parquet(str(src))
    counts = explode_codes(stream, "text").groupBy("code").count()
    q = counts.writeStream.outputMode("complete").format("memory").queryName("codes_stream").start()
    try:
        q.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table("codes_stream").collect())
    finally:
        q.stop()
    assert got == [("a", 2), ("b", 2), ("c", 1)]
