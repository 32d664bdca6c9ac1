from tessera.session import bounded_broadcast, checkpoint_dir, row_count_within, spread


def test_row_count_within_and_bounded_broadcast(spark):
    df = spark.range(100)
    assert row_count_within(df, 100) == 100
    assert row_count_within(df, 99) is None
    hinted, ok = bounded_broadcast(df, 1000)
    assert ok and "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    same, ok = bounded_broadcast(df, 10)
    assert not ok and same is df


def test_checkpoint_dir_comes_from_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = checkpoint_dir(spark)
    assert path and (before is None or path == before)
    assert spark.range(3).checkpoint(eager=True).count() == 3


def test_bounded_broadcast_counts_bytes(spark):
    df = spark.range(10).selectExpr("repeat('x', 1000) AS t")
    assert bounded_broadcast(df, 100, max_bytes=1000)[1] is False
    assert bounded_broadcast(df, 100, max_bytes=100_000)[1] is True


def test_spread_looks_at_files_only(spark, tmp_path):
    want = spark.sparkContext.defaultParallelism
    for name, n in (("one", 1), ("many", 2 * want)):
        spark.range(1000).repartition(n).write.parquet(str(tmp_path / name))
    assert spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == want
    many = spark.read.parquet(str(tmp_path / "many"))
    assert spread(many) is many
    made = spark.range(10)
    assert spread(made) is made
