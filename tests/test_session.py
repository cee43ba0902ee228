from distillery.session import cut_lineage, ensure_checkpoint_dir


def test_checkpoint_dir_and_cut(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d
    df = cut_lineage(spark.range(100).selectExpr("id * 2 AS x"))
    assert df.agg({"x": "sum"}).first()[0] == 9900
    assert "LogicalRDD" in df._jdf.queryExecution().logical().toString()  # lineage is cut


def test_spread_small_inputs_only(spark):
    from distillery.sources.tables import spread
    target = spark.sparkContext.defaultParallelism
    small = spark.range(100).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == target
    wide = spark.range(100).repartition(target + 3)
    assert spread(wide) is wide  # already parallel: unchanged plan
    assert sorted(r.id for r in spread(small).collect()) == list(range(100))
