"""Positive x negative product with a hot sample: exact output, and AQE splits the skewed
join partition (thresholds lowered so the split engages at test size)."""

from distillery.operators import pairs


def test_cross_sides_hot_sample_split(spark):
    rows = [(0, "positive", i) for i in range(40)] + [(0, "negative", 1000 + i) for i in range(2000)]
    rows += [(k, s, k * 10 + i) for k in range(1, 200) for s, i in (("positive", 0), ("negative", 1), ("negative", 2))]
    df = spark.createDataFrame(rows, "sid long, side string, pid long").repartition(8)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = pairs.cross_sides(df, ["sid"], id_cols=["pid"])
        n_hot = out.filter("sid = 0").count()
        total = out.count()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n_hot == 40 * 2000
    assert total == 40 * 2000 + 199 * 2
    assert "skew=true" in plan, plan
