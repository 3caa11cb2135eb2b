from pyspark.sql import functions as F

from pricelens import session


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    a, b = (session.scratch_path(spark, "x") for _ in range(2))
    assert a != b and a.startswith(session.scratch_dir(spark))
    session.ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_stage_table_cuts_the_lineage(spark):
    df = session.stage_table(spark.range(10).withColumn("city", F.lit("LA")), "t", ["city"])
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(df.columns) == ["city", "id"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_broadcast_by_its_stored_bytes(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(name)
    big = spark.range(1000).withColumnRenamed("id", "k")
    side = session.small_side(spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    plans = []
    try:
        for bound in ("1m", "1"):
            spark.conf.set(name, bound)
            joined = session.join_on(big, side, ["k"])
            plans.append(plan_of(joined))
            assert joined.count() == 50
    finally:
        spark.conf.set(name, threshold)
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]
    assert all("Range (0, 50" not in p for p in plans)


def test_join_on_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    got = {(r.k, r.x, r.y) for r in session.join_on(left, right, ["k"], "left").collect()}
    assert got == {(None, 1, 10), ("a", 2, 20), ("b", 3, None)}
