from helixspan.session import hand_over, scratch_path, shared_folder


def test_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == configured if configured else spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(folder.rstrip("/"))


def test_hand_over_keeps_rows_and_schema(table):
    df = table([("a", None, [1, 2]), (None, 2.5, None)], "k string, v double, l array<int>")
    copy = hand_over(df)
    assert copy.dtypes == df.dtypes
    assert sorted(copy.collect(), key=str) == sorted(df.collect(), key=str)
    assert hand_over(df.limit(0)).count() == 0
