from corefold.llm import scratch


def test_tables_are_written_read_and_cleared(spark):
    scratch.clear(spark)
    df, path = scratch.table(spark.range(5), "test")
    assert df.count() == 5 and path.startswith(scratch.shared_dir(spark))
    assert scratch.clear(spark) == 1 and scratch.clear(spark) == 0
    assert spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)) is False


def test_the_driver_hands_freed_memory_back(spark):
    assert scratch.release(spark)
