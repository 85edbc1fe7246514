"""Tasks that write bucketed tables follow the shuffle, not the number of buckets."""

from collections import Counter

from pyspark.sql import functions as F

from arenalake.sources.sinks import save_model


def test_few_buckets_are_written_by_many_tasks(spark):
    rows = spark.range(20_000).select((F.col("id") % 7001).alias("match_id"), (F.col("id") % 3).cast("string").alias("w"))
    spark.sql("CREATE SCHEMA IF NOT EXISTS few_buckets")
    saved = save_model(rows, "few_buckets.facts", bucket_by="match_id", buckets=2, partition_by="w")
    files = saved.select("w", F.input_file_name().alias("file"), "match_id").groupBy("w", "file").agg(
        F.count("*").alias("n"), F.countDistinct(F.pmod(F.hash("match_id"), F.lit(2))).alias("buckets")
    ).collect()
    # The 8 shuffle partitions are 4 shares of each bucket.
    assert Counter(r["w"] for r in files) == {"0": 8, "1": 8, "2": 8}
    assert max(r["n"] for r in files) < 2000 and all(r["buckets"] == 1 for r in files)
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, rows.collect()))
    other = save_model(rows.dropDuplicates(["match_id"]), "few_buckets.keys", bucket_by="match_id", buckets=2)
    plan = saved.join(other.hint("merge"), "match_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP SCHEMA few_buckets CASCADE")
