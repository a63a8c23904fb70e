from activlake.session import get_session, lake_format, shuffle_partitions
from workload.queries import scratch


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert lake_format(spark) == "parquet"
    assert get_session(log_level="ERROR") is spark


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 1024**4) == 81920
    assert shuffle_partitions(100 * 1024**4) == 819_200


def test_stored_results_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second
