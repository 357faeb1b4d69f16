from types import SimpleNamespace

import pytest

from casebook.session import scratch_path, shared_folder


def fake(master, configured=None, checkpoint=None):
    """A session seen through the few settings that matter here."""
    context = SimpleNamespace(master=master, applicationId="app-1", folders=[checkpoint])
    context.getCheckpointDir = lambda: context.folders[-1]
    context.setCheckpointDir = context.folders.append
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default=None: configured or default))


def test_configured_folder_is_used_everywhere():
    for master in ("local[4]", "spark://host:7077"):
        spark = fake(master, configured="hdfs:///shared/")
        assert shared_folder(spark) == "hdfs:///shared"
        assert spark.sparkContext.getCheckpointDir() == "hdfs:///shared/"
        assert scratch_path(spark, "t").startswith("hdfs:///shared/casebook/app-1/t-")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))
    assert shared_folder(fake("yarn", checkpoint="hdfs:///set/by/caller")) == "hdfs:///set/by/caller"


def test_local_session_gets_one_temporary_folder():
    spark = fake("local[2]")
    assert shared_folder(spark) == shared_folder(spark)


def test_two_tables_never_share_a_path():
    spark = fake("yarn", configured="hdfs:///shared")
    assert scratch_path(spark, "t") != scratch_path(spark, "t")
