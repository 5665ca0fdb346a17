import pytest

from tillroll.session import SHUFFLES_GO, app_id, fresh_dir, shared_root, shuffles_go


def test_scratch_lives_under_the_checkpoint_dir(spark):
    root = shared_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == configured.rstrip("/")
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(root + "/tillroll/x-")
    assert app_id(spark) == spark.sparkContext.applicationId


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_shuffle_files_go_with_their_query(spark, shuffle_files):
    there, df = shuffle_files(), spark.range(1000).repartition(3).groupBy("id").count()
    assert spark.conf.get(SHUFFLES_GO, None) is None
    with shuffles_go(spark):
        assert df.count() == 1000
    assert not shuffle_files(until=there) - there
    assert spark.conf.get(SHUFFLES_GO, None) is None
    spark.conf.set(SHUFFLES_GO, "false")
    try:
        with pytest.raises(ZeroDivisionError), shuffles_go(spark):
            1 / 0
        assert spark.conf.get(SHUFFLES_GO) == "false"
    finally:
        spark.conf.unset(SHUFFLES_GO)
