import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("tillroll-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session names none.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="tillroll-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


SF0001 = "/root/testdata/sf0.001"


@pytest.fixture()
def shuffle_files(spark):
    """The shuffle files there are now; with ``until``, once only those are left or after ten seconds."""
    import time

    def now():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}

    def files(until=None):
        end = time.time() + 10
        while until is not None and now() - until and time.time() < end:
            time.sleep(0.2)
        return now()
    return files
