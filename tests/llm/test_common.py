import pytest
from pyspark.sql import functions as F

from trawl.llm import common


class Conf(dict):
    set = dict.__setitem__


class Session:
    def __init__(self, **conf):
        self.conf = Conf(conf)


def test_shared_dir():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.shared_dir(Session(**{"spark.master": master}))
        assert common.shared_dir(Session(**{"spark.master": master, "spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    assert common.shared_dir(Session(**{"spark.master": "local[2]"})).startswith("file:///")


@pytest.mark.parametrize("hot", [1, 4, 10**6])
def test_skew_join(spark, monkeypatch, hot):
    """Hot and cold keys, keys without a match and null keys, as a plain join has them."""
    monkeypatch.setattr(common, "HOT", hot)
    for kind in ("bigint", "string"):
        left = spark.range(500).select(F.when(F.col("id") < 300, 1).when(F.col("id") == 499, None).otherwise(F.col("id") % 9).cast(kind).alias("k"), "id")
        right = left.where("k <> 5").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
        for how in ("left", "inner"):
            got = sorted(common.skew_join(left, right, "k", "n", 500, how).collect(), key=str)
            assert got == sorted(left.join(right, "k", how).select("k", "id", "n", "top").collect(), key=str)


def test_staged_tables_are_deleted_when_released(spark):
    t = common.staged(spark.range(3), "x")
    assert t.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(t.staged_at)
    common.released(t)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
