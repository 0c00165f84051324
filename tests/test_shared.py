"""Intermediate tables never go to a machine-local folder on a cluster."""

import pytest

from trawl.streaming.shared import scratch


class Conf(dict):
    set = dict.__setitem__


class Session:
    def __init__(self, **conf):
        self.conf = Conf(conf)


def test_scratch():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch(Session(**{"spark.master": master}), "x")
        assert scratch(Session(**{"spark.master": master, "spark.checkpoint.dir": "hdfs:///shared/"}), "x").startswith("hdfs:///shared/x-")
    for master in ("local", "local[4]", "local[*]"):
        assert scratch(Session(**{"spark.master": master}), "x").startswith("file:///")
