"""Where streams and sinks write when no path is given: the session's shared folder."""

import re
import tempfile
import uuid


def scratch(spark, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names. Unset, it is a temporary folder where Spark runs in one process, and an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="trawl-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """df written to a new path of the shared folder and read again: what comes after doesn't make it twice."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
