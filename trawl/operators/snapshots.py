"""Content-hash versions of captured pages: versions, changes, flaps, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.operators.order import AT, PART, dealt, scan


def versions(captures: DataFrame, site: str = "site_id", ord_: str = "ord", sha: str = "sha") -> DataFrame:
    """captures with prev_sha, is_new, ver (1..N per site, growing where the hash differs from the capture before) and flap.

    flap: a new version whose content equals any earlier version of the site. Only narrow columns may be given:
    texts are joined back by the caller for the rows that survive. A site's captures are spread over range partitions, which hand on
    their last hash and count; only the first row of a hash in each partition meets those of other partitions."""
    x = dealt(captures, [site], [F.col(ord_), F.col(sha)])
    x = scan(x, [site], lags={"prev_sha": F.col(sha)}, sums={"_row": F.lit(1)})
    x = x.withColumn("is_new", F.when((F.col("_row") == 1) | ~F.col(sha).eqNullSafe(F.col("prev_sha")), 1).otherwise(0))
    x = scan(x, [site], sums={"ver": F.col("is_new")})
    here = F.min(F.when(F.col("is_new") == 1, F.col(AT))).over(Window.partitionBy(PART, site, sha))
    x = x.withColumn("_lead", F.col(AT).eqNullSafe(here))
    rest = x.where(~F.col("_lead")).withColumn("flap", F.col("is_new") == 1)
    # as many rows of a hash as partitions at most
    lead = x.where("_lead").withColumn("flap", F.col(AT) > F.min(AT).over(Window.partitionBy(site, sha)))
    return rest.unionByName(lead).drop("_row", "_lead", PART, AT)


def report(v: DataFrame, site: str = "site_id", ord_: str = "ord", sha: str = "sha") -> DataFrame:
    """One row per site: captures, versions, changes, flaps, last_sha12."""
    return v.groupBy(site).agg(
        F.count("*").alias("captures"),
        F.sum("is_new").alias("versions"),
        (F.sum("is_new") - 1).alias("changes"),
        F.sum(F.col("flap").cast("int")).alias("flaps"),
        F.substring(F.max_by(sha, ord_), 1, 12).alias("last_sha12"),
    )
