"""Tolerant JSON-lines ingest: good lines, quarantine, salvage, damage attribution, progress slots, decoding, file roles."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.functions import pandas_udf as udf

from trawl.operators.order import AT, PART, dealt, scan


SALVAGED = T_.StructType([T_.StructField("salvaged", T_.StringType()), T_.StructField("offset", T_.IntegerType())])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all text files under a path: file, line_no (from 1), value, last (no line end follows), and _part and _at, by which trawl.operators.order goes on.

    Files are read in byte ranges as Spark splits them, so one of any size is many tasks' work. A line belongs to the range
    in which it begins. Ranges are counted in a first pass; a file's counts, one small row a range, are summed up, and each
    line takes its range's total: lines aren't shuffled. Only the line end (0x0A) parts lines, so that the bytes of lines and line ends
    tell whether the last one is missing; empty lines are lines. A compressed file is one range, and its last line counts as whole."""
    x = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    x = x.select(F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_block_start").alias(PART), F.monotonically_increasing_id().alias(AT))
    ranges = x.groupBy("file", PART).agg(F.min(AT).alias("_start"), F.count("*").alias("_n"), F.sum(F.octet_length("value") + 1).alias("_bytes"))
    of = Window.partitionBy("file")
    before = F.coalesce(F.sum("_n").over(of.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one byte more than the file has: the line end of the last line isn't there
    ranges = ranges.select("file", PART, (before - F.col("_start") + 1).alias("_shift"), F.sum("_n").over(of).alias("_lines"), F.sum("_bytes").over(of).alias("_bytes"))
    x = x.join(ranges, ["file", PART]).withColumn("line_no", F.col(AT) + F.col("_shift"))
    return x.select("file", "line_no", "value", ((F.col("line_no") == F.col("_lines")) & (F.col("_bytes") == F.col("_size") + 1)).alias("last"), PART, AT)


def read_tree(spark: SparkSession, path: str, glob: str = "*.{md,txt,html}") -> DataFrame:
    """One row per text file of a tree; empty files give none."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """lines with rec (a struct) and bad: the line isn't a JSON object of the schema."""
    rec = F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.withColumn("rec", rec).withColumn("bad", F.col("rec").isNull() | F.col("rec._corrupt").isNotNull())


def repair_report(p: DataFrame) -> DataFrame:
    """Per file: lines, bad_lines in the middle, truncated_bytes of a torn last line, repaired."""
    torn = F.col("bad") & F.col("last")
    out = p.groupBy("file").agg(F.count("*").alias("lines"), F.sum((F.col("bad") & ~F.col("last")).cast("long")).alias("bad_lines"), F.coalesce(F.sum(F.when(torn, F.octet_length("value"))), F.lit(0)).cast("long").alias("truncated_bytes"))
    return out.select("*", ((F.col("bad_lines") > 0) | (F.col("truncated_bytes") > 0)).alias("repaired"))


def valid_record(value: Column) -> Column:
    """An object whose mms is a non-empty string and that has the key prefix, whatever its value."""
    keys = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    v = F.try_parse_json(value)
    return F.coalesce(F.array_contains(keys, "prefix") & (F.schema_of_variant(F.try_variant_get(v, "$.mms", "variant")) == "STRING") & (F.length(F.get_json_object(value, "$.mms")) > 0), F.lit(False))


@udf(SALVAGED)
def salvage(raw: pd.Series) -> pd.DataFrame:
    """The complete record glued behind a fragment: '{"mms"' is tried first, then '{', 64 starts each."""

    def one(s):
        for mark in ('{"mms"', "{"):
            at, tries = (s or "").find(mark, 1), 0
            while at >= 0 and tries < 64:
                try:
                    if isinstance(json.loads(s[at:]), dict):
                        return s[at:], at
                except ValueError:
                    pass
                at, tries = s.find(mark, at + 1), tries + 1
        return None, None

    return pd.DataFrame([one(s) for s in raw], columns=["salvaged", "offset"]).astype({"offset": "Int32"})


def repaired(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that stay, and those for quarantine: bad ones but for a torn last line, which is dropped. Both keep file and line_no."""
    keep = ["file", "line_no", "value"]
    return p.where(~F.col("bad")).select(*keep), p.where(F.col("bad") & ~F.col("last")).select(*keep)


def attributed(lines: DataFrame) -> DataFrame:
    """Damaged lines with salvaged text and the prefix they are laid to: the last one named before the salvage point, else that of the last good line of the file.

    The last good line may be any number of ranges before: each range hands its last good prefix on, so no file is one task's. Lines that don't come
    from read_lines are dealt by range of (file, line_no) first."""
    x = lines if AT in lines.columns else dealt(lines, ["file"], [F.col("line_no")])
    x = x.withColumn("good", valid_record(F.col("value")))
    x = scan(x, ["file"], lasts={"before": F.when(F.col("good"), F.get_json_object("value", "$.prefix"))})
    bad = x.where(~F.col("good")).withColumn("s", salvage("value"))
    head = F.when(F.col("s.offset").isNotNull(), F.expr("substring(value, 1, s.offset)")).otherwise(F.col("value"))
    named = F.nullif(F.regexp_extract(head, r'"prefix"\s*:\s*"([^"]*)"', 1), F.lit(""))
    return bad.select("file", "line_no", F.col("s.salvaged").alias("salvaged"), F.coalesce(named, F.col("before")).alias("prefix"), (named.isNull() & F.col("before").isNotNull()).alias("inferred"))


def file_role(path: Column) -> tuple[Column, Column]:
    """(role, authoritative) by file name."""
    name = F.lower(F.regexp_extract(path, r"([^/]*)$", 1))
    role = F.when(name.rlike(r"^audit\.jsonl(\.\d+)?$"), "audit").when(name.rlike(r"^(records|leads|items)\.jsonl"), "data").when(name.rlike("memguard"), "aux").when(name.rlike(r"keeper.*\.jsonl"), "keeper").when(name.endswith(".log"), "log").otherwise("other")
    return role, role.isin("audit", "keeper")


def flat_record(doc: Column, prefix: Column) -> Column:
    """A nested catalogue document as one record: the first of each display list or '', holdings with defaults."""
    first = lambda k: F.coalesce(F.get(doc["pnx"]["display"][k], 0), F.lit(""))
    text = lambda x, k: F.coalesce(x[k], F.lit(""))
    holdings = F.transform(F.coalesce(doc["delivery"]["holding"], F.array()), lambda h: F.struct(text(h, "libraryCode").alias("lib"), text(h, "callNumber").alias("call"), text(h, "availabilityStatus").alias("status")))
    return F.struct(first("mms").alias("mms"), first("title").alias("title"), first("creator").alias("creator"), first("creationdate").alias("year"), prefix.alias("prefix"), holdings.alias("holdings"))


@udf(T_.StringType())
def decoded(data: pd.Series, charset: pd.Series) -> pd.Series:
    """Declared charset, then utf-8, then gbk, else utf-8 without what can't be read."""

    def one(b, c):
        if b is None:
            return None
        for name in (c, "utf-8", "gbk"):
            try:
                if name:
                    return b.decode(name)
            except (UnicodeDecodeError, LookupError):
                pass
        return b.decode("utf-8", "ignore")

    return pd.Series([one(b, c) for b, c in zip(data, charset, strict=True)])


def decode(data: Column, charset: Column) -> Column:
    """Text of bytes; only what isn't plain utf-8 goes to the helper."""
    return F.when(charset.isNull() & F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(decoded(data, charset))


def newest_progress(slots: DataFrame, schema: str) -> DataFrame:
    """slots: run_id, slot (primary or backup), value -> run_id, slot, progress: the primary if it can be read, else the backup, else null."""
    p = parsed(slots, schema)
    ok = p.where(~F.col("bad")).groupBy("run_id").agg(F.min_by(F.struct("slot", "rec"), F.when(F.col("slot") == "primary", 0).otherwise(1)).alias("b"))
    return slots.select("run_id").distinct().join(ok, "run_id", "left").select("run_id", F.col("b.slot").alias("slot"), F.col("b.rec").alias("progress"))
