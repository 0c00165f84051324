"""Source and sink queries: SRC and SNK, over lines and files that Spark derives from the tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trawl.plans.tables import read
from trawl.sources import jsonl as J
from trawl.sources import sinks as K
from trawl.streaming.shared import scratch

RECORD = "mms string, prefix string, title string"


def _lines(spark, d):
    """documents as JSON lines of files by source, each of at most LINES lines; some broken, some glued, by id and text."""
    file = F.concat_ws("-", "source", F.expr(f"doc_id div {LINES}"))
    # the text up to its twentieth letter or blank, without what else is there: the same as from the whole text without it, which would be made anew wherever value is used
    title = F.regexp_replace(F.regexp_extract("text", r"^(?:[^A-Za-z ]*+[A-Za-z ]){0,20}", 0), r"[^A-Za-z ]", "")
    x = read(spark, d, "documents").select("doc_id", file.alias("file"), F.length("text").alias("n"), title.alias("title"))
    rec = F.to_json(F.struct(F.concat(F.lit("m"), "doc_id").alias("mms"), F.concat(F.lit("P"), F.col("doc_id") % 7).alias("prefix"), "title"))
    n = (F.col("doc_id") * 7 + F.col("n")) % 20
    value = F.when(n == 3, "NOT-JSON").when(n == 5, F.concat(F.lit('{"mms":"x","prefix":"Q9","ti'), rec)).when(n == 8, F.expr("substring(rec, 1, length(rec) - 4)")).when(n == 11, '{"mms":"","prefix":null}').when(n == 13, "").otherwise(F.col("rec"))
    return x.withColumn("rec", rec).withColumn("value", value).select("doc_id", "file", "value")


#: Lines of a file: about a gigabyte, some times what a task reads.
LINES = 10_000_000


def _files(spark, d):
    """The lines written as text files, in order of doc_id, without a line end behind the last one; a file's lines are one task's to write.

    The first line is told by a window, not by a join: a join on the file would stand in for the repartition, and is read anew in other pieces once it has become a broadcast join."""
    of = Window.partitionBy("file").orderBy("doc_id")
    # the writer's separator is a blank here, and line ends stand before all lines but the first
    x = _lines(spark, d).repartition("file").withColumn("value", F.concat(F.when(F.row_number().over(of) == 1, "").otherwise("\n"), "value"))
    path = scratch(spark, "lines")
    x.sortWithinPartitions("file", "doc_id").drop("doc_id").write.partitionBy("file").option("lineSep", " ").text(path)
    lines = J.read_lines(spark, path)
    return lines.withColumn("file", F.regexp_extract("file", "file=([^/]*)/", 1))


def src_01_ingest(spark, d):
    return J.repair_report(J.parsed(_files(spark, d), RECORD))


def src_02_valid(spark, d):
    return _lines(spark, d).select("doc_id", J.valid_record(F.col("value")).alias("valid"))


def src_03_salvage(spark, d):
    bad = _lines(spark, d).where(~J.valid_record(F.col("value")))
    return bad.select("doc_id", J.salvage("value").alias("s")).select("doc_id", F.get_json_object("s.salvaged", "$.mms").alias("mms"), "s.offset")


def src_04_attribution(spark, d):
    return J.attributed(_files(spark, d)).groupBy("file", "prefix", "inferred").agg(F.count("*").alias("damaged"), F.count("salvaged").alias("salvaged"))


FILES = ("audit.jsonl", "audit.jsonl.2", "records.jsonl", "memguard.jsonl", "keeper-a.jsonl", "scrape.log", "x.txt")


def src_05_roles(spark, d):
    p = read(spark, d, "pages").select("page_id", F.concat(F.lit("/runs/"), F.col("page_id") % 9, F.lit("/"), F.element_at(F.array(*map(F.lit, FILES)), (F.col("page_id") % len(FILES) + 1).cast("int"))).alias("path"))
    role, ok = J.file_role(F.col("path"))
    return p.select("page_id", role.alias("role"), ok.alias("authoritative"))


def src_06_tree(spark, d):
    """Whole texts written as a tree of files of at most a hundred documents, and read as such: one row per file.

    A folder has one source's of ten thousand documents, and all its files but the last are full, so that there are little more of them than a hundredth of the documents."""
    path = scratch(spark, "tree")
    x = read(spark, d, "documents").select(F.concat(F.col("doc_id"), F.lit(" "), F.md5("text"), F.lit(" "), F.regexp_replace("text", r"\s+", " ")).alias("value"), "source", F.expr("doc_id div 10000").alias("part"))
    x.repartition("source", "part").sortWithinPartitions("source", "part").write.option("maxRecordsPerFile", 100).partitionBy("source", "part").text(path)
    line = J.read_tree(spark, path).select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return line.select(F.substring_index("line", " ", 1).cast("long").alias("doc_id"), F.md5("line").alias("md5"))


DOC = "pnx struct<display: map<string, array<string>>>, delivery struct<holding: array<struct<libraryCode: string, callNumber: string, availabilityStatus: string>>>"


def _catalog(spark, d):
    li = read(spark, d, "lineitem")
    hold = li.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_returnflag"))), lambda h: F.struct(F.concat(F.lit("L"), h.l_suppkey).alias("libraryCode"), F.when(h.l_linenumber % 2 == 0, h.l_suppkey.cast("string")).alias("callNumber"), h.l_returnflag.alias("availabilityStatus"))).alias("holding"))
    k = F.col("l_orderkey").cast("string")
    return hold.select("l_orderkey", F.struct(F.struct(F.create_map(F.lit("mms"), F.array(k), F.lit("title"), F.when(F.col("l_orderkey") % 3 > 0, F.array(F.concat(F.lit("T"), k), F.lit("second")))).alias("display")).alias("pnx"), F.struct(F.when(F.col("l_orderkey") % 5 > 0, F.col("holding")).alias("holding")).alias("delivery")).alias("doc"))


def src_07_flatten(spark, d):
    x = _catalog(spark, d).select("l_orderkey", J.flat_record(F.col("doc"), F.lit("P")).alias("r"))
    return x.select("l_orderkey", "r.mms", "r.title", "r.creator", F.size("r.holdings").alias("n_holdings"), F.array_join(F.transform("r.holdings", lambda h: F.concat_ws("/", h["lib"], h["call"], h["status"])), ";").alias("holdings"))


def src_08_unnest(spark, d):
    x = read(spark, d, "conversations").groupBy(F.col("conv_id").alias("query")).agg(F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("title")))).alias("results"))
    return x.select("query", F.inline("results"))


def src_09_decode(spark, d):
    p = read(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1")).alias("data"), F.when(F.col("doc_id") % 2 == 1, "latin-1").alias("charset"))
    return p.select("doc_id", F.md5(J.decode(F.col("data"), F.col("charset"))).alias("md5"))


def src_10_progress_slot(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.explode(F.array(F.lit("primary"), F.lit("backup"))).alias("slot"))
    k = F.col("run_id") % 6
    value = F.when((F.col("slot") == "primary") & k.isin(1, 2), '{"todo": [').when((F.col("slot") == "backup") & k.isin(2, 3), "").otherwise('{"todo": ["a"]}')
    return J.newest_progress(o.withColumn("value", value), "todo array<string>").select("run_id", "slot")


def snk_01_append(spark, d):
    """Appended twice with an overlap: every key once."""
    path = scratch(spark, "append")
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    K.append_new(o.where("o_orderkey % 3 < 2"), path, ["o_orderkey"])
    K.append_new(o.where("o_orderkey % 3 > 0"), path, ["o_orderkey"])
    K.compact(spark, path, o.schema, 1)
    return spark.read.parquet(path).drop(K.BUCKET)


def snk_02_replace(spark, d):
    path = scratch(spark, "replace")
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    K.replace(o, path, "o_orderstatus")
    K.replace(o.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0"), path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def snk_03_csv(spark, d):
    path = scratch(spark, "csv")
    x = read(spark, d, "documents").select("doc_id", F.array(*[F.concat(F.lit("s"), F.col("doc_id") % m) for m in (2, 3, 5, 7, 11, 13)]).alias("sources"), F.regexp_replace("text", r"\s", " ").alias("evidence"))
    K.report_csv(x, path)
    return spark.read.option("header", "true").option("escape", '"').schema("doc_id long, sources string, evidence string").csv(path).select("doc_id", "sources", F.length("evidence").alias("evidence_len"))


def snk_04_snapshots(spark, d):
    path = scratch(spark, "snapshots")
    K.snapshots(read(spark, d, "documents").select(F.col("source").alias("site_id"), F.col("doc_id").alias("ver"), F.sha2("text", 256).alias("sha"), "text"), path)
    return spark.read.parquet(path).groupBy("site_id").agg(F.count("*").alias("versions"), F.max("sha").alias("max_sha"))


QUERIES = {k: v for k, v in list(globals().items()) if k[:4] in ("src_", "snk_")}
_L = f"""rc AS (SELECT doc_id, source || '-' || (doc_id // {LINES}) AS file, (doc_id * 7 + length(text)) % 20 AS n, '{{"mms":"m' || doc_id || '","prefix":"P' || (doc_id % 7) || '","title":"' || substr(regexp_replace(text, '[^A-Za-z ]', '', 'g'), 1, 20) || '"}}' AS rec FROM documents),
  ln AS (SELECT doc_id, file, CASE n WHEN 3 THEN 'NOT-JSON' WHEN 5 THEN '{{"mms":"x","prefix":"Q9","ti' || rec WHEN 8 THEN substr(rec, 1, length(rec) - 4) WHEN 11 THEN '{{"mms":"","prefix":null}}' WHEN 13 THEN '' ELSE rec END AS value FROM rc),
  ok AS (SELECT *, lead(doc_id) OVER (PARTITION BY file ORDER BY doc_id) IS NULL AS last, CASE WHEN json_valid(value) THEN json_type(value, '$.mms') = 'VARCHAR' AND length(value ->> '$.mms') > 0 AND list_contains(json_keys(value), 'prefix') ELSE false END AS valid FROM ln),
  sv AS (SELECT *, CASE WHEN NOT valid THEN list_filter(range(2, length(value) + 1), lambda i: substr(value, i, 1) = '{{' AND json_valid(substr(value, i)))[1] END AS pos FROM ok)"""
SQL = {
    "src_01_ingest": f"WITH {_L} SELECT file, count(*) AS lines, count(*) FILTER (NOT json_valid(value) AND NOT last) AS bad_lines, coalesce(sum(strlen(value) + 1) FILTER (NOT json_valid(value) AND last), 0) AS truncated_bytes, count(*) FILTER (NOT json_valid(value)) > 0 AS repaired FROM ok GROUP BY 1",
    "src_02_valid": f"WITH {_L} SELECT doc_id, valid FROM ok",
    "src_03_salvage": f"WITH {_L} SELECT doc_id, CASE WHEN pos IS NOT NULL THEN substr(value, pos) ->> '$.mms' END AS mms, (pos - 1)::INT AS offset FROM sv WHERE NOT valid",
    "src_04_attribution": f"""WITH {_L}, b AS (SELECT *, last_value(CASE WHEN valid THEN value ->> '$.prefix' END IGNORE NULLS) OVER (PARTITION BY file ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, nullif(regexp_extract(substr(value, 1, coalesce(pos - 1, length(value))), '"prefix"\\s*:\\s*"([^"]*)"', 1), '') AS named FROM sv)
      SELECT file, coalesce(named, before) AS prefix, named IS NULL AND before IS NOT NULL AS inferred, count(*) AS damaged, count(pos) AS salvaged FROM b WHERE NOT valid GROUP BY 1, 2, 3""",
    "src_05_roles": "SELECT page_id, (['audit', 'audit', 'data', 'aux', 'keeper', 'log', 'other'])[page_id % 7 + 1] AS role, page_id % 7 IN (0, 1, 4) AS authoritative FROM pages",
    "src_06_tree": r"SELECT doc_id, md5(doc_id || ' ' || md5(text) || ' ' || regexp_replace(text, '\s+', ' ', 'g')) AS md5 FROM documents",
    "src_07_flatten": "WITH h AS (SELECT l_orderkey, count(*) AS n, string_agg('L' || l_suppkey || '/' || CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey::VARCHAR ELSE '' END || '/' || l_returnflag, ';' ORDER BY l_linenumber, l_suppkey, l_returnflag) AS holdings FROM lineitem GROUP BY 1) SELECT l_orderkey, l_orderkey::VARCHAR AS mms, CASE WHEN l_orderkey % 3 > 0 THEN 'T' || l_orderkey ELSE '' END AS title, '' AS creator, CASE WHEN l_orderkey % 5 > 0 THEN n ELSE 0 END AS n_holdings, CASE WHEN l_orderkey % 5 > 0 THEN holdings ELSE '' END AS holdings FROM h",
    "src_08_unnest": "SELECT conv_id AS query, turn, role AS title FROM conversations",
    "src_09_decode": "SELECT doc_id, md5(text) AS md5 FROM documents",
    "src_10_progress_slot": "SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 6 NOT IN (1, 2) THEN 'primary' WHEN o_orderkey % 6 NOT IN (2, 3) THEN 'backup' END AS slot FROM orders",
    "snk_01_append": "SELECT o_orderkey, o_orderstatus FROM orders",
    "snk_02_replace": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0 GROUP BY 1",
    "snk_03_csv": "SELECT doc_id, 's' || doc_id % 2 || ';s' || doc_id % 3 || ';s' || doc_id % 5 || ';s' || doc_id % 7 || ';s' || doc_id % 11 AS sources, least(300, length(text)) AS evidence_len FROM documents",
    "snk_04_snapshots": "SELECT source AS site_id, count(*) AS versions, max(sha256(text)) AS max_sha FROM documents GROUP BY 1",
}
