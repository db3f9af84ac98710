"""Files as sources and sinks: rules in JSON, globs, headed CSV, nested logs, JSON documents and reports."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


#: Rules of one document, at most: they become constants of a plan.
MAX_RULES = 10_000
#: Names of files that are broadcast, at most.
MAX_FILES = 100_000


def shared(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local master may do without one (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loamwork-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver's JVM ends."""
    path = f"{shared(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def json_rules(spark: SparkSession, path: str) -> DataFrame:
    """id, pattern, severity and what else each rule of a JSON document {"rules": [...]} has, with rule_order."""
    rule = StructType([StructField(n, StringType()) for n in ("id", "pattern", "severity")])
    doc = spark.read.schema(StructType([StructField("rules", ArrayType(rule))])).option("multiLine", True).json(path)
    return doc.select(F.posexplode("rules").alias("rule_order", "r")).select("rule_order", "r.*")


def json_terms(spark: SparkSession, path: str, field: str = "terms") -> DataFrame:
    """found, should_be of a map in a JSON document; names that begin with an underscore are remarks."""
    doc = spark.read.schema(f"{field} map<string, string>").option("multiLine", True).json(path)
    return doc.select(F.explode(field).alias("found", "should_be")).where("not startswith(found, '_')")


def text_files(spark: SparkSession, root: str, globs: list[str]) -> DataFrame:
    """relpath, text of files under root that any of the globs fits, each once, whole.

    Paths are relative to root, so that a copy of the tree gives the same rows."""
    out = None
    for g in globs:
        x = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", g).option("wholetext", True).text(root)
        x = x.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
        out = x if out is None else out.unionByName(x)
    base = root.split("://")[-1].split(":")[-1].rstrip("/")
    rel = F.regexp_extract("path", r"^(?:[a-z]+:)?/*(?:.*?)" + base.lstrip("/") + "/(.*)$", 1)
    rel = F.url_decode(F.replace(rel, F.lit("+"), F.lit("%2B")))
    return out.select(rel.alias("relpath"), "text").dropDuplicates(["relpath"])


def text_copy(spark: SparkSession, path: str, to: str) -> DataFrame:
    """Copies text files, line for line, without the byte-order mark that a file may begin with, and returns relpath, line of
    the copy. A file's lines are kept apart by its name, a folder each; a mark within a file is text.

    Lines are copied by the tasks that read them; what is joined to them is a row a file, the number of its first line."""
    x = spark.read.text(path).select(F.url_decode("_metadata.file_name").alias("relpath"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("n"))
    first = x.where("start = 0").groupBy("relpath").agg(F.min("n").alias("first"))
    first = F.broadcast(first) if first.count() <= MAX_FILES else first
    line = F.when((F.col("n") == F.col("first")) & F.startswith("value", F.lit("\ufeff")), F.substr("value", F.lit(2))).otherwise(F.col("value"))
    x.join(first, "relpath", "left").withColumn("value", line).sortWithinPartitions("relpath", "start", "n").select("relpath", "value").write.mode("overwrite").partitionBy("relpath").text(to)
    return spark.read.schema("value string, relpath string").text(to).select("relpath", F.col("value").alias("line"))


def csv_columns(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    """Some columns of a headed CSV of a known schema: nothing is inferred, and only these columns are parsed."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path).select(*columns)


def flattened(df: DataFrame, column: str, schema: StructType, sep: str = ".") -> DataFrame:
    """df with the leaves of a JSON column as columns of dotted names, however deep structs nest; arrays stay arrays."""

    def leaves(at: Column, kind: StructType, name: str):
        for f in kind.fields:
            here, path = at[f.name], f"{name}{sep}{f.name}" if name else f.name
            if isinstance(f.dataType, StructType):
                yield from leaves(here, f.dataType, path)
            else:
                yield here.alias(path)

    parsed = df.withColumn(column, F.from_json(column, schema))
    return parsed.select(*(c for c in df.columns if c != column), *leaves(F.col(column), schema, ""))


def json_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A JSON document a row; null fields are written, not left out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def findings_report(found: DataFrame, path: str) -> DataFrame:
    """Writes findings as lines of JSON, one a finding, in a folder for each check, and returns them as check, line.

    A check with very many findings has as many lines, in as many files as there were tasks: nothing is gathered."""
    found.write.mode("overwrite").partitionBy("check").json(path)
    return found.sparkSession.read.schema("value string, check string").text(path).select("check", F.col("value").alias("line"))


def markdown_table(rows: DataFrame, key: str, order: str, cells: str = "cells") -> DataFrame:
    """key, table: rows of cells as a Markdown table whose first row is its head; bars escaped, short rows padded."""
    line = lambda r, n: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.replace(F.coalesce(F.get(r, i), F.lit("")), F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    x = rows.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(cells).alias("c")))), lambda r: r["c"]).alias("r"), F.max(F.size(cells)).alias("n"))
    lines = F.transform("r", lambda r: line(r, F.col("n")))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.col("n")))
    return x.select(key, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.size(lines))), "\n").alias("table"))
