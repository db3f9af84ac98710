"""What the operators share: reading tables, row identity, and cutting lineage on shared storage."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.tables import ship

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where it is unset a local master gets a temporary folder (tests); any other is refused, as its executors would not
    see each other's files."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loamwork-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df as a written table in the shared folder: lineage ends here, and a lost executor costs no earlier work.

    The files go when the driver's JVM ends, or by release()."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/loamwork-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    files, at = _at(spark, path)
    files.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._loamwork_path = path
    return out


def release(*written: DataFrame) -> None:
    """Deletes the files of materialized tables that nothing will read again."""
    for df in written:
        files, at = _at(df.sparkSession, df._loamwork_path)
        files.delete(at, True)


def unused(names, *wanted: str) -> list[str]:
    """wanted, each with underscores added until no name (in any case) is equal to it."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


def arrow_field(df: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column, whatever it is."""
    return to_arrow_type(df.schema[name].dataType)


def rows_at_most(df: DataFrame, bound: int) -> bool:
    """Whether df has at most so many rows; reads no more than it must."""
    return df.limit(bound + 1).count() <= bound


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body refers to it."""
    return F.transform(F.array(value), body)[0]


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the column as text, modulo n."""
    return F.crc32(column.cast("string").cast("binary")) % n
