"""What several operators share: reading tables, written intermediate tables, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
LAST_ID = 2**63 - 1  # rows without a doc_id come after all others


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a fresh one where that is unset, which only a local session may do."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tripmill-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a table made by `written` that nothing needs any longer."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def free_names(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front until no column has them."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Words between white space, as an array; none for null and for blank texts."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def order_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))
