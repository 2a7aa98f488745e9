"""Files that tasks read themselves, for what Spark's readers do not give: digests of any size, footers.

A listing of the binary reader without contents is dealt by file size, so a large file is a task of
its own and small ones share one. No byte of a file passes the driver, and a task holds one block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Schemes that tasks can open, and their names for Arrow.
SCHEMES = {
    "file": "file",
    "hdfs": "hdfs",
    "s3": "s3",
    "s3a": "s3",
    "s3n": "s3",
    "gs": "gs",
    "abfs": "abfs",
    "abfss": "abfss",
}
BLOCK_BYTES = 4 << 20


def in_tasks(path: Column) -> Column:
    """Whether tasks can open a listed path."""
    return F.substring_index(path, ":", 1).isin(list(SCHEMES))


def opened(path: str):
    """A listed path as a file of Arrow, which reads what is asked for."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{quote(rest, safe='/@:')}")
    return system.open_input_file(name)


def sha256_of(path: str) -> tuple[str, int]:
    """Digest and size of a file, read block by block."""
    digest, size = hashlib.sha256(), 0
    with opened(path) as source:
        while block := source.read(BLOCK_BYTES):
            digest.update(block)
            size += len(block)
    return digest.hexdigest(), size


def _digests(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        found = [(path, *sha256_of(path)) for path in part["path"]]
        yield pd.DataFrame(found, columns=["path", "checksum", "file_size"])


def digests(listing: DataFrame) -> DataFrame:
    """path, checksum and file_size of listed files of any size."""
    return listing.select("path").mapInPandas(_digests, "path string, checksum string, file_size bigint")


def footer_of(path: str) -> str:
    """What decides how Spark types a Parquet file: its columns, and the schema that a Spark writer left."""
    import pyarrow.parquet as pq

    with opened(path) as source:
        footer = pq.read_metadata(source)
    columns = [
        (c.path, c.physical_type, str(c.logical_type), c.converted_type, c.max_definition_level, c.max_repetition_level)
        for c in (footer.schema.column(i) for i in range(footer.num_columns))
    ]
    noted = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return json.dumps([columns, noted.decode()])


def _footers(parts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        found = [(path, footer_of(path)) for path in part["path"]]
        yield pd.DataFrame(found, columns=["path", "footer"])


def footers(listing: DataFrame) -> DataFrame:
    """path and footer of listed Parquet files; files with the same footer text have one schema."""
    return listing.select("path").mapInPandas(_footers, "path string, footer string")
