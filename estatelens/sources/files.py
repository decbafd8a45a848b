"""SHA-256 of every file of a folder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.session import shared_folder
from estatelens.sources.literals import literal_table

# The manifest and its signature never list themselves.
NOT_LISTED = ("checksums.sha256", "mab.sig")

#: How the file library names the stores that Spark's URLs name.
STORES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfs"}

_BLOCK_BYTES = 8 * 1024 * 1024
_ROWS = 10_000


def _folder_lister():
    """A function for ``mapInPandas``; being local, it travels to executors with its code."""

    def list_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for store_root, name in zip(batch["store"], batch["name"]):
                store, _ = fs.FileSystem.from_uri(store_root)
                entries = store.get_file_info(fs.FileSelector(name))
                for at in range(0, len(entries), _ROWS):
                    part = entries[at : at + _ROWS]
                    yield pd.DataFrame(
                        {
                            "store": store_root,
                            "name": [e.path for e in part],
                            "is_folder": [e.type == fs.FileType.Directory for e in part],
                        }
                    )

    return list_all


def _streaming_digest(block_bytes: int):
    def digest_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            digests = []
            for store_root, name in zip(batch["store"], batch["name"]):
                store, _ = fs.FileSystem.from_uri(store_root)
                digest = hashlib.sha256()
                with store.open_input_stream(name, compression=None) as stream:
                    while block := stream.read(block_bytes):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield pd.DataFrame({"sha256": digests, "name": batch["name"]})

    return digest_all


def checksum_manifest(
    spark: SparkSession, folder: str, not_listed: Sequence[str] = NOT_LISTED, tasks: int | None = None
) -> DataFrame:
    """``sha256`` and ``path`` (relative, as ``./a/b``) of every file, hidden ones too, sorted by path.

    ``folder`` is an absolute path or a URL of a known store; another is refused before any work. Folders
    are listed in tasks, level by level, each level written to the shared folder; only the number of
    folders reaches the driver. Every file is streamed in blocks, so none has to fit in memory. A
    digest runs over one file in order, and a folder is listed as one: these are the units of
    parallelism. ``tasks`` is the number of tasks that hash.
    """
    parts = urlsplit(folder)
    if parts.scheme not in STORES:
        raise ValueError(f"no reader for {parts.scheme!r}: {folder!r}")
    path = (parts.path if parts.scheme else folder).rstrip("/")
    if not path.startswith("/"):
        raise ValueError(f"not an absolute path: {folder!r}")
    shared_folder(spark)
    store = f"{STORES[parts.scheme]}://{parts.netloc}/"
    # Object stores name files from the bucket on, others from the root.
    root = unquote(path) if parts.scheme in ("", "file", "hdfs") else f"{parts.netloc}{path}"
    root = path if parts.scheme == "" else root
    folders = literal_table(spark, ["store", "name"], [(store, root)])
    levels = []
    while True:
        spread = folders.repartition("name") if levels else folders
        level = spread.mapInPandas(_folder_lister(), "store string, name string, is_folder boolean").checkpoint()
        levels.append(level.where("not is_folder").select("store", "name"))
        folders = level.where("is_folder").select("store", "name")
        if folders.isEmpty():
            break
    files = reduce(DataFrame.unionByName, levels)
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = files.repartition(n, "name").mapInPandas(_streaming_digest(_BLOCK_BYTES), "sha256 string, name string")
    relative = F.concat(F.lit("."), F.substr(F.col("name"), F.lit(len(root) + 1)))
    listed = hashed.select("sha256", relative.alias("path"))
    unwanted = F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(name) for name in not_listed]))
    return listed.where(~unwanted).orderBy("path")
