"""Small files listed, read and written in tasks: item folders and PDF heads.

Spark's own file sources list every file on the driver and read it whole. Here a
task lists a folder's names, the names are dealt to tasks, and those read what is
needed. Paths are local ones or URIs that Arrow knows (file, hdfs, s3, gs, abfss).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as afs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 16 << 20  # of texts that a task hands on at once


def _open(path: str) -> tuple[afs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = path.removeprefix("file:")
    return afs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _names(fs: afs.FileSystem, folder: str, kind: afs.FileType) -> list[str]:
    """Names of a folder that don't start with `_` or a dot; none of a folder that isn't there."""
    found = fs.get_file_info(afs.FileSelector(folder, allow_not_found=True))
    return [f.base_name for f in found if f.type == kind and not f.base_name.startswith(("_", "."))]


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _dealt(spark: SparkSession, root: str, folders: list[str], kind: afs.FileType) -> DataFrame:
    """(folder, name) of what lies in some folders under `root`: a task lists each, and the names are dealt to tasks."""
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(root)
        for batch in batches:
            for folder in batch["folder"]:
                names = _names(fs, f"{base}/{folder}".rstrip("/"), kind)
                for i in range(0, len(names), 10_000):
                    yield pd.DataFrame({"folder": folder, "name": names[i : i + 10_000]})

    given = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(max(1, len(folders)), "folder")
    return given.mapInPandas(listed, "folder string, name string").repartition(_tasks(spark), "folder", "name")


def _text(fs: afs.FileSystem, path: str) -> str | None:
    try:
        with fs.open_input_stream(path) as f:
            return f.read().decode("utf-8", "replace")
    except FileNotFoundError:
        return None


def read_item_folders(spark: SparkSession, root: str) -> DataFrame:
    """(content_type, slug, meta, md) of `{type}/{slug}/{slug}.md` and its meta.json.

    Names that start with `_` are skipped, a folder without its text gives no row,
    and one without meta.json a null. The driver lists the types only.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(root)
        rows, size = [], 0
        for batch in batches:
            for kind, slug in batch.itertuples(index=False):
                md = _text(fs, f"{base}/{kind}/{slug}/{slug}.md")
                if md is None:
                    continue
                rows.append((kind, slug, _text(fs, f"{base}/{kind}/{slug}/meta.json"), md))
                size += len(md)
                if size > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns)

    columns = ["content_type", "slug", "meta", "md"]
    fs, base = _open(root)
    folders = _dealt(spark, root, _names(fs, base, afs.FileType.Directory), afs.FileType.Directory)
    return folders.mapInPandas(read, "content_type string, slug string, meta string, md string")


def write_item_folders(items: DataFrame, root: str) -> int:
    """Write items that have `rendered_md` as folders of two files each; how many.

    meta.json holds the fields that are set but for the texts. A task that is run
    again writes the same files again. A slug or type that is empty, holds a slash
    or starts with `_` or a dot is an error, as it could not be read back.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(root)
        for batch in batches:
            for kind, slug, meta, md in batch.itertuples(index=False):
                for part in (kind, slug):
                    if not part or "/" in part or part.startswith(("_", ".")):
                        raise ValueError(f"no folder can be named {part!r}")
                folder = f"{base}/{kind}/{slug}"
                fs.create_dir(folder, recursive=True)
                for name, text in ((f"{slug}.md", md or ""), ("meta.json", meta)):
                    with fs.open_output_stream(f"{folder}/{name}") as f:
                        f.write(text.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    meta = F.to_json(F.struct(*[c for c in items.columns if c not in ("body", "rendered_md")]))
    rows = items.select("content_type", "slug", meta.alias("meta"), "rendered_md")
    return rows.mapInPandas(write, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_heads(spark: SparkSession, root: str, size: int = 8) -> DataFrame:
    """(path, length, head) of the files of a folder, empty ones too; only their first bytes are read."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(root)
        for batch in batches:
            rows = []
            for name in batch["name"]:
                path = f"{base}/{name}"
                with fs.open_input_file(path) as f:
                    rows.append((path, f.size(), f.read(size)))
            yield pd.DataFrame(rows, columns=["path", "length", "head"])

    return _dealt(spark, root, [""], afs.FileType.File).mapInPandas(read, "path string, length bigint, head binary")
