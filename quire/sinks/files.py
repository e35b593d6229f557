"""Folders as Spark sees them: every path is resolved by Spark's own Hadoop
file system, so a bare path means the same to a listing as to a reader."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as other libraries want it."""
    fs, jpath = _resolve(spark, path)
    full = fs.makeQualified(jpath).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def finished_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the folders ``{path}/{prefix}{n}`` whose write was committed."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]
    found = [int(n[len(prefix):]) for n in names if n.startswith(prefix) and n[len(prefix):].lstrip("-").isdigit()]
    return sorted(n for n in found if fs.exists(_resolve(spark, f"{path}/{prefix}{n}/_SUCCESS")[1]))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, jpath = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()) if fs.exists(jpath) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another
    name, then renamed over the old one (atomic where the file system's is)."""
    fs, jpath = _resolve(spark, path)
    full = fs.makeQualified(jpath)
    draft = spark._jvm.org.apache.hadoop.fs.Path(full.getParent(), f"_{uuid.uuid4().hex}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    hadoop.FileContext.getFileContext(full.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, full, options)
