"""Tables that are replaced as a whole, as versions beside each other.

A version is a folder `version=<n>`; it counts when its last file (`_SUCCESS` of the table, or of the part
written last) is there. Readers take the newest one, so a write that is cut off is never seen, and a reader
that runs on keeps the files it has opened until `keep` newer versions exist.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from paywatch.session import delete_path


def complete_versions(spark: SparkSession, path: str, last_part: str = "") -> list[str]:
    """Folders of the versions that were written to the end, oldest first; `last_part` is the part written last."""
    mark = f"{last_part}/_SUCCESS".lstrip("/")
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/{mark}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(s.getPath().toString()[: -len(mark) - 1] for s in found or [])


def newest_version(spark: SparkSession, path: str, last_part: str = "") -> str | None:
    return next(reversed(complete_versions(spark, path, last_part)), None)


def next_version(found: list[str], path: str) -> str:
    """The folder to write next, after the complete ones."""
    number = int(found[-1].rsplit("=", 1)[1]) + 1 if found else 0
    return f"{path}/version={number:012d}"


def delete_old(spark: SparkSession, found: list[str], keep: int) -> list[str]:
    """Delete all but the `keep` newest, one more having been written since `found`; returns what is gone."""
    old = found[: max(0, len(found) + 1 - keep)]
    for folder in old:
        delete_path(spark, folder)
    return old
