"""Changes of a stored Parquet folder that rewrite only the files they touch.

A change reads which files hold an affected row (``_metadata.file_path``), writes what these files become to a hidden folder
beside them, and then leaves a record: the files to drop and the folder to take in. The record appears by one rename, and that decides
the change. A job that dies earlier has changed nothing; one that dies later leaves the rest of the work (moves and deletes, which may be repeated) to
``settle``, which every reader and writer here runs first. So they see the old state or the new one. Files without an
affected row keep their place, name and time.

One writer at a time: this is no transaction log, and readers that bypass ``read_current`` may meet a change half done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD, STAGED, DONE = "_change-", "_staged-", "_done-"


class Folder:
    """A folder in any store that Spark reaches, by the Hadoop file API."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.fs.makeQualified(self.root)

    def at(self, *names: str):
        """A path below the root; names are joined as they are, so encoded partition values stay encoded."""
        path = self.root
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(path, self.spark._jvm.org.apache.hadoop.fs.Path(None, None, name))
        return path

    def names(self, prefix: str) -> list[str]:
        if not self.fs.exists(self.root):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.root) if s.getPath().getName().startswith(prefix))

    def files(self, below: str) -> list[str]:
        """Data files below a folder, as paths relative to it."""
        start = self.at(below)
        if not self.fs.exists(start):
            return []
        found, each = [], self.fs.listFiles(start, True)
        while each.hasNext():
            path = each.next().getPath()
            if not path.getName().startswith(("_", ".")):
                found.append(path.toString()[len(start.toString()) + 1 :])
        return found

    def relative(self, uri: str) -> str:
        """The place below the root of a file that Spark names by an encoded address."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(uri))
        return self.fs.makeQualified(path).toString()[len(self.root.toString()) + 1 :]

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        part = self.at(f"_part-{uuid.uuid4().hex}")
        out = self.fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(part, self.at(name)):
            raise OSError(f"could not place {name}")

    def read(self, name: str) -> str:
        source = self.fs.open(self.at(name))
        size = self.fs.getFileStatus(self.at(name)).getLen()
        made = self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, size)
        source.close()
        return bytes(made).decode()


def settle(spark: SparkSession, path: str) -> int:
    """Finishes changes that are decided and drops what undecided ones left; returns how many were finished."""
    folder = Folder(spark, path)
    records = folder.names(RECORD)
    for name in records:
        record = json.loads(folder.read(name))
        staged = record["staged"]
        for file in folder.files(staged):
            target = folder.at(file)
            folder.fs.mkdirs(target.getParent())
            folder.fs.rename(folder.at(staged, file), target)
        for file in record["replaced"]:
            folder.fs.delete(folder.at(file), False)
        if record["id"]:
            folder.write(DONE + record["id"], "")
        folder.fs.delete(folder.at(staged), True)
        folder.fs.delete(folder.at(name), False)
    for name in folder.names(STAGED):
        folder.fs.delete(folder.at(name), True)
    return len(records)


def read_current(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The folder's rows after all changes that are decided."""
    settle(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def change_files(
    spark: SparkSession,
    path: str,
    affected: Column,
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    change_id: str | None = None,
) -> dict[str, int]:
    """Applies ``change`` to the files with a row for which ``affected`` holds; returns the files replaced and kept.

    ``change`` gets all rows of these files and must leave rows as they are that are not affected (as ``delete_where`` and
    ``update_where`` do with the same condition). With a ``change_id``, a call that is repeated after it was decided does nothing.
    """
    folder = Folder(spark, path)
    df = read_current(spark, path)
    if change_id and folder.names(DONE + change_id):
        return {"replaced": 0, "kept": len(folder.files("."))}
    hit = df.where(affected).select(F.col("_metadata.file_path").alias("file")).distinct()
    uris = [row["file"] for row in hit.collect()]  # names of files, which the driver lists anyway
    replaced = sorted(folder.relative(uri) for uri in uris)
    kept = sum(1 for _ in df.inputFiles()) - len(replaced)
    name = uuid.uuid4().hex
    if replaced:
        paths = [folder.at(file).toString() for file in replaced]
        rows = spark.read.schema(df.schema).option("basePath", folder.root.toString()).parquet(*paths)
        writer = change(rows).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder.at(STAGED + name).toString())
    folder.write(RECORD + name, json.dumps({"staged": STAGED + name, "replaced": replaced, "id": change_id}))
    settle(spark, path)
    return {"replaced": len(replaced), "kept": kept}
