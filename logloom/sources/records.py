"""Delivered records as a Spark data source with one commit per batch.

Tasks write files of their own; the driver commits a batch by writing a manifest with their names, in
place of an earlier one of the same batch. Readers see what manifests name: a task that fails half way, an
aborted batch and a batch that runs twice leave one copy of each record.

    register(spark)
    df.write.format("committed_records").option("batch", 7).mode("append").save(path)
    stream.writeStream.format("committed_records").option("checkpointLocation", c).start(path)
    spark.read.format("committed_records").load(path)

Rows are (`endpoint`, `record`), the record as JSON text. The classes are made here, so that they travel to the
workers by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = "committed_records"
SCHEMA = "endpoint string, record string"


def register(spark: SparkSession) -> None:
    import json
    import os
    import uuid

    from pyspark.sql.datasource import (
        DataSource,
        DataSourceReader,
        DataSourceStreamWriter,
        DataSourceWriter,
        InputPartition,
        WriterCommitMessage,
    )

    def store(path: str):
        from pyarrow import fs

        if "://" in path:
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))

    class Files:
        """What a batch and a stream writer share."""

        def __init__(self, options: dict):
            self.path = options["path"]
            self.batch = options.get("batch", uuid.uuid4().hex)

        def write(self, rows) -> WriterCommitMessage:
            files, root = store(self.path)
            message = WriterCommitMessage()
            message.file = f"{uuid.uuid4().hex}.jsonl"
            files.create_dir(f"{root}/data", recursive=True)
            with files.open_output_stream(f"{root}/data/{message.file}") as out:
                for row in rows:
                    out.write(json.dumps([row.endpoint, row.record]).encode() + b"\n")
            return message

        def settle(self, messages: list, batch: str) -> None:
            files, root = store(self.path)
            files.create_dir(f"{root}/commits", recursive=True)
            made = json.dumps([m.file for m in messages if m is not None]).encode()
            part = f"{root}/commits/.{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write(made)
            files.move(part, f"{root}/commits/{batch}.json")

        def drop(self, messages: list) -> None:
            files, root = store(self.path)
            for message in messages:
                if message is not None:
                    files.delete_file(f"{root}/data/{message.file}")

    class BatchWriter(Files, DataSourceWriter):
        def commit(self, messages) -> None:
            self.settle(messages, self.batch)

        def abort(self, messages) -> None:
            self.drop(messages)

    class StreamWriter(Files, DataSourceStreamWriter):
        def commit(self, messages, batchId: int) -> None:
            self.settle(messages, str(batchId))

        def abort(self, messages, batchId: int) -> None:
            self.drop(messages)

    class Reader(DataSourceReader):
        def __init__(self, path: str):
            self.path = path

        def partitions(self):
            from pyarrow import fs

            files, root = store(self.path)
            found = []
            for info in files.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True)):
                if info.base_name.endswith(".json"):
                    with files.open_input_stream(info.path) as source:
                        found += json.loads(source.read())
            return [InputPartition(name) for name in sorted(found)]

        def read(self, partition):
            if partition is None:  # nothing was committed
                return
            files, root = store(self.path)
            with files.open_input_stream(f"{root}/data/{partition.value}") as source:
                left = b""
                while block := source.read(1 << 20):
                    *lines, left = (left + block).split(b"\n")
                    yield from (tuple(json.loads(line)) for line in lines)

    class CommittedRecords(DataSource):
        @classmethod
        def name(cls):
            return NAME

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader(self.options["path"])

        def writer(self, schema, overwrite):
            return BatchWriter(dict(self.options))

        def streamWriter(self, schema, overwrite):
            return StreamWriter(dict(self.options))

    spark.dataSource.register(CommittedRecords)


def as_records(batch: DataFrame) -> DataFrame:
    """Rows of a batch with an `endpoint`, each as one JSON text."""
    return batch.select("endpoint", F.to_json(F.struct("*")).alias("record"))


class CommittedSink:
    """A sink whose batches appear whole, once, or not at all."""

    def __init__(self, path: str):
        self.path = path

    def write(self, batch: DataFrame, batch_id: int) -> None:
        register(batch.sparkSession)
        as_records(batch).write.format(NAME).option("batch", str(batch_id)).mode("append").save(self.path)
