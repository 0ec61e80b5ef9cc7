"""Dumps with large zstd windows as a Spark data source: one input partition for each file."""

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of lines handed over at once, and bytes decompressed at once.
BATCH_BYTES, READ_BYTES = 1 << 22, 1 << 22


@dataclass
class DumpFile(InputPartition):
    path: str


class ZstdLines(DataSource):
    """Lines of the files in option ``files``, a JSON list of paths."""

    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> str:
        return "value binary"

    def reader(self, schema) -> "ZstdReader":
        return ZstdReader(json.loads(self.options.get("files", "[]")))


class ZstdReader(DataSourceReader):
    def __init__(self, files: list[str]):
        self.files = files

    def partitions(self) -> list[InputPartition]:
        return [DumpFile(f) for f in self.files] or [DumpFile("")]

    def read(self, partition: DumpFile) -> Iterator[pa.RecordBatch]:
        if partition.path:
            for lines in batches(partition.path):
                yield pa.record_batch([pa.array(lines, pa.binary())], names=["value"])


def batches(path: str) -> Iterator[list[bytes]]:
    """Lines of one file in lists of about BATCH_BYTES, or of one line that is longer. Only a newline ends a line."""
    import zstandard
    from pyarrow import fs

    reader = zstandard.ZstdDecompressor(max_window_size=2**31)
    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner, compression=None) as raw:
        with reader.stream_reader(raw, read_across_frames=True) as plain:
            pending, size, rest = [], 0, []
            while chunk := plain.read(READ_BYTES):
                first, *more = chunk.split(b"\n")
                rest.append(first)
                for piece in more:
                    line = b"".join(rest)
                    rest = [piece]
                    pending.append(line)
                    size += len(line)
                    if size >= BATCH_BYTES:
                        yield pending
                        pending, size = [], 0
            if last := b"".join(rest):
                pending.append(last)
            if pending:
                yield pending
