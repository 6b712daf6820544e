"""Files of elements (pages, slides, records) as a Spark data source.

`register` makes a source out of a parser. The driver only lists the files and deals them into groups of
bounded size, one partition each; tasks open them and parse. A record that can't be parsed is a row with
its error, and so is a file that can't be read, so nothing is lost and no job fails for it.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of the files of one partition; a larger file is a partition of its own.
GROUP_BYTES = 64_000_000
#: bytes of a file -> its records in order: tuples of the parser's columns, or an exception for a bad one.
Parser = Callable[[str, bytes], Iterator[tuple | Exception]]


class FileGroup(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def dealt(sizes: list[tuple[str, int]], group_bytes: int) -> list[list[str]]:
    """Paths in the order of their names, in groups of at most `group_bytes` or one file."""
    groups, size = [], 0
    for path, n in sorted(sizes):
        if not groups or size + n > group_bytes:
            groups.append([])
            size = 0
        groups[-1].append(path)
        size += n
    return groups


def element_source(name: str, columns: str, parser: Parser) -> type[DataSource]:
    """A data source `name` with the columns source (path below the root), record (its number in the file from
    0), the parser's `columns`, and error (null for a good record).

    Options: `path` (a folder or a file of any store that pyarrow knows), `pattern` (of file names, default all),
    `groupBytes`. Files whose names begin with `_` or `.` are not data.
    """
    n_columns = len(T.StructType.fromDDL(columns))

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.root, self.pattern = options["path"].rstrip("/"), options.get("pattern", "*")
            self.group_bytes = int(options.get("groupbytes", options.get("groupBytes", GROUP_BYTES)))

        def partitions(self) -> list[InputPartition]:
            fs, root = pafs.FileSystem.from_uri(self.root)
            info = fs.get_file_info(root)
            listed = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=True))
            files = [(f.path, f.size) for f in listed if f.is_file and not f.base_name.startswith(("_", ".")) and fnmatch.fnmatch(f.base_name, self.pattern)]
            return [FileGroup(g) for g in dealt(files, self.group_bytes)]

        def read(self, partition: FileGroup) -> Iterator[tuple]:
            fs, root = pafs.FileSystem.from_uri(self.root)
            for path in partition.paths if partition else ():
                source = path[len(root) :].lstrip("/") or path.rsplit("/", 1)[-1]
                number = 0
                try:
                    with fs.open_input_stream(path) as f:
                        content = f.read()
                    for number, record in enumerate(parser(source, content)):
                        if isinstance(record, Exception):
                            yield (source, number, *[None] * n_columns, str(record))
                        else:
                            yield (source, number, *record, None)
                        number += 1
                except Exception as e:  # noqa: BLE001  a parser may fail in any way
                    yield (source, number, *[None] * n_columns, f"{type(e).__name__}: {e}")

    class Elements(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"source string, record int, {columns}, error string"

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Reader(self.options)

    return Elements


def register(spark: SparkSession, name: str, columns: str, parser: Parser) -> None:
    """Afterwards `spark.read.format(name).load(path)` reads elements."""
    spark.dataSource.register(element_source(name, columns, parser))
