"""A sink for files with names of their own, and moves of such files, both done by tasks."""

from __future__ import annotations

import gzip
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Tasks get these functions with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Where files stand until all of a landing are there.
LANDING = "_landing"
#: Level of packing: page files are read soon, so speed goes before size.
PACKING = 1
MOVES = "old string, new string, moved boolean"


class NamedFiles(DataSource):
    """Rows (name, text) as files of a landing: ``path``/``landing``/name, and ``.gz`` if they are packed.

    Tasks write each file under a hidden name and then give it its own, so a repeated task replaces
    what a lost one left, with the same bytes. The commit moves the whole landing into place at once.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options["landing"], self.options.get("packed") == "true")


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, landing: str, packed: bool):
        self.path, self.landing, self.packed = path, landing, packed

    def _places(self):
        files, base = pyarrow.fs.FileSystem.from_uri(self.path)
        return files, f"{base}/{LANDING}/{self.landing}", f"{base}/{self.landing}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, made, _ = self._places()
        files.create_dir(made, recursive=True)
        for batch in iterator:
            for name, text in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                part = f"{made}/.{uuid.uuid4().hex}"
                with files.open_output_stream(part) as out:
                    body = (text or "").encode() + b"\n"
                    out.write(gzip.compress(body, PACKING, mtime=0) if self.packed else body)
                files.move(part, f"{made}/{name}.gz" if self.packed else f"{made}/{name}")
        return WriterCommitMessage()

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, made, target = self._places()
        if files.get_file_info(made).type == pyarrow.fs.FileType.NotFound:
            return
        if files.get_file_info(target).type != pyarrow.fs.FileType.NotFound:
            files.delete_dir(target)
        files.move(made, target)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, made, _ = self._places()
        if files.get_file_info(made).type != pyarrow.fs.FileType.NotFound:
            files.delete_dir(made)


def moved(names: DataFrame, root: str) -> DataFrame:
    """Moves files (old, new: names below the full name ``root``); (old, new, moved) of each.

    A file that is not there any more was moved before, so any part may be repeated. A move replaces a
    file of the new name.
    """

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            done = []
            for old, new in zip(batch.column("old").to_pylist(), batch.column("new").to_pylist()):
                there = files.get_file_info(f"{base}/{old}").type == pyarrow.fs.FileType.File
                if there:
                    files.create_dir(f"{base}/{new}".rsplit("/", 1)[0], recursive=True)
                    files.move(f"{base}/{old}", f"{base}/{new}")
                done.append(there)
            columns = [batch.column("old"), batch.column("new"), pa.array(done, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["old", "new", "moved"])

    return names.select("old", "new").mapInArrow(move, MOVES)
