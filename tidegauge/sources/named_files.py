"""Spark data sources for files of given names: each row written as a file by the executors, and such files read as lines by them.

Spread over folders of bounded size, files are moved a folder at once and listed by the tasks that read them: what the driver
holds is a name for each folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


def _folder(path: str):
    """(file system, folder in it) of a path or URI that Arrow can open."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


#: Folders that are moved, or whose files are moved, at the same time.
MOVERS = 16
#: Files, and bytes, in a folder after which a task begins another one.
FOLDER_FILES, FOLDER_BYTES = 1000, 32 << 20
#: Arrow's names of the stores that move a folder in one step; elsewhere its files are moved.
MOVES_FOLDERS = ("local", "hdfs")
#: Bytes read at once, and bytes and rows of lines sent to Spark at once.
PIECE, LINES = 1 << 20, 10_000


@dataclass
class Staged(WriterCommitMessage):
    """The folders of a task's files, which are in them under their own names."""

    folders: list[str]


class NamedFilesWriter(DataSourceWriter):
    """Tasks write to a staging folder; what committed tasks wrote is moved to its names at the end, and a failed job leaves none of it.

    The driver makes the staging folder and takes it away, so a task that outlives a failed job finds no place to write.
    """

    def __init__(self, path: str, spread: bool = False):
        self.path, self.spread, self.staging = path, spread, f"_staged-{uuid.uuid4().hex}"
        store, folder = _folder(path)
        store.create_dir(f"{folder}/{self.staging}", recursive=True)

    def write(self, iterator: Iterator) -> Staged:
        store, folder = _folder(self.path)
        own, files, size = [], 0, 0
        for name, text in iterator:
            if not own or files >= FOLDER_FILES or size >= FOLDER_BYTES:
                own.append(f"files-{uuid.uuid4().hex}")
                store.create_dir(f"{folder}/{self.staging}/{own[-1]}", recursive=False)
                files = size = 0
            data = (text or "").encode()
            with store.open_output_stream(f"{folder}/{self.staging}/{own[-1]}/{name}") as out:
                out.write(data)
            files, size = files + 1, size + len(data)
        return Staged(own)

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        store, folder = _folder(self.path)

        def move(own: str) -> None:
            at, to = f"{folder}/{self.staging}/{own}", f"{folder}/{own}" if self.spread else folder
            if self.spread and store.type_name in MOVES_FOLDERS:
                store.move(at, to)
                return
            if self.spread:
                store.create_dir(to)
            for f in store.get_file_info(fs.FileSelector(at)):
                store.move(f.path, f"{to}/{f.base_name}")

        with ThreadPoolExecutor(MOVERS) as pool:
            for _ in pool.map(move, [own for m in messages if m for own in m.folders]):
                pass
        self._clear()

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, folder = _folder(self.path)
        for last in (False, True):  # a task that is being stopped may put a file there meanwhile
            try:
                if store.get_file_info(f"{folder}/{self.staging}").type == fs.FileType.Directory:
                    store.delete_dir(f"{folder}/{self.staging}")
                return
            except OSError:
                if last:
                    raise


class NamedFiles(DataSource):
    """format("named_files"): rows (name, text), to the folder in option `path`, which driver and executors share. Files of the same name are replaced.

    Option `spread` true: to folders of at most FOLDER_FILES files in that folder, whose names are made up.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], self.options.get("spread", "false").lower() == "true")


@dataclass
class Files(InputPartition):
    """A folder of files."""

    folder: str


def _lines(store, path: str) -> Iterator[bytes]:
    """The lines of a file, of which a piece and the line that it ends in are held."""
    rest: list[bytes] = []
    with store.open_input_stream(path) as read:
        while piece := read.read(PIECE):
            *lines, last = piece.split(b"\n")
            for line in lines:
                yield b"".join([*rest, line])
                rest = []
            rest.append(last)
    if any(rest):
        yield b"".join(rest)


class NamedLinesReader(DataSourceReader):
    """One task for each folder, which it lists itself."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, folder = _folder(self.path)
        return [Files(f.base_name) for f in store.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.Directory and f.base_name[0] not in "_."]

    def read(self, partition: Files | None) -> Iterator:
        if partition is None:  # there are no folders
            return
        import pyarrow as pa
        from pyarrow import fs

        store, folder = _folder(self.path)
        names, numbers, texts, size = [], [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int32()), pa.array(texts, pa.binary()).cast(pa.string())], ["file", "line", "t"])

        for f in store.get_file_info(fs.FileSelector(f"{folder}/{partition.folder}")):
            if not f.size:
                continue
            for n, line in enumerate(_lines(store, f.path), 1):
                names.append(f.base_name)
                numbers.append(n)
                texts.append(line)
                size += len(line) + len(f.base_name)
                if size >= PIECE or len(texts) >= LINES:
                    yield batch()
                    names, numbers, texts, size = [], [], [], 0
        if texts:
            yield batch()


class NamedLines(DataSource):
    """format("named_lines"): rows (file, line, t), the lines of all files that named_files spread below the folder in option `path`, numbered from 1."""

    @classmethod
    def name(cls) -> str:
        return "named_lines"

    def schema(self) -> str:
        return "file string, line int, t string"

    def reader(self, schema) -> NamedLinesReader:
        return NamedLinesReader(self.options["path"])
