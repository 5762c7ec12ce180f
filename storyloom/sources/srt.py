"""SRT files as a Spark data source: ``spark.read.format("srt")`` and ``write_srt``.

A file is one stem. Files are listed once, those whose names the options ``prefix`` and ``stems`` rule out are never opened,
and the rest are dealt to partitions by their bytes. Names are options and not filters that Spark hands over, since Spark 4.1
keeps those per loaded source: two differently filtered uses of one DataFrame in a query would both get the last one's
files (``test_uses_of_one_frame_do_not_mix``). A writing task puts its files into a folder of its own; only when all tasks are done does the
driver rename them to their places, so that a task that ran twice leaves one file, and a job that fails leaves the old ones.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "stem string, idx int, start double, end double, text string"
PARTITION_BYTES = 64 << 20
BLOCK = re.compile(r"(?s)[ \t]*(\d+)[ \t]*\n(\d+):(\d+):(\d+)[,.](\d+) --> (\d+):(\d+):(\d+)[,.](\d+)[ \t]*(?:\n(.*))?")
APART = re.compile(r"\n[ \t]*\n+")


def _seconds(h: str, m: str, s: str, ms: str) -> float:
    return (int(h) * 3_600_000 + int(m) * 60_000 + int(s) * 1000 + int(ms)) / 1000


def blocks(text: str) -> Iterator[tuple]:
    """idx, start, end, text of each block. A malformed block is an error."""
    for block in APART.split(text.replace("\r\n", "\n")):
        block = block.strip("\n")
        if not block.strip(" \t"):
            continue
        found = BLOCK.fullmatch(block)
        if not found:
            raise ValueError(f"malformed block: {block[:200]}")
        yield int(found[1]), _seconds(*found.group(2, 3, 4, 5)), _seconds(*found.group(6, 7, 8, 9)), found[10] or ""


def _stamp(seconds: float) -> str:
    ms = round(seconds * 1000)
    if ms < 0:
        raise ValueError(f"a stamp before zero: {seconds}")
    return f"{ms // 3_600_000:02d}:{ms // 60_000 % 60:02d}:{ms // 1000 % 60:02d},{ms % 1000:03d}"


@dataclass
class Files(InputPartition):
    """Files of one partition."""

    paths: list[str] = field(default_factory=list)


@dataclass
class Written(WriterCommitMessage):
    """Where a task put its files, and their names."""

    folder: str
    names: list[str]


def _store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)


def _stem(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[0] if "." in name else name


class Reader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int, prefix: str = "", stems: list[str] | None = None):
        self.path, self.partition_bytes, self.prefix, self.stems = path, partition_bytes, prefix, stems

    def keeps(self, stem: str) -> bool:
        return stem.startswith(self.prefix) and (self.stems is None or stem in self.stems)

    def partitions(self) -> list[Files]:
        store, root = _store(self.path)
        at = store.get_file_info(root)
        found = store.get_file_info(arrow_fs.FileSelector(root)) if at.type == arrow_fs.FileType.Directory else [at]
        if at.type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        out, held = [Files()], 0
        for info in sorted((x for x in found if x.type == arrow_fs.FileType.File and x.path.endswith(".srt")), key=lambda x: x.path):
            if not self.keeps(_stem(info.path)):
                continue
            if out[-1].paths and held + info.size > self.partition_bytes:
                out, held = [*out, Files()], 0
            out[-1].paths.append(info.path)
            held += info.size
        return out

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for path in partition.paths:
            with store.open_input_stream(path) as stream:
                text = stream.read().decode("utf-8-sig")
            for cue in blocks(text):
                yield _stem(path), *cue


class Writer(DataSourceWriter):
    """Expects all cues of a stem in one task, next to each other and in their order, as ``write_srt`` brings them."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.beside = path, overwrite, f"_writing-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        store, root = _store(self.path)
        folder, names, stream = f"{root}/{self.beside}/{uuid.uuid4().hex}", [], None
        store.create_dir(folder)
        try:
            for row in rows:
                if not row.stem or "/" in row.stem or row.stem[0] in "._":
                    raise ValueError(f"no name of a file: {row.stem!r}")
                if row.idx is None or row.start is None or row.end is None:
                    raise ValueError(f"a cue without number or time in {row.stem!r}")
                if not names or names[-1] != row.stem:
                    if stream:
                        stream.close()
                    names.append(row.stem)
                    stream = store.open_output_stream(f"{folder}/{row.stem}.srt")
                    lead = ""
                stream.write(f"{lead}{row.idx}\n{_stamp(row.start)} --> {_stamp(row.end)}\n{row.text or ''}\n".encode())
                lead = "\n"
        finally:
            if stream:
                stream.close()
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        moves = [(m.folder, name) for m in messages if m for name in m.names]
        names = {name for _, name in moves}
        if len(names) < len(moves):
            self.abort(messages)
            raise ValueError("cues of one stem came from several places: use write_srt")
        for folder, name in moves:
            store.move(f"{folder}/{name}.srt", f"{root}/{name}.srt")
        if self.overwrite:
            for info in store.get_file_info(arrow_fs.FileSelector(root)):
                if info.path.endswith(".srt") and _stem(info.path) not in names:
                    store.delete_file(info.path)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        if store.get_file_info(f"{root}/{self.beside}").type == arrow_fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.beside}")


class SrtSource(DataSource):
    """Options: ``prefix`` and ``stems`` (a JSON list), the files wanted; ``partitionBytes``, bytes of files that a reading task gets at most, or one larger file."""

    @classmethod
    def name(cls) -> str:
        return "srt"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        stems = self.options.get("stems")
        return Reader(self.options["path"], int(self.options.get("partitionBytes", PARTITION_BYTES)), self.options.get("prefix", ""), None if stems is None else json.loads(stems))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session."""
    spark.dataSource.register(SrtSource)


def read(spark: SparkSession, path: str, prefix: str = "", stems: list[str] | None = None) -> DataFrame:
    """stem, idx, start, end, text of the ``.srt`` files in a folder, or of one file; of those alone whose stem begins with ``prefix`` and is one of ``stems``. Other files are left alone."""
    register(spark)
    reader = spark.read.format("srt").option("prefix", prefix)
    return (reader if stems is None else reader.option("stems", json.dumps(stems))).load(path)


def write_srt(cues: DataFrame, path: str, mode: str = "append") -> None:
    """One file per stem (stem, idx, start, end, text) in order of idx, start and end. Files of the same names are replaced, others stay; mode "overwrite" takes them away too."""
    register(cues.sparkSession)
    rows = cues.selectExpr("cast(stem AS string) stem", "cast(idx AS int) idx", "cast(start AS double) start", "cast(end AS double) end", "cast(text AS string) text")
    rows.repartition("stem").sortWithinPartitions("stem", "idx", "start", "end", "text").write.format("srt").mode(mode).save(path)
