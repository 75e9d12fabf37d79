"""A data source of saved link answers that follows their continuations.

A saved answer is a line of JSON: the title that was asked for, what was sent along (`asked`, an object: empty at first, the
`continue` object of the answer before from then on) and the answer itself. A file holds all answers of its titles, in
any order, as a fetching job writes it when it is done. The reader goes from a title's first answer along its `continue`
objects and yields the links in their order; a file is a partition, read by the task that gets it.

- Batch: `spark.read.format("saved_links").load(folder)`.
- Stream: `spark.readStream...`; files are taken in the order of their names, and the offset is the last name taken, so new files need
  names that sort behind. A query that ends goes on behind its last offset.

Rows: title, step (answers followed so far, from 0), link, error. A chain that breaks (an answer is missing, is no JSON, or
leads back) keeps the links that were found and ends in a row with an `error` and no link, so that nothing is lost
silently. Lines that are no saved answers are rows with an error and no title. Null and empty links are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .shared import ship

FORMAT = "saved_links"
SCHEMA = "title string, step int, link string, error string"


@dataclass
class File(InputPartition):
    path: str


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def files_of(folder: str) -> list[str]:
    """The files of a folder by name, without hidden ones."""
    from pyarrow import fs as arrow_fs

    fs, root = _filesystem(folder)
    found = fs.get_file_info(arrow_fs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def chains(lines: Iterator[str]) -> Iterator[tuple]:
    """Rows of the answers of a file, title by title."""
    answers: dict[str, dict[str, str]] = {}
    for line in lines:
        if not line.strip():
            continue
        try:
            saved = json.loads(line)
            answers.setdefault(saved["title"], {})[json.dumps(saved.get("asked") or {}, sort_keys=True)] = saved["answer"]
        except (ValueError, KeyError, TypeError, AttributeError):
            yield None, None, None, "no saved answer"
    for title, own in answers.items():
        asked, seen = "{}", set()
        while asked is not None:
            step = len(seen)
            if asked in seen or asked not in own:
                yield title, step, None, f"leads back to {asked}" if asked in seen else f"no answer to {asked}"
                break
            seen.add(asked)
            try:
                answer = json.loads(own[asked])
                pages, more = answer.get("query", {}).get("pages", {}).values(), answer.get("continue")
                links = [link["title"] for page in pages for link in page.get("links") or []]
            except (ValueError, KeyError, TypeError, AttributeError):
                yield title, step, None, f"no links in the answer to {asked}"
                break
            yield from ((title, step, link, None) for link in links if link)
            asked = json.dumps(more, sort_keys=True) if more else None


def _read(folder: str, path: str) -> Iterator[tuple]:
    import io

    fs, _ = _filesystem(folder)
    with fs.open_input_stream(path) as raw, io.TextIOWrapper(raw, encoding="utf-8", errors="replace") as lines:
        yield from chains(lines)


class SavedLinks(DataSource):
    """The source; its one option is the path."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Batch(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Stream(self.options["path"])


class Batch(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [File(f) for f in files_of(self.folder)]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is not None:  # a folder without files has one empty partition
            yield from _read(self.folder, partition.path)


class Stream(DataSourceStreamReader):
    """The offset is the name of the last file that was taken."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        return {"file": max(files_of(self.folder), default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [File(f) for f in files_of(self.folder) if start["file"] < f <= end["file"]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from _read(self.folder, partition.path)


def saved_links(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """title, step, link and error of the saved answers of a folder, as a table or as a stream."""
    ship(spark)
    spark.dataSource.register(SavedLinks)
    return (spark.readStream if stream else spark.read).format(FORMAT).option("path", folder).load()
