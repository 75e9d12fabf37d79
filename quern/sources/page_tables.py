"""Table functions that hand on pages and paragraphs one by one: a task holds one of them, whatever the size of its document.

- `extracted`: the pages of binary files by engines that are generators. An engine that fails gives the whole file to the next one, so
  a file is run through once without keeping anything, and its pages are yielded on a second pass only if that ends well.
- `split_paragraphs`: the paragraphs of documents whose text comes in parts (pages, turns), by a partitioned table argument. The function
  keeps a cursor over the parts: the open paragraph and the next number. A paragraph may run over any number of parts.

Both are registered for SQL by `register`: extract_pages(TABLE(...)) with the engines given there, and
split_paragraphs(TABLE(...) PARTITION BY document_id ORDER BY part).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship

#: An engine: its name, and what gives the pages of a file's bytes.
Engine = tuple[str, Callable[[bytes], Iterable[str]]]
PAGES = "document_id string, page_number int, text string, engine string, error string"
PARAGRAPHS = "document_id string, n int, paragraph string"


def _pages(engines: list[Engine]) -> type:
    class Pages:
        def eval(self, row) -> Iterator[tuple]:
            content, error = bytes(row["content"] or b""), "no engine"
            for name, extract in engines:
                try:
                    for _ in extract(content):  # nothing is kept: does the engine take the whole file?
                        pass
                except Exception as e:  # noqa: BLE001 - the next engine takes it
                    error = f"{name}: {e}"
                    continue
                for n, page in enumerate(extract(content), 1):
                    yield row["document_id"], n, page, name, None
                return
            yield row["document_id"], None, None, None, error

    return Pages


def _paragraphs(shortest: int) -> type:
    class Paragraphs:
        def __init__(self):
            self.document, self.open, self.n = None, "", 0

        def _closed(self, paragraph: str) -> Iterator[tuple]:
            paragraph = paragraph.strip()
            if len(paragraph) >= shortest:
                yield self.document, self.n, paragraph
                self.n += 1

        def eval(self, row) -> Iterator[tuple]:
            self.document, at, text = row["document_id"], 0, self.open + (row["text"] or "")
            while (end := text.find("\n\n", at)) >= 0:
                yield from self._closed(text[at:end])
                at = end + 2
            self.open = text[at:]

        def terminate(self) -> Iterator[tuple]:
            yield from self._closed(self.open)

    return Paragraphs


def register(spark: SparkSession, engines: list[Engine], shortest: int = 50) -> None:
    """Make extract_pages and split_paragraphs known to the session's SQL."""
    ship(spark)
    spark.udtf.register("extract_pages", F.udtf(_pages(engines), returnType=PAGES, useArrow=False))
    spark.udtf.register("split_paragraphs", F.udtf(_paragraphs(shortest), returnType=PARAGRAPHS, useArrow=False))


def extracted(files: DataFrame, engines: list[Engine]) -> DataFrame:
    """document_id, page_number (from 1), text, engine and error of files (document_id, content); a file that defeats all engines is one row with the last error."""
    ship(files.sparkSession)
    table = files.select(F.col("document_id").cast("string").alias("document_id"), "content").asTable()
    return F.udtf(_pages(engines), returnType=PAGES, useArrow=False)(table)


def split_paragraphs(parts: DataFrame, shortest: int = 50) -> DataFrame:
    """document_id, n (from 0) and paragraph of documents in parts (document_id, part, text): what lies between blank lines, stripped, with at least `shortest` characters.

    Parts are joined as they come, in the order of `part`, and cut at blank lines as one text; documents without an id are one.
    """
    ship(parts.sparkSession)
    rows = parts.select(F.col("document_id").cast("string").alias("document_id"), "part", "text")
    return F.udtf(_paragraphs(shortest), returnType=PARAGRAPHS, useArrow=False)(rows.asTable().partitionBy("document_id").orderBy("part"))
