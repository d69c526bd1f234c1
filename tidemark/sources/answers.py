"""A data source of landed answers: what a fetcher got, as files of JSON lines that arrive one after the other.

    register(spark)
    spark.read.format("landed_answers").option("path", folder).load()
    spark.readStream.format("landed_answers").option("path", folder).load()

A row is an answer: source, url, attempt (from 0), http_status (null for a broken connection), at (seconds), retry_after,
raw_content, what the crawl's rules say of it alone, and the file it came from: retried (whether another attempt follows),
wait (the seconds before that), quota_left (of the header that tells it) and quota_low. Options: path (any store that
Arrow can open), sources (comma-separated; others are skipped), retries (later attempts are no answers), low (a quota below
which it counts as low), splitBytes (a file is read in pieces of so many bytes).

Files are read in the order of their names, which is the order of arrival, and never change once they are there. The
offset of a stream is the last file that a batch took, so a restarted stream goes on behind it and a repeated batch reads the
same files. The interface tells a stream no start when it asks for the latest offset, so a batch takes all files that are there.
Every piece of a file is a partition: it reads from the first line that begins in it to the end of the last one. A line that is
no JSON object gives a row with the line as raw_content and nothing else, so that broken answers are seen; empty lines are
skipped. An empty or missing folder is an empty table.

Which answer of an address counts, pacing and quotas over many answers are relations, see crawl.py."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.sources.crawl import BASE, LONGEST, LOW
from tidemark.sources.readers import backoff_seconds

SCHEMA = "source string, url string, attempt int, http_status int, at double, retry_after string, raw_content string, retried boolean, wait double, quota_left int, quota_low boolean, file string"
ARROW = pa.schema([("source", pa.string()), ("url", pa.string()), ("attempt", pa.int32()), ("http_status", pa.int32()), ("at", pa.float64()), ("retry_after", pa.string()), ("raw_content", pa.string()), ("retried", pa.bool_()), ("wait", pa.float64()), ("quota_left", pa.int32()), ("quota_low", pa.bool_()), ("file", pa.string())])
SPLIT, ROWS = 64 << 20, 4096


@dataclass
class Piece(InputPartition):
    """The lines of a file that begin in [start, end)."""

    file: str
    start: int
    end: int


def files(path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the files in the folder, in the order of their names."""
    from pyarrow import fs

    store, folder = _store(path)
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))


def _store(path: str):
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def lines(path: str, name: str, start: int = 0, end: int | None = None) -> Iterator[bytes]:
    """The lines that begin in [start, end)."""
    store, folder = _store(path)
    with store.open_input_file(f"{folder}/{name}") as file:
        at = start
        if start:  # the line that the byte before belongs to is another piece's
            file.seek(start - 1)
            at = start - 1 + len(_line(file))
        else:
            file.seek(0)
        while end is None or at < end:
            line = _line(file)
            if not line:
                return
            at += len(line)
            yield line


def _line(file) -> bytes:
    """Bytes up to and with the next line end."""
    parts = []
    while True:
        at, block = file.tell(), file.read(1 << 16)
        cut = block.find(b"\n")
        if cut >= 0:
            file.seek(at + cut + 1)
            return b"".join([*parts, block[: cut + 1]])
        if not block:
            return b"".join(parts)
        parts.append(block)


def answer(line: bytes, name: str, low: int = LOW) -> tuple:
    """The row of a line."""
    text = line.decode("utf-8", "replace").strip()
    try:
        found = json.loads(text)
    except ValueError:
        found = None
    if not isinstance(found, dict):
        return (*[None] * 6, text, *[None] * 4, name)
    number = lambda x: x if isinstance(x, (int, float)) and not isinstance(x, bool) else None
    whole = lambda x: None if number(x) is None or not -(2**31) <= x < 2**31 else int(x)
    word = lambda k: found[k] if isinstance(found.get(k), str) else None if found.get(k) is None else json.dumps(found[k])
    attempt, status, at = whole(found.get("attempt")), whole(found.get("http_status")), number(found.get("at"))
    headers = found.get("headers") if isinstance(found.get("headers"), dict) else {}
    left = next((str(v).strip() for k, v in headers.items() if k.lower() == "x-ratelimit-remaining"), "")
    left = int(left) if left.isascii() and left.isdigit() and len(left) < 10 else None
    retried = status is None or status == 429 or status >= 500
    wait = backoff_seconds(attempt or 0, word("retry_after"), BASE, LONGEST) if retried else None
    return (word("source"), word("url"), attempt, status, None if at is None else float(at), word("retry_after"), word("raw_content"), retried, wait, left, left is not None and left <= low, name)


class _Options:
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.sources = {s.strip() for s in options.get("sources", "").split(",") if s.strip()} or None
        self.retries = int(options["retries"]) if "retries" in options else None
        self.low = int(options.get("low", LOW))
        self.split = max(1, int(options.get("splitbytes", options.get("splitBytes", SPLIT))))

    def wanted(self, row: tuple) -> bool:
        return (self.sources is None or row[0] in self.sources) and (self.retries is None or (row[2] or 0) <= self.retries)

    def pieces(self, after: str = "", last: str | None = None) -> list[InputPartition]:
        return [Piece(name, at, min(size, at + self.split)) for name, size in files(self.path) if name > after and (last is None or name <= last) for at in range(0, size, self.split)]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        if isinstance(part, Piece):  # without files Spark reads one partition that is none
            rows = (answer(x, part.file, self.low) for x in lines(self.path, part.file, part.start, part.end) if x.strip())
            yield from _batches(r for r in rows if self.wanted(r))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), ARROW)], schema=ARROW)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), ARROW)], schema=ARROW)


class AnswersReader(DataSourceReader):
    def __init__(self, options):
        self.options = _Options(options)

    def partitions(self) -> list[InputPartition]:
        return self.options.pieces()

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.options.read(partition)


class AnswersStreamReader(DataSourceStreamReader):
    """The offset is {"file": the last file taken}."""

    def __init__(self, options):
        self.options = _Options(options)

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        names = [name for name, _ in files(self.options.path)]
        return {"file": names[-1] if names else ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.options.pieces(start["file"], end["file"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.options.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to release: offsets are in the checkpoint, files stay."""


class LandedAnswers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_answers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> AnswersReader:
        return AnswersReader(self.options)

    def streamReader(self, schema) -> AnswersStreamReader:
        return AnswersStreamReader(self.options)


def register(spark) -> None:
    """Make format("landed_answers") known to the session."""
    spark.dataSource.register(LandedAnswers)
