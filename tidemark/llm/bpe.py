"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Every chunk is split into pre-tokens by itself; two
neighbours agree from the first boundary on that both have found in the overlap, because the
pattern never looks behind a boundary. Pieces between boundaries are then merged by rank. Short texts
are one chunk. Chunks of long texts are rows of their own, so one huge text is split by many tasks;
the task that gets all chunks of a text stitches their boundaries and encodes the pieces.

Null text counts as empty; an empty text has no ids. Repeated rows are encoded each on its own, extra
columns are ignored, and an empty table gives an empty result."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a chunk, and of the stretch that it shares with the next one.
CHUNK, OVERLAP = 32_768, 512
#: Rows of a batch whose results are held at a time; each has CHUNK code points and some more at most.
AT_ONCE = 16
#: Pieces whose ids a worker remembers; beyond, it starts to remember anew.
REMEMBERED = 200_000


class Encoder:
    """Encodes pieces by a rank file; a worker keeps one."""

    _kept: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.memory: dict[str, tuple[int, bytes, bytes]] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        if (path, pattern) not in cls._kept:
            cls._kept[path, pattern] = cls(path, pattern)
        return cls._kept[path, pattern]

    def piece_ids(self, piece: str) -> list[int]:
        return self.encoding._encode_single_piece(piece)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, joined."""
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def encoded(self, piece: str) -> tuple[int, bytes, bytes]:
        """How many ids a piece has, the ids in decimal joined by commas, and the bytes they decode to."""
        found = self.memory.get(piece)
        if found is None:
            ids = self.piece_ids(piece)
            found = (len(ids), ",".join(map(str, ids)).encode(), self.decode(ids))
            if len(piece) <= 64:
                if len(self.memory) >= REMEMBERED:
                    self.memory.clear()
                self.memory[piece] = found
        return found

    def boundaries(self, text: str, start: int, end: int) -> list[int]:
        """Starts of the pre-tokens of text[start:end]; where the text ends there, its end too. A cut can
        only change where the last pre-token ends."""
        found = [m.start() for m in self.pattern.finditer(text[start:end])]
        marks = [start + x for x in found]
        return [*marks, end] if end == len(text) else marks

    def pieces(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
        """The pre-tokens of a text, by way of overlapping chunks."""
        if len(text) <= chunk + overlap:
            return self.pattern.findall(text)
        marks = [self.boundaries(text, at, min(len(text), at + chunk + overlap)) for at in range(0, len(text), chunk)]
        cuts = stitch(marks, text, self, chunk, overlap)
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def stitch(marks: list[list[int]], text: str, encoder: Encoder, chunk: int, overlap: int) -> list[int]:
    """One list of boundaries from the chunks' own lists.

    A chunk is followed up to the first boundary that the next chunk has too. Where a pre-token spans
    the whole overlap there is none; then the text is split on from the last sure boundary, by
    stretches that double until one reaches a boundary of the next chunk or the end."""
    cuts, i = list(marks[0]), 0
    last = len(marks) - 1
    while i < last:
        following = set(marks[i + 1])
        first = (i + 1) * chunk
        met = next((k for k, x in enumerate(cuts) if x >= first and x in following), None)
        if met is None:
            sure, base, width = cuts[:-1], cuts[-1], chunk + overlap
            while met is None:
                end = min(len(text), base + width)
                more = encoder.boundaries(text, base, end)
                cuts = [*sure, *more]
                met = next((k for k, x in enumerate(cuts) if x >= first and x in following), None)
                if met is None and end == len(text):
                    return cuts
                width *= 2
        cuts = cuts[:met] + [x for x in marks[i + 1] if x >= cuts[met]]
        i += 1
    return cuts


def chunk_marks(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows -> their boundaries, counted from the text's start. A batch has up to thousands of chunks, each with thousands
    of boundaries, so few chunks are held at a time, and their boundaries as numbers of four bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            few = batch.slice(at, AT_ONCE)
            marks, ends = array("i"), array("i", [0])
            for i in range(few.num_rows):
                part, start = few.column("_part")[i].as_py(), few.column("_n")[i].as_py() * CHUNK
                marks.extend(start + m.start() for m in encoder.pattern.finditer(part))
                if few.column("_last")[i].as_py():
                    marks.append(start + len(part))
                ends.append(len(marks))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(marks, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(few.column(c) for c in ("_row", "_id", "_n", "_part")), lists], names=["_row", "_id", "_n", "_part", "_marks"])


def _digest(total: int, ids: bytes, decoded: bytes) -> tuple[int, str, str]:
    return total, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row of docs: id_col, n_tokens, ids_sha256, decoded_sha256, and with with_ids the ids and the
    decoded bytes themselves.

    Texts of up to CHUNK code points are encoded where they are read. Longer ones go as chunk rows to
    tasks of their own and come together again by row; nothing else is shuffled."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")

    def out(batch_ids, found: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        digests = [_digest(*x) for x in found]
        columns = {"_id": batch_ids, "n_tokens": pa.array([x[0] for x in digests], pa.int64()), "ids_sha256": pa.array([x[1] for x in digests], pa.string()), "decoded_sha256": pa.array([x[2] for x in digests], pa.string())}
        if with_ids:
            columns |= {"ids": pa.array([[int(n) for n in x[1].split(b",") if n] for x in found], pa.list_(pa.int32())), "decoded": pa.array([x[2] for x in found], pa.binary())}
        return pa.RecordBatch.from_pydict(columns)

    def joined(encoder: Encoder, pieces: list[str]) -> tuple[int, bytes, bytes]:
        parts = list(map(encoder.encoded, pieces))
        return sum(x[0] for x in parts), b",".join([x[1] for x in parts]), b"".join([x[2] for x in parts])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path, pattern)
        for batch in batches:
            texts = batch.column("_text")
            for at in range(0, batch.num_rows, AT_ONCE):
                part = texts.slice(at, AT_ONCE)
                yield out(batch.column("_id").slice(at, AT_ONCE), [joined(encoder, encoder.pieces(x.as_py())) for x in part])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return chunk_marks(Encoder.of(path, pattern), batches)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All chunks of a text -> its digests."""
        encoder = Encoder.of(path, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                chunks = sorted(batch.column("_chunks")[i].as_py(), key=lambda c: c["_n"])
                text = "".join([c["_part"][:CHUNK] for c in chunks[:-1]]) + chunks[-1]["_part"]
                cuts = stitch([c["_marks"] for c in chunks], text, encoder, CHUNK, OVERLAP)
                yield out(batch.column("_id").slice(i, 1), [joined(encoder, [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])])

    length = F.length("_text")
    short = rows.where(length <= CHUNK).mapInArrow(whole, schema)
    chunks = (
        rows.where(length > CHUNK)
        .select("_id", "_text", F.monotonically_increasing_id().alias("_row"), F.floor((length - 1) / CHUNK).cast("int").alias("_end"))
        .select("_row", "_id", "_text", F.explode(F.sequence(F.lit(0), F.col("_end"))).alias("_n"), "_end")
        .select("_row", "_id", "_n", F.expr(f"substring(_text, _n * {CHUNK} + 1, {CHUNK + OVERLAP})").alias("_part"), (F.col("_n") == F.col("_end")).alias("_last"))
        .repartition("_row", "_n")
        .mapInArrow(split, f"_row long, _id {kind}, _n int, _part string, _marks array<int>")
    )
    long = (
        chunks.groupBy("_row", "_id")
        .agg(F.collect_list(F.struct("_n", "_part", "_marks")).alias("_chunks"))
        .select("_id", "_chunks")
        .mapInArrow(unite, schema)
    )
    return short.unionByName(long).withColumnRenamed("_id", id_col)
