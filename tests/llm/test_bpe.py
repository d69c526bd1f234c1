import base64
import hashlib
import tracemalloc

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", ["", "a", "it's  a\n\n test  ", "x" * 500, " " * 300, "ab  \n " * 90, "é1!ñ   'll" * 40, "1" * 77 + "a b" * 50])
@pytest.mark.parametrize("chunk,overlap", [(8, 3), (16, 4), (50, 20)])
def test_chunks_resynchronise(text, chunk, overlap):
    encoder = bpe.Encoder.of(PATH, P.PATTERN)
    assert encoder.pieces(text, chunk, overlap) == encoder.pattern.findall(text)


def test_like_the_library(spark, library):
    long = ("Énanli ouch 12345 the, of\n\n   and's " * 3000) + "z" * 40_000 + "  end "
    texts = ["", None, "hello world", long, long, "\n" * 70_000, "dup", "dup", "x y  z  \t"]
    docs = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode(docs, PATH, P.PATTERN, with_ids=True).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(got[i].decoded) == (text or "").encode()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, PATH, P.PATTERN).count() == 0


def test_boundaries_of_few_chunks_are_held():
    """A batch of many chunks costs the memory of few, and says the same."""
    encoder = bpe.Encoder.of(PATH, P.PATTERN)
    part = "a b, " * (bpe.CHUNK // 10)
    rows = [(r, r, n, part, n == 1) for r in range(32) for n in (0, 1)]
    names = ["_row", "_id", "_n", "_part", "_last"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([("_row", pa.int64()), ("_id", pa.int64()), ("_n", pa.int32()), ("_part", pa.string()), ("_last", pa.bool_())]))
    found = [m.start() for m in encoder.pattern.finditer(part)]
    tracemalloc.start()
    at = 0
    for some in bpe.chunk_marks(encoder, iter([batch])):
        assert some.num_rows <= bpe.AT_ONCE and some.column("_row").to_pylist() == [r[0] for r in rows[at : at + some.num_rows]]
        for k, marks in enumerate(some.column("_marks")):
            n, last = rows[at + k][2], rows[at + k][4]
            assert marks.values.equals(pa.array([n * bpe.CHUNK + x for x in found + [len(part)] * last], pa.int32()))
        at += some.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert at == len(rows) and peak < 20 * len(found) * 40  # as lists of numbers the boundaries of all 64 chunks take three times that
