"""Token ids as files of range-coded blocks.

``write_tokens`` writes a folder with three tables of files, ``read_tokens`` gives the documents back:

* ``table``: one row with the frequency table of all ids (ids, scaled frequencies, checksum), which every block shares;
* ``blocks``: files in the order of documents; each row is a block of at most ``BLOCK`` ids that decodes alone, with
  the number of its file (``part``), its first id counted from the start of the file (``start``) and its bytes;
* ``manifest``: each file's first id, counted over all files.

The bytes of a block are, little-endian: ``TOK1``; the checksum of the table; the numbers of lanes, of ids between
checkpoints, of ids, of pieces, of checkpoints, of words; the length of the index; the index (zlib: for each piece of
a document its doc_id, whether it has one, the document's ids, the ids before the piece, the ids of the piece); for
each checkpoint its place in the words and the states of all lanes; the words; the CRC-32 of everything before.

A document is its ids and the end id; documents are range-partitioned by doc_id, then by a hash of the text, then by
the number of the row, so an id that very many rows share is spread as well. A long document goes on in the next
block. Tasks hold one batch and one block. Files are written by Spark's own committer: a lost task writes its part
again, with the same bytes.

Defined results: null and empty texts are the end id alone; a null doc_id stays null and comes last; rows that repeat
an id are documents of their own, in the order of the hash of their texts; texts of any length are read whole; an
empty table gives no blocks and an empty frequency table; only doc_id and text are read, so other columns of any name
are left aside. Damaged blocks raise an error.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from safetylake.llm import rans
from safetylake.llm.common import text_of
from safetylake.llm.packing import VOCABULARY, encoder
from safetylake.session import new_path, stage_table

END_ID = 2
BITS = 18  # of the frequency table
LANES = 1024
SPAN = 1 << 18  # ids between checkpoints
BLOCK = 1 << 20
MAGIC = b"TOK1"
HEAD = "<4sIIIIIIII"
BLOCKS = "part int, start long, n_ids long, data binary"
INDEX = ("<i8", "<u1", "<i8", "<i8", "<i8")


def pack_block(pieces: list[tuple[int | None, int, int, np.ndarray]], table: rans.Table, table_crc: int, lanes: int = LANES, span: int = SPAN) -> bytes:
    """The bytes of a block of pieces (doc_id, ids of the document, ids before the piece, ids)."""
    ids = np.concatenate([p[3] for p in pieces]).astype(np.int64)
    lanes = max(1, min(lanes, len(ids) // 64))  # a state costs as much as some ids
    every = max(1, span // lanes)
    words, marks = rans.encode(ids, table, lanes, every)
    columns = zip(*((0 if d is None else d, d is not None, total, before, len(x)) for d, total, before, x in pieces), strict=True)
    index = zlib.compress(b"".join(np.array(c, dtype=t).tobytes() for c, t in zip(columns, INDEX, strict=True)))
    head = struct.pack(HEAD, MAGIC, table_crc, lanes, every * lanes, len(ids), len(pieces), len(marks), len(words), len(index))
    states = [struct.pack("<I", place) + x.astype("<u8").tobytes() for place, x in marks]
    body = b"".join([head, index, *states, words.astype("<u4").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack_block(data: bytes, table: rans.Table, table_crc: int) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """The pieces of a block."""
    view = memoryview(data)
    if data[:4] != MAGIC or zlib.crc32(view[:-4]) != struct.unpack("<I", view[-4:])[0]:
        raise ValueError("damaged block")
    _, crc, lanes, span, n, n_pieces, n_marks, n_words, n_index = struct.unpack_from(HEAD, data)
    if crc != table_crc:
        raise ValueError("the block belongs to another frequency table")
    at = struct.calcsize(HEAD)
    raw = zlib.decompress(view[at : at + n_index])
    at += n_index
    index, place = [], 0
    for kind in INDEX:
        index.append(np.frombuffer(raw, dtype=kind, count=n_pieces, offset=place).tolist())
        place += n_pieces * np.dtype(kind).itemsize
    marks = []
    for _ in range(n_marks):
        marks.append((struct.unpack_from("<I", data, at)[0], np.frombuffer(data, "<u8", lanes, at + 4)))
        at += 4 + 8 * lanes
    words = np.frombuffer(data, "<u4", n_words, at)
    ids = np.concatenate(list(rans.decode_all(words, marks, n, span, table)))
    first = 0
    for doc_id, has_id, total, before, size in zip(*index, strict=True):
        yield doc_id if has_id else None, total, before, ids[first : first + size]
        first += size


def token_rows(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, tie, nr, ids (little-endian unsigned 16-bit, or 32-bit where the vocabulary needs it)."""
    names = ["doc_id", "tie", "nr", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    width = _width(vocabulary, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        nr = TaskContext.get().partitionId() << 33
        for whole in batches:
            for first in range(0, len(whole), 512):
                batch = whole.slice(first, 512)
                ids = [np.append(encode(text.as_py()), end_id).astype(width).tobytes() for text in batch.column(2)]
                numbers = pa.array(range(nr, nr + len(ids)), pa.int64())
                nr += len(ids)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), numbers, pa.array(ids, types[3])], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("tie"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, tie long, nr long, ids binary")


@lru_cache(maxsize=4)
def _width(vocabulary: str, end_id: int) -> str:
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, width: str) -> DataFrame:
    """id, n over all documents; each task adds up its own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                found = np.bincount(np.frombuffer(ids.as_buffer(), dtype=width))
                if len(found) > len(total):
                    total = np.append(total, np.zeros(len(found) - len(total), dtype=np.int64))
                total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    block: int = BLOCK,
    lanes: int = LANES,
    span: int = SPAN,
    bits: int = BITS,
) -> None:
    """Write the token ids of ``docs`` below ``path``, in ascending doc_id order."""
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    spark, width = docs.sparkSession, _width(vocabulary, end_id)
    tokens = stage_table(token_rows(docs, vocabulary, end_id), "tokens")
    counted = id_counts(tokens, width).collect()  # one row for each id of the vocabulary at most
    table = rans.table_of(np.array([r["id"] for r in counted], dtype=np.int64), np.array([r["n"] for r in counted]), bits)
    stored = table.to_bytes()
    table_crc = zlib.crc32(stored)
    spark.createDataFrame([(bytearray(stored),)], "data binary").coalesce(1).write.parquet(f"{path}/table")
    names = ["part", "start", "n_ids", "data"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def blocks(rows: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[tuple[int, list]]:
        """Whole blocks of pieces, and the ids before each block in this file."""
        start, held, pieces = 0, 0, []
        for doc_id, ids in rows:
            before = 0
            while before < len(ids):
                part = ids[before : before + block - held]
                pieces.append((doc_id, len(ids), before, part))
                before, held = before + len(part), held + len(part)
                if held == block:
                    yield start, pieces
                    start, held, pieces = start + held, 0, []
        if pieces:
            yield start, pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (doc_id.as_py(), np.frombuffer(ids.as_buffer(), dtype=width))
            for batch in batches
            for doc_id, ids in zip(batch.column(0), batch.column(1), strict=True)
        )
        part = TaskContext.get().partitionId()
        for start, pieces in blocks(rows):
            data = pack_block(pieces, table, table_crc, lanes, span)
            row = (part, start, sum(len(p[3]) for p in pieces), data)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("nr")]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    files = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    files.select("part", F.coalesce(before, F.lit(0)).alias("first_id"), "n_ids").coalesce(1).write.parquet(f"{path}/manifest")


def read_pieces(spark: SparkSession, path: str, value: Callable[[np.ndarray, int], object], kind: str, arrow: pa.DataType) -> DataFrame:
    """doc_id, start, doc_tokens, offset, length, value for every piece of a document.

    ``value`` is made from the piece's ids and the number of the document's ids behind it.
    """
    stored = spark.read.schema("data binary").parquet(f"{path}/table").first()["data"]
    table, table_crc = rans.Table.from_bytes(bytes(stored)), zlib.crc32(stored)
    names = ["doc_id", "start", "doc_tokens", "offset", "length", "value"]
    types = [*[pa.int64()] * 5, arrow]

    def rows(start: int, data: bytes) -> Iterator[tuple]:
        for doc_id, total, before, ids in unpack_block(data, table, table_crc):
            yield doc_id, start - before, total, before, len(ids), value(ids, total - before - len(ids))
            start += len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                columns = zip(*rows(start, data.as_py()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    files = spark.read.schema("part int, first_id long, n_ids long").parquet(f"{path}/manifest").select("part", "first_id")
    placed = blocks.join(files, "part").select((F.col("first_id") + F.col("start")).alias("start"), "data")
    return placed.mapInArrow(run, f"doc_id long, start long, doc_tokens long, offset long, length long, value {kind}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, doc_tokens, offset, length, ids (little-endian unsigned 32-bit) of every piece of a document."""
    return read_pieces(spark, path, lambda ids, _: ids.astype("<u4").tobytes(), "binary", pa.binary()).withColumnRenamed("value", "ids")


def _square(rows: list[int]) -> list[int]:
    return [_times(rows, x) for x in rows]


def _times(rows: list[int], vector: int) -> int:
    out = 0
    for i, row in enumerate(rows):
        if vector >> i & 1:
            out ^= row
    return out


@lru_cache(maxsize=1)
def _zero_bytes() -> list[list[int]]:
    """What 1, 2, 4, ... zero bytes do to a CRC-32, as matrices of bits."""
    one_bit = [0xEDB88320, *(1 << i for i in range(31))]
    out = [_square(_square(_square(one_bit)))]
    while len(out) < 48:
        out.append(_square(out[-1]))
    return out


def crc_before(crc: int, n_bytes: int) -> int:
    """What ``crc`` adds (by exclusive or) to the CRC-32 of a text that has ``n_bytes`` more behind it."""
    for i, rows in enumerate(_zero_bytes()):
        if n_bytes >> i & 1:
            crc = _times(rows, crc)
    return crc


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""

    def share(ids: np.ndarray, behind: int) -> int:
        return crc_before(zlib.crc32(ids.astype("<u4").tobytes()), 4 * behind)

    pieces = read_pieces(spark, path, share, "long", pa.int64())
    # only a document that goes on in another block has several pieces; start tells documents apart
    whole = pieces.groupBy("start", "doc_id").agg(F.sum("length").alias("n_tokens"), F.bit_xor("value").alias("ids_crc32"))
    return whole.select("doc_id", "start", "n_tokens", "ids_crc32")


def op13_token_files(docs: DataFrame) -> DataFrame:
    path = new_path(docs.sparkSession, "token-files")
    write_tokens(docs, path)
    return digests(docs.sparkSession, path)
