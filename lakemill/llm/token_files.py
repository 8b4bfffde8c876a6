"""Token ids in files that can be opened at any document.

A file is a run of segments, each ended by a newline. A segment holds documents in ascending
order of their ids:

    magic "LMTOK1\\n\\0", sha-256 of the dictionary, number of documents (u32), length of the body
    (u64), crc-32 of the index (u32), then the index: for each document its id (i64), the number
    of ids of all documents before it (u64), its number of ids (u32), the offset and the length of
    its frame in the body (u64, u32); then the body: a zstandard frame for each document, made with
    the shared dictionary, of its ids as little-endian unsigned 32-bit numbers.

Documents without an id come after all others, in files and segments of their own with the magic
"LMTOK1\\n\\1". All numbers are little-endian. A reader finds a document in the index and inflates that frame
alone. The dictionary is trained on id arrays of a bounded sample and stored once beside the
files. Files are written and read by Spark's own sources, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemill.llm.common import drawn, prepare, text_of
from lakemill.llm.tokens import END_ID, Encoder
from lakemill.session import fresh_folder, settle

MAGIC = b"LMTOK1\n\x00"
#: Begins a segment of documents without an id, whose index entries have 0 in its place.
UNNAMED = b"LMTOK1\n\x01"
HEAD = struct.Struct("<8s32sIQI")
ENTRY = np.dtype([("doc_id", "<i8"), ("start", "<u8"), ("n", "<u4"), ("offset", "<u8"), ("size", "<u4")])
LEVEL = 3
DICTIONARY_BYTES = 1 << 16
#: The dictionary is trained on this many documents at most, the first by a hash of the row, and
#: on this many ids of each at most; all other work covers every document.
SAMPLE_ROWS = 1_000
SAMPLE_IDS = 2_000
#: Documents and bytes of frames after which a segment ends.
SEGMENT_ROWS = 4_096
SEGMENT_BYTES = 4 << 20
#: Files whose starts one task adds up.
FILE_BLOCK = 4_096
#: Bytes of frames that a file aims at; a parameter, as a large corpus wants larger files.
FILE_BYTES = 2 << 20


@dataclass(frozen=True)
class TokenFiles:
    """The folder with the files, and the folder with the dictionary."""

    files: str
    dictionary: str


def train_dictionary(docs: DataFrame, tokenizer: str, text: str = "text") -> bytes:
    """A zstandard dictionary for id arrays; a raw one of common ids if the sample is too small."""
    some = docs.select("doc_id", text_of(text).alias("text")).where("text <> ''")
    rows = drawn(some, SAMPLE_ROWS).select(F.substring("text", 1, 4 * SAMPLE_IDS).alias("text")).collect()
    ids = Encoder(tokenizer).encode([r.text for r in rows], END_ID)
    samples = [x[:SAMPLE_IDS].astype("<u4").tobytes() for x in ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        common = np.unique(np.concatenate([*ids, np.array([END_ID], np.uint32)]))
        return common.astype("<u4").tobytes()


def _segment(dictionary_hash: bytes, entries: list[tuple[int, int, int]], frames: list[bytes], magic: bytes = MAGIC) -> bytes:
    index = np.zeros(len(entries), ENTRY)
    sizes = np.array([len(f) for f in frames], np.int64)
    for name, values in zip(("doc_id", "start", "n"), zip(*entries)):
        index[name] = values
    index["offset"], index["size"] = np.cumsum(sizes) - sizes, sizes
    raw = index.tobytes()
    return HEAD.pack(magic, dictionary_hash, len(entries), int(sizes.sum()), zlib.crc32(raw)) + raw + b"".join(frames)


def segments(data: bytes) -> Iterator[tuple[bytes, np.ndarray, memoryview, bool]]:
    """(dictionary hash, index, body, if its documents have ids) of each segment of a file."""
    at, view = 0, memoryview(data)
    while at < len(data):
        magic, dictionary_hash, n, size, crc = HEAD.unpack_from(data, at)
        at += HEAD.size
        raw = view[at : at + n * ENTRY.itemsize]
        if magic not in (MAGIC, UNNAMED) or zlib.crc32(raw) != crc or at + len(raw) + size >= len(data):
            raise ValueError(f"damaged token file before byte {at}")
        at += len(raw)
        yield dictionary_hash, np.frombuffer(raw, ENTRY), view[at : at + size], magic == MAGIC
        at += size + 1  # the newline


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def read_document(data: bytes, dictionary: bytes, doc_id: int) -> np.ndarray | None:
    """The ids of one document of a file, from its frame alone; None if the file has no such."""
    for used, index, body, named in segments(data):
        if used != hashlib.sha256(dictionary).digest():
            raise ValueError("written with another dictionary")
        if not named:
            continue
        k = int(np.searchsorted(index["doc_id"], doc_id))
        if k < len(index) and index["doc_id"][k] == doc_id:
            frame = body[index["offset"][k] : index["offset"][k] + index["size"][k]]
            return np.frombuffer(_decompressor(dictionary).decompress(frame), "<u4")
    return None


def _raw(df: DataFrame, column: str, path: str) -> None:
    """Writes one binary value a line; the bytes are kept as they are."""
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def write(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", file_bytes: int = FILE_BYTES, unnamed: bool = False) -> TokenFiles:
    """Encodes every whole text (null: empty) and writes it, with the end id, in ascending id order.

    Repeated ids stand side by side, in any order; an id with very many rows fills several files. A row
    with a null id cannot be found by it: such rows are refused, or with `unnamed` written after all
    others, dealt over files of their own. An empty table writes no segment.
    """
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    dictionary = train_dictionary(source, tokenizer)
    digest = hashlib.sha256(dictionary).digest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, mix = Encoder(tokenizer), np.random.default_rng()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        for b in batches:
            if b.column(0).null_count and not unnamed:
                raise ValueError("a document without an id")
            ids = words.encode(b.column(1).to_pylist(), END_ID)
            frames = [packer.compress(x.astype("<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(mix.random(len(ids))), pa.array([len(x) for x in ids], pa.int64()), pa.array(frames, pa.binary())],
                names=["doc_id", "salt", "n", "frame"],
            )

    # The salt deals rows of one id over the files of that id; it is stored, so it stays the same.
    framed = settle(source.mapInArrow(encode, "doc_id long, salt double, n long, frame binary"), "token-frames")
    sizes = {r[0]: r[1] or 0 for r in framed.groupBy(F.col("doc_id").isNull()).agg(F.sum(F.octet_length("frame"))).collect()}  # at most two
    files, apart = max(1, -(-sizes.get(False, 0) // file_bytes)), max(1, -(-sizes.get(True, 0) // file_bytes))
    # The last id of each file but one, found once. An id that ends several files has all of them.
    bounds = framed.stat.approxQuantile("doc_id", [k / files for k in range(1, files)], 0.2 / files) if files > 1 else []
    cuts = np.sort(np.array(bounds, np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def file_of(doc_id: pd.Series, salt: pd.Series) -> pd.Series:
        low = np.searchsorted(cuts, doc_id.to_numpy(), "left")
        several = np.maximum(np.searchsorted(cuts, doc_id.to_numpy(), "right") - low, 1)
        return pd.Series((low + (salt.to_numpy() * several).astype(np.int64)).astype(np.int32))

    after = F.lit(len(cuts) + 1) + F.floor(F.col("salt") * apart).cast("int")
    named = file_of(F.coalesce("doc_id", F.lit(0).cast("long")), "salt")
    placed = framed.withColumn("file", F.when(F.col("doc_id").isNull(), after).otherwise(named))
    totals = placed.groupBy("file").agg(F.sum("n").alias("n")).withColumn("block", F.floor(F.col("file") / FILE_BLOCK))
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("earlier"))  # a row for thousands of files
    within = F.sum("n").over(Window.partitionBy("block").orderBy("file")) - F.col("n")
    before = totals.withColumn("within", within).join(blocks, "block").select("file", (F.col("within") + F.col("earlier")).alias("before"))
    before = settle(before, "file-starts")
    ordered = placed.join(before, "file").select("file", "before", "doc_id", "n", "frame")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, start, entries, frames, held, magic = None, 0, [], [], 0, MAGIC
        for b in batches:
            for f, before, doc, n, frame in zip(*[c.to_pylist() for c in b.columns]):
                if f != file or held >= SEGMENT_BYTES or len(frames) >= SEGMENT_ROWS:
                    if frames:
                        yield pa.RecordBatch.from_arrays([pa.array([_segment(digest, entries, frames, magic)], pa.binary())], names=["segment"])
                    entries, frames, held = [], [], 0
                    if f != file:
                        file, start, magic = f, before, MAGIC if f <= len(cuts) else UNNAMED
                entries.append((0 if doc is None else doc, start, n))
                frames.append(frame)
                start += n
                held += len(frame)
        if frames:
            yield pa.RecordBatch.from_arrays([pa.array([_segment(digest, entries, frames, magic)], pa.binary())], names=["segment"])

    out = TokenFiles(fresh_folder(spark, "token-files"), fresh_folder(spark, "token-dictionary"))
    dealt = ordered.repartition(len(cuts) + 1 + (apart if True in sizes else 0), "file").sortWithinPartitions("file", "doc_id", "frame")
    _raw(dealt.mapInArrow(lay, "segment binary"), "segment", out.files)
    _raw(spark.createDataFrame([(bytearray(dictionary),)], "value binary").coalesce(1), "value", out.dictionary)
    return out


def read(spark: SparkSession, stored: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files; ids as little-endian u32, doc_id null without one."""
    prepare(spark, 1)  # a row is a whole file
    dictionary = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(stored.dictionary).select("content").collect())[:-1]
    digest = hashlib.sha256(dictionary).digest()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = _decompressor(dictionary)
        for b in batches:
            for data in b.column(0):
                for used, index, body, named in segments(data.as_buffer().to_pybytes()):
                    if used != digest:
                        raise ValueError("written with another dictionary")
                    for lo in range(0, len(index), 512):
                        part = index[lo : lo + 512]
                        ids = [inflate.decompress(body[o : o + s]) for o, s in zip(part["offset"].tolist(), part["size"].tolist())]
                        if [len(x) // 4 for x in ids] != part["n"].tolist():
                            raise ValueError("a document's length differs from the index")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part["doc_id"].astype(np.int64)) if named else pa.nulls(len(part), pa.int64()),
                                pa.array(part["start"].astype(np.int64)),
                                pa.array(part["n"].astype(np.int64)),
                                pa.array(ids, pa.binary()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids"],
                        )

    stored_files = spark.read.format("binaryFile").load(stored.files).select("content")
    return stored_files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
