"""Token files: length-delimited binary records with an offset index.

Documents are tokenised with a public word-level BPE vocabulary (a path
parameter) and written in ascending doc_id order, one file ("shard") per range
of ids. A record is framed as

    length    8 bytes, unsigned, little-endian: bytes of the payload
    check     4 bytes: masked CRC-32C of the length field
    payload   1 byte bytes per token id (2 or 4, by the vocabulary's size),
              1 byte 1 if the document has an id, 8 bytes signed doc_id (0 if
              none), then the token ids, little-endian, end id included
    check     4 bytes: masked CRC-32C of the payload

(masking: rotate right by 15 bits, add a constant, so that a checksum stored in
checked data is harmless). The framing is that of common record files, so their
readers can walk a shard.

The index is a Parquet table beside the shards, one row per record: doc_id,
shard, file, record number, byte offset and size, tokens of the shard before
it, tokens. Readers go through it: in file order with few large reads, or in a
seeded global shuffle, where each record is one ranged read. Every read checks
both checksums and the shard's own record length.

Recovery: a task writes its shard under a name that carries the task attempt
and returns the index rows, which Spark commits; only files named by committed
rows are ever read, so a lost or doubled attempt leaves at most an unread file.
Shard count follows the bytes of text (SHARD_BYTES each). Files are written
with pyarrow's file systems (local and shared mounts, HDFS and the object
stores it knows) below a folder that all executors share.

Edge cases: a null or empty text is a record with the end id alone; null
doc_ids come first; repeated ids stay, in input order; the row number breaks
ties of the range partitioning, so one id holding a third of all rows is split;
other columns are not read; an empty table gives an empty index and no shard.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewise.session import scratch_path

from .common import frees, worker_cache
from .packing import WordEncoder, default_vocabulary

END_ID = 2
SHARD_BYTES = 32 << 20
READ_BYTES = 2 << 20                   # one read of neighbouring records
HEAD = "<BBq"               # of a payload
_FRAME = 16                            # bytes of a frame around its payload
INDEX_SCHEMA = ("doc_id long, shard int, file string, record long, offset long, size long, "
                "tokens_before long, n_tokens long")


# ------------------------------------------------------------------ checksums
_BLOCK = 512
_MASK_DELTA = 0xA282EAD8               # fixed value of the masking


@functools.lru_cache(1)
def _crc_tables() -> np.ndarray:
    """T[z, b]: CRC-32C state (start 0) of byte b followed by z zero bytes."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1)
    out = np.empty((_BLOCK, 256), np.uint32)
    out[0] = t
    for z in range(1, _BLOCK):
        out[z] = (out[z - 1] >> 8) ^ t[out[z - 1] & 0xFF]
    return out


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message (4 bytes at least). Messages are padded in front
    to whole blocks (leading zeros leave a zero state alone); all blocks are
    looked up at once and then chained block by block over all messages."""
    table = _crc_tables()
    sizes = np.array([len(m) for m in messages], np.int64)
    blocks = -(-sizes // _BLOCK)
    ends = np.cumsum(blocks)
    data = np.zeros(int(ends[-1]) * _BLOCK if len(ends) else 0, np.uint8)
    for m, end, size in zip(messages, (ends * _BLOCK).tolist(), sizes.tolist()):
        data[end - size:end] = np.frombuffer(m, np.uint8)
        data[end - size:end - size + 4] ^= 0xFF             # the start value, all ones
    flat = table.ravel()
    place = (np.arange(_BLOCK - 1, -1, -1, dtype=np.int32) * 256)[None, :]
    own = np.empty(len(data) // _BLOCK, np.uint32)
    data = data.reshape(-1, _BLOCK)
    for at in range(0, len(data), 1024):
        own[at:at + 1024] = np.bitwise_xor.reduce(flat[place + data[at:at + 1024]], axis=1)
    state = np.zeros(len(messages), np.uint32)
    order = np.argsort(-blocks, kind="stable")               # longest first: the active ones are a prefix
    active, first = blocks[order], (ends - blocks)[order]
    for k in range(int(active[0]) if len(active) else 0):
        live = int(np.searchsorted(-active, -k, side="left"))
        s = state[:live]
        shifted = (table[_BLOCK - 1, s & 0xFF] ^ table[_BLOCK - 2, (s >> 8) & 0xFF]
                   ^ table[_BLOCK - 3, (s >> 16) & 0xFF] ^ table[_BLOCK - 4, s >> 24])
        state[:live] = shifted ^ own[first[:live] + k]
    out = np.empty(len(messages), np.uint32)
    out[order] = ~state
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(_MASK_DELTA)


# --------------------------------------------------------------------- frames
def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads = masked(crc32c(lengths)).astype("<u4").tobytes()
    tails = masked(crc32c(payloads)).astype("<u4").tobytes()
    return [b"".join((n, heads[4 * i:4 * i + 4], p, tails[4 * i:4 * i + 4]))
            for i, (n, p) in enumerate(zip(lengths, payloads))]


def payloads(framed: list[bytes]) -> list[bytes]:
    """The payloads of whole frames; a wrong length or checksum raises."""
    out = [f[12:-4] for f in framed]
    for f, p in zip(framed, out):
        if len(f) < _FRAME or struct.unpack_from("<Q", f)[0] != len(p):
            raise ValueError("record length does not match the index")
    stored = np.frombuffer(b"".join(f[8:12] + f[-4:] for f in framed), "<u4").reshape(-1, 2)
    if not (np.array_equal(masked(crc32c([f[:8] for f in framed])), stored[:, 0])
            and np.array_equal(masked(crc32c(out)), stored[:, 1])):
        raise ValueError("record checksum does not match")
    return out


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI (file:/x and /x are local)."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


# -------------------------------------------------------------------- writing
def _write(folder: str, vocabulary: str, end_id: int):
    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache("packing")
        if vocabulary not in cache:
            cache[vocabulary] = WordEncoder(vocabulary)
        encoder = cache[vocabulary]
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        task = TaskContext.get()
        shard = task.partitionId()
        name = f"shard-{shard:06d}-{task.taskAttemptId()}.rec"
        system, path = _open(folder)
        out, record, offset, before = None, 0, 0, 0
        try:
            for batch in batches:
                encoded = zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)))
                for _ in range(0, len(batch), 256):
                    ids, data, counts = [], [], []
                    for doc, own in islice(encoded, 256):
                        ids.append(doc)
                        counts.append(len(own) + 1)
                        data.append(struct.pack(HEAD, width, doc is not None, doc or 0)
                                    + np.append(own, np.uint32(end_id)).astype(f"<u{width}").tobytes())
                    if out is None:
                        system.create_dir(path, recursive=True)
                        out = system.open_output_stream(f"{path}/{name}")
                    framed = frames(data)
                    out.write(b"".join(framed))
                    sizes, counts = np.array([len(f) for f in framed], np.int64), np.array(counts, np.int64)
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([name] * n),
                         pa.array(np.arange(record, record + n)), pa.array(offset + np.cumsum(sizes) - sizes),
                         pa.array(sizes), pa.array(before + np.cumsum(counts) - counts), pa.array(counts)],
                        names=["doc_id", "shard", "file", "record", "offset", "size", "tokens_before", "n_tokens"])
                    record, offset, before = record + n, offset + int(sizes.sum()), before + int(counts.sum())
        finally:
            if out is not None:
                out.close()

    return run


def write_records(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Write ``docs`` as shards under ``folder``/shards and their index under
    ``folder``/index."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    ordered = (rows.withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row"))
    index = ordered.select("doc_id", "text").mapInArrow(
        _write(f"{folder}/shards", vocabulary or default_vocabulary(), end_id), INDEX_SCHEMA)
    index.write.mode("overwrite").parquet(f"{folder}/index")


# -------------------------------------------------------------------- reading
def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``: tokens of all records before, over all shards."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    starts = sizes.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return index.join(starts, "shard").withColumn("start", F.col("_start") + F.col("tokens_before")).drop("_start")


def _read(folder: str, with_ids: bool):
    """mapInArrow over index rows (file, offset, size, start): neighbouring
    records of a file come in one read."""

    @frees
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("none")
        system, path = _open(folder)
        name, source = None, None
        for batch in batches:
            rows = list(zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(),
                            batch.column("size").to_pylist(), batch.column("start").to_pylist()))
            at = 0
            while at < len(rows):
                file, offset, size, _ = rows[at]
                stop, span = at + 1, size
                while (stop < len(rows) and rows[stop][0] == file and rows[stop][1] == offset + span
                       and span + rows[stop][2] <= READ_BYTES):
                    span += rows[stop][2]
                    stop += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{path}/{file}")
                raw = source.read_at(span, offset)
                doc, start, n, crc, kept = [], [], [], [], []
                framed = [raw[r[1] - offset:r[1] - offset + r[2]] for r in rows[at:stop]]
                for p, r in zip(payloads(framed), rows[at:stop]):
                    width, has_id, doc_id = struct.unpack_from(HEAD, p)
                    ids = np.frombuffer(p, f"<u{width}", offset=struct.calcsize(HEAD)).astype("<u4").tobytes()
                    doc.append(doc_id if has_id else None)
                    start.append(r[3])
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    if with_ids:
                        kept.append(ids)
                columns = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = stop
        if source is not None:
            source.close()

    return run


def read_records(spark: SparkSession, folder: str, seed: int | None = None, with_ids: bool = False) -> DataFrame:
    """Per record, from the shards: doc_id, start, n_tokens, ids_crc32 and, on
    request, ids (little-endian unsigned 32-bit). Without ``seed`` in file
    order, one task per shard; with it in a global shuffle of all records that
    the seed fixes."""
    index = read_index(spark, folder)
    shards = (spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index").agg(F.max("shard")).first()[0] or 0) + 1
    if seed is None:
        order = ["shard", "record"]
    else:
        index, order = index.withColumn("_key", F.xxhash64(F.lit(seed), "shard", "record")), ["_key", "shard", "record"]
    dealt = index.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return dealt.select("file", "offset", "size", "start").mapInArrow(_read(f"{folder}/shards", with_ids), schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """Write ``docs`` and read them back from the files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, f"records/{uuid.uuid4().hex}")
    write_records(docs, folder)
    return read_records(spark, folder)
