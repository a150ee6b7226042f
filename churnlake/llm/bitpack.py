"""Token ids in fixed-width bit packing.

A shard file holds consecutive documents: header, document table, block offsets,
payload. Each id takes ``bits = bit_length(vocabulary - 1)`` bits, little-endian
bit order; every block of ``BLOCK`` ids starts at a byte named in the offset
table, so a reader unpacks any range of ids with numpy from the blocks that it
touches. Shards are written below the shared folder by the tasks of a range
partitioning on doc_id and committed by a manifest: files of failed or repeated
attempts are not in it and are never read.

    header     magic "BPK1", bits u32, block ids u32, documents u64, ids u64, blocks u64
    documents  doc_id i64 each, known u8 each, first id u64 each and the end
    blocks     byte offset in the payload u64 each and the end
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.llm.common import materialise
from churnlake.session import scratch_path

BLOCK = 16_384
SHARD_CHARS = 16_000_000
_HEAD = struct.Struct("<4sIIQQQ")
_MAGIC = b"BPK1"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_block(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (unsigned, below 2**bits) as consecutive ``bits``-wide numbers."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    wide = np.unpackbits(raw, axis=1, bitorder="little")[:, :bits]
    return np.packbits(wide.reshape(-1), bitorder="little").tobytes()


def unpack(data, bits: int, first: int, count: int) -> np.ndarray:
    """``count`` numbers from the ``first`` on, as unsigned 32-bit integers."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count, first * bits // 8).astype("<u4")
    at = np.arange(first, first + count, dtype=np.int64) * bits
    raw = np.frombuffer(data, np.uint8)
    lo, hi = int(at[0] >> 3) if count else 0, int((at[-1] + bits + 7) >> 3) if count else 0
    near = np.concatenate([raw[lo:hi], np.zeros(8, np.uint8)])
    byte = (at >> 3) - lo
    word = np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        word |= near[byte + k].astype(np.uint64) << np.uint64(8 * k)
    word >>= (at & 7).astype(np.uint64)
    return (word & np.uint64((1 << bits) - 1)).astype("<u4")


def shard_bytes(doc_ids: list, lengths: list[int], ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """The file of consecutive documents; ``ids`` holds all their ids."""
    starts = np.zeros(len(lengths) + 1, "<u8")
    np.cumsum(lengths, out=starts[1:], dtype="<u8")
    blocks = [pack_block(ids[i:i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.zeros(len(blocks) + 1, "<u8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:], dtype="<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    head = _HEAD.pack(_MAGIC, bits, block, len(doc_ids), len(ids), len(blocks))
    return b"".join([head, numbers.tobytes(), known.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """Reader of a shard from any buffer (bytes or a memory map)."""

    def __init__(self, data):
        magic, self.bits, self.block, docs, self.n_ids, blocks = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.known = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
        at += 9 * docs
        self.starts = np.frombuffer(data, "<u8", docs + 1, at).astype(np.int64)
        at += 8 * (docs + 1)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64)
        self.payload = memoryview(data)[at + 8 * (blocks + 1):]

    def ids(self, first: int, stop: int) -> np.ndarray:
        """Ids ``first`` to ``stop`` of the shard, from the blocks they lie in."""
        stop = min(stop, self.n_ids)
        out = [np.zeros(0, "<u4")]
        while first < stop:
            b = first // self.block
            upto = min(stop, (b + 1) * self.block)
            part = self.payload[self.offsets[b]:self.offsets[b + 1]]
            out.append(unpack(part, self.bits, first - b * self.block, upto - first))
            first = upto
        return np.concatenate(out)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def _store(root: str):
    """A writer's file system and path for a folder that all executors share."""
    from pyarrow import fs
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def write(docs: DataFrame, root: str, tokenizer_path: str, kind: str, end_id: int, bits: int,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write every document's ids in ascending doc_id order (nulls first) as
    shards below ``root``; returns the manifest
    ``(file, first_doc, known, n_docs, n_ids)``, one row per shard."""
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // SHARD_CHARS))

    def run(batches):
        from churnlake.llm.encode import encoder
        enc, end = encoder(tokenizer_path, kind), end_id.to_bytes(4, "little")
        names, lengths, parts = [], [], []
        for b in batches:
            lot = []
            for i, ids in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1))):
                ids += end
                names.append(i)
                lengths.append(len(ids) // 4)
                lot.append(ids)
            # 32-bit ids are dropped batch by batch; the shard keeps what it needs
            parts.append(np.frombuffer(b"".join(lot), "<u4").astype("<u2" if bits <= 16 else "<u4"))
        enc.rest()
        if names:
            ids = np.concatenate(parts)
            fs, path = _store(root)
            file = f"tokens-{uuid.uuid4().hex}.bpk"
            with fs.open_output_stream(f"{path}/{file}") as f:
                f.write(shard_bytes(names, lengths, ids, bits))
            yield pa.RecordBatch.from_pylist(
                [{"file": file, "first_doc": names[0], "known": names[0] is not None, "n_docs": len(names),
                  "n_ids": len(ids)}],
                pa.schema([("file", pa.string()), ("first_doc", pa.int64()), ("known", pa.bool_()),
                           ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    done = (d.repartitionByRange(int(shards), F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
            .mapInArrow(run, "file string, first_doc long, known boolean, n_docs long, n_ids long"))
    return materialise(done, "manifest")


def read(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Per document of the committed shards: ``doc_id, start, n_tokens,
    ids_crc32, shard``; ``start`` counts the ids of all documents before it."""

    def run(batches):
        for b in batches:
            for path, data in zip(b.column(0).to_pylist(), b.column(1)):
                s = Shard(data.as_buffer())
                ids = s.ids(0, s.n_ids)
                at = s.starts
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(at[:-1], at[1:])]
                n = len(s.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rsplit("/", 1)[-1]] * n, pa.string()),
                     pa.array(s.doc_ids, pa.int64(), mask=s.known == 0),
                     pa.array(at[:-1], pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                    ["file", "doc_id", "first", "n_tokens", "ids_crc32"])

    w = Window.orderBy(F.col("known").asc(), "first_doc").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard of many thousand documents
    base = manifest.select("file", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bpk").load(root).select("path", "content")
    got = files.mapInArrow(run, "file string, doc_id long, first long, n_tokens long, ids_crc32 long")
    return got.join(base, "file").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens",
                                         "ids_crc32", F.col("file").alias("shard"))


def roundtrip(docs: DataFrame, tokenizer_path: str, kind: str = "byte", end_id: int = 2,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, write and read back every whole document.

    Null and empty texts hold the end id alone. Documents with a null id come
    first; rows that repeat an id keep their own entries, one after another in
    any order. An empty table gives no rows; other columns are not read."""
    from churnlake.llm.encode import encoder
    spark = docs.sparkSession
    bits = bits_for(max(encoder(tokenizer_path, kind).vocab_size(), end_id + 1))
    root = scratch_path(spark, "tokens")
    manifest = write(docs, root, tokenizer_path, kind, end_id, bits, doc_id, text)
    if manifest.isEmpty():  # no shard, nothing to load
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, shard string")
    return read(spark, root, manifest)
