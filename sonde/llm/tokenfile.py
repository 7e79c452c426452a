"""Token id files: one zstandard frame per document, a shared dictionary and an offset index.

A data file is a run of independent frames in ascending document order; frames hold little-endian
ids of two bytes, or four where an id needs them.  The index names for every document the file,
the place and length of its frame, the id width, and the hash of the dictionary, so one short
document is read with one seek.  The index is a Parquet table and the only list of valid files:
what a lost or repeated task has left beside it is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonde.llm.frames import keyed, lists, real_id, sampled, slices
from sonde.llm.tokens import shared_encoder

END_ID, LEVEL = 1, 3

# Bounds of what the dictionary is trained on, and its size in bytes.
SAMPLE, SAMPLE_BYTES, DICTIONARY = 2000, 4096, 65_536

# Encoded words that a worker remembers: text is shuffled here, so memory is scarcer than elsewhere.
REMEMBERED = 250_000

# Text bytes of one data file, about.
FILE_BYTES = 64 << 20


def serialized(ids: bytes) -> tuple[int, bytes]:
    """Width and bytes of 32-bit ids in the file format."""
    values = np.frombuffer(ids, "<u4")
    if len(values) and int(values.max()) > 0xFFFF:
        return 4, ids
    return 2, values.astype("<u2").tobytes()


@dataclass
class Dictionary:
    data: bytes

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.data).hexdigest()

    def _loaded(self):
        return zstandard.ZstdCompressionDict(self.data) if self.data else None

    def compressor(self) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=self._loaded())

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._loaded())


def train(docs: DataFrame, path: str, end_id: int = END_ID, sample: int = SAMPLE) -> Dictionary:
    """Dictionary of about ``sample`` serialized documents, chosen by a hash of their ids.

    Of each, the first SAMPLE_BYTES of its serialized ids are used.  Where there is too little to
    train on, the samples themselves (or nothing) serve as dictionary.
    """
    stop = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = shared_encoder(path, "drop", REMEMBERED)
        for batch in slices(batches):
            ids, texts = lists(batch, "id", "text")
            data = [serialized(d + stop)[1][:SAMPLE_BYTES] for d in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                              pa.array(data, pa.binary())], ["id", "data"])
    rows = (sampled(keyed(docs, "text"), sample, "id")
            .mapInArrow(run, "id long, data binary").collect())
    samples = [bytes(r["data"]) for r in sorted(rows, key=lambda r: (r["id"], bytes(r["data"])))]
    try:
        return Dictionary(zstandard.train_dictionary(DICTIONARY, samples).as_bytes())
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY:]
        return Dictionary(raw if len(raw) >= 8 else b"")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID,
          file_bytes: int = FILE_BYTES) -> Dictionary:
    """Encode and write all documents in ascending doc_id order below ``folder``.

    Documents are dealt into ranges of ids first and encoded where they land, so ids are made
    once and each task writes its files on its own.  Equal ids are ordered by text.  Data files
    have fresh names; the index takes over only those of tasks that Spark committed.
    """
    spark = docs.sparkSession
    dictionary = train(docs, path, end_id)
    size = keyed(docs, "text").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // file_bytes))
    parts = max(parts, min(spark.sparkContext.defaultParallelism * 2, -(-size // (4 << 20)) or 1))
    rows = (keyed(docs, "text").repartitionByRange(parts, "id", F.length("text"), F.xxhash64("text"))
            .sortWithinPartitions("id", "text").withColumn("range", F.spark_partition_id()))
    stop = np.array([end_id], "<u4").tobytes()
    hashed = dictionary.hash

    def run(batches):
        encoder, squeeze = shared_encoder(path, "drop", REMEMBERED), dictionary.compressor()
        name, out, offset, line = None, None, 0, 0
        try:
            for batch in slices(batches):
                ids, texts, ranges = lists(batch, "id", "text", "range")
                rows = []
                for i, part, data in zip(ids, ranges, encoder.encode(texts)):
                    if out is None or offset >= file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"data-{part:06d}-{uuid.uuid4().hex}.ids", 0
                        files, base = _open(f"{folder}/data")
                        files.create_dir(base, recursive=True)
                        out = files.open_output_stream(f"{base}/{name}")
                    width, plain = serialized(data + stop)
                    frame = squeeze.compress(plain)
                    out.write(frame)
                    rows.append((i, part, line, name, offset, len(frame), width,
                                 len(plain) // width, hashed))
                    offset, line = offset + len(frame), line + 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
                         pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 9, kinds)],
                    ["id", "range", "line", "file", "offset", "bytes", "width", "n_tokens",
                     "dictionary"])
        finally:
            if out is not None:
                out.close()
    index = rows.mapInArrow(run, "id long, range int, line long, file string, offset long, "
                                 "bytes long, width int, n_tokens long, dictionary string")
    index.write.option("compression", "zstd").parquet(f"{folder}/index")
    spark.createDataFrame([(hashed, bytearray(dictionary.data))], "hash string, data binary").write.parquet(
        f"{folder}/dictionary")
    return dictionary


def _frames(spark: SparkSession, folder: str):
    """Rows of the index with their place, in file order, and what turns them into ids in a task."""
    index = spark.read.parquet(f"{folder}/index")
    data = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary = Dictionary(bytes(data["data"]))
    # One row per range of ids: as many as files, not documents.
    totals = index.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("line").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = (index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(totals, "range").withColumn("start", F.col("inside") + F.col("before"))
              .sortWithinPartitions("file", "offset"))

    def decoded(batches):
        """For each short batch: its columns id and start, and the ids of every document."""
        expand, name, stream = dictionary.decompressor(), None, None
        try:
            for batch in slices(batches):
                names, offsets, sizes, widths, hashes = lists(
                    batch, "file", "offset", "bytes", "width", "dictionary")
                out = []
                for file, offset, size, width, hashed in zip(names, offsets, sizes, widths, hashes):
                    if hashed != dictionary.hash:
                        raise ValueError(f"{file} was written with another dictionary")
                    if file != name:
                        if stream is not None:
                            stream.close()
                        files, base = _open(f"{folder}/data")
                        stream, name = files.open_input_file(f"{base}/{file}"), file
                    stream.seek(offset)
                    plain = expand.decompress(stream.read(size))
                    out.append(np.frombuffer(plain, f"<u{width}").astype("<u4").tobytes())
                yield batch.column(0), batch.column(1), out
        finally:
            if stream is not None:
                stream.close()
    return placed.select("id", "start", "file", "offset", "bytes", "width", "dictionary"), decoded


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids): every document read back; start counts the ids before it.

    Frames are taken in file order, one open file at a time.  A dictionary that does not have the
    index's hash is an error.
    """
    placed, decoded = _frames(spark, folder)

    def run(batches):
        for ids, starts, out in decoded(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, starts, pa.array([len(d) // 4 for d in out], pa.int64()),
                 pa.array(out, pa.binary())], ["id", "start", "n_tokens", "ids"])
    return placed.mapInArrow(run, "id long, start long, n_tokens long, ids binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    Sums are taken where frames are read, so ids do not leave the task's worker.  A null text was
    written as empty: the end id alone.  A null doc_id sorts first; repeated rows were written as
    often as they came.
    """
    placed, decoded = _frames(spark, folder)

    def run(batches):
        for ids, starts, out in decoded(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, starts, pa.array([len(d) // 4 for d in out], pa.int64()),
                 pa.array([zlib.crc32(d) for d in out], pa.int64())],
                ["id", "start", "n_tokens", "ids_crc32"])
    return (placed.mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
            .select(real_id().alias("doc_id"), "start", "n_tokens", "ids_crc32"))
