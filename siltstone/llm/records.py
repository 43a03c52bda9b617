"""Token ids as length-delimited binary records with an offset index (operator 3).

A file ``part-NNNNN.ids`` is a row of frames:

    length of the payload     unsigned 64 bits
    masked CRC of the length  unsigned 32 bits
    payload                   document id (signed 64 bits), 1 if the id is null else 0,
                              width of an id in bytes, the ids
    masked CRC of the payload unsigned 32 bits

All integers are little-endian. The mask turns a CRC-32 right by 15 bits and adds a
constant, so that a checksum of data holding checksums stays telling.
``part-NNNNN.idx`` has one entry of 24 bytes per frame: its offset, its length and
its number of ids, for reads in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.bytesets import blocks, texts_of
from siltstone.llm.files import Staged, read_range
from siltstone.llm.pieces import encoder

_HEAD = struct.Struct("<QI")
_LEAD = struct.Struct("<qBB")
_TAIL = struct.Struct("<I")
_ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("tokens", "<u8")])
_MASK = 0xA282EAD8
#: Frames are listed in the manifest by runs of about so many bytes.
RUN = 4 << 20

_MANIFEST = "file string, run int, begin bigint, length bigint, records bigint, tokens bigint"


def masked(data: bytes) -> int:
    """CRC-32, turned and shifted by a constant."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """One document as a frame."""
    payload = _LEAD.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + _TAIL.pack(masked(length)) + payload + _TAIL.pack(masked(payload))


def frames(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a run of frames; a broken one raises an error."""
    at = 0
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError(f"frame at {at} is cut off")
        length, crc = _HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != crc or at + _HEAD.size + length + 4 > len(data):
            raise ValueError(f"frame at {at} has a broken length")
        payload = data[at + _HEAD.size : at + _HEAD.size + length]
        if masked(payload) != _TAIL.unpack_from(data, at + _HEAD.size + length)[0]:
            raise ValueError(f"frame at {at} has a broken payload")
        doc_id, null, width = _LEAD.unpack_from(payload)
        yield None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=_LEAD.size)
        at += _HEAD.size + length + 4


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text and write the files in ascending id order; returns the manifest.

    Documents are dealt by ranges of the id, so part after part is the whole order;
    a null id comes first, repeated ids stand in the order of their texts' hashes.
    A null or empty text is a record of the end id alone. Other columns are ignored.
    The manifest has a row per run of frames and is itself kept in ``folder``.
    """
    spark = docs.sparkSession
    placed = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    data = f"{folder}/data"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        width = 2 if max(own.library.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        name = f"part-{TaskContext.get().partitionId():010d}"
        out = index = None
        rows: list[list] = []
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            for a, b in blocks(texts, RUN):
                if out is None:
                    out, index = Staged(data, f"{name}.ids"), Staged(data, f"{name}.idx")
                made, begin = [], out.size
                for doc_id, got in zip(ids[a:b], own.encode(texts[a:b])):
                    made.append((frame(doc_id, np.append(got, end_id), width), len(got) + 1))
                entry = np.zeros(len(made), _ENTRY)
                entry["length"] = [len(f) for f, _ in made]
                entry["offset"] = begin + np.cumsum(entry["length"]) - entry["length"]
                entry["tokens"] = [n for _, n in made]
                out.write(f for f, _ in made)
                index.write([entry.tobytes()])
                rows.append(
                    [name, len(rows), begin, out.size - begin, b - a, int(entry["tokens"].sum())]
                )
        if out is not None:
            index.publish()
            out.publish()
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("file", "run", "begin", "length", "records", "tokens"), r)) for r in rows],
                schema=_arrow_manifest(),
            )

    placed.mapInArrow(run, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _arrow_manifest() -> pa.Schema:
    names = ("begin", "length", "records", "tokens")
    return pa.schema(
        [("file", pa.string()), ("run", pa.int32())] + [(n, pa.int64()) for n in names]
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Read every file back: ``doc_id, start, n_tokens, ids_crc32``, a row per record.

    ``start`` counts the ids of all records before it; ``ids_crc32`` is the CRC-32 of the
    ids as little-endian unsigned 32-bit integers. Runs of frames are read in parallel.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    files = manifest.groupBy("file").agg(F.sum("tokens").alias("tokens"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = manifest.join(files, "file").select(
        "file",
        "begin",
        "length",
        (F.col("base") + F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).alias("start"),
    )
    # a number of partitions of its own: these rows are few and small, what they name is not
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = runs.repartition(tasks, F.xxhash64("file", "begin"))
    data = f"{folder}/data"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, start = [], row["start"]
                piece = read_range(data, f"{row['file']}.ids", row["begin"], row["length"])
                for doc_id, ids in frames(piece):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return spread.mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def shuffled_records(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """All records in an order drawn from ``seed``: ``place, doc_id, ids``.

    The offset index is dealt by a hash of file, entry and seed; each task then reads
    its frames one by one, sorted by that hash.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    per_file = manifest.groupBy("file").agg(F.sum("records").alias("records"))
    data = f"{folder}/data"

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = read_range(data, f"{row['file']}.idx", 0, row["records"] * _ENTRY.itemsize)
                found = np.frombuffer(raw, _ENTRY)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(found)),
                        pa.array(found["offset"].astype(np.int64)),
                        pa.array(found["length"].astype(np.int64)),
                    ],
                    ["file", "offset", "length"],
                )

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                piece = read_range(data, f"{row['file']}.ids", row["offset"], row["length"])
                doc_id, ids = next(frames(piece))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["place"]], pa.int64()),
                        pa.array([doc_id], pa.int64()),
                        pa.array([ids.astype(np.int64)], pa.list_(pa.int64())),
                    ],
                    ["place", "doc_id", "ids"],
                )

    index = per_file.mapInArrow(entries, "file string, offset bigint, length bigint")
    placed = index.withColumn("place", F.xxhash64(F.lit(seed), "file", "offset"))
    ordered = placed.repartitionByRange("place").sortWithinPartitions("place")
    return ordered.mapInArrow(load, "place bigint, doc_id bigint, ids array<bigint>")
