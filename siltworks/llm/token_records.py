"""Token ids as length-delimited binary records with a separate offset index.

A shard file is a run of records, each framed as

    length  unsigned 64-bit, of the payload in bytes
    masked CRC-32 of those eight bytes
    payload the document id (signed 64-bit), then its token ids
    masked CRC-32 of the payload

all little-endian. Ids take 16 bits where the vocabulary allows it, else 32. A masked checksum is rotated
and moved by a constant, so that checksums of data that hold checksums stay meaningful.

The index is a Parquet table beside the shards: file, offset and length of each record, in order. It is what
commits a write: shard files get unique names, and only those of task attempts that Spark accepted are in
the index, so a lost executor leaves at most a file that nothing refers to. Sequential and shuffled readers
both start from it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions, whole_numbers, work_folder
from .vector import LOWER, PieceCache, binary, per_text, slices, words

HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<I")
ID = struct.Struct("<q")
MASK = 0xA282EAD8  # fixed value
# Pieces cost more here than elsewhere, so a worker keeps more of them.
CACHED_PIECES = 200_000
INDEX = "doc_id bigint, shard int, file string, offset bigint, length bigint, n_tokens bigint, shard_start bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return HEAD.pack(len(payload), masked(length)) + payload + TAIL.pack(masked(payload))


def unframe(record: bytes) -> bytes:
    """The payload of one framed record; an error if a length or checksum is wrong."""
    length, crc = HEAD.unpack_from(record)
    payload = record[HEAD.size : -TAIL.size]
    if crc != masked(record[:8]) or length != len(payload):
        raise ValueError("a record's length is damaged")
    if TAIL.unpack(record[-TAIL.size :])[0] != masked(payload):
        raise ValueError("a record's content is damaged")
    return payload


def record_of(doc_id: int | None, ids: bytes) -> bytes:
    return frame(ID.pack(doc_id or 0) + ids)


def document_of(record: bytes, width: int) -> tuple[int, bytes]:
    """The document id and the ids as 32-bit integers of a framed record."""
    payload = unframe(record)
    return ID.unpack_from(payload)[0], np.frombuffer(payload, f"<u{width}", offset=ID.size).astype("<u4").tobytes()


# Between a letter, a sign and a digit a pre-token ends, whatever else is around, and between two digits. Signs
# that contractions and special tokens hold are none of these, nor are bytes of characters beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = 2
_CLASS[list(b"0123456789")] = 3
_ENDS = np.array([[a and b and (a != b or a == 3) for b in range(4)] for a in range(4)], bool).ravel()
# The letters U+00C0 to U+00FF begin with this byte; two of that range are signs.
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts that this kind of tokenizer encodes each by itself, and each text's first one.

    It drops white space and lower-cases. Lower-casing ASCII beforehand makes pieces repeat more; text that
    may hold a special token, which is found before that, is left as it is.
    """
    kind = _CLASS[data]
    latin = np.flatnonzero(data == _LATIN)
    latin = latin[~np.isin(data[latin + 1], _SIGNS)]
    kind[latin] = kind[latin + 1] = 1
    cuts = np.append(False, _ENDS[kind[:-1] << 2 | kind[1:]])[: len(data)]
    return words(data if b"<|" in data.tobytes() else LOWER[data], offsets, cuts)


@lru_cache(4)
def word_encoder(path: str) -> PieceCache:
    """Ids of pieces. A word of plain Latin letters is one pre-token and goes to the model directly."""
    import unicodedata

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model = tokenizer.model
    # The rule of byte-level vocabularies: printable bytes stand for themselves, others are moved up in order.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = iter(range(0x100, 0x200))
    table = {b: chr(b if b in shown else next(moved)) for b in range(256)}
    tokenize = model.tokenize

    def encode(pieces: list[bytes]) -> list[tuple]:
        out: list = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            text = piece.decode("utf-8")
            if text.isascii():
                plain = text.lower() if text.isalpha() else None
            else:
                low = unicodedata.normalize("NFC", text).lower()
                latin = text.isalpha() and low.isalpha() and max(text) < "\u0180"
                plain = low.encode().decode("latin-1").translate(table) if latin else None
            if plain is None:
                rest.append(i)
            else:
                out[i] = tuple([t.id for t in tokenize(plain)])
        found = tokenizer.encode_batch([pieces[i].decode("utf-8") for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = tuple(e.ids)
        return out

    return PieceCache(encode, limit=CACHED_PIECES)


def width_of(path: str) -> int:
    """Bytes an id takes on disk."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])
    return 2 if top < 1 << 16 else 4


def encoded(docs: DataFrame, path: str, end_id: int, width: int, bounds: list[int]) -> DataFrame:
    """doc_id, ids with the end id, and the shard: how many bounds are at most doc_id (0 for a null)."""
    limits = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task a core
        encode = word_encoder(path)
        for rows, data, offsets in slices(batches):
            pieces, first = pieces_of(data, offsets)
            ids, lengths = encode(pieces)
            ends = per_text(lengths, first)[1:]
            ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
            at = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            keys = rows.column("doc_id")
            shard = np.searchsorted(limits, keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays(
                [keys, binary(ids.view(np.uint8), at * width), pa.array(shard, pa.int32())], names=["doc_id", "ids", "shard"]
            )

    ready = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ready.mapInArrow(run, "doc_id bigint, ids binary, shard int")


@dataclass(frozen=True)
class TokenRecords:
    """A written set of shards."""

    folder: str
    width: int

    def index(self, spark: SparkSession) -> DataFrame:
        """The index with ``start``: ids of all documents before. One number per shard is summed up apart."""
        rows = spark.read.schema(INDEX).parquet(f"{self.folder}/index")
        sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
        bases, total = [], 0
        for r in sums:  # one row per shard
            bases.append((r["shard"], total))
            total += r["n"]
        base = whole_numbers(spark, bases, "shard int, base bigint")
        return rows.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("shard_start")).drop("base")

    def read(self, index: DataFrame) -> DataFrame:
        """doc_id, start, ids (little-endian unsigned 32-bit integers) of the index rows, in their order.

        Each record is fetched at its offset, and its frame is verified.
        """
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            name, source = None, None
            for batch in batches:
                rows = batch.to_pydict()
                ids = []
                for doc_id, file, offset, length in zip(rows["doc_id"], rows["file"], rows["offset"], rows["length"], strict=True):
                    if file != name:
                        place, path = fs.FileSystem.from_uri(file)
                        name, source = file, place.open_input_file(path)
                    source.seek(offset)
                    held, values = document_of(source.read(length), width)
                    if held != (doc_id or 0):
                        raise ValueError("a record holds another document than the index says")
                    ids.append(values)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])

        return index.select("doc_id", "start", "file", "offset", "length").mapInArrow(run, "doc_id bigint, start bigint, ids binary")

    def shuffled(self, spark: SparkSession, seed: int) -> DataFrame:
        """All documents in a random order that the seed fixes: only index rows move, records are read by offset."""
        order = F.xxhash64(F.lit(seed), "shard", "offset")
        index = self.index(spark).repartitionByRange(shuffle_partitions(spark), order).sortWithinPartitions(order)
        return self.read(index)


def write_records(docs: DataFrame, path: str, end_id: int, folder: str | None = None, shards: int | None = None) -> TokenRecords:
    """Tokenise whole texts and write them in ascending doc_id order.

    Null text counts as empty: a record of the end id alone. Null doc_ids come first (stored as 0), repeated rows are written each,
    next to each other; ties of doc_id are ordered by their ids. An empty table gives an empty index. Columns besides
    doc_id and text are ignored. Shards are ranges of doc_id, from its approximate quantiles (one number
    per shard); only ids move between executors, and a shard is sorted on disk and streamed to its file.
    ``folder`` must be one that all executors see; by default one below ``spark.checkpoint.dir``.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "records")
    shards = shards or shuffle_partitions(spark)
    width = width_of(path)
    cuts = [i / shards for i in range(1, shards)]
    quantiles = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).approxQuantile("doc_id", cuts, 0.1 / shards)
    # Quantiles are doubles: a cut that is off by rounding only moves a row to the next shard, for all equal ids alike.
    bounds = sorted({int(q) for q in quantiles})
    made = encoded(docs, path, end_id, width, bounds)
    placed = made.repartitionById(len(bounds) + 1, "shard").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        sink, file, at, start = None, "", 0, 0
        names = [c.split()[0] for c in INDEX.split(", ")]
        for batch in batches:
            rows, out = batch.to_pydict(), []
            for doc_id, ids, shard in zip(rows["doc_id"], rows["ids"], rows["shard"], strict=True):
                if sink is None:
                    file = f"{folder}/shard-{shard:05d}-{uuid.uuid4().hex}.rec"
                    place, local = fs.FileSystem.from_uri(file)
                    place.create_dir(local.rsplit("/", 1)[0], recursive=True)
                    sink = place.open_output_stream(local)
                record = record_of(doc_id, ids)
                sink.write(record)
                out.append((doc_id, shard, file, at, len(record), len(ids) // width, start))
                at, start = at + len(record), start + len(ids) // width
            columns = list(zip(*out)) or [()] * len(names)
            types = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        if sink is not None:
            sink.close()

    placed.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return TokenRecords(folder, width)


def ids_crc32(ids: Column) -> Column:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return F.crc32(ids)
