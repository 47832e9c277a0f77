"""Token-id files: one compressed frame per document, a shared dictionary, an offset index.

A file of this format holds, in order:

    8 bytes   magic
    32 bytes  SHA-256 of the dictionary file that its frames need
    frames    per document, Zstandard with the dictionary: ids as little-endian 32-bit integers
    index     per document: doc_id (int64), has_id (int8), frame offset (uint64), ids (uint64)
    8 bytes   number of documents
    8 bytes   offset of the index
    8 bytes   magic

so that one short document is read with two small reads. The dictionary is trained on the
serialised id arrays of a bounded sample (``DICTIONARY_SAMPLE`` documents, chosen by the hash of
their id); it changes the size of the files, never what is read back. Documents are dealt to files
by range of ``doc_id``. Every task attempt writes a file of its own name and reports it in the
manifest, a table that Spark commits once, so lost executors and repeated tasks leave no wrong file.

Cases: null texts count as empty; empty texts hold the end id alone; rows without ``doc_id`` come
last; rows that share a ``doc_id`` are all kept, ordered by their text; an empty table gives no file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docspark.llm.batches import list_array, steps
from docspark.llm.bpe import WordEncoder
from docspark.session import fresh_path

MAGIC = b"DSTOKEN1"
#: Documents whose ids the dictionary is trained on, and its size in bytes.
DICTIONARY_SAMPLE = 1024
DICTIONARY_BYTES = 64 << 10
#: New words that the library gets in one text.
GROUP = 200
_INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "i1"), ("offset", "<u8"), ("n", "<u8")])


class LibraryEncoder(WordEncoder):
    """New words get their ids from the tokenizers library, some hundred of them in one call.

    A word's ids end with the only one that stands for a word's end, which parts the words again.
    """

    def __init__(self, definition: bytes) -> None:
        super().__init__(definition)
        self.tokenizer = Tokenizer.from_str(definition.decode())
        self.ends = np.zeros(max(self.tokens) + 1, bool)
        self.ends[[i for t, i in self.ids.items() if t.endswith(self.end)]] = True

    def learn(self, unknown: list[str]) -> None:
        # Marks that join the letters before them are left to the library, chunk by chunk.
        odd = [c for c in unknown if not c.isascii() and max(c) >= "\u0300"]
        for chunk, found in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            self.chunks.known[chunk] = np.array(found.ids, "<u4").tobytes()
        super().learn(list(set(unknown).difference(odd)) if odd else unknown)

    def merge(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(words), GROUP * 64):
            part = words[start:start + GROUP * 64]
            calls = [" ".join(part[i:i + GROUP]) for i in range(0, len(part), GROUP)]
            found = self.tokenizer.encode_batch_fast(calls, add_special_tokens=False)
            flat = np.concatenate([np.array(x.ids, "<u4") for x in found])
            cut = (4 * (np.flatnonzero(self.ends[flat]) + 1)).tolist()
            if len(cut) != len(part):
                raise ValueError("the library splits words in another way")
            data = flat.tobytes()
            out += [data[a:b] for a, b in zip([0, *cut], cut)]
        return out


@lru_cache(maxsize=1)
def encoder_of(definition: bytes) -> LibraryEncoder:
    """One encoder per worker, with what it remembers from earlier partitions."""
    return LibraryEncoder(definition)


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder that all executors share."""
    return arrow_fs.FileSystem.from_uri(uri)


def train_dictionary(docs: DataFrame, definition: bytes, end_id: int, doc_id: str, text: str) -> bytes:
    """A dictionary for the frames, from a bounded sample of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for _, texts in steps(batches, text):
            yield pa.RecordBatch.from_pydict({"ids": pa.array(encoder.encode(texts), pa.binary())})

    # Ids alone are ranked; texts are read for the chosen ones.
    chosen = docs.select(doc_id).distinct().orderBy(F.xxhash64(doc_id), doc_id).limit(DICTIONARY_SAMPLE)
    picked = docs.join(F.broadcast(chosen), doc_id, "left_semi").dropDuplicates([doc_id])
    end = struct.pack("<I", end_id)
    samples = [bytes(r.ids) + end for r in picked.select(text).mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few documents to train on: their ids themselves serve as dictionary
        return b"".join(samples)[:DICTIONARY_BYTES] or end


def write_token_files(
    docs: DataFrame, definition: bytes, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    files: int | None = None,
) -> DataFrame:
    """Write the ids of every document under ``folder``; return the manifest (shard, file, docs, ids)."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    dictionary = train_dictionary(plain, definition, end_id, "doc_id", "text")
    key = hashlib.sha256(dictionary).digest()
    fs, root = open_folder(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{key.hex()}.dictionary") as f:
        f.write(dictionary)
    shared = spark.sparkContext.broadcast((definition, dictionary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trained = shared.value
        encoder, end = encoder_of(words), struct.pack("<I", end_id)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(trained))
        where, path = open_folder(folder)
        name = f"{uuid.uuid4().hex}.tokens"
        out = shard = None
        index, at = [], 40
        for batch, texts in steps(batches, "text", 2_000_000):
            if out is None:
                shard = batch.column(2)[0].as_py()
                out = where.open_output_stream(f"{path}/{name}")
                out.write(MAGIC + key)
            for one, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                frame = packer.compress(ids + end)
                out.write(frame)
                index.append((one or 0, one is not None, at, len(ids) // 4 + 1))
                at += len(frame)
        if out is not None:
            table = np.array(index, _INDEX)
            out.write(table.tobytes() + struct.pack("<QQ", len(table), at) + MAGIC)
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "file": [name], "docs": pa.array([len(table)], pa.int64()),
                "ids": pa.array([int(table["n"].sum())], pa.int64())})

    dealt = (plain.repartitionByRange(files, F.col("doc_id").asc_nulls_last())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
             .withColumn("shard", F.spark_partition_id()))
    manifest = dealt.mapInArrow(run, "shard int, file string, docs bigint, ids bigint")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


class TokenFile:
    """Random access to one file: ``ids(i)`` reads the frame of the i-th document alone."""

    def __init__(self, folder: str, name: str) -> None:
        fs, root = open_folder(folder)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        head = self.file.read_at(40, 0)
        if head[:8] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{name} is not a token file")
        n, self.index_at = struct.unpack("<QQ", tail[:16])
        self.index = np.frombuffer(self.file.read_at(n * _INDEX.itemsize, self.index_at), _INDEX)
        with fs.open_input_stream(f"{root}/{head[8:].hex()}.dictionary") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != head[8:]:
            raise ValueError(f"{name}: its dictionary has changed")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def frames(self, first: int, count: int) -> list[bytes]:
        ends = np.append(self.index["offset"].astype(np.int64), self.index_at)
        low, high = int(ends[first]), int(ends[first + count])
        data = self.file.read_at(high - low, low)
        cut = (ends[first:first + count + 1] - low).tolist()
        return [self.unpacker.decompress(data[a:b]) for a, b in zip(cut, cut[1:])]

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.frames(i, 1)[0], "<u4")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, raw: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens, ids.

    ``raw`` gives the ids as stored, little-endian 32-bit integers in a binary, in place of an array.
    The running sum over files has one row per file, the sums inside a file come from its index.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select("shard", "file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    listed = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")
    kinds = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids", pa.binary() if raw else pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                opened = TokenFile(folder, name)
                counts = opened.index["n"].astype(np.int64)
                starts = start + np.cumsum(counts) - counts
                for first in range(0, len(counts), 256):
                    part = opened.index[first:first + 256]
                    frames = opened.frames(first, len(part))
                    lists = pa.array(frames, pa.binary()) if raw else list_array(
                        np.frombuffer(b"".join(frames), np.int32), counts[first:first + 256].tolist(), pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(part["doc_id"], mask=part["has_id"] == 0), pa.array(starts[first:first + 256]),
                        pa.array(counts[first:first + 256]), lists], schema=kinds)

    kind = "binary" if raw else "array<int>"
    return listed.mapInArrow(run, f"doc_id bigint, start bigint, n_tokens bigint, ids {kind}")


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files on the store that the executors share."""
    return fresh_path(spark, "tokens")
