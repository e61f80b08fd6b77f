"""Token shards: raw ids on disk, reached by document key through a minimal perfect hash.

A shard is two files. ``<name>.ids`` holds the ids of its documents, one after the other, in
ascending id order, as little-endian 16- or 32-bit integers. ``<name>.idx`` maps each key to
the place of its document:

    magic "TIDX1", bytes per id (1 byte), u32 header length, JSON header, then the arrays
    levels (bit sets), fingerprint u32[n], place u64[n + 1], order u32[n], key i64[n], null u8[n]

The hash has levels, each a bit set of twice the keys left: a key that is alone in its slot
has found its place, the others go to the next level. A key's rank among the set bits is its
number, so a lookup reads a bit on one or two levels, then one fingerprint and one place. A
key that is not there fails the bit or the fingerprint.

``write`` sorts documents by range; each task writes its shards under a name of its own, so a
task that is run again cannot harm, and the table of shards, which Spark commits, names only
files of tasks that ended. Files are written with Arrow's file systems at the folder's URI.

Defined results: null text is the empty text; rows that repeat an id stand next to each other,
ordered by text, and a lookup gives the first; null ids come first and cannot be looked up; an
empty table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avspark.llm.common import slices, texts
from avspark.session import new_path

MAGIC = b"TIDX1"
#: A task begins a new shard once its ids take this many bytes.
SHARD_BYTES = 64 << 20
_GAMMA = 2
_MOST_LEVELS = 64


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal and perfect over distinct 64-bit keys: each gets a number below their count."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of bool
        self.before, n = [], 0
        for bits in levels:
            self.before.append(n + np.cumsum(bits) - bits)
            n += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == _MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, _GAMMA * len(keys))
            slot = _mix(keys, len(levels)) % np.uint64(size)
            alone = np.bincount(slot.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[slot]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Numbers; -1 where no level has the key's bit."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            slot = (_mix(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[slot]
            out[left[hit]] = before[slot[hit]]
            left = left[~hit]
        return out


def check_code(keys: np.ndarray) -> np.ndarray:
    """The stored fingerprint of a key."""
    return (_mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


class Index:
    """The index of one shard. Rows are its documents in file order."""

    def __init__(self, keys: np.ndarray, null: np.ndarray, place: np.ndarray, width: int,
                 hashed: PerfectHash | None = None, order: np.ndarray | None = None, code: np.ndarray | None = None):
        self.keys, self.null, self.place, self.width = keys, null, place, width
        if hashed is None:
            first = ~null & np.concatenate([[True], (keys[1:] != keys[:-1]) | null[:-1]])[: len(keys)]
            rows = np.flatnonzero(first)
            hashed = PerfectHash.build(keys[rows])
            order = np.zeros(len(rows), np.uint32)
            order[hashed(keys[rows])] = rows
            code = check_code(keys[order])
        self.hashed, self.order, self.code = hashed, order, code

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key in constant time; -1 for keys that are not there."""
        if not len(self.order):
            return np.full(len(keys), -1, np.int64)
        number = self.hashed(keys)
        there = (number >= 0) & (self.code[number] == check_code(keys))
        return np.where(there, self.order[number].astype(np.int64), -1)

    def to_bytes(self) -> bytes:
        header = json.dumps({"rows": len(self.keys), "keys": len(self.order), "levels": [len(x) for x in self.hashed.levels]}).encode()
        return b"".join([
            MAGIC, struct.pack("<BI", self.width, len(header)), header,
            *(np.packbits(x).tobytes() for x in self.hashed.levels),
            self.code.astype("<u4").tobytes(), self.place.astype("<u8").tobytes(), self.order.astype("<u4").tobytes(),
            self.keys.astype("<i8").tobytes(), self.null.astype(np.uint8).tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Index:
        if raw[:5] != MAGIC:
            raise ValueError("not an index file")
        width, size = struct.unpack_from("<BI", raw, 5)
        at = 10 + size
        told = json.loads(raw[10:at])
        levels = []
        for bits in told["levels"]:
            n = -(-bits // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, n, at), count=bits).astype(bool))
            at += n
        parts = []
        for kind, n in (("<u4", told["keys"]), ("<u8", told["rows"] + 1), ("<u4", told["keys"]), ("<i8", told["rows"]), ("u1", told["rows"])):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        code, place, order, keys, null = parts
        return cls(keys, null.astype(bool), place.astype(np.int64), width, PerfectHash(levels), order, code)


def _open(folder: str):
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class ShardReader:
    """Keyed access to one shard."""

    def __init__(self, folder: str, name: str):
        self.files, root = _open(folder)
        with self.files.open_input_file(f"{root}/{name}.idx") as f:
            self.index = Index.from_bytes(f.read())
        self.ids_path = f"{root}/{name}.ids"

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids from place ``first`` to ``last`` of the shard."""
        width = self.index.width
        with self.files.open_input_file(self.ids_path) as f:
            f.seek(first * width)
            return np.frombuffer(f.read((last - first) * width), f"<u{width}")

    def get(self, key: int) -> np.ndarray | None:
        row = int(self.index.rows(np.array([key], np.int64))[0])
        return None if row < 0 else self.ids(*self.index.place[row : row + 2].tolist())


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None,
          special_as_text: bool = True) -> tuple[str, DataFrame]:
    """Writes the shards; the folder, and the table of shards: name, first_id, n_docs, n_tokens,
    part (order of shards: by part, then number), number. ``special_as_text=False``: a special
    token's string inside a text gives the token's id, as the library does by default."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "shards")
    files, root = _open(folder)
    files.create_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from avspark.llm.pieces import library_pieces

        encode = library_pieces(tokenizer, True, special_as_text)
        width = 2 if encode.vocabulary <= 1 << 16 and end_id < 1 << 16 else 4
        files, root = _open(folder)
        files.create_dir(root)
        number, out, held = 0, None, []

        def close() -> pa.RecordBatch:
            nonlocal out, held, number
            out.close()
            keys = pa.concat_arrays([k for k, _ in held])
            counts = np.concatenate([c for _, c in held])
            null = keys.is_null().to_numpy(zero_copy_only=False)
            place = np.concatenate([[0], np.cumsum(counts)])
            index = Index(keys.fill_null(0).to_numpy(), null, place, width)
            with files.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(index.to_bytes())
            row = pa.RecordBatch.from_pylist([{"name": name, "first_id": keys[0].as_py(), "n_docs": len(keys), "n_tokens": int(place[-1]), "number": number}])
            out, held, number = None, [], number + 1
            return row

        size = 0
        for batch in slices(batches):
            if out is None:
                name, size = uuid.uuid4().hex, 0
                out = files.open_output_stream(f"{root}/{name}.ids")
            ids, counts = encode(batch.column("text"))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype(f"<u{width}")
            out.write(ids.tobytes())
            size += ids.nbytes
            held.append((batch.column("doc_id"), counts + 1))
            if size >= SHARD_BYTES:
                yield close()
        if out is not None:
            yield close()

    table = new_path(spark, "shard-table")
    # Ascending within and across partitions; the partition's number orders them.
    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = "name string, first_id long, n_docs long, n_tokens long, number long"
    (ordered.mapInArrow(run, schema).withColumn("part", F.spark_partition_id()).write.parquet(table))
    return folder, spark.read.parquet(table)


def read(spark: SparkSession, folder: str, table: DataFrame) -> DataFrame:
    """Per document, looked up in its shard's index: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all shards. The table of shards
    has one row for each 64 MB, or task, and is the only thing that the driver sees.
    """
    shards = sorted(table.collect(), key=lambda r: (r["part"], r["number"]))
    rows, start = [], 0
    for r in shards:
        rows.append((r["name"], start))
        start += r["n_tokens"]
    spread = spark.createDataFrame(rows, "name string, start long").repartition(max(1, len(rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = ShardReader(folder, name)
                index = shard.index
                found = index.rows(index.keys)
                repeats = index.null | (np.concatenate([[False], index.keys[1:] == index.keys[:-1]]) if len(index.keys) else index.null)
                own = np.where(repeats, np.arange(len(index.keys)), found)
                if (index.keys[own] != index.keys).any():
                    raise ValueError(f"index of shard {name} is damaged")
                for at in range(0, len(own), 4096):
                    part = own[at : at + 4096]
                    first, last = int(index.place[part[0]]), int(index.place[part[-1] + 1])
                    raw = memoryview(shard.ids(first, last).astype("<u4").tobytes())
                    a, b = index.place[part], index.place[part + 1]
                    crc = [zlib.crc32(raw[4 * (x - first) : 4 * (y - first)]) for x, y in zip(a, b, strict=True)]
                    keys = pa.array(index.keys[part], pa.int64(), mask=index.null[part])
                    yield pa.RecordBatch.from_arrays(
                        [keys, pa.array(start + a, pa.int64()), pa.array(b - a, pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
