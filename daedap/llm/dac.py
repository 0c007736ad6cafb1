"""Token ids in files of directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first
chunk of every id, level 1 the second of those that have one, and so on; a bitmap
per level says which ids go on, and a directory of counts before every 512 bits
finds their place in the next level. Any id can so be read by a few seeks.

A file is: magic, the lengths of a JSON head and its padding, the head, then the
sections it names: keys of the documents, where each ends, and per level chunks,
bitmap and directory. Numbers are little-endian.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daedap.llm.folders import create, new_folder, reading
from daedap.llm.tokens import documents_of_ids
from daedap.session import materialize

MAGIC = b"DAC1"
BLOCK_BITS = 512

# Ids in one file; a document is never divided between files.
FILE_TOKENS = 4_000_000

# Tasks that read files back, a file or more each.
MOST_TASKS = 50_000

WRITTEN = "part int, file int, address string, n_docs long, n_tokens long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap and directory of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK_BITS // 8)))
        in_block = np.bitwise_count(bits).reshape(-1, BLOCK_BITS // 8).sum(1, dtype=np.uint32)
        before = np.concatenate([[0], np.cumsum(in_block)[:-1]]).astype("<u4")
        levels.append((rest.astype(np.uint8), bits, before[: len(in_block)]))
        if not more.any():
            return levels
        rest = rest[more] >> 8


def write_file(out, keys: list, documents: list[np.ndarray]) -> None:
    """Documents in their order; a key may be null."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    ends = np.cumsum([len(d) for d in documents], dtype=np.int64)
    sections = {
        "keys": np.array([0 if k is None else k for k in keys], "<i8"),
        "no_key": np.array([k is None for k in keys], np.uint8),
        "ends": ends.astype("<i8"),
    }
    levels = levels_of(ids)
    for n, (chunks, bits, before) in enumerate(levels):
        sections |= {f"chunks{n}": chunks, f"bits{n}": bits, f"before{n}": before}
    head: dict = {"n_docs": len(keys), "n_tokens": len(ids), "levels": len(levels), "at": {}}
    offset = 0
    for name, values in sections.items():
        head["at"][name] = [offset, values.nbytes]
        offset += values.nbytes
    data = json.dumps(head).encode()
    out.write(MAGIC + len(data).to_bytes(4, "little") + data)
    for values in sections.values():
        out.write(values.tobytes())


class TokenFile:
    """A file of token ids, open for reading."""

    def __init__(self, source):
        self.source = source
        source.seek(0)
        begin = source.read(8)
        if begin[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        length = int.from_bytes(begin[4:], "little")
        self.head = json.loads(source.read(length))
        self.base = 8 + length

    def _bytes(self, name: str, first: int = 0, length: int | None = None) -> bytes:
        at, size = self.head["at"][name]
        self.source.seek(self.base + at + first)
        return self.source.read(size - first if length is None else length)

    def documents(self) -> tuple[list, np.ndarray]:
        """Keys, and where each document ends."""
        keys = np.frombuffer(self._bytes("keys"), "<i8").tolist()
        missing = np.frombuffer(self._bytes("no_key"), np.uint8)
        ends = np.frombuffer(self._bytes("ends"), "<i8")
        return [None if m else k for k, m in zip(keys, missing)], ends

    def token(self, i: int) -> int:
        """One id, by reading a chunk and a block of bits per level."""
        if not 0 <= i < self.head["n_tokens"]:
            raise IndexError(i)
        value = shift = 0
        for n in range(self.head["levels"]):
            value |= self._bytes(f"chunks{n}", i, 1)[0] << shift
            block, bit = divmod(i, BLOCK_BITS)
            size = BLOCK_BITS // 8
            bits = int.from_bytes(self._bytes(f"bits{n}", block * size, size), "little")
            if not bits >> bit & 1:
                return value
            before = int.from_bytes(self._bytes(f"before{n}", 4 * block, 4), "little")
            i = before + (bits & ((1 << bit) - 1)).bit_count()
            shift += 8
        raise ValueError("a code goes on after the last level")

    def tokens(self) -> np.ndarray:
        """All ids."""
        ids = np.frombuffer(self._bytes("chunks0"), np.uint8).astype(np.uint32)
        places = np.arange(len(ids))
        for n in range(1, self.head["levels"]):
            bits = np.frombuffer(self._bytes(f"bits{n - 1}"), np.uint8)
            more = np.unpackbits(bits, count=len(places), bitorder="little").view(bool)
            places = places[more]
            chunks = np.frombuffer(self._bytes(f"chunks{n}"), np.uint8)
            ids[places] |= chunks.astype(np.uint32) << (8 * n)
        return ids


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int = 0, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Write ``docs(doc_id, text)`` as token files; one row per file, in its order.

    Documents stand in ascending order of their ids, null ids first and rows that
    repeat an id as they were read; null text is empty, and ``end_id`` ends every
    document. Ranges of ids are split by row as well, so a much repeated id is no
    hot spot. A task that is run again writes new files, and only those of its
    finished run are in the table.
    """
    folder = new_folder(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, held, keys, documents = TaskContext.get().partitionId(), 0, 0, [], []
        written = []

        def finish() -> None:
            address = f"{folder}/{part:07d}-{file:05d}-{uuid.uuid4().hex}.dac"
            with create(address) as out:
                write_file(out, keys, documents)
            written.append((part, file, address, len(keys), held))

        for more_keys, more in documents_of_ids(batches, tokenizer, end_id):
            for key, ids in zip(more_keys, more):
                keys.append(key)
                documents.append(ids)
                held += len(ids)
                if held >= file_tokens:
                    finish()
                    file, held, keys, documents = file + 1, 0, [], []
        if keys:
            finish()
        if written:
            names = [c.split()[0] for c in WRITTEN.split(", ")]
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(zip(*written), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    row = F.monotonically_increasing_id().alias("_row")
    ordered = docs.select(F.col("doc_id").cast("long"), "text", row)
    ranges = ordered.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row")
    return materialize(ranges.select("doc_id", "text").mapInArrow(run, WRITTEN))


def read_tokens(files: DataFrame) -> DataFrame:
    """Per document of ``write_tokens``' files: start, n_tokens and crc32 of its ids.

    ``start`` counts the ids of all documents before it. The files' own counts are
    added up over one row per file.
    """
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        "address", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, start in zip(*(c.to_pylist() for c in batch.columns)):
                with reading(address) as source:
                    file = TokenFile(source)
                    keys, ends = file.documents()
                    ids = file.tokens().astype("<u4")
                lengths = np.diff(ends, prepend=0)
                data = memoryview(ids.tobytes())
                crcs = [
                    zlib.crc32(data[4 * (e - n) : 4 * e])
                    for e, n in zip(ends.tolist(), lengths.tolist())
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(keys, pa.int64()),
                        "start": pa.array(start + ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    tasks = min(max(files.count(), 1), MOST_TASKS)
    spread = starts.repartition(tasks, "address")
    return spread.mapInArrow(run, READ)
