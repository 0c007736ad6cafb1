"""The entries of one large JSON object, read by many tasks.

A block of bytes does not tell whether it begins inside a string. So each block is read
as a function of the state that it is entered in: in a string or not, behind a backslash or
not. Functions are put together along the file, which gives every block its state and depth;
then tasks cut the entries that begin in their blocks, at the commas of the outer object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daedap.sources.files import open_file, reads_parts

# Bytes that a task looks at together.
BLOCK_BYTES = 8 << 20

# Bytes for a task and tasks for a core, where there is more to read or there are more blocks;
# and tasks for a set of files. Every task sends the driver a few kilobytes about itself.
TASK_BYTES = 64 << 20
CORE_TASKS = 4
MOST_TASKS = 10_000

# Places of entries: the block, and the number in it.
IN_BLOCK = 1 << 32

OPEN, CLOSE, COMMA = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[[*b"{["]], KINDS[[*b"}]"]], KINDS[ord(",")] = OPEN, CLOSE, COMMA
SPACE = b" \t\r\n"

# A state is 1 inside a string, plus 2 behind a backslash. For each of the four that a block
# can be entered in: the state behind it, how much deeper it ends, whether it opens something.
STEPS = "file string, block long, size long, out array<int>, deeper array<long>, opens array<boolean>"
ENTERED = "file string, block long, size long, state int, depth long, opened boolean"
ENTRIES = "file string, pos long, entry string"


class Marks:
    """The unescaped quotes, brackets and commas of some bytes."""

    def __init__(self, data: bytes):
        values = np.frombuffer(data, np.uint8)
        self.size = len(values)
        slashes = np.flatnonzero(values == ord("\\"))
        begins = np.flatnonzero(np.diff(slashes, prepend=-2) > 1)
        runs = np.diff(np.append(begins, len(slashes)))
        self.first_run = int(runs[0]) if len(runs) and slashes[0] == 0 else 0
        ends = slashes[begins] + runs if len(begins) else np.zeros(0, np.int64)
        # Characters behind an odd run of backslashes, the run at the begin left out.
        self.escaped = ends[(runs % 2 == 1) & (ends > self.first_run)]
        self.quotes = np.flatnonzero(values == ord('"'))
        kinds = KINDS[values]
        self.at = np.flatnonzero(kinds)
        self.kinds = kinds[self.at]
        self.values = values

    def outside(self, state: int) -> tuple[np.ndarray, int]:
        """Which marks are outside strings if entered in ``state``, and the state behind."""
        escaped = self.escaped
        if (self.first_run + state // 2) % 2:
            escaped = np.append(escaped, self.first_run)
        quotes = self.quotes[~np.isin(self.quotes, escaped)]
        inside = (np.searchsorted(quotes, self.at) + state) % 2
        return inside == 0, (len(quotes) + state) % 2 + 2 * bool((escaped == self.size).any())

    def deeper(self, outside: np.ndarray) -> np.ndarray:
        """The change of depth at each mark outside strings."""
        kinds = self.kinds[outside]
        return (kinds == OPEN).astype(np.int64) - (kinds == CLOSE)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in STEPS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            with open_file(row["file"]) as source:
                marks = Marks(source.read_at(row["size"], row["begin"]))
            found = []
            for state in range(4):
                outside, out = marks.outside(state)
                change = marks.deeper(outside)
                found.append((out, int(change.sum()), bool((change > 0).any())))
            columns = ([row["file"]], [row["block"]], [row["size"]], *([list(c)] for c in zip(*found)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _STEP_TYPES)], names=names
            )


_STEP_TYPES = [
    pa.string(), pa.int64(), pa.int64(),
    pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()),
]


def _entered(rows: pd.DataFrame) -> pd.DataFrame:
    """The state, depth and past of every block of a file, a small row for each."""
    rows = rows.sort_values("block")
    state, depth, opened, found = 0, 0, False, []
    for out, deeper, opens in zip(rows["out"], rows["deeper"], rows["opens"]):
        found.append((state, depth, opened))
        state, depth, opened = int(out[state]), depth + int(deeper[state]), opened or bool(opens[state])
    if state or depth or not opened:
        raise ValueError(f"no JSON object, or one cut short: {rows['file'].iloc[0]}")
    states = pd.DataFrame(found, columns=["state", "depth", "opened"], index=rows.index)
    return pd.concat([rows[["file", "block", "size"]], states], axis=1)


def cut_entries(
    source: pa.NativeFile, begin: int, size: int, state: int, depth: int, opened: bool, step: int
) -> list[bytes]:
    """The entries of the outer object that begin in a block, read to their ends.

    Raises ValueError for anything else at the outer level.
    """

    def refuse() -> None:
        raise ValueError("no JSON object: more than one, or no entry where one has to be")

    entries: list[bytes] = []
    parts: list[bytes] | None = None  # of an entry that has begun
    first = False  # behind the bracket, so that it may be missing
    end, total = begin + size, source.size()
    at = begin
    while at < end or (parts is not None and at < total):
        inside_block = at < end
        data = source.read_at(min(step, (end if inside_block else total) - at), at)
        marks = Marks(data)
        outside, state_behind = marks.outside(state)
        places, kinds = marks.at[outside], marks.kinds[outside]
        behind = depth + np.cumsum(marks.deeper(outside))
        ahead = np.concatenate([[depth], behind])[:-1]
        wanted = np.flatnonzero(
            ((kinds == OPEN) & (ahead == 0))
            | ((kinds == CLOSE) & (behind <= 0))
            | ((kinds == COMMA) & (behind <= 1))
        )
        done = 0
        for i in wanted.tolist():
            place, kind = int(places[i]), int(kinds[i])
            if kind == OPEN:
                if opened or data[place] != ord("{") or data[done:place].strip(SPACE):
                    refuse()
                opened, first, parts = True, True, []
            else:
                if behind[i] != (1 if kind == COMMA else 0):
                    refuse()
                if parts is not None:
                    entry = b"".join([*parts, data[done:place]])
                    if entry.strip(SPACE):
                        entries.append(entry)
                    elif not (first and kind == CLOSE):
                        refuse()
                if not inside_block:
                    return entries
                first, parts = False, [] if kind == COMMA else None
            done = place + 1
        rest = data[done:]
        depth = int(behind[-1]) if len(behind) else depth
        if parts is not None:
            parts.append(rest)
        elif depth == 0 and rest.strip(SPACE):
            refuse()
        state, at = state_behind, at + len(data)
    return entries


def tasks_for(blocks: int, size: int, cores: int) -> int:
    """Tasks for so many blocks of so many bytes in all: by bytes, not by blocks."""
    return max(1, min(blocks, max(CORE_TASKS * cores, -(-size // TASK_BYTES)), MOST_TASKS))


def json_entries(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame | None:
    """``file, pos, entry``: every ``"key": value`` of JSON files that are each one object.

    ``pos`` grows along a file, ``floor(pos / IN_BLOCK)`` is the block an entry begins in.
    A file's blocks are read by many tasks, by the bytes of all files; what is put together
    along it is a row of some 100 bytes per block. None if tasks cannot read parts of these files. Entries
    are not looked into. A file that is not one object raises ValueError.
    """
    read = spark.read.format("binaryFile").load(path)
    listed = read.select("path", "length")
    sizes = listed.agg(
        F.count("*").alias("files"),
        F.sum(F.greatest(F.lit(1), F.ceil(F.col("length") / block_bytes))).alias("blocks"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.collect_set(F.substring_index("path", ":", 1)).alias("schemes"),
    ).first()
    if sizes["files"] < len(read.inputFiles()):  # scans pass over files without bytes
        raise ValueError(f"no JSON object, but an empty file: {path}")
    if not all(reads_parts(f"{scheme}:") for scheme in sizes["schemes"]):
        return None
    tasks = tasks_for(sizes["blocks"] or 1, sizes["bytes"], spark.sparkContext.defaultParallelism)
    last = F.greatest(F.lit(0), F.ceil(F.col("length") / block_bytes) - 1).cast("long")
    blocks = (
        listed.select(F.col("path").alias("file"), "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
        .withColumn("begin", F.col("block") * block_bytes)
        .withColumn("size", F.least(F.lit(block_bytes), F.col("length") - F.col("begin")))
        .select("file", "block", "begin", "size")
        .repartition(tasks)
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, size, *entered in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(file) as source:
                    try:
                        found = cut_entries(source, block * block_bytes, size, *entered, block_bytes)
                    except ValueError as error:
                        raise ValueError(f"{error}: {file}") from None
                places = block * IN_BLOCK + np.arange(len(found))
                columns = [pa.array([file] * len(found), pa.string()), pa.array(places, pa.int64())]
                entries = pa.array([e.decode("utf-8", "replace") for e in found], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, entries], names=["file", "pos", "entry"])

    entered = blocks.mapInArrow(_steps, STEPS).groupBy("file").applyInPandas(_entered, ENTERED)
    spread = entered.repartition(tasks)
    return spread.mapInArrow(cut, ENTRIES)
