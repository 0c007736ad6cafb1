"""Question sets: Parquet, or a folder a dataset library saved as Arrow streams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from daedap.functions.text import Tokenizer, normalize, word_tokens
from daedap.sources.files import open_file, reads_parts


def load_split(spark: SparkSession, path: str) -> DataFrame:
    """One split of a saved columnar dataset, in Parquet."""
    return spark.read.parquet(path)


MANIFEST = "struct<_data_files:array<struct<filename:string>>>"

# Message types in an Arrow stream.
SCHEMA, DICTIONARY, RECORDS = 1, 2, 3

# A record batch, where it lies, and what a reader needs ahead of it.
BATCHES = "file int, batch int, address string, ahead array<long>, begin long, end long"


def _data_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, path``: the data files of a saved dataset folder in order.

    Those that its manifest names, in its order, or without one all, by name. A manifest
    that cannot be read raises an error, as does a file that is named and missing.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.arrow").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    files = listed.select("path", name.alias("name"))
    manifest = spark.read.format("binaryFile").option("pathGlobFilter", "state.json").load(path)
    text = F.col("content").cast("string")
    parsed = F.from_json(text, MANIFEST, {"mode": "FAILFAST"})
    # One small file; what it lists are file names.
    state = manifest.select(parsed["_data_files"]["filename"].alias("names"), parsed.isNull().alias("empty")).first()
    if state is not None and state["empty"]:
        raise ValueError(f"state.json in {path} is no JSON object")
    if state is None or state["names"] is None:
        places = [(i, row["path"]) for i, row in enumerate(files.orderBy("name").collect())]
    else:
        known = {row["name"]: row["path"] for row in files.collect()}
        missing = [n for n in state["names"] if n not in known]
        if missing:
            raise FileNotFoundError(f"state.json in {path} names files that are not there: {missing[:5]}")
        places = [(i, known[n]) for i, n in enumerate(state["names"])]
    if not places:
        raise FileNotFoundError(f"no .arrow file in {path}")
    return spark.createDataFrame(places, "file int, path string")


def messages(source: pa.NativeFile) -> Iterator[tuple[int, int, int]]:
    """Type, begin and end of every message of an Arrow stream, bodies left unread."""
    size, at = source.size(), 0
    while at < size:
        source.seek(at)
        head = source.read(8)
        marked = head[:4] == b"\xff\xff\xff\xff"
        length = int.from_bytes(head[4:] if marked else head[:4], "little")
        if length == 0:
            return
        begin, at = at, at + (8 if marked else 4)
        source.seek(at)
        metadata = source.read(length)
        if len(metadata) < length:
            raise EOFError("an Arrow stream ends inside a message")
        kind, body = _message_of(metadata)
        at += length + body
        if at > size:
            raise EOFError("an Arrow stream ends inside a message")
        yield kind, begin, at


def _message_of(metadata: bytes) -> tuple[int, int]:
    """Type and body length, the second and fourth field of a message's table."""

    def number(at: int, size: int, signed: bool = False) -> int:
        return int.from_bytes(metadata[at : at + size], "little", signed=signed)

    table = number(0, 4)
    fields = table - number(table, 4, signed=True)

    def field(i: int, size: int) -> int:
        offset = number(fields + 4 + 2 * i, 2) if 4 + 2 * i < number(fields, 2) else 0
        return number(table + offset, size) if offset else 0

    return field(1, 1), field(3, 8)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the record batches of some files lie."""
    names = [part.split()[0] for part in BATCHES.split(", ")]
    types = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    for files in batches:
        for file, address in zip(*(c.to_pylist() for c in files.columns)):
            found, ahead = [], []
            with open_file(address) as source:
                for kind, begin, end in messages(source):
                    if kind == RECORDS:
                        found.append((file, len(found), address, list(ahead), begin, end))
                    else:
                        ahead += [begin, end]
            if found:
                arrays = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Without metadata and with dictionaries written out, as Spark takes it."""
    columns = [c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for c in batch.columns]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def _read_batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        for address, ahead, begin, end in zip(*(row.column(c).to_pylist() for c in ("address", "ahead", "begin", "end"))):
            with open_file(address) as source:
                parts = [*zip(ahead[::2], ahead[1::2]), (begin, end)]
                data = b"".join(source.read_at(stop - start, start) for start, stop in parts)
            with pa.ipc.open_stream(data) as stream:
                for part in stream:
                    yield _plain(part)


def load_arrow_split(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """One split saved as a folder of ``*.arrow`` stream files, read by record batch.

    A ``state.json`` in the folder names the data files; others are left alone. If it
    cannot be read, or names a file that is missing, or a file is cut short, an error is
    raised. Rows come in the order of the files and their batches. The schema is read from
    the first file, in a task, unless it is given. One task per file finds where its record
    batches lie, without reading them; then each is read on its own, by as many tasks as the
    session has for a shuffle. Files in a store that tasks cannot open come whole, one row
    each of up to 2 GB.
    """
    files = _data_files(spark, path)
    in_parts = reads_parts(files.first()["path"])

    def schema_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("path").to_pylist():
                with open_file(address) as source, pa.ipc.open_stream(source) as stream:
                    found = stream.schema.remove_metadata()
                yield pa.record_batch({"schema": [found.serialize().to_pybytes()]})

    if not in_parts:
        return _load_whole(spark, files, schema)
    if schema is None:
        first = files.orderBy("file").limit(1).mapInArrow(schema_of, "schema binary").first()
        schema = from_arrow_schema(pa.ipc.read_schema(pa.py_buffer(bytes(first["schema"]))))
    places = files.repartition(files.count()).mapInArrow(_batches, BATCHES)
    # Ranges, so that rows keep their order and the batches of one file are dealt out.
    dealt = places.repartitionByRange("file", "batch").sortWithinPartitions("file", "batch")
    return dealt.mapInArrow(_read_batches, schema)


def _load_whole(spark: SparkSession, files: DataFrame, schema: T.StructType | None) -> DataFrame:
    paths = [row["path"] for row in files.orderBy("file").collect()]
    contents = spark.read.format("binaryFile").load(paths).select("path", "content").join(files, "path")
    contents = contents.repartitionByRange("file").sortWithinPartitions("file").select("content")

    def schema_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                found = pa.ipc.open_stream(content.as_buffer()).schema.remove_metadata()
                yield pa.record_batch({"schema": [found.serialize().to_pybytes()]})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with pa.ipc.open_stream(content.as_buffer()) as stream:
                    for part in stream:
                        yield _plain(part)

    if schema is None:
        first = contents.limit(1).mapInArrow(schema_of, "schema binary").first()
        schema = from_arrow_schema(pa.ipc.read_schema(pa.py_buffer(bytes(first["schema"]))))
    return contents.mapInArrow(read, schema)


def as_questions(
    df: DataFrame,
    question_id: str | Column = "id",
    question: str | Column = "question",
    tokenizer: Tokenizer = word_tokens,
    normalized: bool = False,
    order: str | Column | None = None,
) -> DataFrame:
    """``question_id, question, tokens`` from a split; nothing else is read.

    Questions are tokenized raw: capitals and marks then miss the index, which
    holds cleaned text. ``normalized=True`` cleans them first. Of rows that repeat an
    id the last one in ``order`` stays; without an order, ids must be unique, and
    ranking refuses others.
    """

    def col(c: str | Column) -> Column:
        return F.col(c) if isinstance(c, str) else c

    picked = df.select(
        col(question_id).alias("question_id"),
        col(question).alias("question"),
        *([] if order is None else [col(order).alias("_order")]),
    )
    if order is not None:
        last = F.max_by("question", "_order").alias("question")
        picked = picked.groupBy("question_id").agg(last)
    asked = normalize(F.col("question")) if normalized else F.col("question")
    return picked.withColumn("tokens", tokenizer(asked))


def gold_answers(df: DataFrame, question_id: str = "id", answers: str = "answers") -> DataFrame:
    """The first gold answer of each question, as ``question_id, answer``."""
    return df.select(
        F.col(question_id).alias("question_id"),
        F.get(F.col(f"{answers}.text"), F.lit(0)).alias("answer"),
    )
