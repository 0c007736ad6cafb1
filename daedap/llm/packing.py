"""Packing documents of tokens into sequences by the sum of squares of open gaps.

A document is placed where the squared counts of open sequences per free length
add up to the least, and a sequence is opened only where none has room. This keeps
many different gaps open, so that later documents find one that they fill.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.llm.tokens import documents_of_ids
from daedap.session import materialize

MAX_TOKENS = 2048

# Pieces that one task packs on its own; a few sequences per group stay open.
GROUP_PIECES = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """``docs(doc_id, text)`` as pieces of at most ``max_tokens`` ids, by tokenizer file.

    A document is its ids and ``end_id``; null text is empty, so every row gives at
    least one piece. Only longer documents are cut. Null and repeated ids are kept
    as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, documents in documents_of_ids(batches, tokenizer, end_id):
            rows = [
                (key, n, start, len(part), zlib.crc32(part.astype("<u4").tobytes()))
                for key, ids in zip(keys, documents)
                for n, start in enumerate(range(0, len(ids), max_tokens))
                for part in (ids[start : start + max_tokens],)
            ]
            columns = zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*rows))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = {name: pa.array(c, t) for (name, c), t in zip(columns, types)}
            yield pa.RecordBatch.from_pydict(arrays)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For items in their order of arrival: the bin of each and its place there.

    Ties go to the bin with the smallest gap; a bin is opened only where none has room.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)  # count[gap], full bins left out
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_bins = 0
    for i, size in enumerate(lengths.tolist()):
        if size >= capacity:
            bins[i], n_bins = n_bins, n_bins + 1
            continue
        gaps = np.flatnonzero(count[size:]) + size
        if len(gaps):
            left = gaps - size
            cost = np.where(left > 0, 2 * count[left] + 1, 0) - 2 * count[gaps] + 1
            gap = int(gaps[np.argmin(cost)])
            bin_ = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_, n_bins = capacity, n_bins, n_bins + 1
        bins[i], places[i] = bin_, capacity - gap
        if gap > size:
            open_bins[gap - size].append(bin_)
            count[gap - size] += 1
    return bins, places


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, group: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; other columns are kept.

    Pieces are dealt at random into groups of about ``group`` rows, whatever their
    ids, and each group is packed on its own, longest piece first. ``length`` must
    be between 1 and ``max_tokens``. ``pieces`` is written once to the shared folder.
    An empty table gives an empty one.
    """
    stored = materialize(pieces)
    groups = max(1, -(-stored.count() // group))
    rest = [c for c in stored.columns if c not in ("sequence_id", "offset")]
    dealt_to = "_group"
    while dealt_to in map(str.lower, rest):
        dealt_to += "_"
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    dealt = stored.select(*(F.col(f"`{c}`") for c in rest), number.alias(dealt_to))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(-rows["length"].to_numpy(), kind="stable")
        rows = rows.iloc[order].reset_index(drop=True)
        bins, places = sum_of_squares(rows["length"].to_numpy(), max_tokens)
        return rows.drop(columns=dealt_to).assign(
            sequence_id=bins + (np.int64(key[0]) << 32), offset=places
        )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema[:-1])
    return dealt.groupBy(dealt_to).applyInPandas(run, f"{schema}, sequence_id long, offset long")
