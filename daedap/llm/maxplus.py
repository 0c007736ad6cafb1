"""SentencePiece encoding by the best path, giant documents in parallel, and decoding.

The ids of a text are those of the pieces that cover it with the largest sum of
scores. A giant document is cut into chunks, which go to tasks of their own. A path
enters a chunk some characters after its begin, where the piece before ended, and leaves
it some characters after its end; so a chunk is a small matrix of the best scores from
each entry to each exit. Matrices combine by maxima of sums, in blocks of ``FAN`` at a
time; back down the blocks, every chunk gets its entry and exit, and is traced on its own.
Between the first and the last place that every path passes, a chunk's ids do not depend
on these, so they are kept with its matrix.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from daedap.llm.shingles import MIX, STEP
from daedap.llm.tokens import as_texts, slices
from daedap.session import materialize

# Characters in a chunk; longer texts are cut.
CHUNK = 16_384

# Chunks, or blocks of them, that are combined at a time.
FAN = 64

# Shorter texts taken from Spark at a time.
SHORT_ROWS = 1024

# Different words that a Python worker keeps, and those worked out at a time; longer
# words are worked out one by one.
MOST_UNITS = 400_000
BLOCK = 8_000
LONG_UNIT = 40  # below 128, for places of a byte
BLANK = "▁"
NONE = -np.inf

# Scores are rounded to this part of one, so that sums are exact in any order.
GRAIN = 4096
UNKNOWN_PENALTY = 10.0

ENCODED = "row long, doc_id long, chunk int, n_chunks int, ids array<int>, score double"
DIGESTS = (
    "row long, doc_id long, chunk int, n_chunks int, n_tokens long, score double, "
    "ids_crc32 long, n_bytes long, text_crc32 long"
)
CUT = "row long, doc_id long, chunk int, n_chunks int, length int, text string"
# A chunk between its first and last place that all paths pass; without such places
# ``head`` is the whole chunk, and the rest is null. ``inside`` are the tail's characters in it.
MEASURED = (
    "row long, doc_id long, chunk int, n_chunks int, length int, head string, "
    "middle array<int>, between double, tail string, inside int, matrix binary"
)

MEASURED_NAMES = [field.split()[0] for field in MEASURED.split(", ")]


class Lattice:
    """Pieces and scores of a model file, and best paths through texts.

    Blanks are written as the model's blank mark, one is put before every text, and
    a character without a piece becomes the pieces of its bytes, at a penalty. The
    model's own normalization beyond that is not applied.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.names: list[bytes | str] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.names.append(bytes([int(piece[1:-1], 16)]))
                continue
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            self.names.append("" if special else piece)
            if not special:
                self.pieces[piece] = (i, round(model.get_score(i) * GRAIN) / GRAIN)
        self.longest = max(map(len, self.pieces))
        self.unknown_id = model.unk_id()
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        # Every path passes before a blank behind another character.
        self.forced = all(BLANK not in p.lstrip(BLANK) for p in self.pieces)
        self._index_pieces()
        names = [n if isinstance(n, bytes) else n.replace(BLANK, " ").encode() for n in self.names]
        self.text = np.frombuffer(b"".join(names), np.uint8)
        self.text_ends = np.cumsum([0, *map(len, names)])
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.scores = np.zeros(0, np.float64)

    def _index_pieces(self) -> None:
        """Hashes of all pieces in order, with ids and scores; single bytes included."""
        entries = dict(self.pieces)
        for byte, id_ in self.bytes.items():
            if byte < 128 and chr(byte) not in entries:
                entries[chr(byte)] = (id_, self.unknown)
        rows = [(self._hash_of(piece), *entry) for piece, entry in entries.items()]
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.hash_ids = np.array([r[1] for r in rows], np.int32)
        self.hash_scores = np.array([r[2] for r in rows])
        begins = {piece[:n] for piece in entries for n in range(1, len(piece) + 1)}
        self.begins = np.zeros(1 << 22, bool)  # may hold more than there are, never less
        self.begins[np.array([self._hash_of(b) for b in begins], np.uint64) >> np.uint64(42)] = True

    @staticmethod
    def _next(hashes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ characters.astype(np.uint64)) * MIX
        mixed ^= mixed >> np.uint64(29)
        return mixed * STEP

    def _hash_of(self, piece: str) -> int:
        found = np.zeros(1, np.uint64)
        for c in piece:
            found = self._next(found, np.array([ord(c)]))
        return int(found[0])

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``hashes`` pieces are, and their places among all pieces."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        here = np.flatnonzero(self.hashes[at] == hashes)
        return here, at[here]

    def _best_of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Best paths of words of one length, blanks in them, all in step, and their scores.

        A path is a row of ids; -1 stands for a character without a piece, -2 for nothing.
        From each place on, only words whose letters there still begin some piece go on.
        """
        n, count = len(units[0]), len(units)
        letters = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(count, n)
        letters = np.where(letters.T == ord(" "), np.uint32(ord(BLANK)), letters.T)
        best, back = np.full((n + 1, count), NONE), np.zeros((n + 1, count), np.int8)
        last = np.full((n + 1, count), -1, np.int32)
        best[0] = 0.0
        for begin in range(n):
            # Best scores up to here are final; ties take the longest last piece.
            rows, hashes = np.arange(count), np.zeros(count, np.uint64)
            alone = best[begin] + self.unknown
            for end in range(begin + 1, min(begin + self.longest, n) + 1):
                hashes = self._next(hashes, letters[end - 1, rows])
                on = self.begins[hashes >> np.uint64(42)]
                rows, hashes = rows[on], hashes[on]
                if not len(rows):
                    break
                here, piece = self._find(hashes)
                found = rows[here]
                score = best[begin, found] + self.hash_scores[piece]
                if end == begin + 1:
                    alone[found] = NONE
                better = score > best[end, found]
                found, score, piece = found[better], score[better], piece[better]
                best[end, found], back[end, found] = score, begin
                last[end, found] = self.hash_ids[piece]
            better = alone > best[begin + 1]
            best[begin + 1, better], back[begin + 1, better] = alone[better], begin
            last[begin + 1, better] = -1
        rows, at = np.arange(count), np.full(count, n)
        steps = []
        while at.any():
            steps.append(np.where(at > 0, last[at, rows], -2))
            at = np.where(at > 0, back[at, rows], 0)
        return np.stack(steps[::-1], 1), best[n]

    def _learn(self, units: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        # Long ones, and those in which a character has several ids, go one by one.
        alone = [u for n, group in by_length.items() if n > LONG_UNIT for u in group]
        if not units:
            return
        order, flat, lengths, scores = [], [self.ids], [], [self.scores]
        for length, group in by_length.items():
            for i in range(0, len(group) if length <= LONG_UNIT else 0, BLOCK):
                block = group[i : i + BLOCK]
                paths, score = self._best_of_units(block)
                whole = ~(paths == -1).any(1)
                alone += [u for u, fine in zip(block, whole) if not fine]
                order += [u for u, fine in zip(block, whole) if fine]
                steps = paths[whole] > -2
                flat.append(paths[whole][steps])
                lengths.append(steps.sum(1))
                scores.append(score[whole])
        ways = [self.path(u.replace(" ", BLANK), 0, len(u), len(u)) for u in alone]
        flat.append(np.array([i for ids, _ in ways for i in ids], np.int32))
        lengths.append(np.array([len(ids) for ids, _ in ways], np.int64))
        scores.append(np.array([s for _, s in ways], np.float64))
        names = order + alone
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))
        self.starts = np.concatenate(
            [self.starts, len(self.ids) + np.cumsum(np.concatenate(lengths))]
        )
        self.ids, self.scores = np.concatenate(flat), np.concatenate(scores)

    @staticmethod
    def marked(text: str) -> str:
        return BLANK + text.replace(" ", BLANK) if text else ""

    def walk(self, text: str, begin: int, end: int) -> tuple[list[float], list[int]]:
        """Best scores from ``begin`` to each place up to ``longest`` behind ``end``.

        The steps to a place are pieces that begin before ``end``; ties take the
        longest last piece. Also the place before on the best path, or -1.
        """
        limit = min(len(text), end + self.longest - 1)
        best, back = [NONE] * (limit - begin + 1), [-1] * (limit - begin + 1)
        best[0] = 0.0
        pieces, longest = self.pieces, self.longest
        for at in range(begin, min(end, limit)):
            here = best[at - begin]
            if here == NONE:
                continue
            for stop in range(at + 1, min(at + longest, limit) + 1):
                found = pieces.get(text[at:stop])
                score = found[1] if found else self.unknown if stop == at + 1 else None
                if score is not None and here + score > best[stop - begin]:
                    best[stop - begin], back[stop - begin] = here + score, at
        return best, back

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.pieces:
            return [self.pieces[piece][0]]
        return [self.bytes.get(b, self.unknown_id) for b in piece.encode("utf-8", "replace")]

    def path(self, text: str, begin: int, end: int, stop: int) -> tuple[list[int], float]:
        """Ids and score of the best path from ``begin`` to ``stop``, the last step from before ``end``."""
        best, back = self.walk(text, begin, end)
        cuts, at = [stop], stop
        while at > begin:
            at = back[at - begin]
            cuts.append(at)
        cuts.reverse()
        ids = [i for a, b in zip(cuts, cuts[1:]) for i in self.ids_of(text[a:b])]
        return ids, best[stop - begin]

    def best(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best paths of texts between places that every path passes.

        All ids one after another, where each text's end, and each text's score.
        """
        if len(self.known) > MOST_UNITS:
            self._forget()
        column, n_units = self._units(texts)
        coded = column.dictionary_encode()
        units = coded.dictionary.to_pylist()
        self._learn([u for u in units if u not in self.known])
        places = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        which = places[coded.indices.to_numpy()]
        ids, ends = _gathered(self.ids, self.starts, which)
        totals = np.concatenate([[0.0], np.cumsum(self.scores[which])])
        return ids, ends[n_units[1:]], totals[n_units[1:]] - totals[n_units[:-1]]

    def _units(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """Runs of blanks with the word behind them, and where each text's begin and end.

        Blank marks are one byte in them, a blank.
        """
        encoded = [t.replace(BLANK, " ").encode() for t in texts]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        bounds = np.cumsum([0, *map(len, encoded)])
        blank = data == ord(" ")
        first = np.zeros(len(data), bool)
        if self.forced:
            first[1:] = blank[1:] & ~blank[:-1]
        first[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        at = np.flatnonzero(first)
        offsets = np.concatenate([at, [len(data)]]).astype(np.int32)
        column = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
        return column, np.searchsorted(at, bounds)

    def middle(self, text: str) -> tuple[np.ndarray, float]:
        """Ids and score of one such text."""
        ids, _, scores = self.best([text])
        return ids, float(scores[0])

    def _passed(self, text: str, length: int) -> tuple[int, int] | None:
        """The first place behind all entries and the last in the chunk that paths pass."""
        if not self.forced:
            return None
        places = [
            m.start() + 1
            for m in re.finditer(f"[^{BLANK}](?={BLANK})", text[: length + 1])
            if self.longest - 1 <= m.start() + 1 <= length
        ]
        return (places[0], places[-1]) if places else None

    def walks(self, text: str, end: int) -> np.ndarray:
        """Best scores from each entry to each place, the last steps from before ``end``.

        Row by place, up to ``longest`` behind ``end``; all entries in step.
        """
        n, limit = self.longest, min(len(text), end + self.longest - 1)
        best = np.full((limit + 1, n), NONE)
        entries = np.arange(min(n, limit + 1))
        best[entries, entries] = 0.0
        pieces = self.pieces
        for at in range(min(end, limit)):
            here = best[at]
            if here.max() == NONE:
                continue
            for stop in range(at + 1, min(at + n, limit) + 1):
                found = pieces.get(text[at:stop])
                score = found[1] if found else self.unknown if stop == at + 1 else None
                if score is not None:
                    np.maximum(best[stop], here + score, out=best[stop])
        return best

    def measured(self, text: str, length: int) -> tuple:
        """The parts of the chunk ``text[:length]`` and its matrix, as in ``MEASURED``.

        The matrix has the best scores from each entry to each exit. What follows in
        ``text`` is the begin of the next chunk. An entry behind the chunk's end is an
        exit at once.
        """
        n = self.longest
        found = np.full((n, n), NONE)
        passed = self._passed(text, length)
        if passed:
            first, last = passed
            ids, between = self.middle(text[first:last])
            ahead = self.walks(text[:first], first)[first]
            behind = np.array(self.walk(text, last, length)[0][length - last :])
            found[:, : len(behind)] = (ahead + between)[:, None] + behind
            return text[:first], ids, between, text[last:], length - last, found
        exits = self.walks(text, length)[length:]
        found[:, : len(exits)] = exits.T
        return text, None, None, None, None, found

    def trace(
        self, parts: tuple, length: int, entry: int, exit_: int
    ) -> tuple[np.ndarray, float]:
        """Ids and score of the best path between an entry and an exit of a measured chunk."""
        head, middle, between, tail, inside = parts
        if entry >= length:
            return np.zeros(0, np.int32), 0.0
        if middle is None:
            ids, score = self.path(head, entry, length, length + exit_)
            return np.array(ids, np.int32), score
        before, first = self.path(head, entry, len(head), len(head))
        after, last = self.path(tail, 0, inside, inside + exit_)
        ids = np.concatenate([np.array(p, np.int32) for p in (before, middle, after)])
        return ids, first + between + last

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Texts of runs of ids, in UTF-8, with the blank that stands before every text."""
        data, stops = _gathered(self.text, self.text_ends, ids)
        whole = data.tobytes()
        bounds = [0, *stops[ends].tolist()]
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]


def _gathered(
    values: np.ndarray, starts: np.ndarray, which: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ``values``, one after another, and where each begins and the last ends."""
    first, length = starts[which], starts[which + 1] - starts[which]
    total = np.concatenate([[0], np.cumsum(length)])
    return values[np.repeat(first - total[:-1], length) + np.arange(total[-1])], total


def longest_piece(path: str) -> int:
    """The characters of a model's longest piece."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    ids = (i for i in range(model.get_piece_size()) if not any(of(i) for of in special))
    return max(len(model.id_to_piece(i)) for i in ids)


def lattice_for(path: str) -> Lattice:
    """The lattice of this Python worker, which keeps it from one task to the next."""
    kept = sys.__dict__.setdefault("_lattices", {})
    if path not in kept:
        kept.clear()
        kept[path] = Lattice(path)
    return kept[path]


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix of one chunk after another; associative."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def _square(data: bytes) -> np.ndarray:
    values = np.frombuffer(data, "<f8")
    side = int(len(values) ** 0.5)
    return values.reshape(side, side)


def between(matrices: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """On a best path from ``entry`` to ``exit_``: where it enters each matrix, and its exit."""
    ahead = np.full(len(matrices[0]), NONE)
    ahead[exit_] = 0.0
    after = [ahead]
    for m in matrices[:0:-1]:
        after.append((m + after[-1][None, :]).max(1))
    states = [entry]
    for m, rest in zip(matrices, after[::-1]):
        states.append(int(np.argmax(m[states[-1]] + rest)))
    return states


def _cut(giants: DataFrame, chunk: int, longest: int) -> DataFrame:
    """A row per chunk, with the begin of the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row, key, whole = (column.slice(at, 1) for column in batch.columns)
                text = Lattice.marked(as_texts(whole)[0])
                n = -(-len(text) // chunk)
                for i in range(0, n, FAN):
                    some = range(i, min(i + FAN, n))
                    parts = [text[j * chunk : (j + 1) * chunk + longest - 1] for j in some]
                    repeated = pa.array([0] * len(parts), pa.int64())
                    arrays = [
                        row.take(repeated),
                        key.take(repeated),
                        pa.array(some, pa.int32()),
                        pa.array([n] * len(parts), pa.int32()),
                        pa.array([min(chunk, len(text) - j * chunk) for j in some], pa.int32()),
                        pa.array(parts, pa.string()),
                    ]
                    names = ["row", "doc_id", "chunk", "n_chunks", "length", "text"]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return giants.mapInArrow(run, CUT)


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what a task holds of texts is bounded."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _measured(chunks: DataFrame, model: str) -> DataFrame:
    """Each chunk with its matrix, by itself, whatever text it is from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_for(model)
        for batch in _few(batches, FAN):
            texts, lengths = as_texts(batch.column(5)), batch.column(4).to_pylist()
            lattice.best(texts)  # so that words are worked out many at a time
            *parts, matrices = zip(*map(lattice.measured, texts, lengths))
            types = pa.string(), pa.list_(pa.int32()), pa.float64(), pa.string(), pa.int32()
            arrays = [
                *batch.columns[:5],
                *(pa.array(part, type_) for part, type_ in zip(parts, types)),
                pa.array([m.astype("<f8").tobytes() for m in matrices], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=MEASURED_NAMES)

    return chunks.mapInArrow(run, MEASURED)


def _spread(blocks: DataFrame, by: str = "block") -> DataFrame:
    """By block over all partitions, few as the bytes may be: the work is in the matrices."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(parts, "row", by)


def _up(level: DataFrame, fan: int) -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = None
        for data in rows.sort_values("place")["matrix"]:
            total = _square(data) if total is None else combined(total, _square(data))
        return pd.DataFrame({"row": [key[0]], "place": [key[1]], "matrix": [total.tobytes()]})

    blocks = _spread(level.withColumn("block", F.floor(F.col("place") / fan)))
    return blocks.groupBy("row", "block").applyInPandas(run, "row long, place long, matrix binary")


def _down(level: DataFrame, states: DataFrame, fan: int) -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        entry, exit_ = int(rows["entry"].iloc[0]), int(rows["exit"].iloc[0])
        found = between([_square(m) for m in rows["matrix"]], entry, exit_)
        return pd.DataFrame(
            {"row": rows["row"], "place": rows["place"], "entry": found[:-1], "exit": found[1:]}
        )

    blocks = level.withColumn("block", F.floor(F.col("place") / fan))
    known = states.withColumnRenamed("place", "block")
    joined = _spread(blocks.join(known, ["row", "block"]))
    return joined.groupBy("row", "block").applyInPandas(
        run, "row long, place long, entry int, exit int"
    )


def _giants(docs: DataFrame, model: str, chunk: int, fan: int, rows: "_Rows") -> DataFrame:
    chunks = _spread(_cut(docs, chunk, longest_piece(model)), "chunk")
    cut = materialize(_measured(chunks, model))
    levels = [cut.select("row", F.col("chunk").cast("long").alias("place"), "matrix")]
    most = cut.agg(F.max("n_chunks")).first()[0] or 0
    while most > 1:
        levels.append(materialize(_up(levels[-1], fan)))
        most = -(-most // fan)
    ends = F.lit(0).alias("entry"), F.lit(0).alias("exit")
    states = levels[-1].select("row", "place", *ends)
    for level in levels[-2::-1]:
        states = materialize(_down(level, states, fan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_for(model)
        for batch in _few(batches, FAN):
            length, entry, exit_ = (batch.column(i).to_pylist() for i in (4, 10, 11))
            middles = batch.column(6)
            flat = middles.flatten().to_numpy()
            sizes = middles.value_lengths().fill_null(0).to_numpy()
            middle = np.split(flat, np.cumsum(sizes))[:-1]
            alone = middles.is_null().to_pylist()
            head, tail = batch.column(5).to_pylist(), batch.column(8).to_pylist()
            between, inside = batch.column(7).to_pylist(), batch.column(9).to_pylist()
            middle = [None if missing else ids for missing, ids in zip(alone, middle)]
            parts = zip(head, middle, between, tail, inside)
            found = [lattice.trace(*each) for each in zip(parts, length, entry, exit_)]
            ids, scores = [i for i, _ in found], [s for _, s in found]
            flat = np.concatenate([np.zeros(0, np.int32), *ids])
            yield rows(lattice, batch.columns[:4], flat, np.cumsum([*map(len, ids)]), scores)

    placed = states.withColumnRenamed("place", "chunk")
    wanted = (*MEASURED_NAMES[:-1], "entry", "exit")
    traced = cut.drop("matrix").join(placed, ["row", "chunk"]).select(*wanted)
    return traced.mapInArrow(run, ROWS[rows])


def _encoded(
    lattice: Lattice, columns: list[pa.Array], ids: np.ndarray, ends: np.ndarray, scores
) -> pa.RecordBatch:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    arrays = [*columns, pa.ListArray.from_arrays(offsets, ids), pa.array(scores, pa.float64())]
    return pa.RecordBatch.from_arrays(
        arrays, names=["row", "doc_id", "chunk", "n_chunks", "ids", "score"]
    )


def _digested(
    lattice: Lattice, columns: list[pa.Array], ids: np.ndarray, ends: np.ndarray, scores
) -> pa.RecordBatch:
    texts = lattice.decode(ids, ends)
    # The blank before a text is not part of it.
    texts = [t[1:] if chunk == 0 else t for t, chunk in zip(texts, columns[2].to_pylist())]
    data, bounds = ids.astype("<u4").tobytes(), [0, *(4 * ends).tolist()]
    checks = [zlib.crc32(data[a:b]) for a, b in zip(bounds, bounds[1:])]
    arrays = [
        *columns,
        pa.array(np.diff(ends, prepend=0), pa.int64()),
        pa.array(scores, pa.float64()),
        pa.array(checks, pa.int64()),
        pa.array([*map(len, texts)], pa.int64()),
        pa.array([*map(zlib.crc32, texts)], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(
        arrays, names=[field.split()[0] for field in DIGESTS.split(", ")]
    )


# What is told of each chunk: all its ids, or their number and checksums.
_Rows = Callable[[Lattice, list[pa.Array], np.ndarray, np.ndarray, list[float]], pa.RecordBatch]
ROWS: dict[_Rows, str] = {_encoded: ENCODED, _digested: DIGESTS}


def _numbered(docs: DataFrame, giant: bool, chunk: int) -> DataFrame:
    row = F.monotonically_increasing_id().alias("row")
    numbered = docs.select(row, F.col("doc_id").cast("long"), "text")
    is_giant = F.coalesce(F.char_length("text"), F.lit(0)) >= chunk
    return numbered.filter(is_giant if giant else ~is_giant)


def _short(docs: DataFrame, model: str, rows: _Rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = lattice_for(model)
        for batch in _few(batches, SHORT_ROWS):
            texts = as_texts(batch.column(2))
            for a, b in slices(texts):
                part = batch.slice(a, b - a)
                found = lattice.best([lattice.marked(t) for t in texts[a:b]])
                counts = pa.array([0] * (b - a), pa.int32()), pa.array([1] * (b - a), pa.int32())
                yield rows(lattice, [*part.columns[:2], *counts], *found)

    return docs.mapInArrow(run, ROWS[rows])


def encode(docs: DataFrame, model: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(row, doc_id, chunk, n_chunks, ids, score) of every ``docs(doc_id, text)``.

    A text of less than ``chunk`` characters is one row; the rows of a longer one,
    in the order of their chunks, are its ids. Where paths tie, one of the best is
    taken. Null and empty texts have no ids. ``row`` numbers the rows of ``docs``, so null
    and repeated ids stay apart. ``docs`` must give its rows in the same order each
    time, as a stored table does. Chunks of longer texts with their matrices, and states
    of blocks, are written to the shared folder.
    """
    short = _short(_numbered(docs, False, chunk), model, _encoded)
    return short.unionByName(_giants(_numbered(docs, True, chunk), model, chunk, fan, _encoded))


def digests(docs: DataFrame, model: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """What ``encode`` gives for each of ``docs(doc_id, text)``, and what its ids give back.

    doc_id, n_chunks, n_tokens, score, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), n_bytes and text_crc32 (of the decoded text in UTF-8, blank marks as
    blanks). Null and empty texts have zeros, an empty table no rows, null and repeated ids a
    row each. Ids and texts never come together: a longer text's checksums are those of its
    chunks, each moved by the number of bytes behind it, so they add up in any order.
    """
    short = _short(_numbered(docs, False, chunk), model, _digested)
    rows = _giants(_numbered(docs, True, chunk), model, chunk, fan, _digested)
    behind = Window.partitionBy("row").orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)

    def after(size: str) -> Column:
        return F.coalesce(F.sum(size).over(behind), F.lit(0)).alias(f"{size}_after")

    @F.arrow_udf("long")
    def moved(check: pa.Array, n: pa.Array) -> pa.Array:
        pairs = zip(check.to_pylist(), n.to_pylist())
        return pa.array([shifted_crc32(*pair) for pair in pairs], pa.int64())

    whole = ["doc_id", "n_chunks", "n_tokens", "score", "ids_crc32", "n_bytes", "text_crc32"]
    parts = rows.select("*", after("n_tokens"), after("n_bytes"))
    added = parts.withColumns(
        {
            "ids_crc32": moved("ids_crc32", 4 * F.col("n_tokens_after")),
            "text_crc32": moved("text_crc32", "n_bytes_after"),
        }
    ).groupBy("row", "doc_id", "n_chunks")
    giants = added.agg(
        *(F.sum(c).alias(c) for c in ("n_tokens", "score", "n_bytes")),
        *(F.bit_xor(c).alias(c) for c in ("ids_crc32", "text_crc32")),
    )
    return short.select(*whole).union(giants.select(*whole))


def _times(a: int, b: int) -> int:
    """The product of two polynomials over two elements, modulo that of CRC-32 (bits reversed)."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return product


def shifted_crc32(check: int, n: int) -> int:
    """The part of bytes with this checksum in that of a longer run, ``n`` bytes behind them.

    The checksum of a run is the exclusive or of those of its parts.
    """
    power = 1 << 23  # eight places, so one byte
    while n:
        if n & 1:
            check = _times(power, check)
        power, n = _times(power, power), n >> 1
    return check


def decoded(ids: str, model: str) -> Column:
    """The text of a column of ids.

    The text of a document is that of its chunks, one after another, without the first
    blank; a blank mark in it has become a blank.
    """

    @F.arrow_udf(StringType())
    def texts(column: pa.Array) -> pa.Array:
        lattice = lattice_for(model)
        ids = column.flatten().to_numpy(zero_copy_only=False)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        texts = lattice.decode(ids, np.cumsum(lengths))
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())

    return texts(F.col(ids))
