"""Token counts of whole texts by a SentencePiece model."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.llm.tokens import as_texts

MAX_TOKENS = 4096

# What is encoded at a time, and how much of one text at most stands in one part.
BATCH_BYTES = 1_000_000
PART_CHARS = 65_536

# Distinct chunks that one task keeps the count of.
MOST_CHUNKS = 400_000

BLANK = "▁"
CHUNK = re.compile(f"[ {BLANK}]+[^ {BLANK}]*")
# A blank with nothing behind it is one token, whichever way it is written.
LONE = {" ": 1, BLANK: 1}

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Counter:
    """Numbers of tokens as the ``sentencepiece`` library gives them for whole texts.

    A blank after another character is a safe boundary if no piece of the model holds
    a blank behind anything else and the model changes no text before cutting it:
    then no merge crosses it, and the count of a text is the sum over its chunks,
    each a run of blanks and the word behind it. For other models nothing is cut.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        probes = ("a  b", "  a b ", "ﬁ é.\nx\ty", "a▁b ▁c", "a▁", "a ▁", "a▁ ▁")
        self.known: dict[str, int] = dict(LONE)
        self.cuts = all(BLANK not in p.lstrip(BLANK) for p in pieces) and all(
            sum(self._chunk_counts(CHUNK.findall(" " + p))) == len(self.model.encode(p))
            for p in probes
        )

    def _chunk_counts(self, chunks: list[str]) -> list[int]:
        """A chunk begins with the blank that the model puts before every text."""
        if len(self.known) > MOST_CHUNKS:
            self.known = dict(LONE)
        known = self.known
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        if new:
            found = self.model.encode([c[1:] for c in new], num_threads=1)
            known.update(zip(new, map(len, found)))
        return [known[c] for c in chunks]

    def parts(self, text: str) -> Iterator[tuple[list[str], int]]:
        """A text's chunks and their bytes, some ``PART_CHARS`` characters at a time."""
        part, chars, n_bytes = [], 0, 0
        for match in CHUNK.finditer(" " + text):
            part.append(match.group())
            chars += len(part[-1])
            n_bytes += len(part[-1].encode())
            if chars >= PART_CHARS:
                yield part, n_bytes
                part, chars, n_bytes = [], 0, 0
        if part:
            yield part, n_bytes

    def count(self, texts: list[str], n_bytes: list[int]) -> list[int]:
        """Token counts, in batches of ``BATCH_BYTES`` that may end inside a text.

        ``n_bytes`` are the lengths of the texts in UTF-8.
        """
        if not self.cuts:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        totals = [0] * len(texts)
        chunks: list[str] = []
        owners: list[tuple[int, int]] = []
        size = 0

        def finish() -> None:
            done = 0
            numbers = self._chunk_counts(chunks)
            for owner, n in owners:
                totals[owner] += sum(numbers[done : done + n])
                done += n

        for i, text in enumerate(texts):
            if not text:
                continue
            whole = len(text) <= PART_CHARS
            parts = [(CHUNK.findall(" " + text), n_bytes[i])] if whole else self.parts(text)
            for part, part_bytes in parts:
                chunks += part
                owners.append((i, len(part)))
                size += part_bytes
                if size >= BATCH_BYTES:
                    finish()
                    chunks, owners, size = [], [], 0
        finish()
        return totals


def token_counts(docs: DataFrame, model: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every ``docs(doc_id, text)``.

    Only lengths leave the task. Null text is empty and has no tokens; null and
    repeated ids are kept, one row each; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model)
        for batch in batches:
            texts = as_texts(batch.column(1))
            n_bytes = [len(b or b"") for b in batch.column(1).cast(pa.binary()).to_pylist()]
            n_tokens = counter.count(texts, n_bytes)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": pa.array(n_bytes, pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "over_limit": pa.array([n > max_tokens for n in n_tokens], pa.bool_()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTS)
