"""Token ids of whole texts by a tokenizer file, each distinct chunk encoded once."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

# A chunk is a run of blanks and line ends with the word behind it. Both public
# tokenizers of this kind never form a token over the end of a word, so the ids of
# a text are those of its chunks, one after another.
BLANK, LINE_END = b" \n"

# Other white space could continue a run across a chunk's start; texts with it are
# one chunk.
OTHER_SPACE = re.compile(
    r"[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)

# Marks that end a word: behind a Latin letter they are tokens of their own.
MARKS = ".,;:!?"

# Distinct words, and characters in them, that a Python worker keeps at a time: up to
# some 150 MB.
MOST_WORDS = 700_000
MOST_CHARS = 14_000_000

# Characters encoded at a time; one longer text is a batch of its own.
BATCH_CHARS = 2_000_000


# How byte-level vocabularies write bytes: printable ones as they are, the others by
# the characters from 256 on, in their order.
SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
HIDDEN = [b for b in range(256) if b not in SHOWN]
BYTE_MARKS = {b: chr(256 + i) for i, b in enumerate(HIDDEN)}


class ChunkEncoder:
    """Encodes with the ``tokenizers`` library, without special tokens added.

    Special strings inside a text are handled as the library does by default. The
    library sees each word once, without the marks behind it; and without blanks and
    capitals where they make no difference to it. Words of Latin letters go to its
    model many at a time, past the steps that cannot change or divide them. What is
    remembered is bounded: beyond ``MOST_WORDS`` or ``MOST_CHARS`` it starts anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for each in (self.tokenizer, self.model):
            each.no_truncation()
            each.no_padding()
        self.model.normalizer, self.model.pre_tokenizer = Sequence([]), WhitespaceSplit()
        plain, blank, capital = (e.ids for e in self._library(["ab", "\n ab", "aB"]))
        self.drops_blanks, self.drops_capitals = plain == blank, plain == capital
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(token.content) for token in added) or r"(?!)")
        self.edges = self._edges()
        letters = ["ab", "thextra", "été", "straße", "the", "ñandú"]
        letters = letters if self.drops_blanks else [" " + w for w in letters]
        lengths, ids = self._ids_of_letters(letters)
        expected = [e.ids for e in self._library(letters)]
        self.letters_apart = [p.tolist() for p in np.split(ids, np.cumsum(lengths))[:-1]] == expected
        self._forget()

    def _library(self, words: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(words, add_special_tokens=False)

    def _edges(self) -> np.ndarray:
        """Of each id: the token begins with a blank, or where these make no difference ends a word."""
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        edges = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        for token, i in vocabulary.items():
            if self.drops_blanks:
                edges[i] = bool(suffix) and token.endswith(suffix)
            else:
                edges[i] = token.startswith(BYTE_MARKS[BLANK])
        return edges

    def _ids_of_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words of letters, each as the model alone divides it.

        Every word has one token at its edge, which tells the words apart.
        """
        # A line end, which no word of letters holds, parts them.
        shown = "\n".join(words).encode().decode("latin-1")
        for byte, mark in BYTE_MARKS.items():
            shown = shown.replace(chr(byte), mark)
        shown = shown.split(BYTE_MARKS[LINE_END]) if words else []
        groups = [" ".join(shown[i : i + 200]) for i in range(0, len(shown), 200)]
        found = self.model.encode_batch_fast(groups, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32)
        at = np.flatnonzero(self.edges[ids])
        lengths = np.diff(at, prepend=-1) if self.drops_blanks else np.diff(at, append=len(ids))
        return lengths, ids

    def _is_letters(self, word: str) -> bool:
        """One run of Latin letters that stays as it is, behind one blank where these count."""
        bare = word[1:] if word[:1] == " " else word
        return (
            bare.isalpha()
            and (bare.isascii() or max(bare) < "\u0250")
            and (word == bare) == self.drops_blanks
            and (not self.drops_capitals or word == word.lower())
        )

    def _forget(self) -> None:
        self.words: dict[str, int] = {"": 0}
        self.chars = 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(2, np.int64)

    def _word_and_marks(self, chunk: str) -> tuple[str, str]:
        word, marks = chunk, ""
        if chunk[-1] in MARKS:
            bare = chunk.rstrip(MARKS)
            last = bare[-1:]
            # A letter whose small form ends in a combining sign takes the marks with it.
            if last.isalpha() and last < "\u0250" and len(last.lower()) == 1:
                word, marks = bare, chunk[len(bare) :]
        if self.drops_blanks and (bare := word.strip(" \n")):
            word = bare
        if self.drops_capitals and word.isascii():
            small = word.lower()
            if not self.special.search(small):
                word = small
        return word, marks

    def _learn(self, new: list[str]) -> None:
        """Encode words that are not known yet."""
        words = self.words
        letters = [w for w in new if self._is_letters(w)] if self.letters_apart else []
        taken = set(letters)
        others = [w for w in new if w not in taken]
        words.update(zip(letters + others, range(len(words), len(words) + len(new))))
        lengths, flat = self._ids_of_letters(letters)
        ids = [e.ids for e in self._library(others)]
        lengths = np.concatenate([lengths, np.fromiter(map(len, ids), np.int64, len(ids))])
        rest = np.fromiter(chain.from_iterable(ids), np.uint32)
        ends = np.cumsum(lengths) + len(self.ids)
        self.ids = np.concatenate([self.ids, flat, rest])
        self.starts = np.concatenate([self.starts, ends])
        self.chars += sum(map(len, new))

    def _chunks(self, texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
        """The chunks of all texts, and how many each has.

        Where blanks make no difference to the library they are left out.
        """
        encoded = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum([len(e) for e in encoded], dtype=np.int64)
        begins = np.concatenate([[0], ends])[:-1]
        some = begins < ends
        blank = (data == BLANK) | (data == LINE_END)
        before = np.concatenate([[False], blank])[:-1]
        before[begins[some]] = self.drops_blanks
        first = before & ~blank if self.drops_blanks else blank & ~before
        kept = ~blank if self.drops_blanks else None
        whole = [i for i, text in enumerate(texts) if OTHER_SPACE.search(text)]
        for i in whole:
            first[begins[i] : ends[i]] = False
            if kept is not None:
                kept[begins[i] : ends[i]] = True
        first[begins[whole] if self.drops_blanks else begins[some]] = True
        at = np.flatnonzero(first)
        n_chunks = np.searchsorted(at, ends) - np.searchsorted(at, begins)
        if kept is not None:
            at = (np.cumsum(kept) - kept)[at]
            data = data[kept]
        offsets = np.concatenate([at, [len(data)]]).astype(np.int32)
        column = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
        return column, n_chunks

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of whole texts, one after another, and where each ends."""
        if len(self.words) > MOST_WORDS or self.chars > MOST_CHARS:
            self._forget()
        column, n_chunks = self._chunks(texts)
        coded = column.dictionary_encode()
        chunks = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        words = self.words
        parts = np.zeros((len(chunks), 2), np.int64)  # of each chunk its word and its marks
        parts[:, 0] = np.fromiter(map(words.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(parts[:, 0] < 0)
        cut = [part for i in missing.tolist() for part in self._word_and_marks(chunks[i])]
        self._learn([w for w in dict.fromkeys(cut) if w not in words])
        parts[missing] = np.fromiter(map(words.__getitem__, cut), np.int64, len(cut)).reshape(-1, 2)
        # Of each distinct chunk where its ids lie; its marks, mostly none, are a run apart.
        begins, sizes = self.starts[parts], self.starts[parts + 1] - self.starts[parts]
        which = coded.indices.to_numpy()
        length = sizes.astype(np.int32)[which].reshape(-1)
        some = np.flatnonzero(length)
        first, length = begins.astype(np.int32)[which].reshape(-1)[some], length[some]
        total = np.cumsum(length, dtype=np.int64)
        ids = np.ones(total[-1] if len(total) else 0, np.int32)
        if len(total):
            # Steps of one inside a run, and from the end of a run to the next.
            ids[0] = first[0]
            ids[total[:-1]] = first[1:] - (first[:-1] + length[:-1] - 1)
            np.cumsum(ids, out=ids)
        runs = np.searchsorted(some, 2 * np.cumsum(n_chunks))
        ends = np.concatenate([[0], total])[runs]
        return self.ids[ids], ends


def encoder_for(path: str) -> ChunkEncoder:
    """The encoder of this Python worker, which keeps it from one task to the next."""
    kept = sys.__dict__.setdefault("_chunk_encoders", {})
    if path not in kept:
        kept.clear()  # one at a time, so that memory stays bounded
        kept[path] = ChunkEncoder(path)
    return kept[path]


def as_texts(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty, bytes that are no UTF-8 are replaced."""
    return [(b or b"").decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[str], most_chars: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``most_chars`` characters each."""
    begin = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= most_chars:
            yield begin, i + 1
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def documents_of_ids(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[list, list[np.ndarray]]]:
    """From batches of (doc_id, text): keys and the ids of each text, ``end_id`` last."""
    encoder = encoder_for(path)
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), as_texts(batch.column(1))
        for a, b in slices(texts):
            ids, ends = encoder.encode(texts[a:b])
            ids = np.insert(ids, ends, np.uint32(end_id))
            bounds = ends[:-1] + np.arange(1, b - a)
            yield keys[a:b], np.split(ids, bounds)
