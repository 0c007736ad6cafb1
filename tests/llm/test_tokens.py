"""Token counts, packing and token files against the libraries on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from daedap.llm.counts import Counter, token_counts
from daedap.llm.dac import TokenFile, read_tokens, write_file, write_tokens
from daedap.llm.folders import create, new_folder, reading
from daedap.llm.packing import pack, sum_of_squares, token_pieces
from daedap.llm.queries import QUERIES, table
from daedap.llm.tokens import ChunkEncoder

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
FILES = [public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json")]
ODD = st.text(st.sampled_from(" \n\t▁aB'sé!1 日🙂Σ\x1c") | st.characters(codec="utf-8"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoders():
    return [(ChunkEncoder(f), Tokenizer.from_file(f)) for f in FILES]


def test_chunks_give_the_ids_of_awkward_texts(encoders):
    texts = [t or "" for t in TEXTS]
    for encoder, tokenizer in encoders:
        ids, ends = encoder.encode(texts)
        parts = [p.tolist() for p in np.split(ids, ends)[:-1]]
        assert parts == [ids_of(tokenizer, t) for t in texts]


def test_words_of_letters_go_to_the_model(spark, encoders):
    """Every word of real texts, and letters of all Latin blocks in all positions."""
    texts = [t for (t,) in table(spark, SF, "documents").select("text").collect()]
    texts += [f"{chr(i)} a{chr(i)} {chr(i)}b. A{chr(i)}" for i in range(0x41, 0x260)]
    texts += [f"a{chr(i)}{m} GELD{chr(i)}{m}{m}" for i in range(0x41, 0x260) for m in ".,;:!?"]
    for encoder, tokenizer in encoders:
        assert encoder.letters_apart
        ids, ends = encoder.encode(texts)
        parts = [p.tolist() for p in np.split(ids, ends)[:-1]]
        assert parts == [ids_of(tokenizer, t) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_chunks_give_the_ids_of_whole_texts(encoders, texts):
    for encoder, tokenizer in encoders:
        ids, ends = encoder.encode(texts)
        parts = [p.tolist() for p in np.split(ids, ends)[:-1]]
        assert parts == [ids_of(tokenizer, t) for t in texts]


def counted(counter, texts):
    return counter.count(texts, [len(t.encode()) for t in texts])


@pytest.mark.parametrize("text", ["▁", "a▁", ">▁", "\t▁", "日▁", "a▁ ", "a ▁", "a▁▁", " ", "a "])
def test_a_blank_at_the_end_is_a_token(counter, text):
    ours, model = counter
    assert counted(ours, [text]) == [len(model.encode(text))]


@pytest.fixture(scope="module")
def counter():
    return Counter(MODEL), SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=400, deadline=None)
@given(st.lists(ODD, max_size=4))
def test_chunks_give_the_counts_of_whole_texts(counter, texts):
    ours, model = counter
    assert ours.cuts
    texts += [t + "▁" for t in texts]
    assert counted(ours, texts) == [len(model.encode(t)) for t in texts]


def test_counts_of_long_texts_in_parts(counter):
    ours, model = counter
    long = [t for t in TEXTS if t]
    assert counted(ours, long * 3) == [len(model.encode(t)) for t in long] * 3
    whole = Counter(MODEL)
    whole.cuts = False
    assert counted(whole, long) == counted(ours, long)


def test_token_counts(spark):
    model = SentencePieceProcessor(model_file=MODEL)
    docs = documents(spark)
    expected = [
        (d, len((t or "").encode()), len(n := model.encode(t or "")), len(n) > 4096)
        for d, t in docs.select("doc_id", "text").collect()
    ]
    assert sorted(map(tuple, token_counts(docs, MODEL).collect()), key=str) == sorted(expected, key=str)
    assert token_counts(empty(spark), MODEL).count() == 0


def test_token_files(spark):
    tokenizer = Tokenizer.from_file(FILES[1])
    docs = documents(spark)
    files = write_tokens(docs, FILES[1], file_tokens=1000)
    assert files.count() > 2
    rows = sorted(read_tokens(files).collect(), key=lambda r: r.start)
    ids = {}
    for d, t in docs.select("doc_id", "text").collect():
        ids.setdefault(d, np.array([*ids_of(tokenizer, t), 0], "<u4"))
    start = 0
    for row, key in zip(rows, sorted([*range(len(TEXTS)), 1, None], key=lambda k: (k is not None, k or 0)), strict=True):
        expected = ids[key]
        assert tuple(row) == (key, start, len(expected), zlib.crc32(expected.tobytes()))
        start += len(expected)
    assert read_tokens(write_tokens(empty(spark), FILES[1])).count() == 0


def test_any_token_is_read_directly(spark):
    numbers = np.random.default_rng(5)
    ids = (numbers.integers(0, 2**32, 5000, np.uint64) >> numbers.integers(0, 32, 5000, np.uint64)).astype(np.uint32)
    address = new_folder(spark, "test") + "/a.dac"
    with create(address) as out:
        write_file(out, [7, None, 3], [ids[:3000], ids[3000:3000], ids[3000:]])
    with reading(address) as source:
        file = TokenFile(source)
        assert [file.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
        assert file.tokens().tolist() == ids.tolist()
        assert file.documents()[0] == [7, None, 3] and file.documents()[1].tolist() == [3000, 3000, 5000]
        with pytest.raises(IndexError):
            file.token(5000)


def check_packing(rows, ids, most=2048):
    """All ids are there once, and every sequence is gapless and not too long."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for key, expected in ids.items():
        # Rows that repeat an id give the same pieces again.
        pieces = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[key]})
        assert pieces == [
            (n, s, len(p := expected[s : s + most]), zlib.crc32(p.tobytes()))
            for n, s in enumerate(range(0, len(expected), most))
        ]
    for members in by_sequence.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= most
    return len(by_sequence)


def test_packing(spark):
    tokenizer = Tokenizer.from_file(FILES[0])
    docs = documents(spark)
    ids = {d: np.array([*ids_of(tokenizer, t), 0], "<u4") for d, t in docs.select("doc_id", "text").collect()}
    rows = pack(token_pieces(docs, FILES[0]), group=40).collect()
    check_packing(rows, ids)
    assert sum(r.length for r in rows) == sum(map(len, ids.values())) + len(ids[1])
    assert pack(token_pieces(empty(spark), FILES[0])).count() == 0
    named = token_pieces(docs, FILES[0]).selectExpr("*", "doc_id AS _group", "piece AS `_GROUP_`")
    again = pack(named, group=40)
    assert again.columns == [*named.columns, "sequence_id", "offset"]
    rows = again.collect()
    check_packing(rows, ids)
    assert all((r[5], r[6]) == (r.doc_id, r.piece) for r in rows)


def test_packing_wastes_little(spark):
    tokenizer = Tokenizer.from_file(FILES[0])
    rows = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    ids = {d: np.array([*ids_of(tokenizer, t), 0], "<u4") for d, t in docs}
    assert check_packing(rows, ids) <= 1.01 * sum(map(len, ids.values())) / 2048 + 1


def test_placement_makes_squares_least():
    """Against a plain search over all open bins."""
    lengths = np.random.default_rng(3).integers(1, 21, 300)
    bins, places = sum_of_squares(lengths, 20)
    gaps = []
    for size, bin_, place in zip(lengths.tolist(), bins.tolist(), places.tolist()):
        def squares(choice):
            after = [g - size * (i == choice) for i, g in enumerate(gaps)]
            return sum(after.count(g) ** 2 for g in range(1, 20)), gaps[choice]
        fitting = [i for i, g in enumerate(gaps) if g >= size]
        if fitting:
            assert squares(bin_) == min(map(squares, fitting))
        else:
            assert bin_ == len(gaps)
            gaps.append(20)
        assert place == 20 - gaps[bin_]
        gaps[bin_] -= size


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_letters_have_one_edge(name):
    """Words encoded many at a time are told apart by one token each, without offsets."""
    encoder = ChunkEncoder(public_tokenizers.path(name))
    words = ["a", "straße", "ñandúes", "überschwänglichkeiten", "zzzzqqqxxx", "Ø" if not encoder.drops_capitals else "ø"]
    words = [w if encoder.drops_blanks else " " + w for w in words] * 70
    assert all(map(encoder._is_letters, words))
    lengths, ids = encoder._ids_of_letters(words)
    assert encoder.edges[ids].sum() == len(words) == len(lengths)
    found = [p.tolist() for p in np.split(ids, np.cumsum(lengths))[:-1]]
    assert found == [e.ids for e in encoder._library(words)]
    assert [len(x) for x in encoder._ids_of_letters([])] == [0, 0]
