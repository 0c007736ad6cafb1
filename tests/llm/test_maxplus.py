"""Best paths in parallel against one sequential pass, and round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import TEXTS, documents, empty
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from daedap.llm import maxplus
from daedap.llm.maxplus import BLANK, Lattice, combined, decoded, digests, encode, shifted_crc32
from daedap.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return Lattice(MODEL)


def best_score(lattice, text):
    """The largest sum over all ways to cut a text, by one pass over it."""
    text = lattice.marked(text)
    best = [0.0]
    for end in range(1, len(text) + 1):
        choices = [best[end - 1] + lattice.unknown] if text[end - 1] not in lattice.pieces else []
        for begin in range(max(0, end - lattice.longest), end):
            found = lattice.pieces.get(text[begin:end])
            if found:
                choices.append(best[begin] + found[1])
        best.append(max(choices))
    return best[-1]


def score_of(lattice, ids):
    """The sum of the scores of ids; the bytes of a character together are one penalty."""
    scores = {i: s for i, s in lattice.pieces.values()}
    total, data = 0.0, b""
    for i in [*ids, None]:
        if i is not None and isinstance(lattice.names[i], bytes):
            data += lattice.names[i]
            continue
        total += len(data.decode()) * lattice.unknown
        data = b""
        total += scores[i] if i is not None else 0
    return total


def by_document(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.row, r.chunk)):
        found.setdefault(r.row, []).append(r)
    return found


def check(spark, lattice, docs, chunk, fan):
    rows = encode(docs, MODEL, chunk, fan).withColumn("text", decoded("ids", MODEL)).collect()
    texts = docs.select(F.monotonically_increasing_id(), "text").collect()
    found = by_document(rows)
    assert sorted(found) == sorted(row for row, _ in texts)
    for row, text in texts:
        parts = found[row]
        text = text or ""
        ids = [i for p in parts for i in p.ids]
        assert [p.chunk for p in parts] == list(range(parts[0].n_chunks))
        assert sum(p.score for p in parts) == best_score(lattice, text) == score_of(lattice, ids)
        assert "".join(p.text for p in parts)[1:] == text.replace(BLANK, " ")
    summed = digests(docs, MODEL, chunk, fan).collect()
    wanted = []
    for parts in found.values():
        ids = [i for p in parts for i in p.ids]
        data = "".join(p.text for p in parts)[1:].encode()
        ends = zlib.crc32(np.array(ids, "<u4").tobytes()), len(data), zlib.crc32(data)
        score = sum(p.score for p in parts)
        wanted.append((parts[0].doc_id, parts[0].n_chunks, len(ids), score, *ends))
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in summed)
    return max(len(p) for p in found.values())


@pytest.mark.parametrize("chunk, fan", [(5, 2), (40, 3), (4096, 64)])
def test_awkward_rows(spark, lattice, chunk, fan):
    r = random.Random(4)
    texts = [t if t is None or len(t) < 6000 else t[:9000] for t in TEXTS]
    texts += ["".join(r.choice("abe nt▁\n日") for _ in range(n)) for n in (16, 17, 300, 5000)]
    docs = documents(spark, texts if chunk > 5 else [t if t is None else t[:200] for t in texts])
    assert check(spark, lattice, docs, chunk, fan) > 1
    assert encode(empty(spark), MODEL, chunk, fan).count() == 0
    assert digests(empty(spark), MODEL, chunk, fan).count() == 0


def test_matrices_combine_associatively():
    r = np.random.default_rng(3)
    a, b, c = (np.where(r.random((6, 6)) < 0.3, -np.inf, r.integers(-99, 0, (6, 6))) for _ in range(3))
    assert (combined(combined(a, b), c) == combined(a, combined(b, c))).all()


def test_checksums_of_parts_add_up():
    r = random.Random(1)
    for sizes in [(0, 0), (1, 0), (0, 5), (3, 100_000), (70_000, 1)]:
        a, b = (r.randbytes(n) for n in sizes)
        assert shifted_crc32(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_words_of_one_length_in_step_as_one_by_one(lattice):
    r = random.Random(7)
    for n in (1, 2, 5, 17, 30):
        words = ["".join(r.choice(" abdeinorst日é") for _ in range(n)) for _ in range(200)]
        paths, scores = lattice._best_of_units(words)
        for word, path, score in zip(words, paths, scores):
            ids, best = lattice.path(word.replace(" ", BLANK), 0, n, n)
            assert best == score
            if -1 not in path:
                assert path[path > -2].tolist() == ids


def test_matrices_entry_by_entry(lattice):
    r = random.Random(9)
    for letters in ("abe", "abdeinorst ", "ab ▁"):
        for size, more in [(5, 0), (5, 3), (16, 15), (200, 15)]:
            text = lattice.marked("".join(r.choice(letters) for _ in range(size + more)))[: size + more]
            found = lattice.measured(text, size)[-1]
            for entry in range(lattice.longest):
                exits = [-np.inf] * lattice.longest
                if entry < size:
                    got = lattice.walk(text, entry, size)[0][size - entry :]
                    exits[: len(got)] = got
                elif entry <= len(text):
                    exits[entry - size] = 0.0
                assert found[entry].tolist() == exits


def test_giant_texts_are_worked_on_by_many_tasks(spark):
    """Chunks of one text are measured in several tasks, and no row holds it whole again."""
    docs = documents(spark, [" ".join(f"word{i}" for i in range(40_000)), "short"])
    chunks = maxplus._spread(maxplus._cut(maxplus._numbered(docs, True, 4096), 4096, 16), "chunk")
    tasks = chunks.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert len(tasks) == 3 and sum(t.n for t in tasks) > 80
    assert chunks.agg(F.max(F.length("text"))).first()[0] == 4096 + 15
    plan = digests(docs, MODEL)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_whole_table(spark, lattice):
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    found = QUERIES["op9_max_plus_encoding"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        text = texts[r.doc_id]
        assert (r.n_bytes, r.text_crc32) == (len(text.encode()), zlib.crc32(text.encode()))
        assert r.n_chunks == max(1, -(-(len(text) + 1) // maxplus.CHUNK) if len(text) >= maxplus.CHUNK else 1)
        if len(text) < 3000:
            assert r.score == best_score(lattice, text)


def test_same_as_the_library_reads_the_scores(spark, lattice):
    """The library, told that the same pieces and scores are of the unigram kind."""
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pb2.TrainerSpec.UNIGRAM
    model = SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = [t for (t,) in table(spark, SF, "documents").select("text").collect()]
    words = {w for t in texts[:60] for w in t.split()} | {"", "ab", "x" * 300}
    # The library adds in single precision, which a blank's or a byte's huge penalty
    # leaves little of; so word by word, without these.
    words = [w for w in words if best_score(lattice, w) > -1e8]
    assert len(words) > 1000
    scores = [(score_of(lattice, model.encode(w)), best_score(lattice, w)) for w in words]
    # Its path is the best in all but a few words, and never better than that.
    assert all(theirs <= ours for theirs, ours in scores)
    assert sum(theirs == ours for theirs, ours in scores) > 0.98 * len(scores)
