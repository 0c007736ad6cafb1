import json
import random

import pyarrow as pa
import pytest
from helpers import rows
from pyspark.sql import functions as F

from daedap.sources import json_map
from daedap.sources.answers import (
    last_write_wins,
    map_entries,
    read_answer_map,
    write_answer_map,
    write_answer_rows,
)
from daedap.sources.corpus import load_json_lines, load_json_map, with_scope
from daedap.sources.json_map import Marks, cut_entries, json_entries
from daedap.sources.splits import as_questions, load_arrow_split, load_split


def test_json_map_keeps_file_order(spark, tmp_path):
    path = tmp_path / "corpus.json"
    records = {str(k): {"title": f"t{k}", "text": f"글\n{k}"} for k in (7, 3, 5)}
    path.write_text(json.dumps(records))
    got = sorted(rows(load_json_map(spark, str(path)), "doc_pos", "doc_id", "title", "text"))
    assert got == [(0, "7", "t7", "글\n7"), (1, "3", "t3", "글\n3"), (2, "5", "t5", "글\n5")]


def test_json_map_duplicates_and_nulls(spark, tmp_path):
    path = tmp_path / "corpus.json"
    path.write_text(
        '{"a": {"title": "x", "text": "1"}, "b": {"title": null, "text": "2"},'
        ' "a": {"title": "y", "text": null, "other": 3}, "c": {"text": "4"}}'
    )
    got = sorted(rows(load_json_map(spark, str(path)), "doc_pos", "doc_id", "title", "text"))
    assert got == [(0, "a", "y", ""), (1, "b", "", "2"), (2, "c", "", "4")]


def test_json_map_folder_numbers_on(spark, tmp_path):
    for name, keys in (("1.json", "ab"), ("2.json", "c"), ("3.json", "de")):
        (tmp_path / name).write_text(json.dumps({k: {"title": k, "text": k} for k in keys}))
    corpus = with_scope(load_json_map(spark, str(tmp_path)), 3)
    got = sorted(rows(corpus, "doc_pos", "doc_id", "is_candidate"))
    assert got == [(i, k, i < 3) for i, k in enumerate("abcde")]


def _map_text(r, n):
    """A JSON map with signs of the format inside strings, as text, and the same parsed."""
    signs = ['"', "\\", "{", "}", "[", "]", ",", ":", "a", "글", "\n", "🙂", " "]

    def word():
        return "".join(r.choice(signs) for _ in range(r.randint(0, 9)))

    parts = []
    for _ in range(n):
        record = {"title": word(), "text": word(), "more": [{word(): [word()]}, 1, None]}
        parts.append(f"{json.dumps(word())} :{json.dumps(record, ensure_ascii=r.random() < 0.5)}")
    return " \n{" + ", ".join(parts) + "}\r\n"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1 << 20])
def test_json_entries_from_any_block(tmp_path, size):
    """Blocks of any size, each entered in the state that the ones before lead to."""
    r = random.Random(size)
    for n in (0, 1, 2, 25):
        text = _map_text(r, n).encode()
        path = tmp_path / f"{n}.json"
        path.write_bytes(text)
        state, depth, opened, found = 0, 0, False, []
        with pa.OSFile(str(path)) as source:
            for at in range(0, len(text), size):
                part = text[at : at + size]
                found += cut_entries(source, at, len(part), state, depth, opened, size)
                marks = Marks(part)
                outside, state = marks.outside(state)
                change = marks.deeper(outside)
                depth, opened = depth + int(change.sum()), opened or bool((change > 0).any())
        assert (state, depth, opened) == (0, 0, True)
        pairs = [p for e in found for p in json.loads(b"{" + e + b"}", object_pairs_hook=list)]
        assert pairs == json.loads(text, object_pairs_hook=list)


def test_json_map_of_many_blocks(spark, tmp_path):
    """One file read by many tasks gives what the standard reader gives; last key wins."""
    path = tmp_path / "corpus.json"
    path.write_text(_map_text(random.Random(5), 400))
    entries = json_entries(spark, str(path), 512)
    assert entries.groupBy(F.spark_partition_id()).count().count() > 20
    got = sorted(rows(load_json_map(spark, str(path), 512), "doc_pos", "doc_id", "title", "text"))
    parsed = json.loads(path.read_text())
    assert len(parsed) < 400
    assert got == [(i, k, v["title"], v["text"]) for i, (k, v) in enumerate(parsed.items())]
    assert got == sorted(rows(load_json_map(spark, str(path)), "doc_pos", "doc_id", "title", "text"))


@pytest.mark.parametrize(
    "text",
    ["", "  ", "[]", '[{"a": {}}]', '{"a": {}', '{"a": {}}{"b": {}}', '{"a": {}} x', 'x {"a": {}}', '{"a": {},}']
    + ['{,"a": {}}', '{"a": {}}}', '{"a": "{}', '{"a" {}}', '{"a": 5}', '{"a": {]}', "{'a': {}}", '{"a": {}},', "5"],
)
def test_json_map_refuses_what_is_no_object(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text('{"b": {}}')
    for size in (3, 1 << 20):
        with pytest.raises(Exception, match="(?i)malformed|no JSON object"):
            load_json_map(spark, str(tmp_path), size).collect()


def test_empty_json_map(spark, tmp_path):
    (tmp_path / "a.json").write_text(" { \n} ")
    (tmp_path / "b.json").write_text('{"a": null}')
    for size in (1, 1 << 20):
        assert rows(load_json_map(spark, str(tmp_path), size), "doc_pos", "doc_id", "title", "text") == [(0, "a", "", "")]


def test_splits(spark, tmp_path):
    columns = {"id": ["q1", "q2"], "question": ["누구?", "Who is"], "context": ["c", "d"]}
    table = pa.table(columns)
    spark.createDataFrame(table.to_pandas()).write.parquet(str(tmp_path / "parquet"))
    folder = tmp_path / "arrow"
    folder.mkdir()
    for i in range(2):
        with pa.OSFile(str(folder / f"data-{i}.arrow"), "wb") as sink:
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table.slice(i, 1))
    (folder / "state.json").write_text("{}")
    for split in (load_split(spark, str(tmp_path / "parquet")), load_arrow_split(spark, str(folder))):
        asked = as_questions(split)
        assert sorted(rows(asked, "question_id", "question", "tokens")) == [
            ("q1", "누구?", ["누구", "?"]),
            ("q2", "Who is", ["Who", "is"]),
        ]


def test_arrow_split_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_arrow_split(spark, str(tmp_path))


def save_stream(path, table, rows_per_batch):
    with pa.OSFile(str(path), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table, max_chunksize=rows_per_batch)


def test_arrow_batches_are_dealt_to_tasks_in_order(spark, tmp_path):
    """One file of many batches, with dictionaries, read by several tasks."""
    for i, name in enumerate(("b.arrow", "a.arrow")):
        ids = list(range(1000 * i, 1000 * i + 700))
        words = pa.array([f"w{j % 7}" for j in ids]).dictionary_encode()
        save_stream(tmp_path / name, pa.table({"id": ids, "word": words, "text": ["글 " * 50] * 700}), 20)
    manifest = {"_data_files": [{"filename": "b.arrow"}, {"filename": "a.arrow"}]}
    (tmp_path / "state.json").write_text(json.dumps(manifest))
    split = load_arrow_split(spark, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = rows(split.withColumn("task", F.spark_partition_id()), "id", "word", "task")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [i for i, _, _ in found] == [*range(700), *range(1000, 1700)]
    assert all(w == f"w{i % 7}" for i, w, _ in found)
    assert len({task for i, _, task in found if i < 700}) > 1


def test_arrow_files_that_tasks_cannot_open_come_whole(spark, tmp_path, monkeypatch):
    from daedap.sources import splits

    monkeypatch.setattr(splits, "reads_parts", lambda address: False)
    for name in ("b.arrow", "a.arrow"):
        save_stream(tmp_path / name, pa.table({"id": [name]}), 1)
    assert rows(load_arrow_split(spark, str(tmp_path)), "id") == [("a.arrow",), ("b.arrow",)]


def test_incomplete_arrow_splits_raise(spark, tmp_path):
    save_stream(tmp_path / "data-0.arrow", pa.table({"id": list(range(100))}), 10)
    save_stream(tmp_path / "cache-1.arrow", pa.table({"id": [7]}), 10)
    named = {"_data_files": [{"filename": "data-0.arrow"}, {"filename": "data-1.arrow"}]}
    (tmp_path / "state.json").write_text(json.dumps(named))
    with pytest.raises(FileNotFoundError, match="data-1.arrow"):
        load_arrow_split(spark, str(tmp_path))
    (tmp_path / "state.json").write_text(json.dumps(named)[:-9])
    with pytest.raises(Exception, match="(?i)malformed|no JSON object"):
        load_arrow_split(spark, str(tmp_path))
    (tmp_path / "state.json").write_text(json.dumps({"_data_files": named["_data_files"][:1]}))
    assert load_arrow_split(spark, str(tmp_path)).count() == 100
    whole = (tmp_path / "data-0.arrow").read_bytes()
    (tmp_path / "data-0.arrow").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception, match="inside a message"):
        load_arrow_split(spark, str(tmp_path)).collect()


ANSWERS = [("q2", '따옴표 "와" \\'), ("q1", "줄\n바꿈"), ("q10", None), ("q3", "}, {")]


def answers(spark, data):
    return spark.createDataFrame(data, "question_id string, answer string")


def written(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_answer_map_is_one_object(spark, tmp_path):
    path = tmp_path / "map"
    write_answer_map(answers(spark, ANSWERS).repartition(3), str(path))
    expected = {q: a for q, a in ANSWERS if a is not None}
    assert json.loads(written(path)) == expected
    assert dict(rows(read_answer_map(spark, str(path)), "question_id", "answer")) == expected


@pytest.mark.parametrize("data", [[], [("q1", "하나")]])
def test_small_answer_maps(spark, tmp_path, data):
    path = tmp_path / "map"
    write_answer_map(answers(spark, data), str(path))
    assert json.loads(written(path)) == dict(data)
    assert dict(rows(read_answer_map(spark, str(path)), "question_id", "answer")) == dict(data)


def test_answer_rows(spark, tmp_path):
    write_answer_rows(answers(spark, ANSWERS), str(tmp_path / "rows"))
    back = spark.read.json(str(tmp_path / "rows"))
    assert dict(rows(back, "question_id", "answer")) == {q: a for q, a in ANSWERS if a is not None}


def test_entries_leave_out_the_unanswered(spark):
    assert [q for (q,) in rows(map_entries(answers(spark, ANSWERS)), "question_id")] == ["q2", "q1", "q3"]


def test_last_write_wins(spark):
    df = spark.createDataFrame(
        [("a", "one", 1), ("b", "two", 2), ("a", "three", 3)],
        "question_id string, answer string, at int",
    )
    assert sorted(rows(last_write_wins(df, "at"), "question_id", "answer")) == [
        ("a", "three"),
        ("b", "two"),
    ]


def test_unreadable_files_raise(spark, tmp_path):
    """A file cut short, or no object at all, is never left out."""
    whole = json.dumps({k: {"title": k, "text": k} for k in "ab"})
    for name, text in (("1.json", whole), ("2.json", whole[:-9]), ("3.json", whole)):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|no JSON object"):
        load_json_map(spark, str(tmp_path)).collect()
    broken = tmp_path / "map"
    broken.mkdir()
    (broken / "part-0").write_text('{"q":"x",\n"r":\n')
    with pytest.raises(Exception, match="(?i)malformed|no entry"):
        read_answer_map(spark, str(broken)).collect()


def test_json_lines(spark, tmp_path):
    lines = [
        {"doc_pos": 1, "doc_id": "b", "title": None, "text": "2\n"},
        {"doc_pos": 0, "doc_id": "a", "title": "x", "more": 1},
    ]
    path = tmp_path / "corpus.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    got = sorted(rows(load_json_lines(spark, str(path)), "doc_pos", "doc_id", "title", "text"))
    assert got == [(0, "a", "x", ""), (1, "b", "", "2\n")]
    for broken in ('{"doc_pos": 1, "doc_id": ', '{"doc_id": "no place"}'):
        path.write_text(broken)
        with pytest.raises(Exception, match="(?i)malformed|without doc_pos"):
            load_json_lines(spark, str(path)).collect()


@pytest.mark.parametrize("named", [["data-1.arrow", "data-0.arrow"], ["data-1.arrow"], []])
def test_arrow_manifest_names_the_files(spark, tmp_path, named):
    table = pa.table({"id": [1]})
    for i, name in enumerate(("data-0.arrow", "data-1.arrow", "cache-0.arrow")):
        with pa.OSFile(str(tmp_path / name), "wb") as sink:
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(pa.table({"id": [i]}))
    manifest = {"_data_files": [{"filename": n} for n in named], "_split": "train"}
    (tmp_path / "state.json").write_text(json.dumps(manifest))
    if not named:
        with pytest.raises(FileNotFoundError):
            load_arrow_split(spark, str(tmp_path))
        return
    assert sorted(rows(load_arrow_split(spark, str(tmp_path)), "id")) == sorted((int(n[5]),) for n in named)


def test_repeated_ids_in_the_answer_map(spark, tmp_path):
    data = [("q", "x", 2), ("q", "y", 1), ("r", "z", 1)]
    frame = spark.createDataFrame(data, "question_id string, answer string, turn int").coalesce(1)
    for name, order, kept in (("a", "turn", "x"), ("b", None, "y")):
        write_answer_map(frame, str(tmp_path / name), order)
        assert json.loads(written(tmp_path / name)) == {"q": kept, "r": "z"}


def test_json_tasks_follow_bytes_and_not_blocks(spark, tmp_path):
    """Very many small files: every one is a block, but not a task."""
    for i in range(200):
        (tmp_path / f"{i:03d}.json").write_text(json.dumps({str(i): {"title": "", "text": "x"}}))
    entries = json_map.json_entries(spark, str(tmp_path))
    assert entries.count() == 200
    assert entries.rdd.getNumPartitions() <= json_map.CORE_TASKS * spark.sparkContext.defaultParallelism
    assert json_map.tasks_for(10**6, 6 << 30, 12) == 96
    assert json_map.tasks_for(3, 6 << 30, 12) == 3
