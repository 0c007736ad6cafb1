"""License notices against full alignments of every template."""

import random
import re

import numpy as np
import pytest
from fixtures import documents, empty

from daedap.llm import licenses
from daedap.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", text.encode().lower())


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[-1]))
    return row[-1]


def test_edited_notices_are_found(spark):
    r = random.Random(6)
    rows, expected = [], {}
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        plain = text.split()
        edited = list(plain)
        if len(plain) > 20:
            for _ in range(len(plain) // 15):
                edited[r.randrange(len(edited))] = r.choice(["changed", "", "two words"])
        around = " ".join(f"w{r.randint(0, 99)}" for _ in range(r.randint(0, 400)))
        notice = " ".join(w for w in edited if w)
        rows.append((i, f"É {around}\n{notice}\n{around}"))
        expected[i] = (name, notice)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for m in licenses.license_matches(docs).collect():
        found.setdefault(m.doc_id, {})[m.license] = m
    texts = dict(rows)
    for i, (name, notice) in expected.items():
        m = found[i][name]
        template = words(licenses.TEMPLATES[name])
        span = texts[i][m.start : m.end]
        assert m.matched_words <= common(template, words(span))
        assert m.matched_words >= common(template, words(notice)) - 1
        assert m.coverage == pytest.approx(m.matched_words / len(template))
        assert abs(len(span) - len(notice)) <= 25


def test_exact_lines_in_the_whole_table(spark):
    """A notice of one line is reported once for each place where it stands."""
    texts = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    found = QUERIES["op7_license_scan"](spark, SF).collect()
    ours = sorted((m.doc_id, m.license, m.start) for m in found if m.coverage == 1)
    lines = {n: t.rstrip(".") for n, t in licenses.TEMPLATES.items() if n.endswith("line")}
    expected = sorted(
        (d, name, m.start())
        for d, text in texts.items()
        for name, line in lines.items()
        for m in re.finditer(re.escape(line), text)
    )
    assert len(expected) > 20 and ours == expected


def test_many_notices_in_one_text(spark):
    line = licenses.TEMPLATES["MIT line"]
    text = "\n".join([f"some words before number {i}\n{line}" for i in range(300)])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.license_matches(docs).collect()
    assert sorted(m.start for m in found) == [m.start() for m in re.finditer(re.escape(line), text)]


def test_awkward_rows(spark):
    rows = documents(spark)
    assert licenses.license_matches(rows).count() == 0
    assert licenses.license_matches(empty(spark)).count() == 0
    line = licenses.TEMPLATES["GPL-3.0 line"]
    docs = spark.createDataFrame([(None, line), (2, line), (2, line), (3, line.upper())], "doc_id long, text string")
    found = licenses.license_matches(docs).collect()
    assert sorted((m.doc_id or 0, m.license) for m in found) == [(i, "GPL-3.0 line") for i in (0, 2, 2, 3)]
    with pytest.raises(ValueError):
        licenses.license_matches(docs, {"huge": "a b c " * 6_000_000})


def test_winnowing_sees_five_common_words():
    r = random.Random(2)
    for _ in range(200):
        common_ = [r.randrange(2**63) for _ in range(5)]
        texts = [
            np.array([r.randrange(2**63) for _ in range(r.randint(0, 9))] + common_ + [r.randrange(2**63) for _ in range(r.randint(0, 9))], np.uint64)
            for _ in range(2)
        ]
        prints = [set(licenses.windows(t, licenses.RUN)[licenses.winnowed(t)].tolist()) for t in texts]
        assert prints[0] & prints[1]


def names_in(text):
    index = licenses.Index(licenses.all_templates())
    return [name for name, *_ in licenses.scan(index, text.encode(), licenses.LEAST_COVERAGE)]


def test_versions_and_families_are_told_apart():
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    for text, expected in {
        gnu.format("", "2"): ["GPL-2.0 line"],
        gnu.format("", "3.0"): ["GPL-3.0 line"],
        gnu.format("Lesser ", "2.1"): ["LGPL-2.1 line"],
        gnu.format("Lesser ", "3"): ["LGPL-3.0 line"],
        gnu.format("", "4"): [],
        "Licensed under the Apache License, Version 2.1.": [],
        "Licensed under the Apache License, Version 2.0.1.": [],
        "Released under an MIT License.": ["MIT line"],
        "Some of it is released under terms of the MIT License": ["MIT line"],
        "Released under the BSD License.": [],
        "Licensed under CC BY-NC-SA 4.0.": ["CC-BY-NC-SA-4.0 line"],
        licenses.MORE_TEMPLATES["LGPL-3.0 notice"]: ["LGPL-3.0 notice"],
        licenses.MORE_TEMPLATES["AGPL-3.0 notice"]: ["AGPL-3.0 notice"],
        licenses.MORE_TEMPLATES["LGPL-2.1 notice"].replace("2.1", "2.2"): [],
    }.items():
        assert names_in(f"Some words before. {text} Some words behind.") == expected


def test_every_template_and_whole_text_is_its_own_best():
    templates = licenses.all_templates()
    index = licenses.Index(templates)
    assert sum(n.endswith(" text") for n in templates) == 17
    for name, text in templates.items():
        found = licenses.scan(index, f"before\n{text}\nbehind".encode(), licenses.LEAST_COVERAGE)
        assert [(f[0], f[1]) for f in found] == [(name, 1.0)]


def test_whole_texts_with_changes():
    r = random.Random(3)
    for name in ("GPL-2 text", "Apache-2.0 text", "BSD-3-Clause", "BSD-2-Clause"):
        words_ = licenses.all_templates()[name].split()
        for _ in range(len(words_) // 30):
            words_[r.randrange(40, len(words_))] = r.choice(["changed", "", "two words"])
        assert names_in("before " + " ".join(words_) + " behind") == [name]
    mit, bsd = licenses.TEMPLATES["MIT"], licenses.MORE_TEMPLATES["BSD-3-Clause"]
    assert names_in(f"{mit}\n{bsd}\n{mit}") == ["MIT", "BSD-3-Clause", "MIT"]
