"""Personal data by patterns and a skip-chain conditional random field.

Patterns find what is certain. The field labels what they leave out: its nodes are the
tokens with a digit or an at sign, every other word being outside by observation. Neighbors
in the text share a chain potential. Tokens that are alike (one address, or the same last
digits), however far apart, are linked along their occurrences and share a potential that
favors one kind for both. Loopy message passing brings what a pattern found in one place
to the others. Tokens under a pattern's match are observed.

Token and chain potentials are fitted piece by piece on the patterns' own matches in all
documents. A token is described by one of ``N_PATTERNS`` combinations of features, so what
is collected for that is bounded however many documents there are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from daedap.llm.tokens import as_texts
from daedap.session import materialize

KINDS = ("email", "ip", "card", "phone")

# Outside; then per kind its first token, and its further tokens where blanks may part it.
LABELS = ("O", "B-email", "B-ip", "B-card", "I-card", "B-phone", "I-phone")
KIND_OF = np.array([-1, 0, 1, 2, 2, 3, 3])
FIRST, FURTHER = (1, 2, 3, 5), (1, 2, 4, 6)

# What may follow a label: something new (or outside), or one of the two that go on.
NEXT = np.array([[1, 0, 0]] * 4 + [[0, 1, 0], [1, 0, 0], [0, 0, 1]], float)

# A further token of a kind stands only behind its first one or another further one.
GOES_ON = np.ones((len(LABELS), len(LABELS)), bool)
GOES_ON[:, [4, 6]] = False
GOES_ON[[3, 4, 5, 6], [4, 4, 6, 6]] = True

# What two linked tokens of one kind are favored by, as a logarithm of odds.
SKIP = 9.0
ROUNDS = 30
DAMPING = 0.3
OBSERVED = -30.0

# Part of each fitted distribution that is spread evenly: what patterns leave out counts as
# outside there, so nothing may seem impossible, however large the corpus is.
SPREAD = 0.05

# Digits that tokens must have in common at their ends to be linked.
COMMON_DIGITS = 7

# As the contract states them; possessive where nothing behind can need a way back.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TOKEN = re.compile(r"(?<![^\s,;:=|\"'<>\[\]{}])[^\s,;:=|\"'<>\[\]{}0-9@]*+[0-9@][^\s,;:=|\"'<>\[\]{}]*+")
HEAD = re.compile(r"[^0-9A-Za-z+(@]*")
TAIL = re.compile(r"[^0-9A-Za-z)]+\Z")

DIGIT_STEPS = (1, 2, 3, 4, 5, 7, 8, 9, 11, 12, 16, 17, 20)
FORMS = 10
LEAST_DIGITS = (0, *DIGIT_STEPS)
NEEDED_DIGITS = (0, 4, 12, COMMON_DIGITS)  # by kind
N_PATTERNS = (len(DIGIT_STEPS) + 1) * FORMS * 2

FOUND = (
    "doc_id long, base string, begins array<int>, ends array<int>, patterns array<int>, "
    "labels array<int>, keys array<long>, joined array<boolean>"
)
RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)

Span = tuple[int, int, int]  # begin, place of the kind in KINDS, end


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit)
        total += value if i % 2 == 0 else 2 * value - 9 * (value > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at, end = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in LOCAL:
            begin -= 1
        match = AT.match(text, at) if begin < at else None
        if match:
            end = match.end()
            yield begin, 0, end
        at = text.find("@", max(at + 1, end))


def _addresses(text: str) -> Iterator[Span]:
    for match in DOTTED.finditer(text):
        parts = match.group().split(".")
        begin = match.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield begin, 1, end
            begin = end + 1


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by begin and then by kind."""
    spans = [*_emails(text), *_addresses(text)]
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                spans.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= len(_only_digits(match.group())) <= 15:
            spans.append((match.start(), 3, match.end()))
    return sorted(spans)


def as_string(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{begin}:{end}" for begin, kind, end in spans)


def _from_string(spans: str) -> list[Span]:
    parts = (part.split(":") for part in spans.split(",") if part)
    return [(int(begin), KINDS.index(kind), int(end)) for kind, begin, end in parts]


def _form(token: str, digits: str) -> int:
    if "@" in token:
        return 0 if any(s[0] == 0 and s[2] == len(token) for s in _emails(token)) else 1
    quad = token.split(".")
    if len(quad) == 4 and any(s[0] == 0 and s[2] == len(token) for s in _addresses(token)):
        return 2
    if any(c.isalpha() for c in token):
        return 3
    if token[0] == "+":
        return 4
    if "(" in token or ")" in token:
        return 5
    if len(digits) == len(token):
        return 6
    if "-" in token:
        return 7
    return 8 if "." in token else 9


def describe(token: str) -> tuple[int, int]:
    """The number of a token's features, and the key that it shares with those alike.

    Key 0 is shared with nobody.
    """
    digits = _only_digits(token)
    form = _form(token, digits)
    luhn = form not in (0, 1, 3) and 12 <= len(digits) <= 19 and passes_luhn(digits)
    size = sum(len(digits) >= step for step in DIGIT_STEPS)
    key = 0
    if form <= 1:
        local = token[: token.index("@")].lower()
        key = xxh3_64_intdigest("@" + local) if len(local) > 3 else 0
    elif form != 3 and len(digits) >= COMMON_DIGITS:
        key = xxh3_64_intdigest(digits[-COMMON_DIGITS:])
    return (size * FORMS + form) * 2 + luhn, key & 0x7FFFFFFFFFFFFFFF


def nodes_of(text: str, base: list[Span]) -> list[tuple[int, int, int, int, int, bool]]:
    """Begin, end, features, observed label (-1: none), key and whether the node before is
    the neighboring token, of every node of a text."""
    nodes, last, done = [], -1, 0
    begins = [span[0] for span in base]
    reach = max((span[2] - span[0] for span in base), default=0)
    for match in TOKEN.finditer(text):
        token = match.group()
        begin = match.start() + HEAD.match(token).end()
        tail = TAIL.search(text, begin, match.end())
        end = tail.start() if tail else match.end()
        token = text[begin:end]
        if not any(c == "@" or "0" <= c <= "9" for c in token):
            continue
        # The first span over the token, of those that can reach it.
        label, i = -1, bisect_left(begins, begin - reach)
        while i < len(base) and base[i][0] < end:
            if base[i][2] > begin:
                inside = base[i][0] < begin and done > base[i][0]
                label = (FURTHER if inside else FIRST)[base[i][1]]
                break
            i += 1
        joined = last >= 0 and text[last:begin].strip("() ") == "" and begin - last <= 4
        nodes.append((begin, end, *describe(token)[:1], label, describe(token)[1], joined))
        last = done = end
    return nodes


def found(docs: DataFrame) -> DataFrame:
    """Patterns' spans and nodes of every ``docs(doc_id, text)``, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FOUND.split(", ")]
        types = [pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 4]
        types += [pa.list_(pa.int64()), pa.list_(pa.bool_())]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), as_texts(batch.column(1))):
                base = base_spans(text)
                nodes = nodes_of(text, base)
                rows.append((doc_id, as_string(base), *(zip(*nodes) if nodes else [()] * 6)))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)


@dataclass(frozen=True)
class Potentials:
    """Logarithms: of each label by features, of each pair of neighboring labels, and of two
    linked tokens of one kind."""

    token: np.ndarray  # features, label
    chain: np.ndarray  # label, label
    skip: float = SKIP


def potentials(token_counts: np.ndarray, pair_counts: np.ndarray, skip: float = SKIP) -> Potentials:
    """Each piece by its own likelihood, from counts in all documents.

    The chain potential is what a pair is more frequent by than its labels alone, so that
    the frequency of a label is not counted twice. Behind a label, all that begin something
    new share a parameter: where two findings touch, patterns often fail, and such pairs
    would seem rarer than they are.
    """
    seen = token_counts.sum(1, keepdims=True)
    token = (1 - SPREAD) * (token_counts / np.maximum(seen, 1)) + SPREAD / len(LABELS)
    token[seen[:, 0] == 0] = 1 / len(LABELS)
    pairs = pair_counts @ NEXT
    expected = pairs.sum(1)[:, None] * pairs.sum(0)[None, :] / max(pairs.sum(), 1.0)
    ratio = np.where(expected > 0, pairs / np.where(expected > 0, expected, 1), 1.0)
    chain = np.log((1 - SPREAD) * ratio + SPREAD) @ NEXT.T
    chain = np.where(GOES_ON, chain, OBSERVED)
    return Potentials(np.log(token), chain, skip)


def fit(rows: DataFrame, skip: float = SKIP) -> Potentials:
    """From the table of ``found``; at most ``N_PATTERNS`` + 7 rows per label are collected."""
    outside = F.transform("labels", lambda x: F.greatest(x, F.lit(0)))
    tokens = rows.select(F.explode(F.arrays_zip("patterns", outside.alias("label"))).alias("t"))
    by_token = tokens.groupBy(F.col("t.patterns").alias("row"), F.col("t.label").alias("label")).count()
    # A node whose neighbor is no node stands beside an observed outside.
    n = F.size("labels")
    before = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.when((i > 0) & (i < n) & F.get("joined", i), F.get("l", i - 1)).when(
            i < n, F.lit(0)
        ),
    )
    pairs = (
        rows.filter(n > 0)
        .select("joined", "labels", outside.alias("l"))
        .select(F.posexplode(F.arrays_zip(F.col("l").alias("here"), before.alias("before"))).alias("i", "p"), "l", "joined")
        .select("p.here", "p.before", F.get("joined", F.col("i") + 1).alias("goes_on"))
        .filter(F.col("before").isNotNull())
    )
    into = pairs.select(F.col("before").alias("row"), F.col("here").alias("label"))
    out = pairs.filter(~F.coalesce("goes_on", F.lit(False))).select(
        F.col("here").alias("row"), F.lit(0).alias("label")
    )
    by_pair = into.unionAll(out).groupBy("row", "label").count()
    counts = []
    for table, size in ((by_token, N_PATTERNS), (by_pair, len(LABELS))):
        counted = np.zeros((size, len(LABELS)))
        for row in table.collect():
            counted[row["row"], row["label"]] = row["count"]
        counts.append(counted)
    return potentials(*counts, skip)


def links_of(keys: np.ndarray, joined: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighboring nodes, and of a node with the next one alike in its document.

    A key that stands very often gives a path of links, not all pairs.
    """
    here = np.flatnonzero(joined[1:] & (document[1:] == document[:-1])) + 1
    chain = np.stack([here - 1, here], 1)
    named = np.flatnonzero(keys != 0)
    order = named[np.lexsort((named, keys[named], document[named]))]
    a, b = order[:-1], order[1:]
    alike = (keys[a] == keys[b]) & (document[a] == document[b])
    return chain, np.stack([a[alike], b[alike]], 1)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis)) + top.squeeze(axis)


def marginals(
    unary: np.ndarray, edges: np.ndarray, factors: np.ndarray, rounds: int = ROUNDS
) -> np.ndarray:
    """Each node's probabilities by loopy message passing, exact where no links form a loop.

    ``factors`` holds a matrix of logarithms for each of ``edges``. All messages are sent at
    once for a fixed number of rounds, so a document's result does not depend on others.
    """
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([factors, factors.transpose(0, 2, 1)])
    n = len(edges)
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    messages = np.zeros((2 * n, unary.shape[1]))

    def beliefs() -> np.ndarray:
        total = unary.copy()
        np.add.at(total, target, messages)
        return total

    for _ in range(rounds if n else 0):
        sent = _log_sum((beliefs()[source] - messages[back])[:, :, None] + both, 1)
        sent -= _log_sum(sent, 1)[:, None]
        messages = DAMPING * messages + (1 - DAMPING) * sent
    total = beliefs()
    return np.exp(total - _log_sum(total, 1)[:, None])


def decide(
    model: Potentials,
    patterns: np.ndarray,
    labels: np.ndarray,
    keys: np.ndarray,
    joined: np.ndarray,
    document: np.ndarray,
) -> np.ndarray:
    """The most probable label of each node."""
    unary = model.token[patterns].copy()
    joined = joined & np.concatenate([[False], document[1:] == document[:-1]])
    goes_on = np.concatenate([joined[1:], [False]])
    unary[~joined] += model.chain[0]
    unary[~goes_on] += model.chain[:, 0]
    seen = np.flatnonzero(labels >= 0)
    unary[seen] = OBSERVED
    unary[seen, labels[seen]] = 0.0
    chain, alike = links_of(keys, joined, document)
    same = model.skip * (KIND_OF[:, None] == KIND_OF[None, :])
    factors = np.concatenate(
        [np.broadcast_to(model.chain, (len(chain), 7, 7)), np.broadcast_to(same, (len(alike), 7, 7))]
    )
    return marginals(unary, np.concatenate([chain, alike]), factors).argmax(1)


def added_spans(
    base: list[Span],
    begins: list[int],
    ends: list[int],
    patterns: list[int],
    joined: list[bool],
    labels: list[int],
) -> list[Span]:
    """Runs of a kind's tokens, with digits enough for it, that no pattern's span touches."""
    runs: list[list[int]] = []
    goes_on = False
    for begin, end, pattern, near, label in zip(begins, ends, patterns, joined, labels):
        kind, digits = int(KIND_OF[label]), LEAST_DIGITS[pattern // (2 * FORMS)]
        if label in (4, 6) and near and goes_on and runs[-1][1] == kind:
            runs[-1][2] = end
            runs[-1][3] += digits
        elif label:
            runs.append([begin, kind, end, digits])
        goes_on = label > 0
    spans, first = [], 0
    ordered = sorted(base)
    for begin, kind, end, digits in runs:
        while first < len(ordered) and ordered[first][2] <= begin:
            first += 1
        touched = any(s[0] < end and s[2] > begin for s in _until(ordered, first, end))
        if not touched and digits >= NEEDED_DIGITS[kind]:
            spans.append((begin, kind, end))
    return spans


def _until(ordered: list[Span], first: int, end: int) -> Iterator[Span]:
    while first < len(ordered) and ordered[first][0] < end:
        yield ordered[first]
        first += 1


def personal_data(docs: DataFrame, skip: float = SKIP) -> DataFrame:
    """Counts and spans of personal data of every ``docs(doc_id, text)``, one row each.

    The counts and ``base_sha256`` are those of the patterns, ``spans`` has theirs and those
    that the field adds. Null text is empty and has none; null and repeated ids are kept,
    each row by its own text; other columns play no part. Patterns' spans and nodes are
    written once to the shared folder, texts are read once. Without any match in the whole
    table there is nothing to learn from, and nothing is added.
    """
    rows = materialize(found(docs))
    model = fit(rows, skip)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            columns = [batch.column(i) for i in range(2, 8)]
            sizes = np.array([len(x) for x in columns[0].to_pylist()], np.int64)
            begins, ends, patterns, labels, keys, joined = (
                c.flatten().to_numpy(zero_copy_only=False) for c in columns
            )
            document = np.repeat(np.arange(len(sizes)), sizes)
            decided = labels
            if len(labels):
                decided = decide(model, patterns, labels, keys, joined.astype(bool), document)
            stops = np.cumsum(sizes)
            out = []
            for text, a, b in zip(texts, (stops - sizes).tolist(), stops.tolist()):
                base = _from_string(text)
                parts = (c[a:b].tolist() for c in (begins, ends, patterns, joined, decided))
                spans = sorted(base + added_spans(base, *parts)) if b > a else base
                counts = [sum(s[1] == kind for s in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(text.encode()).hexdigest()
                out.append((*counts, digest, as_string(spans)))
            names = [part.split()[0] for part in RESULT.split(", ")]
            types = [*[pa.int64()] * 4, pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([doc_ids, *arrays], names=names)

    return rows.mapInArrow(run, RESULT)
