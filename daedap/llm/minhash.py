"""Near-duplicate documents by a multi-index Hamming join of b-bit signatures.

A document's signature holds 16 bits of the minimum of its shingle hashes under each
of 64 permutations. Two signatures that differ in at most ``MOST_DIFFERENT`` of the 64
places have, of 16 chunks of four, one with at most one difference: 31 differences
spread over 16 chunks cannot leave two in each. So each signature is filed under
every three places of each chunk, and every such pair meets under a common key.

At a similarity of 0.75 a place differs with probability 0.25, and more than 31 of 64
do so with a probability of about 0.00002; links are confirmed on the full sets.
"""

from __future__ import annotations

import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from daedap.llm.graph import components
from daedap.llm.shingles import shingle_set, windows
from daedap.session import materialize

PLACES = 64
CHUNK = 4
MOST_DIFFERENT = 2 * (PLACES // CHUNK) - 1

# Nodes under one key up to which all pairs are looked at one by one; the nodes of
# fuller keys are joined by their rarest shingles instead.
FEW_NODES = 64

# Nodes of a full key that stand together when frequent shingles are counted.
SHARE_NODES = 256

# Slots in which shingles are counted, and bits of a set's bitmap.
COUNTERS = 2**20
BITMAP = 1024

# Slots that tell which shingles can meet another text's, in so many parts.
MEETING = 2**22
PARTS = 16

_NUMBERS = np.random.default_rng(20_240_501)
FACTORS = _NUMBERS.integers(0, 2**63, PLACES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _NUMBERS.integers(0, 2**64, PLACES, np.uint64)

SKETCH = "doc_id long, n_shingles long, print binary, signature binary"


def signature(shingles: np.ndarray, block: int = 1024) -> np.ndarray:
    """16 bits of the least value under each permutation, of at least one shingle."""
    least = np.full(PLACES, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), block):
        values = shingles[None, i : i + block] * FACTORS[:, None] + SHIFTS[:, None]
        least = np.minimum(least, values.min(1))
    return least.astype("<u2")


def sketches(docs: DataFrame) -> DataFrame:
    """Number of shingles, a print of the whole set, and signature of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, prints, signatures = [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                shingles = shingle_set(data)
                n.append(len(shingles))
                prints.append(xxh3_128_digest(shingles.tobytes()))
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_shingles": pa.array(n, pa.int64()),
                    "print": pa.array(prints, pa.binary()),
                    "signature": pa.array(signatures, pa.binary()),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SKETCH)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """For rows of places: a key per chunk and place left out of it."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), -1, CHUNK)
    keys = []
    for chunk in range(parts.shape[1]):
        for out in range(CHUNK):
            kept = [parts[:, chunk, i] for i in range(CHUNK) if i != out]
            name = np.full(len(parts), chunk * CHUNK + out, np.uint64)
            keys.append(windows(np.stack([name, *kept]), CHUNK)[0])
    return np.stack(keys, 1)


def filed(classes: DataFrame) -> DataFrame:
    """(key, node, n) for every key of every ``classes(node, n, signature)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                batch = whole.slice(i, 2000)
                nodes = batch.column(0).to_numpy(zero_copy_only=False)
                n = batch.column(1).to_numpy(zero_copy_only=False)
                places = b"".join(batch.column(2).to_pylist())
                keys = index_keys(np.frombuffer(places, "<u2").reshape(-1, PLACES))
                each = keys.shape[1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": keys.reshape(-1).view(np.int64),
                        "node": np.repeat(nodes, each),
                        "n": np.repeat(n, each),
                    }
                )

    return classes.select("node", "n", "signature").mapInArrow(run, "key long, node long, n long")


def _sizes_fit(a: str, b: str):
    """Sets of these sizes can be similar enough."""
    return F.expr(f"100 * least({a}, {b}) >= 75 * greatest({a}, {b})")


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sizes fit and signatures differ in few places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, PLACES)
                for i in (2, 3)
            )
            few = (x != y).sum(1) <= MOST_DIFFERENT
            yield batch.select([0, 1]).filter(pa.array(few))

    def of(end: str) -> DataFrame:
        return classes.select(
            F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}")
        )

    joined = pairs.select("a", "b").join(of("b"), "b").join(of("a"), "a")
    fitting = joined.filter(_sizes_fit("n_a", "n_b")).select("a", "b", "s_a", "s_b")
    return fitting.mapInArrow(run, "a long, b long").distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def shingles(text: bytes) -> np.ndarray:
            name = xxh3_128_digest(text)
            if name not in recent:
                recent[name] = shingle_set(text)
                if len(recent) > 16:
                    recent.popitem(last=False)
            return recent[name]

        for batch in batches:
            linked = []
            columns = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            for x, y in zip(*columns):
                x, y = shingles(x), shingles(y)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= 75 * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    def of(end: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"t_{end}"))

    # ``a`` may stand in very many pairs, so it is joined last, where Spark splits it.
    joined = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "t_a", "t_b")
    return joined.mapInArrow(run, "a long, b long").distinct()


def _pairs_by_key(buckets: DataFrame) -> DataFrame:
    """Pairs under a common key that are not linked yet; the head's pairs are known."""
    x = buckets.filter("node != head").selectExpr("key", "node a", "n n_a", "component c_a")
    y = buckets.filter("node != head").selectExpr("key", "node b", "n n_b", "component c_b")
    found = x.join(y, "key").filter("a < b and c_a != c_b").filter(_sizes_fit("n_a", "n_b"))
    return found.select("a", "b").distinct()


def _frequent(texts: DataFrame) -> np.ndarray:
    """For each of ``COUNTERS`` slots of shingles, how many of the texts hold a frequent one.

    Texts under one key stand together, and what makes such a key full are shingles that
    most of its texts hold. So a slot counts with the texts of a batch where several hold
    it; the shingles of one text alone, which are nearly all, are not sent anywhere. What
    comes to the driver is one number per slot, however many texts there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            sets = [shingle_set(t) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            slots = [np.unique(s % np.uint64(COUNTERS)) for s in sets]
            slot, n = np.unique(np.concatenate(slots).astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"slot": slot[n > 1], "n": n[n > 1]})

    slots = texts.select("text").mapInArrow(run, "slot long, n long")
    found = slots.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[found["slot"].to_numpy()] = found["n"].to_numpy()
    return table


def _first_quarter(shingles: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a set of which similar sets share one, and their places."""
    n = len(shingles)
    place = np.flatnonzero(100 * (n - np.arange(n)) >= 75 * n)
    order = np.lexsort((shingles, table[shingles % np.uint64(COUNTERS)]))
    return shingles[order[place]], place


def _meeting(texts: DataFrame, table: np.ndarray) -> np.ndarray:
    """For each of ``MEETING`` slots, whether two or more texts have a first shingle there.

    A task sends bits for its texts, which are put together part by part; what comes to
    the driver are the bits of all slots once, however many texts there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, more = np.zeros(MEETING, bool), np.zeros(MEETING, bool)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                first, _ = _first_quarter(shingle_set(text), table)
                slots = np.unique(first % np.uint64(MEETING))
                more[slots] |= once[slots]
                once[slots] = True
        if once.any():
            sent = [[zlib.compress(np.packbits(p).data, 1) for p in np.split(x, PARTS)] for x in (once, more)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PARTS), pa.int32()), *(pa.array(x, pa.binary()) for x in sent)],
                names=["part", "once", "more"],
            )

    def together(rows: pa.Table) -> pa.Table:
        once, more = (np.zeros(MEETING // PARTS // 8, np.uint8) for _ in range(2))
        for x, y in zip(rows["once"].to_pylist(), rows["more"].to_pylist()):
            x, y = (np.frombuffer(zlib.decompress(z), np.uint8) for z in (x, y))
            more |= y | (once & x)
            once |= x
        return pa.table({"part": rows["part"][:1], "more": pa.array([more.tobytes()], pa.binary())})

    sent = texts.select("text").mapInArrow(run, "part int, once binary, more binary")
    found = sent.groupBy("part").applyInArrow(together, "part int, more binary").collect()
    meeting = np.zeros((PARTS, MEETING // PARTS), bool)
    for r in found:
        meeting[r["part"]] = np.unpackbits(np.frombuffer(r["more"], np.uint8))
    return meeting.reshape(-1)


def _pairs_by_rare_shingles(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs of ``nodes(node, component, key, share)`` that can be links, exactly.

    With each set's shingles in one order for all, similar sets share one in their
    first quarter, and what can follow its place in both bounds what they share. Any
    order will do; here those come last that many texts under a key have in common. Bits
    that differ between two sets' bitmaps bound from below what they do not share. Two of
    one component need no link. Shingles that no other set has in its first quarter meet
    nothing and are not sent: these are what texts around a common passage mostly have.
    """
    named = materialize(
        nodes.withColumnRenamed("node", "doc_id")
        .join(texts, "doc_id")
        .repartition("key", "share")
        .select("doc_id", "component", "text")
    )
    table = _frequent(named)
    meeting = np.packbits(_meeting(named, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meets = np.unpackbits(meeting).view(bool)
        for batch in batches:
            columns = (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()))
            for node, component, text in zip(*(c.to_pylist() for c in columns)):
                shingles = shingle_set(text)
                n = len(shingles)
                first, place = _first_quarter(shingles, table)
                met = meets[first % np.uint64(MEETING)]
                first, place = first[met], place[met]
                marks = np.zeros(BITMAP, np.uint8)
                marks[shingles % np.uint64(BITMAP)] = 1
                bits = np.tile(np.packbits(marks).view(np.int64), len(place))
                ends = np.arange(len(place) + 1, dtype=np.int32) * (BITMAP // 64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": np.full(len(place), node),
                        "component": np.full(len(place), component),
                        "n": np.full(len(place), n),
                        "shingle": first.view(np.int64),
                        "place": place,
                        "bits": pa.ListArray.from_arrays(ends, bits),
                    }
                )

    schema = "node long, component long, n long, shingle long, place long, bits array<long>"
    first = materialize(named.mapInArrow(run, schema))
    x = first.selectExpr("shingle", "node a", "component c_a", "n n_a", "place p_a", "bits b_a")
    y = first.selectExpr("shingle", "node b", "component c_b", "n n_b", "place p_b", "bits b_b")
    differ = " + ".join(f"bit_count(b_a[{i}] ^ b_b[{i}])" for i in range(BITMAP // 64))
    found = (
        x.join(y, "shingle")
        .filter("a < b and c_a != c_b")
        .filter(_sizes_fit("n_a", "n_b"))
        .filter("7 * least(n_a - p_a, n_b - p_b) >= 3 * (n_a + n_b)")
        .filter(f"7 * ({differ}) <= n_a + n_b")
    )
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, few_nodes: int = FEW_NODES) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every ``docs(doc_id, text)``.

    Documents are linked where their sets of five-word shingles have a similarity of
    0.75 or more; ``component_id`` is the smallest id that links lead to, ``kept``
    says that it is the document's own. Equal sets are one class, and only classes
    are compared. Under each key all are compared with the smallest first, which
    joins groups of copies; what is still apart is compared pair by pair under keys
    with few nodes, and by an exact join on rare shingles under fuller ones. Tables
    of one row per document and less are written to the shared folder meanwhile.

    Null and empty texts are linked with nothing. Rows that repeat an id are linked
    by their own texts; rows without an id can be copies of others but link nothing,
    and one that is no copy of a row with an id is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = materialize(sketches(docs))
    classes = materialize(
        sketch.filter("signature is not null")
        .groupBy("print", F.col("n_shingles").alias("n"))
        .agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    )
    keys = filed(classes.filter("node is not null"))
    heads = keys.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"))
    buckets = materialize(keys.join(heads.filter("head < last").drop("last"), "key"))
    members = buckets.select(F.col("node").alias("doc_id")).distinct()
    texts = materialize(docs.join(members, "doc_id", "left_semi"))

    stars = buckets.filter("node != head").filter(F.col("n").isNotNull())
    pairs = stars.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(_confirmed(materialize(_near(pairs, classes)), texts))
    labels = components(links)

    component = F.coalesce("component", "node").alias("component")
    placed = materialize(
        buckets.join(labels, "node", "left").select("key", "node", "n", "head", component)
    )
    mixed = (
        placed.groupBy("key")
        .agg(
            F.count("*").alias("nodes"),
            F.min("component").alias("least"),
            F.max("component").alias("greatest"),
        )
        .filter("least < greatest")
        .select("key", "nodes")
    )
    apart = materialize(placed.join(mixed, "key"))
    by_key = _pairs_by_key(apart.filter(F.col("nodes") <= few_nodes))
    # Each node once, with its fullest key and a share of the nodes there.
    fullest = F.max(F.struct("nodes", "key")).alias("at")
    full = apart.filter(F.col("nodes") > few_nodes).groupBy("node", "component").agg(fullest)
    shares = F.ceil(F.col("at.nodes") / SHARE_NODES)
    full = full.select(
        "node", "component", "at.key", F.pmod(F.xxhash64("node"), shares).alias("share")
    )
    rare = _pairs_by_rare_shingles(full, texts)
    near = materialize(_near(by_key.union(rare).distinct(), classes))
    more = materialize(_confirmed(near, texts))
    if not more.isEmpty():
        labels = components(links.union(more))

    named = classes.join(labels, "node", "left").select(
        "print", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("class_id")
    )
    component_id = F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    found = sketch.select("doc_id", "n_shingles", "print").join(named, ["print", "n_shingles"], "left")
    return found.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept: of each group that with the smallest id.

    All columns stay. Rows that repeat the id of a kept row stay with it.
    """
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
