"""Document fingerprints from closed syncmers, in column expressions alone.

A text is read as pieces of words, of at most eight characters. Of every run of
``LENGTH`` pieces, the runs of ``INNER`` pieces inside it are hashed; it is a closed
syncmer if the smallest of these stands at its begin or end. Whether a run is chosen
depends on nothing around it. Anchors take a piece at every character of a longer word,
so equal passages give equal anchors wherever they stand, without blanks too. Sketches
cut a longer word into eights from its begin: there this holds from one blank to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daedap.session import materialize

PIECE = r"\S{1,8}"
# For anchors: words of at most eight characters, and every eight neighbors in longer ones.
# None begins with the second half of a sign that Java holds in two.
MOVABLE = r"(?!\p{Cs})(?=(\S{8}|(?<!\S)\S{1,7}(?!\S)))"
LENGTH, INNER = 5, 2

# A fingerprint holds so many of a text's smallest anchors, all of a shorter text.
SIZE = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _hashes(text: Column, piece: str = PIECE, group: int = 0) -> Column:
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(piece), F.lit(group))
    return F.transform(pieces, lambda p: F.xxhash64(p))


def _closed(inner: Column, i: Column) -> Column:
    """The smallest of the inner hashes of the run at ``i``, from 1, is at an edge."""
    n = LENGTH - INNER + 1
    at = [F.element_at(inner, i + j) for j in range(n)]
    return F.least(at[0], at[-1]) <= F.least(*at[1:-1])


def _chosen(hashes: Column, result: Callable[[Column, Column], Column], few: Column) -> Column:
    """``result(hashes, i)`` of each closed syncmer; ``few`` if there are too few pieces."""

    def over(h: Column) -> Column:
        n = F.size(h) - INNER + 1
        starts = F.sequence(F.lit(1), F.size(h) - LENGTH + 1)
        inner = F.zip_with(
            F.slice(h, 1, n), F.slice(h, INNER, n), lambda a, b: F.xxhash64(a, b)
        )
        many = _let(
            inner,
            lambda g: F.transform(
                F.filter(starts, lambda i: _closed(g, i)), lambda i: result(h, i)
            ),
        )
        return F.when(F.size(h) >= LENGTH, many).when(F.size(h) > 0, few)

    return over(hashes)


def _short(value: Column) -> Column:
    """The upper half of a hash."""
    return F.shiftrightunsigned(value, 32)


def anchors(text: Column) -> Column:
    """(position, hash) of every closed syncmer; positions count pieces, from 0.

    A text with fewer pieces than a run has one anchor for all of it; null and empty
    texts and white space have none.
    """

    def one(h: Column, i: Column) -> Column:
        name = _short(F.xxhash64(F.slice(h, i, LENGTH)))
        return F.struct((i - 1).cast("int").alias("position"), name.alias("hash"))

    def all_of(h: Column) -> Column:
        whole = F.struct(F.lit(0).alias("position"), _short(F.xxhash64(h)).alias("hash"))
        none = F.array().cast("array<struct<position:int,hash:bigint>>")
        return F.coalesce(_chosen(h, one, F.array(whole)), none)

    return _let(_hashes(text, MOVABLE, 1), all_of)


def sketch(text: Column) -> Column:
    """The smallest anchor hashes of the whole text, ascending and distinct."""

    def all_of(h: Column) -> Column:
        found = _chosen(
            h,
            lambda h, i: _short(F.xxhash64(F.slice(h, i, LENGTH))),
            F.array(_short(F.xxhash64(h))),
        )
        return F.coalesce(found, F.array().cast("array<bigint>"))

    return F.slice(F.sort_array(F.array_distinct(_let(_hashes(text), all_of))), 1, SIZE)


def as_text(values: Column) -> Column:
    """A sketch as a string, eight hexadecimal digits for each anchor."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """What part of all anchors two texts share, as their sketches tell; from 0 to 1.

    Exact where the texts together have no more anchors than a sketch holds. Two
    empty sketches are alike.
    """

    def over(both: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
        return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))

    return _let(F.slice(F.sort_array(F.array_union(a, b)), 1, SIZE), over)


def _following(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, n_replaced) of every different id; the last is followed by the first.

    Only ids move: by ranges, inside which the next id is looked up, and one row per
    range for the id that begins the next one.
    """
    replaced = F.floor(F.char_length("text") / 4).cast("int")
    each = docs.groupBy("doc_id").agg(F.max(replaced).alias("n_replaced"))
    ranges = each.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    parts = materialize(ranges)
    inside = Window.partitionBy("part").orderBy("doc_id")
    over = Window.orderBy("part")
    begins = parts.groupBy("part").agg(F.min("doc_id").alias("begin"))
    first = F.first("begin").over(over.rowsBetween(Window.unboundedPreceding, 0))
    after = begins.select("part", F.coalesce(F.lead("begin").over(over), first).alias("after"))
    return (
        parts.withColumn("lead", F.lead("doc_id").over(inside))
        .join(after, "part")
        .select("doc_id", F.coalesce("lead", "after").alias("next_id"), "n_replaced")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)``, of edited texts, and how alike they are.

    The edited text has its last quarter of characters, rounded down, replaced by as
    many from the begin of the next document's text (or all, if it has fewer).
    Null text is empty. Of rows that repeat an id, that with the smallest begin is the
    next document for others; all of them have the same next document. Rows without an
    id stand in no order and are edited as if the next document were empty.
    """
    # Spark shares the shuffle only if both joins read the very same column.
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = texts.filter("doc_id IS NOT NULL")
    order = _following(named)

    before = order.select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before_id"), "n_replaced"
    )
    begin = F.substring("text", F.lit(1), F.col("n_replaced")).alias("begin")
    # Texts are shuffled by id once, for both joins; sketches are worked out behind it.
    # A third of the texts at most moves on to the document before.
    begins = (
        named.join(before, "doc_id")
        .groupBy(F.col("before_id").alias("doc_id"))
        .agg(F.min(F.struct(begin, sketch(F.col("text")).alias("next_sketch"))).alias("next"))
    )
    joined = named.join(begins, "doc_id").select(
        "doc_id", "text", sketch(F.col("text")).alias("sketch"), "next.*"
    )
    alone = texts.filter("doc_id IS NULL").select(
        "doc_id",
        "text",
        sketch(F.col("text")).alias("sketch"),
        F.lit("").alias("begin"),
        sketch(F.lit("")).alias("next_sketch"),
    )
    n = F.char_length("text")
    replaced = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - replaced), F.substring("begin", F.lit(1), replaced)
    )
    rows = joined.unionByName(alone).select(
        "doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")
    )
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def _packed(text: Column) -> Column:
    """All anchors of a text as numbers, position above hash."""
    return F.transform(
        anchors(text),
        lambda a: F.shiftleft(a["position"].cast("long"), 32).bitwiseOR(a["hash"]),
    )


def _codes(packed: Column, side: int) -> Column:
    """Anchors as numbers that sort by hash, side and position."""
    return F.transform(
        packed,
        lambda p: F.shiftleft(p, 32)
        .bitwiseOR(F.lit(side << 31).cast("long"))
        .bitwiseOR(F.shiftright(p, 32)),
    )


def shared_passages(docs: DataFrame) -> DataFrame:
    """What each text shares with the next document's, from all anchors and where they stand.

    One row per row of ``docs(doc_id, text)``: doc_id, n_anchors, next_anchors, shared,
    aligned, offset, near, in_place and passages. The k-th place of a hash in one text
    is matched to the k-th in the other; ``shared`` counts these, ``aligned`` those of
    the commonest ``offset`` (the nearer to 0 of as common ones, the positive of two as
    near), both also as a part of all anchors (``near``, ``in_place``; 1 if neither text
    has any). ``passages`` has the matches of each offset, by begin: from which to which
    piece of this text they reach, the offset, and how many they are. Of rows that
    repeat an id, that with the smallest anchors is the next document for others; rows
    without an id have an empty one. Texts stay in the tasks that read them; their anchors
    are written once to the shared folder.
    """
    if dict(docs.dtypes)["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    # Anchors are found once for each text, and only these go on from here.
    text = F.coalesce("text", F.lit(""))
    packed = materialize(docs.select("doc_id", _packed(text).alias("own")))
    named = packed.filter("doc_id IS NOT NULL")
    order = _following(named.select("doc_id", F.lit("").alias("text")))
    before = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before_id"))
    nexts = (
        named.join(before, "doc_id")
        .groupBy(F.col("before_id").alias("doc_id"))
        .agg(F.min("own").alias("next"))
    )
    rows = named.join(nexts, "doc_id").select(
        "doc_id", F.monotonically_increasing_id().alias("row"), "own", "next"
    )

    def hashes(packed: str) -> Column:
        return F.transform(packed, lambda p: p.bitwiseAND(F.lit(0xFFFFFFFF)))

    codes = F.concat(_codes(F.col("own"), 0), _codes(F.col("next"), 1))
    # A row whose texts share nothing goes on as one row without a code. Rows are
    # numbered in the tasks that finish them.
    each = rows.select(
        "doc_id",
        "row",
        F.size("own").alias("n_anchors"),
        F.size("next").alias("next_anchors"),
        F.explode_outer(F.when(F.arrays_overlap(hashes("own"), hashes("next")), codes)).alias("code"),
    )
    one = ["doc_id", "row", "n_anchors", "next_anchors"]
    side = F.shiftrightunsigned("code", 31)
    rank = F.row_number().over(Window.partitionBy("doc_id", "row", "side").orderBy("code"))
    place = F.col("code").bitwiseAND(F.lit(0x7FFFFFFF))
    ranked = each.withColumn("side", side).withColumn("rank", rank)
    is_next = F.col("side").bitwiseAND(F.lit(1)) == 1
    matches = ranked.groupBy(*one, F.shiftrightunsigned("side", 1).alias("hash"), "rank").agg(
        F.max(F.when(~is_next, place)).alias("here"), F.max(F.when(is_next, place)).alias("there")
    )
    offset = F.col("there") - F.col("here")
    by_offset = matches.groupBy(*one, offset.alias("offset")).agg(
        F.count(offset).alias("n"),
        F.min("here").alias("begin"),
        (F.max("here") + LENGTH).alias("end"),
    )
    commonest = F.max(
        F.when(
            F.col("offset").isNotNull(),
            F.struct("n", (-F.abs("offset")).alias("near"), "offset"),
        )
    )
    passage = F.when(
        F.col("offset").isNotNull(), F.struct("begin", "end", "offset", F.col("n").alias("n_anchors"))
    )
    found = (
        by_offset.groupBy(*one)
        .agg(
            F.sum("n").alias("shared"),
            commonest.alias("best"),
            F.array_sort(F.collect_list(passage)).alias("passages"),
        )
        .select(
            "doc_id",
            "n_anchors",
            "next_anchors",
            "shared",
            F.coalesce("best.n", F.lit(0)).cast("long").alias("aligned"),
            F.col("best.offset").alias("offset"),
            "passages",
        )
    )
    alone = packed.filter("doc_id IS NULL").select(
        "doc_id",
        F.size("own").alias("n_anchors"),
        F.lit(0).alias("next_anchors"),
        F.lit(0).cast("long").alias("shared"),
        F.lit(0).cast("long").alias("aligned"),
        F.lit(None).cast("long").alias("offset"),
        F.array().cast(found.schema["passages"].dataType).alias("passages"),
    )

    def part(n: str) -> Column:
        total = F.col("n_anchors") + F.col("next_anchors") - F.col(n)
        return F.when(total == 0, 1.0).otherwise(F.col(n) / total)

    both = found.unionByName(alone)
    return both.select(
        *found.columns[:-1], part("shared").alias("near"), part("aligned").alias("in_place"), "passages"
    )
