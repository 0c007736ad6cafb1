"""A quality classifier by co-training on two views of a document.

One classifier sees the text, its words and measures, the other the metadata of the
page: language, source and length. Both are naive Bayes, over binned measures and over every
language, source and pair of language and length as it is, so that a fit is three counts
over all rows. In each round either labels documents that it is
sure of for the other. At last both are calibrated on labelled rows that no fit has
seen, and their log odds combined.

What the words of a text say is the mean of their log odds, binned as any measure. The
odds are counted in two halves of the texts, and a text meets those of the half that it
is not in, so that no text is judged by its own label. Equal texts are in the same half.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from daedap.llm.measures import measured, share, texts_of
from daedap.llm.shingles import word_hashes
from daedap.session import materialize

# Bins of each feature, one more for null.
BINS = 64
ROUNDS, SURE = 3, 0.95
HELD_OUT = 4  # of one in so many labelled rows; they calibrate

# Log odds are counted in steps of 1 / STEPS between -MOST_ODDS and MOST_ODDS.
STEPS, MOST_ODDS = 4, 50

# How strongly the slope of a view is drawn to 0, and the views' weights to their sum.
SHRINK, MIX_SHRINK = 1e-3, 1.0

# What a page is known by; none is hashed. A key never counted adds nothing, and any
# is counted as if it had so many more rows, good and bad as all rows are.
KEYS = ("_source", "_lang", "_length")
SMOOTHING = 2.0
SALTS = 16  # so many tasks share the rows of a hot source

# Words are counted by the hash of their letters and digits, A to Z as a to z, in so many
# slots; a table of odds has 1 MB for each half. Words that share a slot share its odds.
SLOTS = 1 << 17
HALVES = 2
MOST_WORD_ODDS = 4.0
ROWS = 512  # whose slots stand side by side at a time
NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalnum())
BLANKED = bytes.maketrans(NO_LETTERS, b" " * len(NO_LETTERS))


def _binned(value: Column, low: float, high: float) -> Column:
    """Equal bins from ``low`` to ``high``, what lies outside in the outermost."""
    place = F.floor((value - low) * BINS / (high - low))
    bin_ = F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1))
    return F.coalesce(bin_, F.lit(BINS)).cast("int")


def text_bins(struct: str) -> list[Column]:
    """Features of the text view, from ``measures.measured``."""

    def m(name: str) -> Column:
        return F.col(f"{struct}.{name}")

    letters = m("n_upper") + m("n_lower")
    return [
        _binned(F.log2(1 + m("n_words")), 0, 16),
        _binned(share(m("n_repeat_words"), m("n_words")), 0, 1),
        _binned(share(m("n_dup_lines"), m("n_lines")), 0, 1),
        _binned(share(m("n_symbols"), m("n_words")), 0, 4),
        _binned(share(m("word_chars"), m("n_words")), 0, 16),
        _binned(share(m("n_distinct"), m("n_words")), 0, 1),
        _binned(share(m("n_top"), m("n_words")), 0, 1),
        _binned(share(m("n_upper"), letters), 0, 1),
        _binned(share(m("n_shouted"), m("n_words")), 0, 1),
        _binned(share(m("n_ended"), m("n_lines")), 0, 1),
    ]


def slots_of(data: bytes | None) -> np.ndarray:
    """The different slots of the words of a text in UTF-8, in order; null has none."""
    words = set((data or b"").translate(BLANKED).lower().split())
    return np.unique(word_hashes(list(words)) % np.uint64(SLOTS)).astype(np.int32)


def _slot_lists(texts: pa.Array) -> pa.ListArray:
    found = [slots_of(data) for data in texts_of(texts)]
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *found]))


def _mean_odds(table: np.ndarray, words: pa.ListArray, half: pa.Array) -> pa.Array:
    """The mean log odds of each row's slots; null where there are none."""
    parts = [(words.slice(i, ROWS), half.slice(i, ROWS)) for i in range(0, len(words), ROWS)]
    return pa.concat_arrays([pa.array([], pa.float64()), *(_odds_of(table, *p) for p in parts)])


def _odds_of(table: np.ndarray, words: pa.ListArray, half: pa.Array) -> pa.Array:
    sizes = np.diff(words.offsets.to_numpy())
    row = np.repeat(np.arange(len(words)), sizes)
    odds = table[half.to_numpy(zero_copy_only=False)[row], words.flatten().to_numpy()]
    total = np.bincount(row, odds, minlength=len(words))
    return pa.array(total / np.maximum(sizes, 1), mask=sizes == 0)


@F.arrow_udf(ArrayType(IntegerType(), False))
def _slots(texts: pa.Array) -> pa.Array:
    return _slot_lists(texts)


def text_words(text: str) -> Column:
    """The different slots of a text's words."""
    return _slots(F.col(text).cast("string"))


def text_half(text: str) -> Column:
    return F.pmod(F.xxhash64(F.col(text).cast("string"), F.lit(1)), F.lit(HALVES)).cast("int")


def _log_length(length: str) -> Column:
    return F.log2(1 + F.greatest(F.col(length), F.lit(0)))


def page_bins(length: str = "n_chars") -> list[Column]:
    """Binned features of the page view; they need no look at the text."""
    return [_binned(_log_length(length), 0, 32)]


def page_keys(lang: str = "lang", source: str = "source", length: str = "n_chars") -> list[Column]:
    """The columns ``KEYS`` of the page view; null is a key of its own."""

    def named(column: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))

    pair = F.concat_ws(" ", F.floor(_log_length(length)).cast("string"), named(lang))
    return [c.alias(k) for k, c in zip(KEYS, (named(source), named(lang), pair))]


# Numbers of binned features; the last of the text is that of its words.
VIEWS = {"text": 11, "page": 1}


@dataclass
class Model:
    """What each bin of each feature adds to the log odds of being good, per view.

    ``pages`` has what the keys of a page add to the page view, in ``_odds``, for each
    source, pair of language and length, and salt. ``words`` has the log odds of each
    slot for the texts of either half.
    """

    prior: dict[str, float] = field(default_factory=dict)
    steps: dict[str, np.ndarray] = field(default_factory=dict)
    slope: dict[str, float] = field(default_factory=dict)
    level: dict[str, float] = field(default_factory=dict)
    mix: tuple[float, float, float] = (0.0, 1.0, 0.0)
    pages: DataFrame | None = None
    words: np.ndarray = field(default_factory=lambda: np.zeros((HALVES, SLOTS)))

    def word_bin_of_text(self, text: str) -> Column:
        """The same from the text at once, so that no second Python worker takes part."""
        table = self.words

        @F.arrow_udf(DoubleType())
        def mean(texts: pa.Array, half: pa.Array) -> pa.Array:
            return _mean_odds(table, _slot_lists(texts), half)

        return _binned(mean(F.col(text).cast("string"), text_half(text)), -MOST_WORD_ODDS, MOST_WORD_ODDS)

    def with_pages(self, rows: DataFrame) -> DataFrame:
        """Rows with ``KEYS`` and, in ``_odds``, what these add to the page view.

        Rows stay where they are while the table of pages is small enough for a
        broadcast; otherwise those of a hot source go to ``SALTS`` tasks.
        """
        salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        joined = salted.join(self.pages, ["_source", "_length", "_salt"], "left")
        return joined.withColumn("_odds", F.coalesce("_odds", F.lit(0.0)))

    def raw(self, view: str, bins: list[Column]) -> Column:
        tables = (F.array(*map(F.lit, row)) for row in self.steps[view].tolist())
        parts = (F.element_at(t, b + 1) for t, b in zip(tables, bins))
        total = reduce(Column.__add__, parts, F.lit(self.prior[view]))
        if view == "page":
            total += F.col("_odds")
        return F.least(F.greatest(total, F.lit(-MOST_ODDS)), F.lit(MOST_ODDS))

    def calibrated(self, view: str, bins: list[Column]) -> Column:
        return self.raw(view, bins) * self.slope[view] + self.level[view]

    def combined(self, text: list[Column], page: list[Column]) -> Column:
        level, by_text, by_page = self.mix
        odds = self.calibrated("text", text) * by_text + self.calibrated("page", page) * by_page
        return odds + level


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _logistic(
    x: np.ndarray, good: np.ndarray, bad: np.ndarray, usual: tuple[float, ...], shrink: float
) -> np.ndarray:
    """Weights, level first, from counts of good and bad rows per point.

    They are drawn to ``usual``, as a normal prior of variance 1 / ``shrink`` does: where
    the rows are parted without an error they would be without bound otherwise.
    """
    x = np.concatenate([np.ones((len(x), 1)), x], 1)
    usual = np.array(usual)
    w, n = np.zeros(x.shape[1]), good + bad
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (good - n * p) - shrink * (w - usual)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + shrink * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-10:
            break
    return w


def _with_words(rows: DataFrame, **tables: np.ndarray) -> DataFrame:
    """Rows(base, words, half) with the bins of the text view by each table of odds.

    One Python worker meets all of the tables.
    """
    names = list(tables)

    @F.arrow_udf(StructType([StructField(name, DoubleType()) for name in names]))
    def means(words: pa.Array, half: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([_mean_odds(tables[n], words, half) for n in names], names)

    seen = rows.withColumn("_means", means("words", "half"))
    bins = {
        n: F.concat("base", F.array(_binned(F.col(f"_means.{n}"), -MOST_WORD_ODDS, MOST_WORD_ODDS)))
        for n in names
    }
    return seen.withColumns(bins).drop("_means")


def _bins_of(view: str) -> list[Column]:
    return [F.col(view)[i] for i in range(VIEWS[view])]


def _fit(rows: DataFrame, model: Model) -> None:
    """Count rows(text, page, text_label, page_label) per view, feature, bin and label."""

    def cells_of(view: str) -> Column:
        return F.transform(
            view,
            lambda b, i: F.struct(
                F.lit(view).alias("view"), i.alias("feature"), b.alias("bin"), F.col(f"{view}_label").alias("y")
            ),
        )

    cells = rows.select(F.explode(F.concat(*map(cells_of, VIEWS))).alias("c")).filter("c.y IS NOT NULL")
    counts = cells.groupBy("c.view", "c.feature", "c.bin", "c.y").count().collect()
    for view in VIEWS:
        n = max((r["feature"] + 1 for r in counts if r["view"] == view), default=VIEWS[view])
        table = np.ones((n, BINS + 1, 2))
        for r in counts:
            if r["view"] == view:
                table[r["feature"], r["bin"], r["y"]] += r["count"]
        seen = table.sum(1)
        model.prior[view] = float(np.log(seen[0, 1] / seen[0, 0]))
        model.steps[view] = np.log(table[:, :, 1] / seen[:, None, 1]) - np.log(
            table[:, :, 0] / seen[:, None, 0]
        )


def _fit_words(rows: DataFrame, model: Model) -> None:
    """Count rows(words, half, text_label) per slot, half and label.

    A slot counts a text once, as if it had SMOOTHING more, good and bad as all are.
    What comes to the driver are at most HALVES * SLOTS rows of counts.
    """
    told = rows.filter("text_label IS NOT NULL").select("half", "words", "text_label")
    # The slot behind the last counts all texts.
    slots = F.explode(F.concat("words", F.array(F.lit(SLOTS)))).alias("slot")
    cells = told.select("half", slots, "text_label").groupBy("half", "slot")
    found = cells.agg(F.sum("text_label").alias("good"), F.count("*").alias("n")).toArrow().to_pandas()
    counts = np.zeros((2, HALVES, SLOTS + 1))
    counts[1, found["half"], found["slot"]] = found["good"]
    counts[0, found["half"], found["slot"]] = found["n"] - found["good"]
    counts = counts[:, ::-1]  # of the other half
    part = (counts[1, :, -1:] + 1) / (counts[:, :, -1:].sum(0) + 2)
    good, bad = counts[1] + SMOOTHING * part, counts[0] + SMOOTHING * (1 - part)
    model.words = (np.log(good / bad) - np.log(part / (1 - part)))[:, :SLOTS]


def _fit_pages(rows: DataFrame, pages: DataFrame, model: Model) -> None:
    """Count rows(KEYS.., page_label) per key and label, for ``pages``, all different ``KEYS``.

    Follows ``_fit``. The counts stay tables; a key has one row however many it counts.
    """
    each = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("key")) for k in KEYS]
    told = rows.filter("page_label IS NOT NULL").select(
        F.explode(F.array(*each)).alias("k"), F.col("page_label").alias("y")
    )
    counts = told.groupBy("k.kind", "k.key").agg(F.sum("y").alias("good"), F.count("y").alias("n"))
    prior = model.prior["page"]
    part = float(1 / (1 + np.exp(-prior)))
    good = F.col("good") + SMOOTHING * part
    bad = F.col("n") - F.col("good") + SMOOTHING * (1 - part)
    counts = materialize(counts.select("kind", "key", (F.log(good) - F.log(bad) - prior).alias("odds")))
    total = F.lit(0.0)
    for k in KEYS:
        one = counts.filter(F.col("kind") == k).select(F.col("key").alias(k), F.col("odds").alias(f"odds{k}"))
        pages = pages.join(one, k, "left")
        total += F.coalesce(f"odds{k}", F.lit(0.0))
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt")
    model.pages = materialize(pages.select("_source", "_length", total.alias("_odds"), salt))


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Fit slope and level of both views, and how they are combined, on held-out rows."""

    def step(odds: Column) -> Column:
        return F.round(odds * STEPS).cast("int")

    raw = [step(model.raw(v, _bins_of(v))).alias(v) for v in VIEWS]
    held = model.with_pages(rows.filter("held_out AND label IS NOT NULL")).select(*raw, "label")
    # At most (2 * MOST_ODDS * STEPS + 1) ** 2 cells.
    cells = held.groupBy("text", "page").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )
    found = cells.orderBy("text", "page").collect()
    good, bad = (np.array([r[c] for r in found], float) for c in ("good", "bad"))
    odds = np.array([[r[v] / STEPS for v in VIEWS] for r in found]).reshape(-1, len(VIEWS))
    usual = float(np.log((good.sum() + 1) / (bad.sum() + 1)))
    for i, view in enumerate(VIEWS):
        level, slope = _logistic(odds[:, [i]], good, bad, (0.0, 0.0), SHRINK)
        # A view never counts against its own sense.
        model.slope[view] = max(float(slope), 0.0)
        model.level[view] = float(level) if slope > 0 else usual
    both = np.stack([odds[:, i] * model.slope[v] + model.level[v] for i, v in enumerate(VIEWS)], 1)
    # Either view's odds hold those of all rows, which count once. No view counts against
    # its own sense.
    level, *weights = _logistic(both, good, bad, (-usual, 1.0, 1.0), MIX_SHRINK).tolist()
    model.mix = (level, *(max(w, 0.0) for w in weights))


def _told(model: Model, view: str, bins: list[Column], sure: float) -> Column:
    """The given label of a row, or what a view is sure of where it has none."""
    own = F.when(~F.col("held_out"), F.col("label"))
    p = _probability(model.calibrated(view, bins))
    pseudo = F.when(p >= sure, 1).when(p <= 1 - sure, 0)
    return F.when(F.col("label").isNotNull(), own).otherwise(pseudo)


def _trained(rows: DataFrame, rounds: int, sure: float) -> tuple[Model, DataFrame] | None:
    """The model of ``train``, and rows without words, with the bins of both views in it.

    Words are read twice in a round, to count them and to put their odds into bins; all
    other counts read the bins, which are written once in a round.
    """
    labels = rows.filter("NOT held_out").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    if labels.first()[:] != (0, 1):
        return None
    model = Model()
    pages = materialize(rows.select(*KEYS).distinct())
    own = F.when(~F.col("held_out"), F.col("label"))
    kept = [c for c in rows.columns if c not in ("base", "words", "half")]
    seen = None
    for _ in range(rounds + 1):
        if seen is None:
            labelled = rows.withColumn("text_label", own)
            _fit_words(labelled, model)
            told = _with_words(labelled, text=model.words).withColumn("page_label", own)
        else:
            before = model.words
            labelled = model.with_pages(rows).withColumn(
                "text_label", _told(model, "page", _bins_of("page"), sure)
            )
            _fit_words(labelled, model)
            told = _with_words(labelled, text=model.words, before=before)
            bins = [F.col("before")[i] for i in range(VIEWS["text"])]
            told = told.withColumn("page_label", _told(model, "text", bins, sure))
        seen = materialize(told.select(*kept, "text", "text_label", "page_label"))
        _fit(seen, model)
        _fit_pages(seen, pages, model)
        _calibrate(seen, model)
    return model, seen.drop("text_label", "page_label")


def train(rows: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """Fit on rows(base, words, half, page, KEYS.., label, held_out).

    None without labels of both kinds.

    Every round counts over all rows: labelled ones, and those of the rest that the
    other view is sure of with probability ``sure`` either way.
    """
    found = _trained(rows, rounds, sure)
    return found and found[0]


def _labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """A document with several labels counts as good if most of them are."""
    given = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    label = (F.avg("quality") >= 0.5).cast("int").alias("label")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    # Rows with their words are never sorted, and labels never broadcast whole.
    joined = features.join(given.agg(label).hint("shuffle_hash"), "doc_id", "left")
    return joined.withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def _features(docs: DataFrame) -> DataFrame:
    words = text_words("text").alias("words"), text_half("text").alias("half")
    seen = docs.select(F.col("doc_id").cast("long"), measured("text").alias("m"), *words, *PAGE)
    base, page = F.array(*text_bins("m")).alias("base"), F.array(*page_bins()).alias("page")
    return seen.select("doc_id", base, "words", "half", page, *page_keys())


PAGE = ("lang", "source", "n_chars")


def classified(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, text_score, page_score, quality and kept of every row of ``docs``.

    ``docs`` has doc_id, text, lang, source and n_chars, ``labels`` has doc_id and
    quality 0 or 1. Null is a bin of its own, a null text is empty. Null and repeated
    ids are kept, one row each. Without labels of both kinds nothing can be told, and
    every score is 1. Features are written once to the shared folder.
    """
    rows = materialize(_labelled(_features(docs), labels))
    found = _trained(rows, ROUNDS, SURE)
    if found is None:
        scores = [F.lit(1.0)] * 3
    else:
        model, rows = found
        rows = model.with_pages(rows)
        text, page = _bins_of("text"), _bins_of("page")
        odds = model.calibrated("text", text), model.calibrated("page", page)
        scores = [_probability(o) for o in (*odds, model.combined(text, page))]
    names = ("text_score", "page_score", "quality")
    scored = rows.select("doc_id", *(s.alias(n) for s, n in zip(scores, names)))
    return scored.withColumn("kept", F.col("quality") >= threshold)


def without_rejected(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever these are called.

    Texts are not shuffled while the table of different pages is small enough for a
    broadcast, and once otherwise.
    """
    model = train(materialize(_labelled(_features(docs), labels)))
    if model is None:
        return docs
    text = [*text_bins("_m"), F.col("_word_bin")]
    odds = model.combined(text, page_bins("_row.n_chars"))
    rows = model.with_pages(docs.select(F.struct("*").alias("_row"), *page_keys()))
    word_bin = model.word_bin_of_text("_row.text").alias("_word_bin")
    judged = rows.select("_row", "_odds", measured("_row.text").alias("_m"), word_bin)
    return judged.filter(_probability(odds) >= threshold).select("_row.*")
