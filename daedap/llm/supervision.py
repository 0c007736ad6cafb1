"""Document quality by weak supervision: rules vote, and votes are weighed.

Rules call a document good or bad or abstain. Expectation-maximisation estimates,
without labels, how each rule votes on good documents and on bad ones of each kind;
a document's quality is then the posterior probability that it is good. Documents
are bad in different ways, and a rule for one way says little about the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daedap.llm.measures import measured, share
from daedap.session import materialize

BAD, ABSTAIN, GOOD = 0, 1, 2

# Documents with fewer words, or a larger share of repeated ones, fail at once.
LEAST_WORDS = 20
MOST_REPEATED = 30

# Part of all documents that speaks for a rule's own sense of good and bad.
BELIEF = 0.02


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where these hold of the measures, otherwise abstains."""

    name: str
    kind: str  # of the bad documents that it is made for
    bad: Callable[[Callable[[str], Column]], Column]
    good: Callable[[Callable[[str], Column]], Column]

    def vote(self, m: Callable[[str], Column]) -> Column:
        bad = F.when(self.bad(m), BAD).when(self.good(m), GOOD)
        return bad.otherwise(ABSTAIN)


RULES = (
    Rule("length", "fragment", lambda m: m("n_words") < 20, lambda m: m("n_words") >= 50),
    Rule(
        "repeated passages",
        "repetition",
        lambda m: share(m("n_repeat_words"), m("n_words")) > 0.3,
        lambda m: share(m("n_repeat_words"), m("n_words")) < 0.1,
    ),
    Rule(
        "repeated lines",
        "repetition",
        lambda m: share(m("n_dup_lines"), m("n_lines")) > 0.3,
        lambda m: (m("n_dup_lines") == 0) & (m("n_lines") >= 3),
    ),
    Rule(
        "symbols",
        "symbols",
        lambda m: share(m("n_symbols"), m("n_words")) > 0.2,
        lambda m: share(m("n_symbols"), m("n_words")) < 0.02,
    ),
    Rule(
        "symbol density",
        "symbols",
        lambda m: share(m("n_symbols"), m("word_chars")) > 0.05,
        lambda m: share(m("n_symbols"), m("word_chars")) < 0.005,
    ),
    Rule(
        "line ends",
        "symbols",
        lambda m: share(m("n_ended"), m("n_lines")) < 0.3,
        lambda m: share(m("n_ended"), m("n_lines")) > 0.6,
    ),
    Rule(
        "word length",
        "fragment",
        lambda m: (share(m("word_chars"), m("n_words")) < 2.5)
        | (share(m("word_chars"), m("n_words")) > 14),
        lambda m: share(m("word_chars"), m("n_words")).between(3.5, 9),
    ),
    Rule(
        "vocabulary",
        "repetition",
        lambda m: share(m("n_distinct"), m("n_words")) < 0.15,
        lambda m: (share(m("n_distinct"), m("n_words")) > 0.4) & (m("n_words") >= 20),
    ),
    Rule(
        "top word",
        "repetition",
        lambda m: (share(m("n_top"), m("n_words")) > 0.2) & (m("n_words") >= 20),
        lambda m: (share(m("n_top"), m("n_words")) < 0.1) & (m("n_words") >= 20),
    ),
    Rule(
        "capitals",
        "shouting",
        lambda m: share(m("n_upper"), m("n_upper") + m("n_lower")) > 0.4,
        lambda m: share(m("n_upper"), m("n_upper") + m("n_lower")) < 0.1,
    ),
    Rule(
        "shouting",
        "shouting",
        lambda m: share(m("n_shouted"), m("n_words")) > 0.1,
        lambda m: F.lit(False),
    ),
)


@dataclass(frozen=True)
class Estimate:
    """How frequent each class is and how often its members get each vote of a rule.

    Class 0 are the good documents, the others the kinds of bad ones.
    """

    prior: np.ndarray  # class
    votes: np.ndarray  # rule, class, vote

    def accuracies(self) -> list[float]:
        """Of each rule, what part of the votes that it casts is right."""
        each = self.votes * self.prior[None, :, None]
        right = each[:, 0, GOOD] + each[:, 1:, BAD].sum(1)
        return (right / each[:, :, [BAD, GOOD]].sum((1, 2))).tolist()

    def good(self, one_hot: np.ndarray) -> np.ndarray:
        """The probability of class 0 for (pattern, rule, vote) patterns."""
        return self.classes(one_hot)[:, 0]

    def classes(self, one_hot: np.ndarray) -> np.ndarray:
        logs = np.log(self.prior) + np.einsum("prv,rcv->pc", one_hot, np.log(self.votes))
        weights = np.exp(logs - logs.max(1, keepdims=True))
        return weights / weights.sum(1, keepdims=True)


def expectation_maximisation(
    patterns: np.ndarray,
    counts: np.ndarray,
    kinds: list[str],
    belief: float = BELIEF,
    rounds: int = 500,
) -> Estimate:
    """Estimate from vote patterns (pattern, rule) and how many documents have each.

    Begins with rules that are mostly right about good documents and about the kind
    in ``kinds`` that they are made for, and keeps ``belief`` times the number of
    documents as if they had been seen to vote so: this tells the classes apart, and
    leaves no probability at zero.
    """
    names = list(dict.fromkeys(kinds))
    usual = np.full((len(kinds), 1 + len(names), 3), [0.15, 0.5, 0.35])
    usual[:, 0] = [0.05, 0.5, 0.45]
    for rule, kind in enumerate(kinds):
        usual[rule, 1 + names.index(kind)] = [0.6, 0.35, 0.05]
    share = np.array([0.5] + [0.5 / len(names)] * len(names))
    found, total = Estimate(share, usual), float(counts.sum())
    one_hot = np.eye(3)[patterns]
    for _ in range(rounds):
        weights = found.classes(one_hot) * counts[:, None]
        cast = np.einsum("pc,prv->rcv", weights, one_hot) + belief * total * usual
        prior = (weights.sum(0) + belief * total * share) / (total * (1 + belief))
        last, found = found, Estimate(prior, cast / cast.sum(2, keepdims=True))
        if abs(found.prior - last.prior).max() < 1e-9:
            break
    return found


def _votes(rules: tuple[Rule, ...], struct: str) -> list[Column]:
    return [rule.vote(lambda name: F.col(f"{struct}.{name}")) for rule in rules]


def estimate(measures: DataFrame, struct: str, rules: tuple[Rule, ...] = RULES) -> Estimate | None:
    """Fit on all rows; what is collected are the counts of at most 3 ** rules patterns."""
    code = sum((v * 3**i for i, v in enumerate(_votes(rules, struct))), F.lit(0))
    rows = measures.groupBy(code.cast("long").alias("code")).count().orderBy("code").collect()
    if not rows:
        return None
    codes = np.array([r["code"] for r in rows])
    patterns = codes[:, None] // 3 ** np.arange(len(rules)) % 3
    counts = np.array([r["count"] for r in rows], float)
    return expectation_maximisation(patterns, counts, [rule.kind for rule in rules])


def posterior(fitted: Estimate | None, struct: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """The probability that a document is good, from its measures."""
    if fitted is None:
        return F.lit(1.0)
    votes, good = _votes(rules, struct), F.lit(1.0)
    against = np.log(fitted.votes) - np.log(fitted.votes[:, :1])
    for c in range(1, len(fitted.prior)):
        odds = F.lit(float(np.log(fitted.prior[c] / fitted.prior[0])))
        for vote, step in zip(votes, against[:, c].tolist()):
            odds = odds + F.element_at(F.array(*map(F.lit, step)), vote + 1)
        good = good + F.exp(odds)
    return 1 / good


def base_failed(struct: str) -> Column:
    """Too few words, or too many of them in repeated passages."""
    n, repeated = F.col(f"{struct}.n_words"), F.col(f"{struct}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """doc_id, all measures, base_failed, quality and kept of every ``docs(doc_id, text)``.

    Null and empty texts have no words and fail. Null and repeated ids are kept, one
    row each. The measures are written once to the shared folder; without any row
    there is nothing to estimate, and the result is empty.
    """
    measures = materialize(docs.select(F.col("doc_id").cast("long"), measured("text").alias("m")))
    quality = posterior(estimate(measures, "m", rules), "m", rules)
    return measures.select(
        "doc_id",
        "m.*",
        base_failed("m").alias("base_failed"),
        quality.alias("quality"),
        (~base_failed("m") & (quality >= threshold)).alias("kept"),
    )


def without_bad(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, whatever these are called.

    Texts are measured twice, to estimate and to decide, and never shuffled.
    """
    rows = docs.select(F.struct("*").alias("row"), measured("text").alias("m"))
    fitted = estimate(rows.select("m"), "m", rules)
    verdict = ~base_failed("m") & (posterior(fitted, "m", rules) >= threshold)
    return rows.filter(verdict).select("row.*")
