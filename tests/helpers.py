"""Small corpora and plain Python forms of what the jobs compute."""

import math
import uuid

from daedap.functions.text import word_tokens
from daedap.operators.index import build_index, store_index
from daedap.session import shared_dir
from daedap.sources.corpus import with_scope
from daedap.sources.splits import as_questions


def corpus_of(spark, texts, scope=None):
    """A corpus without titles; all documents eligible, or the first ``scope``."""
    rows = [(i, str(i), "", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_pos long, doc_id string, title string, text string")
    return with_scope(df, len(texts) if scope is None else scope)


def index_of(spark, texts, scope=None):
    return build_index(corpus_of(spark, texts, scope), partitions=3)


def stored_index(corpus):
    """An index written to the shared folder; plans over it are short."""
    folder = f"{shared_dir(corpus.sparkSession)}/test-{uuid.uuid4().hex}"
    return store_index(build_index(corpus, partitions=2), folder)


def questions_of(spark, texts, tokenizer=word_tokens):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, question string")
    return as_questions(df, tokenizer=tokenizer)


def dense_scores(docs, question, k1=1.5, b=0.75, delta=1.0):
    """The score of every document, term by term, as the definition has it."""
    avgdl = sum(map(len, docs)) / len(docs)
    scores = []
    for doc in docs:
        score = 0.0
        for term in question:
            df = sum(term in d for d in docs)
            if df:
                tf = doc.count(term)
                norm = k1 * (1 - b + b * len(doc) / avgdl)
                score += math.log((len(docs) + 1) / df) * (delta + tf * (k1 + 1) / (norm + tf))
        scores.append(score)
    return scores


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
