"""The registered queries in DuckDB SQL, each written the long way round.

Scores are dense (every question against every document), ends are ranked in the
masked form, windows are range joins, the fallback is a second pass. So they check
the Spark plans, which do none of this, and do not repeat them.
"""

from __future__ import annotations

# The characters that cleaning keeps.
KEPT = "0-9a-zA-Zㄱ-ㅎㅏ-ㅣ가-힣"


def cleaned(text: str) -> str:
    """SQL for cleaned text."""
    replaced = f"replace(replace(replace(replace({text}, '\\n\\n', ' '), chr(10) || chr(10), ' '), '\\n', ' '), chr(10), ' ')"
    return f"trim(regexp_replace(lower(trim({replaced})), '[^{KEPT}]+', ' ', 'g'))"


def words(text: str) -> str:
    return rf"regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')"


def marked(text: str) -> str:
    blanks = rf"'▁' || regexp_replace({text}, '[ \t\r\n\f]+', '▁', 'g')"
    return rf"regexp_extract_all({blanks}, '▁?(?:[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}▁])')"


def detok(tokens: str) -> str:
    """SQL for the text of a token list without a leading <s>."""
    joined = f"array_to_string(list_filter({tokens}, lambda t: t <> '</s>'), '')"
    return f"""CASE WHEN contains(array_to_string({tokens}, ' '), '</s> </s>') THEN ''
        ELSE trim(replace(replace({joined}, ' ', ''), '▁', ' ')) END"""


def score(units: str) -> str:
    return f"floor(({units} + 500) / 1000) / 1000000"


CORPUS = """
corpus AS MATERIALIZED (
  SELECT doc_id AS doc_pos, coalesce(source, '') AS title, coalesce(text, '') AS text,
         doc_id < CAST(floor(0.8433 * (SELECT count(*) FROM documents)) AS BIGINT) AS is_candidate
  FROM documents)"""

DOC_TOKENS = f"""
doc_tokens AS MATERIALIZED (
  SELECT doc_pos, is_candidate,
         list_filter(string_split({cleaned("title || ' ' || text")}, ' '), lambda t: t <> '') AS tokens
  FROM corpus)"""

INDEX = """
postings AS MATERIALIZED (
  SELECT doc_pos, is_candidate, dl, term, count(*) AS tf
  FROM (SELECT doc_pos, is_candidate, len(tokens) AS dl, unnest(tokens) AS term FROM doc_tokens)
  GROUP BY ALL),
terms AS MATERIALIZED (SELECT term, count(*) AS df FROM postings GROUP BY term),
stats AS MATERIALIZED (
  SELECT count(*) AS n, CAST(sum(len(tokens)) AS BIGINT) AS total_tokens,
         CAST(sum(len(tokens)) AS DOUBLE) / count(*) AS avgdl
  FROM doc_tokens)"""


def asked(source: str = "benchmark", normalized: bool = False) -> str:
    rows = {
        "benchmark": "SELECT item_id AS question_id, text AS question FROM benchmark",
        "user": """SELECT conv_id || '-' || turn AS question_id, text AS question
                   FROM conversations WHERE role = 'user'""",
        "last_user": """SELECT conv_id AS question_id, text AS question FROM (
                          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place
                          FROM conversations WHERE role = 'user') WHERE place = 1""",
    }[source]
    text = cleaned("question") if normalized else "question"
    return f"""
questions AS MATERIALIZED (
  SELECT question_id, question, {words(text)} AS tokens FROM ({rows}))"""


NORM = "(dl * 0.75 / (SELECT avgdl FROM stats) + 0.25)"
RANKERS = {
    "plus": ("ln((n + 1) / df)", f"tf * 2.5 / ({NORM} * 1.5 + tf)", "CAST(1 AS DOUBLE)"),
    "l": (
        "ln((n + 1) / (df + 0.5))",
        f"2.5 * (tf / {NORM} + 0.5) / (1.5 + tf / {NORM} + 0.5) - 2.5 * 0.5 / 2.0",
        "CAST(2.5 * 0.5 / 2.0 AS DOUBLE)",
    ),
    "okapi": (
        """CASE WHEN ln(n - df + 0.5) - ln(df + 0.5) < 0
           THEN 0.25 * (SELECT avg(ln(n - df + 0.5) - ln(df + 0.5)) FROM terms, stats)
           ELSE ln(n - df + 0.5) - ln(df + 0.5) END""",
        f"tf * 2.5 / ({NORM} * 1.5 + tf)",
        "CAST(0 AS DOUBLE)",
    ),
}


def dense(ranker: str = "plus") -> str:
    """Every question's score of every document, in billionths."""
    idf, gain, floor = RANKERS[ranker]
    return f"""
weights AS MATERIALIZED (
  SELECT question_id, term, qtf, CAST({idf} AS DOUBLE) AS idf
  FROM (SELECT question_id, term, count(*) AS qtf
        FROM (SELECT question_id, unnest(tokens) AS term FROM questions) GROUP BY ALL)
  JOIN terms USING (term), stats),
base AS MATERIALIZED (
  SELECT question_id, CAST(coalesce(sum(floor(qtf * idf * {floor} * 1e9 + 0.5)), 0) AS BIGINT) AS base
  FROM questions LEFT JOIN weights USING (question_id) GROUP BY question_id),
matches AS MATERIALIZED (
  SELECT question_id, doc_pos,
         CAST(sum(CAST(floor(qtf * idf * (CAST({gain} AS DOUBLE)) * 1e9 + 0.5) AS BIGINT)) AS BIGINT) AS match
  FROM weights JOIN postings USING (term) GROUP BY ALL),
dense AS MATERIALIZED (
  SELECT b.question_id, c.doc_pos, c.is_candidate, base + coalesce(match, 0) AS units,
         match IS NOT NULL AS matched
  FROM base b CROSS JOIN corpus c
  LEFT JOIN matches m ON m.question_id = b.question_id AND m.doc_pos = c.doc_pos)"""


def top(n: int, scope: str = "is_candidate") -> str:
    return f"""
top AS MATERIALIZED (
  SELECT *, max(units) OVER (PARTITION BY question_id) AS best
  FROM (SELECT question_id, doc_pos, is_candidate, units, CAST(row_number() OVER (
          PARTITION BY question_id ORDER BY units DESC, doc_pos DESC) AS INT) AS rank
        FROM dense WHERE {scope})
  WHERE rank <= {n})"""


def query(*parts: str) -> str:
    *tables, final = parts
    return f"WITH {','.join(tables)}\n{final}" if tables else final


def retrieval(source: str = "benchmark", ranker: str = "plus") -> tuple[str, ...]:
    return (CORPUS, DOC_TOKENS, INDEX, asked(source), dense(ranker))


RETRIEVAL = retrieval()


def ranked(
    n: int = 10,
    scope: str = "is_candidate",
    source: str = "benchmark",
    normalized: bool = False,
    ranker: str = "plus",
    where: str = "true",
) -> str:
    return query(
        CORPUS,
        DOC_TOKENS,
        INDEX,
        asked(source, normalized),
        dense(ranker),
        top(n, scope),
        f"SELECT question_id, rank, doc_pos, {score('units')} AS score FROM top WHERE {where}",
    )


# Reading. ``contexts(question_id, ctx, doc_pos, rank, in_cut, text)`` comes first.

CUT_CONTEXTS = """
contexts AS MATERIALIZED (
  SELECT question_id, doc_pos AS ctx, doc_pos, rank, units > {cut} * best AS in_cut, text
  FROM top JOIN corpus USING (doc_pos))"""


def sequences(max_len: int | None = None) -> str:
    cut = "seq" if max_len is None else f"seq[1:{max_len}]"
    return f"""
packed AS MATERIALIZED (
  SELECT question_id, ctx, doc_pos, rank, in_cut, document_start, {cut} AS seq
  FROM (SELECT c.*, len({marked("question")}) + 3 AS document_start,
               list_concat(['<s>'], {marked("question")}, ['</s>', '</s>'], {marked("c.text")}, ['</s>']) AS seq
        FROM contexts c JOIN questions USING (question_id)))"""


LOGITS = """
reader_weights AS MATERIALIZED (
  SELECT question_id, term, CAST(floor(ln((n + 1) / df) * 1e4 + 0.5) AS BIGINT) AS weight
  FROM (SELECT DISTINCT question_id, lower(replace(unnest(tokens), '▁', '')) AS term FROM questions)
  JOIN terms USING (term), stats),
token_rows AS (
  SELECT question_id, ctx, doc_pos, document_start, unnest(seq) AS token,
         CAST(generate_subscripts(seq, 1) - 1 AS INT) AS pos
  FROM packed),
weighted AS (
  SELECT t.*, pos >= document_start AND token <> '</s>' AS in_document,
         CASE WHEN pos >= document_start AND token <> '</s>' THEN coalesce(weight, 0) ELSE 0 END AS w
  FROM token_rows t LEFT JOIN reader_weights r
    ON r.question_id = t.question_id AND r.term = lower(replace(token, '▁', ''))),
logits AS MATERIALIZED (
  SELECT question_id, ctx, doc_pos, pos, token,
         CASE WHEN in_document THEN CAST(coalesce(before, 0) - 2 * w - 10000 AS DOUBLE) / 1e4
              ELSE CAST(-20 AS DOUBLE) END AS start_logit,
         CASE WHEN in_document THEN CAST(coalesce(after, 0) - 2 * w - 10000 AS DOUBLE) / 1e4
              ELSE CAST(-20 AS DOUBLE) END AS end_logit
  FROM (SELECT *,
          sum(w) OVER (PARTITION BY question_id, ctx ORDER BY pos ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS before,
          sum(w) OVER (PARTITION BY question_id, ctx ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING) AS after
        FROM weighted))"""


# The model slot's stand-in: logits that follow token lengths.
MODEL_LOGITS = """
logits AS MATERIALIZED (
  SELECT question_id, ctx, doc_pos, pos, token,
         CAST(length(token) % 7 - 2 AS DOUBLE) AS start_logit,
         CAST(length(token) * 3 % 5 - 1 AS DOUBLE) AS end_logit
  FROM (SELECT question_id, ctx, doc_pos, unnest(seq) AS token,
               CAST(generate_subscripts(seq, 1) - 1 AS INT) AS pos
        FROM packed))"""


def span_tables(
    end_weight: float = 1.0, k: int = 10, end_source: str = "start", hook: str = "answer"
) -> str:
    return f"""
starts AS MATERIALIZED (
  SELECT * FROM (
    SELECT question_id, ctx, doc_pos, pos AS start, start_logit, CAST(row_number() OVER (
      PARTITION BY question_id, ctx ORDER BY start_logit DESC, pos) AS INT) AS start_rank
    FROM logits)
  WHERE start_rank <= {k}),
ends AS MATERIALIZED (
  SELECT * FROM (
    SELECT s.question_id, s.ctx, s.doc_pos, start, start_rank, s.start_logit, e.pos AS "end",
           e.{end_source}_logit AS at_end,
           CAST(row_number() OVER (
             PARTITION BY s.question_id, s.ctx, start
             ORDER BY CASE WHEN e.pos >= start THEN e.end_logit ELSE CAST(0 AS DOUBLE) END DESC, e.pos) AS INT) AS end_rank
    FROM starts s JOIN logits e ON e.question_id = s.question_id AND e.ctx = s.ctx)
  WHERE end_rank <= {k} AND "end" >= start),
all_spans AS MATERIALIZED (
  SELECT question_id, ctx, doc_pos, rank, in_cut, start, "end" + 1 AS end_excl, start_rank, end_rank,
         start_logit + CAST({end_weight} AS DOUBLE) * at_end AS score,
         {detok("toks")} AS answer
  FROM (SELECT e.*, p.rank, p.in_cut,
               CASE WHEN seq[start + 1] = '<s>' THEN seq[start + 2:"end" + 1]
                    ELSE seq[start + 1:"end" + 1] END AS toks
        FROM ends e JOIN packed p ON p.question_id = e.question_id AND p.ctx = e.ctx)),
spans AS MATERIALIZED (
  SELECT * FROM (SELECT * REPLACE ({hook} AS answer) FROM all_spans) WHERE length(answer) > 1)"""


def reading(
    end_weight: float = 1.0,
    cut: float = 0.95,
    k: int = 10,
    max_len: int | None = None,
    end_source: str = "start",
    hook: str = "answer",
    source: str = "benchmark",
    ranker: str = "plus",
    logits: str = LOGITS,
) -> tuple[str, ...]:
    return (
        *retrieval(source, ranker),
        top(10),
        CUT_CONTEXTS.format(cut=cut),
        sequences(max_len),
        logits,
        span_tables(end_weight, k, end_source, hook),
    )


# Selection


def rejected(inside: tuple[str, ...], anywhere: tuple[str, ...]) -> str:
    """SQL that is true for an answer with a marker."""
    tests = [f"contains(left(answer, length(answer) - 1), '{m}')" for m in inside]
    tests += [f"contains(answer, '{m}')" for m in anywhere]
    return "(" + " OR ".join(tests or ["false"]) + ")"


# The stand-in tagger: last morpheme and tag of an answer.
MORPH = """(CASE WHEN lower(left(right(answer, 2), 1)) IN ('a', 'e', 'i', 'o', 'u')
            THEN right(answer, 1) ELSE right(answer, 2) END)"""
TAG = "(CASE WHEN length(answer) % 2 = 0 THEN 'JKG' ELSE 'JX' END)"


def trimmed(particles: tuple[str, ...], genitive: bool = False) -> str:
    listed = ", ".join(f"'{p}'" for p in particles)
    tagged = f"AND {TAG} = 'JKG'" if genitive else ""
    return f"""CASE WHEN right(answer, 1) IN ({listed}) AND {MORPH} = right(answer, 1) {tagged}
               THEN left(answer, length(answer) - 1) ELSE answer END"""


# Markers and particles.
KOREAN = {
    "inside": ("다.",),
    "strict": ("며,", "데,", "뿐,", "라,", "unk"),
    "relaxed": ("며,", "데,", "뿐,", "unk"),
    "particles": ("의", "을", "를", "이"),
}
LATIN = {
    "inside": ("n.",),
    "strict": ("e,", "s,", "d,", "t,", "unk"),
    "relaxed": ("e,", "s,", "d,", "unk"),
    "particles": ("e", "n", "s", "t"),
}


def answers(rules: dict) -> str:
    """``answers(question_id, answer, stage)``: from the cut, then from all documents."""

    def first(markers: str, where: str) -> str:
        return f"""
  SELECT question_id, answer FROM (
    SELECT question_id, answer, row_number() OVER (
      PARTITION BY question_id ORDER BY score DESC, rank, start_rank, end_rank) AS place
    FROM (SELECT * REPLACE ({trimmed(rules["particles"])} AS answer) FROM spans
          WHERE {where} AND NOT {rejected(rules["inside"], rules[markers])})
    WHERE length(answer) > 1 AND length(answer) < 30)
  WHERE place = 1"""

    return f"""
from_cut AS MATERIALIZED ({first("strict", "in_cut")}),
from_all AS MATERIALIZED (
  SELECT * FROM ({first("relaxed", "true")})
  WHERE question_id NOT IN (SELECT question_id FROM from_cut)),
answers AS MATERIALIZED (
  SELECT q.question_id, coalesce(c.answer, a.answer) AS answer,
         CASE WHEN c.answer IS NOT NULL THEN 'cut' WHEN a.answer IS NOT NULL THEN 'fallback'
              ELSE 'none' END AS stage
  FROM questions q LEFT JOIN from_cut c USING (question_id) LEFT JOIN from_all a USING (question_id))"""


def answers_by_cut(rules: dict, final: str = "SELECT * FROM answers", **how) -> str:
    return query(*reading(**how), answers(rules), final)


RANKED30 = """
ranked30 AS MATERIALIZED (
  SELECT question_id, doc_pos, rank, CASE WHEN c.is_candidate THEN text ELSE '' END AS text
  FROM top JOIN corpus c USING (doc_pos))"""
NONBLANK = """
nonblank AS MATERIALIZED (
  SELECT question_id, doc_pos, text,
         CAST(row_number() OVER (PARTITION BY question_id ORDER BY rank) AS INT) AS rank
  FROM ranked30 WHERE text <> '')"""
WINDOWED = """
windowed AS MATERIALIZED (
  SELECT q.question_id, CAST(e AS INT) AS rank,
         coalesce(string_agg(text, ' ' || chr(10) ORDER BY d.rank), '') AS text
  FROM questions q CROSS JOIN generate_series(1, 7) g(e)
  LEFT JOIN nonblank d ON d.question_id = q.question_id AND d.rank BETWEEN e - 2 AND e
  GROUP BY q.question_id, e)"""
TOP30 = (*RETRIEVAL, top(30, "true"), RANKED30)


def answers_by_rank(
    anywhere: tuple[str, ...] = (),
    most: int | None = None,
    genitive: str | None = None,
    windows: bool = False,
    hook: str = "answer",
) -> str:
    """Contexts in order; windows count before single documents."""
    if windows:
        contexts = """
contexts AS MATERIALIZED (
  SELECT question_id, rank AS ctx, 0 AS doc_pos, rank, true AS in_cut, text FROM windowed
  UNION ALL
  SELECT question_id, 100 + rank AS ctx, doc_pos, 100 + rank AS rank, true AS in_cut, text FROM nonblank)"""
        tables = (*TOP30, NONBLANK, WINDOWED, contexts)
    else:
        contexts = """
contexts AS MATERIALIZED (
  SELECT question_id, rank AS ctx, doc_pos, 100 + rank AS rank, true AS in_cut, text FROM ranked30)"""
        tables = (*TOP30, contexts)
    trim = trimmed((genitive,), genitive=True) if genitive else "answer"
    limit = f"AND length(answer) <= {most}" if most else ""
    final = f"""
SELECT q.question_id, answer,
       CASE WHEN rank < 100 THEN 'window' WHEN rank >= 100 THEN 'single' ELSE 'none' END AS stage
FROM questions q LEFT JOIN (
  SELECT * FROM (
    SELECT question_id, rank, answer,
           row_number() OVER (PARTITION BY question_id ORDER BY rank) AS place
    FROM (SELECT question_id, rank, {trim} AS answer FROM spans WHERE NOT {rejected((), anywhere)})
    WHERE length(answer) > 1 {limit})
  WHERE place = 1) USING (question_id)"""
    return query(*tables, sequences(), LOGITS, span_tables(k=1, hook=hook), final)


GOLD = """
gold AS (SELECT conv_id || '-' || turn AS question_id, text AS answer
         FROM conversations WHERE role = 'assistant')"""

AUDITED = [("n.", "left(answer, length(answer) - 1)")] + [(m, "answer") for m in LATIN["strict"]]
PARTICLES = (".", *LATIN["particles"])
SPAN = "question_id, doc_pos, start, end_excl"
ROWS = f"{SPAN}, start_rank, end_rank, round(score, 6) AS score, answer"

FETCH = query(
    *RETRIEVAL, top(10), "SELECT question_id, rank, doc_pos, text FROM top JOIN corpus USING (doc_pos)"
)


def particle_hits(where: str = "true") -> str:
    return query(
        GOLD,
        " UNION ALL ".join(
            f"""SELECT question_id, answer, '{p}' AS particle, CAST({i} AS BIGINT) AS particle_order
                FROM gold WHERE right(answer, 1) = '{p}' AND {MORPH} = '{p}' AND {where}"""
            for i, p in enumerate(PARTICLES, 1)
        ),
    )


LAST_TURN = """
SELECT conv_id, text, turn FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place FROM conversations)
WHERE place = 1"""
WITHOUT_MARKS = "rtrim(answer, '.,')"

DISTRIBUTION = query(
    *RETRIEVAL,
    f"""
SELECT question_id, count(*) AS count, round(avg(units / 1e9), 4) AS mean,
       round(stddev_samp(units / 1e9), 4) AS std, {score("min(units)")} AS min,
       {score("floor(quantile_cont(CAST(units AS DOUBLE), 0.25) + 0.5)")} AS q25,
       {score("floor(quantile_cont(CAST(units AS DOUBLE), 0.5) + 0.5)")} AS q50,
       {score("floor(quantile_cont(CAST(units AS DOUBLE), 0.75) + 0.5)")} AS q75,
       {score("max(units)")} AS max,
       round(CAST(0.95 AS DOUBLE) * {score("max(units)")}, 4) AS cut_score
FROM dense GROUP BY question_id""",
)

BEHIND = "('a', 'e', 'i', 'o', 'u')"


def korean(sql: str) -> str:
    """The same over texts with Hangul in place of letters."""
    for table in ("documents", "benchmark", "conversations"):
        mapped = f"SELECT * REPLACE (translate(text, 'nesdthrialou', '다의을이며데라뿐가를는은') AS text) FROM {table}"
        sql = sql.replace(f"FROM {table}", f"FROM ({mapped})")
    return sql.replace(BEHIND, "('가', '의', '뿐', '는', '은')")


def by_letters(sql: str) -> str:
    """The same with characters as tokens."""
    letters = "list_filter(string_split({}, ''), lambda t: t NOT IN ('', ' '))"
    words_of_text = f"list_filter(string_split({cleaned("title || ' ' || text")}, ' '), lambda t: t <> '')"
    sql = sql.replace(words_of_text, letters.format(cleaned("title || ' ' || text")))
    return sql.replace(words("question"), letters.format("question"))


KOREAN_GOLD = GOLD.replace("text AS answer", "regexp_replace(text, '[.]$', '') AS answer")
KOREAN_AUDITED = [("다.", "left(answer, length(answer) - 1)")] + [
    (m, "answer") for m in ("며,", "데,", "뿐,", "라,", "고,")
]

ORACLE = {
    "normalize_text": query(
        CORPUS, f"SELECT doc_pos, {cleaned("title || ' ' || text")} AS normalized FROM corpus"
    ),
    "tokenize_corpus": query(
        CORPUS,
        DOC_TOKENS,
        """SELECT doc_pos, CAST(len(tokens) AS INT) AS n_tokens,
                  coalesce(array_to_string(tokens, ' '), '') AS tokens FROM doc_tokens""",
    ),
    "tokenize_question_raw": query(
        asked(),
        """SELECT question_id, CAST(len(tokens) AS INT) AS n_tokens,
                  coalesce(array_to_string(tokens, ' '), '') AS tokens FROM questions""",
    ),
    "tokenize_question_normalized": query(
        asked(normalized=True),
        """SELECT question_id, CAST(len(tokens) AS INT) AS n_tokens,
                  coalesce(array_to_string(tokens, ' '), '') AS tokens FROM questions""",
    ),
    "detokenize_text": query(
        CORPUS,
        r"""SELECT doc_pos,
                   trim(replace(regexp_replace(text, '[ \t\r\n\f▁]+', ' ', 'g'), '▁', ' ')) AS read_back
            FROM corpus""",
    ),
    "corpus_size": "SELECT count(*) AS n_documents FROM documents",
    "index_stats": query(CORPUS, DOC_TOKENS, INDEX, "SELECT * FROM stats"),
    "term_df_idf": query(
        CORPUS,
        DOC_TOKENS,
        INDEX,
        "SELECT term, df, round(ln((n + 1) / df), 6) AS idf FROM terms, stats",
    ),
    "postings_tf": query(
        CORPUS,
        DOC_TOKENS,
        INDEX,
        """SELECT doc_pos, is_candidate, CAST(dl AS INT) AS dl, term, CAST(tf AS INT) AS tf
           FROM postings""",
    ),
    "retrieve_top10": ranked(),
    "retrieve_top10_normalized": ranked(normalized=True),
    "retrieve_top10_conversations": ranked(source="user"),
    "retrieve_top10_reopened": ranked(),
    "load_json_map": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_pos, CAST(doc_id AS VARCHAR) AS doc_id,
       coalesce(source, '') AS title, coalesce(text, '') AS text FROM documents""",
    "load_json_lines": """
SELECT doc_id AS doc_pos, CAST(doc_id AS VARCHAR) AS doc_id, coalesce(source, '') AS title,
       coalesce(text, '') AS text FROM documents""",
    "load_arrow_split": "SELECT * FROM benchmark",
    "spans_model_slot": query(*reading(logits=MODEL_LOGITS), f"SELECT {ROWS} FROM spans"),
    "retrieve_top30": ranked(n=30, scope="true"),
    "retrieve_cut_095": ranked(where="units > CAST(0.95 AS DOUBLE) * best"),
    "retrieve_cut_090": ranked(where="units > CAST(0.9 AS DOUBLE) * best"),
    "retrieve_okapi": ranked(ranker="okapi"),
    "retrieve_okapi_letters": by_letters(ranked(ranker="okapi")),
    "retrieve_bounded": query(
        *RETRIEVAL,
        f"""SELECT question_id, rank, doc_pos, {score("match")} AS score
            FROM (SELECT question_id, doc_pos, match, CAST(row_number() OVER (
                    PARTITION BY question_id ORDER BY match DESC, doc_pos DESC) AS INT) AS rank
                  FROM matches)
            WHERE rank <= 10""",
    ),
    "retrieve_l": ranked(ranker="l"),
    "score_candidates": query(
        *RETRIEVAL,
        f"""SELECT question_id, doc_pos, {score("units")} AS score FROM dense
            WHERE matched AND is_candidate""",
    ),
    "question_base_score": query(
        *RETRIEVAL, f"SELECT question_id, {score('base')} AS score FROM base"
    ),
    "fetch_text": FETCH,
    "fetch_text_stored": FETCH,
    "score_distribution": DISTRIBUTION,
    "score_distribution_long": DISTRIBUTION.replace(
        "text AS question FROM benchmark", "repeat(text || ' ', 3000) AS question FROM benchmark"
    ),
    "score_top5": query(
        *RETRIEVAL,
        top(5, "true"),
        f"SELECT question_id, rank, {score('units')} AS score FROM top",
    ),
    "score_sorted": query(
        *RETRIEVAL,
        f"""SELECT question_id, {score("units")} AS score, count(*) AS n_docs
            FROM dense GROUP BY ALL""",
    ),
    "nonblank_contexts": query(
        *TOP30, NONBLANK, "SELECT question_id, rank, doc_pos, text FROM nonblank"
    ),
    "sliding_contexts": query(
        *TOP30, NONBLANK, WINDOWED, "SELECT question_id, rank, text FROM windowed"
    ),
    "pack_truncate": query(
        *RETRIEVAL,
        top(10),
        CUT_CONTEXTS.format(cut=0.95),
        sequences(512),
        """SELECT question_id, doc_pos, CAST(document_start AS INT) AS document_start,
                  CAST(len(seq) AS INT) AS n_tokens, array_to_string(seq, ' ') AS sequence
           FROM packed""",
    ),
    "reader_logits": query(
        *reading()[:-1],
        """SELECT question_id, doc_pos, CAST(pos AS INT) AS pos, token, start_logit, end_logit
           FROM logits""",
    ),
    "top_starts": query(
        *reading(), "SELECT question_id, doc_pos, start_rank, start, start_logit FROM starts"
    ),
    "top_ends": query(
        *reading(), 'SELECT question_id, doc_pos, start, end_rank, "end" FROM ends'
    ),
    "span_candidates_w100": query(*reading(1.0), f"SELECT {ROWS} FROM spans"),
    "span_candidates_w050": query(*reading(0.5), f"SELECT {ROWS} FROM spans"),
    "span_candidates_w010": query(*reading(0.1), f"SELECT {ROWS} FROM spans"),
    "span_candidates_end_source": query(
        *reading(1.0, end_source="end"), f"SELECT {ROWS} FROM spans"
    ),
    "best_span": query(*reading(k=1), f"SELECT {SPAN}, answer FROM all_spans"),
    "pool_order": query(
        *reading(),
        f"""SELECT {SPAN}, CAST(row_number() OVER (
              PARTITION BY question_id ORDER BY score DESC, rank, start_rank, end_rank) AS INT) AS place
            FROM spans""",
    ),
    "marker_filter": query(
        *reading(),
        f"""SELECT {SPAN}, NOT {rejected(LATIN["inside"], LATIN["strict"])} AS strict,
                   NOT {rejected(LATIN["inside"], LATIN["relaxed"])} AS relaxed FROM spans""",
    ),
    "early_filters": query(
        *reading(k=1),
        """SELECT question_id, doc_pos,
                  NOT (answer = '' OR length(answer) = 1 OR length(answer) >= 100) AS p0,
                  NOT (length(answer) <= 1 OR contains(answer, 'n.')) AS p1,
                  NOT (length(answer) <= 1 OR contains(answer, 'n.') OR contains(answer, 'unk')) AS p2
           FROM all_spans""",
    ),
    "particle_trim": query(
        *reading(), f"SELECT {SPAN}, {trimmed(LATIN['particles'])} AS trimmed FROM spans"
    ),
    "genitive_trim": query(
        *reading(), f"SELECT {SPAN}, {trimmed(('n',), genitive=True)} AS trimmed FROM spans"
    ),
    "conditional_trim": query(
        *reading(),
        f"""SELECT question_id, doc_pos, start, end_excl,
                   CASE WHEN genitive AND EXISTS (
                          SELECT 1 FROM spans o WHERE o.question_id = s.question_id
                          AND o.answer = left(s.answer, length(s.answer) - 1))
                        THEN left(s.answer, length(s.answer) - 1) ELSE s.answer END AS trimmed
            FROM (SELECT *, {MORPH} = 'n' AND {TAG} = 'JKG' AS genitive FROM spans) s""",
    ),
    "candidate_membership": query(
        *reading(),
        f"""SELECT question_id, answer
            FROM (SELECT DISTINCT question_id, unnest({words("question")}) AS answer FROM questions) w
            WHERE EXISTS (SELECT 1 FROM spans s
                          WHERE s.question_id = w.question_id AND s.answer = w.answer)""",
    ),
    "answers_p0": answers_by_rank(most=99),
    "answers_p1": answers_by_rank(("다.",), genitive="의"),
    "answers_p2": answers_by_rank(("다.", "unk"), genitive="의", windows=True),
    "answers_p2_latin": answers_by_rank(("n.", "unk"), genitive="n", windows=True),
    "answers_p3": answers_by_cut(KOREAN),
    "answers_p3_latin": answers_by_cut(LATIN),
    "answers_p3_read_again": answers_by_cut(LATIN),
    "answers_p3_model_length": answers_by_cut(KOREAN, max_len=512),
    "answers_p3_korean": korean(answers_by_cut(KOREAN)),
    "answers_p2_korean": korean(answers_by_rank(("다.", "unk"), genitive="의", windows=True)),
    "answers_p4": answers_by_cut(KOREAN, end_weight=0.5, cut=0.9),
    "answers_p5": answers_by_cut(KOREAN, end_weight=0.1, cut=0.9),
    "answers_p0_hook": answers_by_rank(most=99, hook=WITHOUT_MARKS),
    "answers_p3_hook": answers_by_cut(KOREAN, hook=WITHOUT_MARKS),
    "answers_p3_okapi": answers_by_cut(LATIN, ranker="okapi"),
    "answers_repeated_ids": answers_by_cut(LATIN, source="last_user"),
    "answer_map_repeated_ids": f"""
SELECT CAST(conv_id AS VARCHAR) AS question_id, text AS answer FROM ({LAST_TURN}) WHERE text IS NOT NULL""",
    "answer_report": answers_by_cut(
        KOREAN, "SELECT stage, count(*) AS n_questions FROM answers GROUP BY stage"
    ),
    "answer_map": answers_by_cut(
        KOREAN,
        """SELECT question_id, '"' || question_id || '":' || CAST(to_json(answer) AS VARCHAR) AS entry
           FROM answers WHERE answer IS NOT NULL""",
    ),
    "answer_map_read_back": answers_by_cut(
        KOREAN,
        """SELECT CAST(question_id AS VARCHAR) AS question_id, answer FROM answers
           WHERE answer IS NOT NULL""",
        end_weight=0.5,
        cut=0.9,
    ),
    "last_answer_wins": f"SELECT conv_id AS question_id, text AS answer, turn FROM ({LAST_TURN})",
    "audit_markers": query(
        GOLD,
        " UNION ALL ".join(
            f"SELECT '{m}' AS marker, count(*) FILTER (WHERE contains({where}, '{m}')) AS n FROM gold"
            for m, where in AUDITED
        ),
    ),
    "audit_marker_hits": query(
        GOLD,
        " UNION ALL ".join(
            f"SELECT question_id, answer, '{m}' AS marker FROM gold WHERE contains({where}, '{m}')"
            for m, where in AUDITED
        ),
    ),
    "audit_genitive": query(
        GOLD, f"SELECT question_id, answer FROM gold WHERE {MORPH} = '.' AND {TAG} = 'JKG'"
    ),
    "audit_particles": particle_hits(),
    "audit_particles_lookup": particle_hits("length(answer) % 3 <> 0"),
    "audit_trim_trace": query(
        GOLD,
        f"""SELECT question_id, right(answer, 1) AS final, {MORPH} AS morph,
                   {trimmed(PARTICLES)} AS trimmed FROM gold""",
    ),
    "audit_markers_korean": korean(
        query(
            GOLD,
            " UNION ALL ".join(
                f"SELECT '{m}' AS marker, count(*) FILTER (WHERE contains({where}, '{m}')) AS n FROM gold"
                for m, where in KOREAN_AUDITED
            ),
        )
    ),
    "audit_particles_korean": korean(
        query(
            KOREAN_GOLD,
            " UNION ALL ".join(
                f"""SELECT question_id, answer, '{p}' AS particle, CAST({i} AS BIGINT) AS particle_order
                    FROM gold WHERE right(answer, 1) = '{p}' AND {MORPH} = '{p}'"""
                for i, p in enumerate(("을", "를", "이", "가", "는", "은"), 1)
            ),
        )
    ),
    "audit_genitive_korean": korean(
        query(
            KOREAN_GOLD,
            f"SELECT question_id, answer FROM gold WHERE right(answer, 1) = '의' AND {MORPH} = '의' AND {TAG} = 'JKG'",
        )
    ),
}
