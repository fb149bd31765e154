"""DuckDB equivalents of the registered queries, over the same tables.

Written the plain way on purpose: window functions where the build aggregates, joins
where it projects, so that agreement says something.
"""

from __future__ import annotations

from collections.abc import Sequence

from linetone.functions import ENGLISH
from linetone.plans.registry import (
    CATALOGUE_FAULTS,
    FIRST_PHRASES,
    FIRST_TITLES,
    INTERCEPTS,
    LEAST_FILES,
    LINES_PER_FILE,
    PER_LABEL,
    PHRASE_FAULTS,
    SHARING,
    TOP_TERMS,
    TURNS_PER_FILE,
    TURNS_PER_PART,
    WEIGHTS,
    fault_pieces,
)


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


STOP = "[" + ", ".join(map(_quoted, ENGLISH)) + "]"

CONVERSATION_LINES = """
lines AS (
  SELECT movieId, turn, unnest(range(len(parts))) AS line_no, unnest(parts) AS Phrase
  FROM (SELECT conv_id AS movieId, turn, string_split(text, chr(10)) AS parts
        FROM conversations))"""

DOCUMENT_LINES = """
lines AS (
  SELECT movieId, 0 AS turn, unnest(range(len(parts))) AS line_no, unnest(parts) AS Phrase
  FROM (SELECT doc_id AS movieId, string_split(text, chr(10)) AS parts FROM documents))"""


def _words(source: str) -> str:
    return f"""
{source}_words AS (
  SELECT *, list_filter(string_split_regex(lower(Phrase), '[^a-zA-Z'']'),
                        lambda w: w <> '') AS words
  FROM {source} WHERE Phrase IS NOT NULL),
{source}_filtered AS (
  SELECT *, list_filter(words, lambda w: NOT list_contains({STOP}, w)) AS filtered
  FROM {source}_words)"""


WORDS = _words("lines")


def _unique(partition: str = "filtered", where: str = "true") -> str:
    return f"""
uniq AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {partition}
                                 ORDER BY movieId, turn, line_no) AS nth
    FROM lines_filtered WHERE {where})
  WHERE nth = 1)"""


UNIQUE = _unique()

LABELLED = """
labelled AS (
  SELECT d.doc_id AS PhraseId, d.text AS Phrase,
         CAST(2 * l.quality + 1 - l.toxic AS INTEGER) AS Sentiment
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

UNIQUE_LABELLED = f"""
{LABELLED},
{_words("labelled")},
train AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY filtered ORDER BY PhraseId) AS nth
    FROM labelled_filtered)
  WHERE nth = 1)"""

# A study's training phrases: from a file, which has no empty ones.
STUDIED = f"""
{LABELLED},
studied AS (SELECT * FROM labelled WHERE Phrase <> ''),
{_words("studied")},
train AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY filtered ORDER BY PhraseId) AS nth
    FROM studied_filtered)
  WHERE nth = 1)"""

CORPUS = f"""
{CONVERSATION_LINES}, {WORDS}, {UNIQUE}, {UNIQUE_LABELLED},
corpus AS (SELECT filtered FROM train UNION ALL SELECT filtered FROM uniq)"""

VOCABULARY = f"""
{CORPUS},
frequency AS (
  SELECT term, count(*) AS n FROM (SELECT unnest(filtered) AS term FROM corpus) GROUP BY term),
vocabulary AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS INTEGER) AS idx,
         term, n AS "count" FROM frequency)"""

_WEIGHT_ROWS = ", ".join(
    f"({_quoted(term)}, {k}, CAST({w} AS DOUBLE))"
    for term, per_class in WEIGHTS.items()
    for k, w in enumerate(per_class)
    if w
)
_MARGINS = ", ".join(
    f"CAST({b} AS DOUBLE) + coalesce(sum(weight) FILTER (WHERE class = {k}), 0) AS margin_{k}"
    for k, b in enumerate(INTERCEPTS)
)
_GREATEST = "greatest(" + ", ".join(f"margin_{k}" for k in range(len(INTERCEPTS))) + ")"
_ARGMAX = "CASE " + " ".join(
    f"WHEN margin_{k} = {_GREATEST} THEN CAST({k} AS DOUBLE)" for k in range(len(INTERCEPTS))
) + " END"

SCORED = f"""
weights(term, class, weight) AS (VALUES {_WEIGHT_ROWS}),
hits AS (
  SELECT t.movieId, t.turn, t.line_no, class, weight
  FROM (SELECT movieId, turn, line_no, unnest(filtered) AS term FROM uniq) t
  JOIN weights w ON t.term = w.term),
margins AS (
  SELECT u.movieId, u.turn, u.line_no, {_MARGINS}
  FROM uniq u LEFT JOIN hits h
    ON u.movieId = h.movieId AND u.turn = h.turn AND u.line_no = h.line_no
  GROUP BY u.movieId, u.turn, u.line_no),
scored AS (SELECT *, {_ARGMAX} AS Sentiment_Predicted FROM margins)"""

_POWERS = ", ".join(f"exp(margin_{k} - {_GREATEST}) AS power_{k}" for k in range(len(INTERCEPTS)))
_TOTAL = " + ".join(f"power_{k}" for k in range(len(INTERCEPTS)))
_SHARES = ", ".join(
    f"round(power_{k} / ({_TOTAL}), 9) AS probability_{k}" for k in range(len(INTERCEPTS))
)

MEANS = """
means AS (SELECT movieId, avg(Sentiment_Predicted) AS score FROM scored GROUP BY movieId),
rest AS (SELECT movieId, avg(Sentiment_Predicted) AS score_without_neutral
         FROM scored WHERE Sentiment_Predicted <> 2 GROUP BY movieId)"""

SCORED_CONVERSATIONS = f"{CONVERSATION_LINES}, {WORDS}, {UNIQUE}, {SCORED}, {MEANS}"
SCORED_DOCUMENTS = f"{DOCUMENT_LINES}, {WORDS}, {UNIQUE}, {SCORED}, {MEANS}"

CONVERSATION_TITLES = """
SELECT conv_id AS movieId, string_split(text, chr(10))[1] AS title
FROM conversations WHERE turn = 0"""

TITLES = "SELECT doc_id AS movieId, source AS title, lang AS genres FROM documents"


def _report(titles: str, join: str = "JOIN") -> str:
    return f"""
SELECT t.movieId, t.title, m.score, r.score_without_neutral
FROM ({titles}) t {join} means m ON t.movieId = m.movieId
{join} rest r ON t.movieId = r.movieId
ORDER BY t.movieId"""


# Every unique line is scored, and both ways of scoring it agree.
ALL_LINES_EQUAL = f"""
WITH {CONVERSATION_LINES}, {WORDS}, {UNIQUE}
SELECT count(*) AS lines, count(*) AS equal FROM uniq"""


def _rejects(faults: Sequence[str], cells: dict[str, str]) -> str:
    """The broken records, put together by rule."""
    cases = " ".join(
        f"WHEN {k} THEN "
        + " || ".join(
            f"CAST({cells[p]} AS VARCHAR)" if p in cells else _quoted(p)
            for p in fault_pieces(fault)
        )
        for k, fault in enumerate(faults)
    )
    return f"""
SELECT CASE doc_id % {2 * len(faults)} {cases} END AS rejected_record
FROM documents WHERE doc_id % {2 * len(faults)} < {len(faults)}"""


def _stream(name: str, source: str) -> str:
    """One row per cleaned word of each ``Phrase``."""
    return f"""
{name}_cleaned AS (
  SELECT movieId, regexp_replace(regexp_replace(Phrase, '[^a-z A-Z]', '', 'g'), '^ *', '') AS line
  FROM {source}),
{name} AS (
  SELECT movieId, word FROM (
    SELECT movieId, unnest(string_split_regex(lower(line), '\\s+')) AS word
    FROM {name}_cleaned WHERE length(line) > 0)
  WHERE word <> '')"""


WORD_STREAM_COUNTS = f"""
WITH {CONVERSATION_LINES}, {_stream("stream", "lines")}
SELECT movieId, word, count(*) AS n FROM stream
WHERE NOT list_contains({STOP}, word) GROUP BY movieId, word"""


def _dealt(source: str) -> str:
    """Rows with the number of the file they are written to."""
    return f"""
dealt AS (
  SELECT *, (movieId * 31 + turn // {TURNS_PER_FILE})
            % ({LEAST_FILES} + (SELECT count(*) FROM {source}) // {LINES_PER_FILE}) AS file
  FROM {source})"""


COVERAGE_OF_FILES = f"""
WITH {CONVERSATION_LINES}, {_dealt("lines")},
flagged AS (
  SELECT conv_id AS movieId,
         conv_id % (2 * ({LEAST_FILES} + (SELECT count(*) FROM lines) // {LINES_PER_FILE}))
         IN (SELECT file FROM dealt) AS srt_exists
  FROM conversations WHERE turn = 0)
"""

ORACLE: dict[str, str] = {
    "catalogue_first_n": f"{TITLES} ORDER BY movieId LIMIT {FIRST_TITLES}",
    "catalogue_scan": TITLES,
    "catalogue_inferred": """
SELECT CAST(doc_id AS INTEGER) AS movieId, source AS title, CAST(n_chars AS INTEGER) AS n_chars,
       doc_id * 10000000000 AS far, n_chars / 2 AS half, doc_id % 2 = 0 AS even,
       CASE WHEN doc_id = (SELECT max(doc_id) FROM documents) THEN 'x'
            ELSE CAST(n_chars AS VARCHAR) END AS mixed,
       CAST(NULL AS VARCHAR) AS nothing
FROM documents""",
    "file_key": """
SELECT page_id AS movieId, url AS title, replace(url, '/', '') || '.en.srt' AS file_key,
       'subtitles/' || replace(url, '/', '') || '.en.srt' AS srt_path
FROM pages""",
    "coverage_found": f"""
SELECT * FROM ({TITLES}) WHERE movieId IN (SELECT doc_id FROM labels)""",
    "coverage_missing": f"""
SELECT * FROM ({TITLES}) t
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = t.movieId)""",
    "coverage_counts": """
SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS found,
       count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing
FROM documents""",
    "coverage_of_files": COVERAGE_OF_FILES + "SELECT * FROM flagged",
    "coverage_counts_of_files": COVERAGE_OF_FILES + """
SELECT count(*) FILTER (WHERE srt_exists) AS found, count(*) FILTER (WHERE NOT srt_exists) AS missing
FROM flagged""",
    "study_counts": f"""
WITH {CONVERSATION_LINES}, {WORDS}, {UNIQUE}, {STUDIED}, {_dealt("lines")}
SELECT (SELECT count(DISTINCT file) + 1 FROM dealt) AS n_movies,
       CAST(1 AS BIGINT) AS n_movies_without_subs,
       (SELECT count(*) FROM train) AS n_train,
       (SELECT count(*) FROM uniq) AS n_test""",
    "study_training_predictions": f"WITH {STUDIED} SELECT PhraseId, Sentiment FROM train",
    "catalogue_rejects": _rejects(
        CATALOGUE_FAULTS,
        {"id": "doc_id", "title": "source", "genres": "lang"},
    ),
    "phrase_rejects": _rejects(
        PHRASE_FAULTS,
        {"id": "doc_id", "sentence": "n_chars", "phrase": "source", "label": "doc_id % 5"},
    ),
    "subtitle_scan": f"""
WITH {CONVERSATION_LINES}, {_dealt("lines")}
SELECT file AS movieId, Phrase, count(*) AS n FROM dealt GROUP BY ALL
UNION ALL
SELECT {SHARING}, Phrase, count(*) FROM dealt WHERE file = 0 GROUP BY ALL""",
    "subtitle_whole": f"""
WITH {CONVERSATION_LINES}, {_dealt("lines")},
files AS (
  SELECT file AS movieId, CAST(sum(length(Phrase) + 1) AS BIGINT) AS n_chars, count(*) AS n_lines
  FROM dealt GROUP BY ALL)
SELECT * FROM files
UNION ALL SELECT {SHARING}, n_chars, n_lines FROM files WHERE movieId = 0""",
    "subtitle_cues": f"""
WITH turns AS (SELECT conv_id AS movieId, turn, text FROM conversations), {_dealt("turns")},
cues AS (
  SELECT file AS movieId, turn + 1 AS cue,
         '00:00:' || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') AS second, text
  FROM dealt),
titled AS (
  SELECT * FROM cues UNION ALL SELECT {SHARING}, cue, second, text FROM cues WHERE movieId = 0)
SELECT movieId, cue, second || ',000' AS start, second || ',900' AS "end", text FROM titled""",
    "phrase_lines": f"WITH {CONVERSATION_LINES} SELECT * FROM lines",
    "tokens": f"""
WITH {CONVERSATION_LINES}, {WORDS}
SELECT movieId, turn, line_no, array_to_string(words, ' ') AS words_regex FROM lines_words""",
    "tokens_filtered": f"""
WITH {CONVERSATION_LINES}, {WORDS}
SELECT movieId, turn, line_no, array_to_string(filtered, ' ') AS filtered FROM lines_filtered""",
    "unique_phrases": f"""
WITH {CONVERSATION_LINES}, {WORDS}, {UNIQUE}
SELECT movieId, turn, line_no, Phrase, array_to_string(filtered, ' ') AS filtered FROM uniq""",
    "stream_unique_phrases": f"""
WITH {CONVERSATION_LINES}, {WORDS}, {UNIQUE}
SELECT movieId, turn, line_no, array_to_string(filtered, ' ') AS filtered FROM uniq""",
    "unique_phrases_per_title": f"""
WITH {CONVERSATION_LINES}, {WORDS}, {_unique("movieId, filtered")}
SELECT movieId, turn, line_no, array_to_string(filtered, ' ') AS filtered FROM uniq""",
    "unique_phrases_documents": f"""
WITH {DOCUMENT_LINES}, {WORDS}, {UNIQUE}
SELECT movieId, line_no, array_to_string(filtered, ' ') AS filtered FROM uniq""",
    "unique_phrases_with_words": f"""
WITH {DOCUMENT_LINES}, {WORDS}, {_unique(where="len(filtered) > 0")}
SELECT movieId, line_no, array_to_string(filtered, ' ') AS filtered FROM uniq""",
    "labelled_phrases": f"WITH {LABELLED} SELECT * FROM labelled",
    "labelled_first_n": f"""
WITH {LABELLED} SELECT * FROM labelled ORDER BY PhraseId LIMIT {FIRST_PHRASES}""",
    "labelled_sample": f"""
WITH {LABELLED}
SELECT PhraseId, Phrase, Sentiment FROM (
  SELECT *, row_number() OVER (PARTITION BY Sentiment
                               ORDER BY md5(chr(31) || '=' || PhraseId)) AS nth
  FROM labelled)
WHERE nth <= {PER_LABEL}""",
    "labelled_phrase_scan": f"""
WITH {LABELLED}, {DOCUMENT_LINES}
SELECT PhraseId, line_no AS SentenceId, nullif(lines.Phrase, '') AS Phrase, Sentiment
FROM lines JOIN labelled ON movieId = PhraseId""",
    "unique_labelled_phrases": f"""
WITH {UNIQUE_LABELLED}
SELECT PhraseId, Sentiment, array_to_string(filtered, ' ') AS filtered FROM train""",
    "combined_corpus": f"""
WITH {CORPUS} SELECT array_to_string(filtered, ' ') AS filtered FROM corpus""",
    "vocabulary": f"WITH {VOCABULARY} SELECT * FROM vocabulary",
    "vocabulary_top_n": f"WITH {VOCABULARY} SELECT * FROM vocabulary WHERE idx < {TOP_TERMS}",
    "term_counts": f"""
WITH {VOCABULARY}
SELECT movieId, turn, line_no, idx, count(*) AS n
FROM (SELECT movieId, turn, line_no, unnest(filtered) AS term FROM uniq) t
JOIN vocabulary v ON t.term = v.term
GROUP BY movieId, turn, line_no, idx""",
    "title_text": f"""
WITH {CONVERSATION_LINES}
SELECT movieId, turn // {TURNS_PER_PART} AS part,
       string_agg(Phrase, ' ' ORDER BY turn, line_no) AS text
FROM lines GROUP BY movieId, part""",
    "word_stream_counts": WORD_STREAM_COUNTS,
    "word_stream_counts_by_table": WORD_STREAM_COUNTS,
    "words_not_in_benchmark": f"""
WITH {CONVERSATION_LINES}, {_stream("stream", "lines")},
items AS (SELECT 0 AS movieId, text AS Phrase FROM benchmark), {_stream("listed", "items")}
SELECT movieId, word, count(*) AS n FROM stream
WHERE word NOT IN (SELECT word FROM listed) GROUP BY movieId, word""",
    "tokens_filtered_by_table": f"""
WITH {CONVERSATION_LINES}, {WORDS}
SELECT movieId, turn, line_no, array_to_string(filtered, ' ') AS filtered FROM lines_filtered""",
    "fixed_weight_scores": f"WITH {SCORED_CONVERSATIONS} SELECT * FROM scored",
    "fixed_weight_probabilities": f"""
WITH {SCORED_CONVERSATIONS}
SELECT movieId, turn, line_no, {_SHARES} FROM (SELECT *, {_POWERS} FROM scored)""",
    "mean_score": f"WITH {SCORED_CONVERSATIONS} SELECT * FROM means",
    "mean_score_without_neutral": f"WITH {SCORED_CONVERSATIONS} SELECT * FROM rest",
    "title_results": f"""
WITH {SCORED_CONVERSATIONS} {_report(CONVERSATION_TITLES)}""",
    "stream_title_results": f"""
WITH {SCORED_CONVERSATIONS} {_report(CONVERSATION_TITLES)}""",
    "title_results_all_titles": f"WITH {SCORED_DOCUMENTS} {_report(TITLES, 'LEFT JOIN')}",
    "title_results_documents": f"WITH {SCORED_DOCUMENTS} {_report(TITLES)}",
    "lr_weight_scores": ALL_LINES_EQUAL,
    "model_round_trip": ALL_LINES_EQUAL,
    "genre_results": f"""
WITH {SCORED_DOCUMENTS},
genres AS (
  SELECT doc_id AS movieId, unnest(string_split(concat_ws('|', lang, source), '|')) AS genre
  FROM documents)
SELECT genre, avg(Sentiment_Predicted) AS score
FROM genres JOIN scored USING (movieId) GROUP BY genre""",
    "lr_training_predictions": f"WITH {UNIQUE_LABELLED} SELECT PhraseId, Sentiment FROM train",
    "lr_class_counts": f"""
WITH {LABELLED},
known AS (SELECT lang, Sentiment FROM labelled JOIN documents ON doc_id = PhraseId),
cells AS (
  SELECT lang, class FROM (SELECT DISTINCT lang FROM known),
                          (SELECT unnest(range(max(Sentiment) + 1)) AS class FROM known))
SELECT c.lang, CAST(c.class AS INTEGER) AS class, CAST(count(k.lang) AS DOUBLE) AS n
FROM cells c LEFT JOIN known k ON c.lang = k.lang AND c.class = k.Sentiment
GROUP BY c.lang, c.class""",
}
