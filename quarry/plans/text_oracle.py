"""DuckDB SQL equivalents of the text queries (same output column names)."""

from __future__ import annotations

# Lines of corpus A (documents) and B (conversation turns), as a line reader sees them.
LINES = r"""
lines_a AS (
  SELECT doc_id, unnest(CASE WHEN text = '' THEN []::VARCHAR[]
    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END) AS value
  FROM documents),
lines_b AS (
  SELECT conv_id * 1000 + turn AS doc_id, unnest(CASE WHEN text = '' THEN []::VARCHAR[]
    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END) AS value
  FROM conversations)
"""

WS = r"'[ \t\n\r\f]+'"


def _ws_tokens(src: str) -> str:
    return (f"(SELECT doc_id, word FROM (SELECT doc_id, unnest(regexp_split_to_array(value, {WS})) AS word "
            f"FROM {src}) WHERE word <> '')")


def _space_tokens(src: str) -> str:
    return (f"(SELECT doc_id, lower(unnest(CASE WHEN value = '' THEN [''] "
            f"WHEN rtrim(value, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim(value, ' '), ' ') END)) AS word FROM {src})")


STOP_FOLD = "(SELECT lower(w) AS w FROM (VALUES ('The'), ('of'), ('and'), ('to'), ('in')) s(w))"
STOP_EXACT = "(SELECT w FROM (VALUES ('The'), ('of'), ('and'), ('to'), ('in')) s(w))"


def _counts_cased(src: str) -> str:
    return (f"(SELECT word, CAST(count(*) AS BIGINT) AS n FROM {_ws_tokens(src)} t "
            f"WHERE lower(word) NOT IN {STOP_FOLD} GROUP BY word)")


def _counts_lower(src: str) -> str:
    return (f"(SELECT word, CAST(count(*) AS BIGINT) AS n FROM {_space_tokens(src)} t "
            f"WHERE word NOT IN {STOP_EXACT} GROUP BY word)")


def _common(ca: str, cb: str) -> str:
    return f"(SELECT a.word, least(a.n, b.n) AS n FROM {ca} a JOIN {cb} b ON a.word = b.word)"


SQL = {
    "tokens_whitespace": f"WITH {LINES} SELECT doc_id, word, CAST(count(*) AS BIGINT) AS n "
                         f"FROM {_ws_tokens('lines_a')} t GROUP BY doc_id, word",
    "tokens_space": f"WITH {LINES} SELECT doc_id, word, CAST(count(*) AS BIGINT) AS n "
                    f"FROM {_space_tokens('lines_a')} t GROUP BY doc_id, word",
    "stopwords_fold": f"WITH {LINES} SELECT * FROM {_counts_cased('lines_b')} c",
    "stopwords_exact": f"WITH {LINES} SELECT * FROM {_counts_lower('lines_b')} c",
    "word_count_a": f"WITH {LINES} SELECT word, CAST(count(*) AS BIGINT) AS n "
                    f"FROM {_ws_tokens('lines_a')} t GROUP BY word",
    "common_words_cased": f"WITH {LINES} SELECT n, word FROM "
                          f"{_common(_counts_cased('lines_a'), _counts_cased('lines_b'))} c "
                          f"ORDER BY n DESC, word ASC LIMIT 15",
    "common_words_lower": f"WITH {LINES} SELECT word, n FROM "
                          f"{_common(_counts_lower('lines_a'), _counts_lower('lines_b'))} c "
                          f"ORDER BY n DESC, word ASC LIMIT 15",
    "common_words_union": f"WITH {LINES} SELECT word, n FROM "
                          f"{_common(_counts_cased('lines_a'), _counts_cased('lines_b'))} c",
    "kv_roundtrip": f"WITH {LINES} SELECT word AS key, CAST(count(*) AS VARCHAR) AS value "
                    f"FROM {_ws_tokens('lines_a')} t GROUP BY word",
    "tuple_roundtrip": f"WITH {LINES} SELECT '(' || word || ',' || CAST(n AS VARCHAR) || ')' AS value FROM "
                       f"(SELECT word, n FROM {_common(_counts_lower('lines_a'), _counts_lower('lines_b'))} c "
                       f"ORDER BY n DESC, word ASC LIMIT 15) t",
    "dir_tagged_input": f"WITH {LINES} SELECT 'corpus_a' AS tag, CAST(count(*) AS BIGINT) AS n FROM lines_a "
                        f"UNION ALL SELECT 'corpus_b', CAST(count(*) AS BIGINT) FROM lines_b",
}
