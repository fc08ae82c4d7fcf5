"""End-to-end common-words job (two variants of the reference).

``variant="cased"``: whitespace tokens with their case, stop words matched
case-folded, counts per corpus, common words with the smaller count, top n.
``variant="lower"``: single-space tokens of each line, lower-cased, stop words
matched verbatim, then the same join and top n.

One lazy plan: two scans, two partial+final aggregates, one join on the word
(both sides already partitioned by it) and a ``TakeOrderedAndProject``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from quarry.operators import text as T

VARIANTS = {
    "cased": dict(mode="whitespace", lower=False, match="fold"),
    "lower": dict(mode="space", lower=True, match="exact"),
}


def corpus_counts(lines: DataFrame, stopwords: DataFrame | Sequence[str], variant: str = "cased") -> DataFrame:
    """``(word, n)`` of one corpus after tokenizing and stop-word removal."""
    v = VARIANTS[variant]
    tokens = T.tokenize(lines, mode=v["mode"], lower=v["lower"])
    return T.word_count(T.remove_stopwords(tokens, stopwords, match=v["match"]))


def common_words_job(lines_a: DataFrame, lines_b: DataFrame, stopwords: DataFrame | Sequence[str],
                     variant: str = "cased", n: int | None = 15, strategy: str = "join") -> DataFrame:
    """``(word, n)``: the ``n`` most frequent common words (all of them if n is None)."""
    a = corpus_counts(lines_a, stopwords, variant)
    b = corpus_counts(lines_b, stopwords, variant)
    common = T.common_words(a, b, strategy=strategy)
    return common if n is None else T.top_words(common, n)
