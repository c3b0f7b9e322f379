"""Why rows match, clause by clause, and how strongly texts match words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field
from logframe.functions.predicates import Condition, all_of, condition
from logframe.functions.text import has_any_word, mentions_any, occurrences, query_words, word_count

# The published BM25 parameters.
K1 = 1.2
B = 0.75


def match_explain(
    df: DataFrame, key: str, clauses: dict[str, Condition], ids: list | None = None
) -> DataFrame:
    """Each row's key, whether each named clause holds, and whether all do (``matched``).

    A clause that is NULL for lack of a value does not hold. ``ids`` narrows
    the table to some keys.
    """
    if not clauses:
        raise ValueError("no clauses given")
    if {key, "matched"} & set(clauses):
        raise ValueError(f"a clause must not be named {key!r} or 'matched'")
    rows = df if ids is None else df.filter(field(df, key).isin(list(ids)))
    holds = {name: F.coalesce(condition(c), F.lit(False)) for name, c in clauses.items()}
    return rows.select(
        field(df, key).alias(key),
        *[c.alias(name) for name, c in holds.items()],
        all_of(*holds.values()).alias("matched"),
    )


def text_score(df: DataFrame, text_field: str, words, key: str) -> DataFrame:
    """BM25 score of each asked word in each text: ``(key, word, tf, df, score)``.

    Works row by row: one pass sums up the one-row corpus figures (texts, mean
    length, texts per word), which a scalar subquery puts into the pass that
    scores. The words of the texts are never shuffled, and the second pass
    looks closely only at texts that contain an asked word somewhere.
    """
    asked = list(dict.fromkeys(query_words(words)))
    text = field(df, text_field)
    # Texts without any word take no part in the figures.
    length = F.when(F.col("_length") > 0, F.col("_length"))
    corpus = (
        df.select(text.alias("_text"), word_count(text).alias("_length"))
        .agg(
            F.struct(
                F.count(length).alias("texts"),
                F.avg(length).alias("mean_length"),
                F.array(*[F.count_if(has_any_word(F.col("_text"), [w])) for w in asked]).alias(
                    "df"
                ),
            )
        )
        .scalar()
    )
    hits = F.array(
        *[
            F.struct(
                F.lit(w).alias("word"),
                F.col("_tf")[n].cast("bigint").alias("tf"),
                corpus["df"][n].alias("df"),
            )
            for n, w in enumerate(asked)
        ]
    )
    candidates = df.filter(mentions_any(text, asked)).select(
        field(df, key).alias(key),
        word_count(text).alias("_length"),
        F.array(*[occurrences(text, w) for w in asked]).alias("_tf"),
    )
    scored = candidates.select(key, "_length", F.inline(hits)).filter("tf > 0")
    return scored.select(key, "word", "tf", "df", _bm25(corpus).alias("score"))


def _bm25(corpus: Column) -> Column:
    tf, df = F.col("tf").cast("double"), F.col("df").cast("double")
    rarity = F.log(1.0 + (corpus["texts"] - df + 0.5) / (df + 0.5))
    length = (1.0 - B) + B * F.col("_length") / corpus["mean_length"]
    return rarity * tf * (K1 + 1.0) / (tf + K1 * length)
