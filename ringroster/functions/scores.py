"""Survey scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.text import nth_label, null_if

# Fixed values.
NO_OPINION_SCORE = "-1"
NO_OPINION_LABEL = "Não opinou"
LABEL_SEPARATOR = ":"


def _one_if(flag: ColumnLike) -> Column:
    return F.when(as_column(flag) == 1, 1).otherwise(0)


def shifted_score(score: ColumnLike, zero_based: ColumnLike) -> Column:
    """Score as text, plus one on a zero-based scale; NULL for no opinion."""
    given = null_if(score, NO_OPINION_SCORE).try_cast("int")
    return (given + _one_if(zero_based)).cast("string")


def score_label(
    score: ColumnLike,
    labels: ColumnLike,
    starts_at_zero: ColumnLike,
    question: ColumnLike | None = None,
) -> Column:
    """Label of a score in the `:`-delimited list of its question.

    With `question`, "no opinion" is said only where that question exists, and an empty
    list counts as no list. An index below one gives NULL.
    """
    score, labels = as_column(score), as_column(labels)
    index = score.try_cast("int") + _one_if(starts_at_zero)
    silent = score == NO_OPINION_SCORE
    if question is not None:
        silent = silent & null_if(question, "").isNotNull()
        labels = null_if(labels, "")
    return F.when(silent, NO_OPINION_LABEL).otherwise(
        nth_label(labels, index, LABEL_SEPARATOR)
    )
