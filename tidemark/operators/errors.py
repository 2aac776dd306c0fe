"""What kind of error a message tells of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import contains_any
from tidemark.presets import (
    ERROR_CLASSES,
    ERROR_MESSAGE_LIMIT,
    OTHER_ERROR_CLASS,
    OTHER_ERROR_TASK,
    TRANSIENT_WORDS,
)


def classify_errors(
    df: DataFrame, message: str, kind: str | None = None, task: str | None = None
) -> DataFrame:
    """Add ``is_transient``, ``error_class``, ``failed_task`` and ``short_message``.

    ``kind`` names the error type column, which counts as part of the message when
    looking for transient errors; ``task`` names the column of the failed task.
    """
    text = F.col(message)
    whole = F.concat(F.col(kind), F.lit(": "), text) if kind else text
    error_class, blamed = F.lit(OTHER_ERROR_CLASS), F.lit(OTHER_ERROR_TASK)
    for word, name, default_task in reversed(ERROR_CLASSES):
        found = contains_any(text, [word])
        error_class = F.when(found, F.lit(name)).otherwise(error_class)
        blamed = F.when(found, F.lit(default_task)).otherwise(blamed)
    if task:
        blamed = F.coalesce(F.when(F.col(task) != "", F.col(task)), blamed)
    return df.withColumns(
        {
            "is_transient": contains_any(whole, TRANSIENT_WORDS),
            "error_class": error_class,
            "failed_task": blamed,
            "short_message": F.substring(text, 1, ERROR_MESSAGE_LIMIT),
        }
    )
