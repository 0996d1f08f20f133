"""Join strategies read from the text of a plan."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

# Physical join operator -> label of the join-strategy vocabulary.
STRATEGY_LABELS = {
    "BroadcastHashJoin": "BROADCAST",
    "SortMergeJoin": "MERGE",
    "ShuffledHashJoin": "SHUFFLE_HASH",
    "BroadcastNestedLoopJoin": "BROADCAST_NL",
    "CartesianProduct": "SHUFFLE_REPLICATE_NL",
}


def plan_text(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def strategy_labels(df: DataFrame) -> list[str]:
    """Join strategies named in the plan of ``df``; final after an action on it."""
    plan = plan_text(df).split("== Initial Plan ==")[0]
    return sorted({label for operator, label in STRATEGY_LABELS.items() if operator in plan})
