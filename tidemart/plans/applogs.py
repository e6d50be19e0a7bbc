"""From raw log lines to repaired, split logs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.operators.logs import repair_new_visitors, split_logs
from tidemart.sources.feeds import app_log, visit_log


def split_messages(messages: DataFrame, tz: str | None = None) -> dict[str, DataFrame]:
    """Raw lines to err, start, display, action, page and dirty.

    The visitor flag is repaired first, in one pass that reads what it needs of the lines and one that reads all.
    """
    logs, dirty = app_log(messages)
    outputs = split_logs(repair_new_visitors(logs, "page", tz, visits=visit_log(messages)))
    outputs["dirty"] = dirty
    return outputs
