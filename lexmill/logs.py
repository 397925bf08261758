"""Logs as lines of JSON with a context, and counts of what a plan has passed."""

from __future__ import annotations

import contextlib
import json
import logging
from collections.abc import Iterator
from contextvars import ContextVar
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_context: ContextVar[dict] = ContextVar("context", default={})
_PLAIN = frozenset(vars(logging.makeLogRecord({}))) | {"message", "asctime", "taskName"}


class JsonLines(logging.Formatter):
    """Time, level, logger and message, then the context and what a call gave as ``extra``; values that JSON has no form for are texts."""

    def format(self, record: logging.LogRecord) -> str:
        row = {"time": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        row |= _context.get() | {k: v for k, v in vars(record).items() if k not in _PLAIN}
        if record.exc_info:
            row["error"] = self.formatException(record.exc_info)
        return json.dumps(row, default=str, ensure_ascii=False)


@contextlib.contextmanager
def context(**fields) -> Iterator[None]:
    """Fields of every line that is logged inside; of nested contexts all hold, the inner one's values first."""
    token = _context.set(_context.get() | fields)
    try:
        yield
    finally:
        _context.reset(token)


def configure(name: str = "lexmill", level: int = logging.INFO, stream=None) -> logging.Logger:
    """The package's logger with one handler that writes JSON lines, to standard error or a stream."""
    logger = logging.getLogger(name)
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonLines())
    logger.handlers[:] = [handler]
    logger.setLevel(level)
    logger.propagate = False
    return logger


def counted(docs: DataFrame, name: str, file_col: str | None = None, text_col: str = "text") -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that has documents, characters and (about) the number of files once an action has run over them. No pass of its own."""
    sums = [F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.length(text_col).cast("long")), F.lit(0)).alias("characters")]
    if file_col:
        sums.append(F.approx_count_distinct(file_col).alias("files"))
    seen = Observation(name)
    return docs.observe(seen, *sums), seen
