"""Log lines as JSON or text, with the fields that callers attach."""

from __future__ import annotations

import json
import logging
import sys
from datetime import UTC, datetime

_PLAIN = set(logging.makeLogRecord({}).__dict__) | {"message", "asctime", "taskName"}


class JsonFormatter(logging.Formatter):
    """One JSON object a line: time, level, logger, message, what `extra` gave, and an exception."""

    def format(self, record: logging.LogRecord) -> str:
        line = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        line |= {k: v for k, v in vars(record).items() if k not in _PLAIN}
        if record.exc_info:
            line["exception"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str, ensure_ascii=False)


def configure(level: str = "INFO", style: str = "json") -> None:
    """Sends all logs to stdout, as "json" or as text."""
    handler = logging.StreamHandler(sys.stdout)
    handler.setFormatter(JsonFormatter() if style == "json" else logging.Formatter("%(asctime)s %(levelname)s [%(name)s] %(message)s"))
    root = logging.getLogger()
    root.handlers[:] = [handler]
    root.setLevel(level.upper())
    logging.getLogger("py4j").setLevel(logging.WARNING)
