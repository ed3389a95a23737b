"""Driver logs without personal data: what is logged is redacted by the patterns that redact columns."""

from __future__ import annotations

import hashlib
import json
import logging
import re
from datetime import UTC, datetime
from typing import Any

from factloom.functions.privacy import PATTERNS
from factloom.functions.text import SALT_LOG

# Python's classes are Unicode-aware without the flag that Java needs.
_PATTERNS = [(kind, re.compile(pattern.replace("(?U)", "", 1))) for kind, pattern in PATTERNS]
_OWN = set(logging.makeLogRecord({}).__dict__) | {"message", "asctime"}


def redacted(text: str, secrets: tuple[str, ...] = (), length: int = 12) -> str:
    """The text as ``privacy.redact`` gives it for a column."""
    named = [("SECRET", re.compile(re.escape(s))) for s in sorted({s for s in secrets if len(s) >= 8}, key=lambda s: (-len(s), s))]
    pieces = [(text, False)]
    for kind, pattern in (*named, *_PATTERNS):  # what is a token already is not read again
        out = []
        for piece, done in pieces:
            at = 0
            for m in () if done else pattern.finditer(piece):
                out += [(piece[at : m.start()], False), (f"<{kind}:{hashlib.sha256((SALT_LOG + m.group()).encode()).hexdigest()[:length]}>", True)]
                at = m.end()
            out.append((piece[at:], done))
        pieces = out
    return "".join(piece for piece, _ in pieces)


class Redacting(logging.Filter):
    """Redacts a record's message with its arguments, and every extra value, at any depth up to twelve."""

    def __init__(self, secrets: tuple[str, ...] = ()):
        super().__init__()
        self.secrets = secrets

    def _clean(self, value: Any, depth: int = 0) -> Any:
        if isinstance(value, str):
            return redacted(value, self.secrets)
        if depth < 12 and isinstance(value, dict):
            return {k: self._clean(v, depth + 1) for k, v in value.items()}
        if depth < 12 and isinstance(value, (list, tuple)):
            return [self._clean(v, depth + 1) for v in value]
        return value if value is None or isinstance(value, (bool, int, float)) else redacted(str(value), self.secrets)

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg, record.args = redacted(record.getMessage(), self.secrets), None
        for key in record.__dict__.keys() - _OWN:
            setattr(record, key, self._clean(getattr(record, key)))
        return True


class JsonLines(logging.Formatter):
    """One JSON object a line, extras included."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        out |= {k: v for k, v in record.__dict__.items() if k not in _OWN}
        if record.exc_info:
            out["exception"] = redacted(self.formatException(record.exc_info))
        return json.dumps(out, ensure_ascii=False, default=str)


def logger(name: str = "factloom", level: str = "INFO", stream=None, secrets: tuple[str, ...] = ()) -> logging.Logger:
    """The package's logger with one redacting handler; calling it again adds none."""
    log = logging.getLogger(name)
    log.setLevel(level)
    log.propagate = False
    if not any(isinstance(f, Redacting) for h in log.handlers for f in h.filters):
        handler = logging.StreamHandler(stream)
        handler.setFormatter(JsonLines())
        handler.addFilter(Redacting(secrets))
        log.addHandler(handler)
    return log
