"""Settings, errors and structured logs of the command line."""

from __future__ import annotations

import json
import logging
import os
import sys
from dataclasses import dataclass


class BaseError(Exception):
    """Root of the package's errors."""


class IngestionError(BaseError):
    pass


class ParsingError(BaseError):
    pass


class ValidationError(BaseError):
    pass


@dataclass(frozen=True)
class Settings:
    """Where tables and input lie; from the environment where not given."""

    tables: str
    input_dir: str = "data/in"
    log_level: str = "INFO"

    @classmethod
    def from_env(cls, tables: str | None = None, input_dir: str | None = None) -> Settings:
        found = tables or os.environ.get("LEXGRAIN_TABLES")
        if not found:
            raise ValidationError("no folder for the tables: give --tables or set LEXGRAIN_TABLES")
        return cls(found, input_dir or os.environ.get("INPUT_DIR", cls.input_dir), os.environ.get("LOG_LEVEL", cls.log_level))


class _Json(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"level": record.levelname.lower(), "event": record.getMessage(), "logger": record.name} | getattr(record, "fields", {}), default=str)


def logger(level: str = "INFO") -> logging.Logger:
    """A logger that writes one JSON object a line."""
    log = logging.getLogger("lexgrain")
    log.setLevel(level)
    if not log.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(_Json())
        log.addHandler(handler)
        log.propagate = False
    return log
