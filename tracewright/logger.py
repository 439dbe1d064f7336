"""Loggers of the engine: the console at LOG_LEVEL, and everything in a file if one is named."""

from __future__ import annotations

import logging
import os

_LINE = "%(asctime)s %(levelname)s %(name)s: %(message)s"


def get_logger(name: str, path: str | None = None) -> logging.Logger:
    """The logger of a name; asked for again it gets no second handler of a kind."""
    out = logging.getLogger(name)
    out.setLevel(logging.DEBUG)
    out.propagate = False
    if not any(type(h) is logging.StreamHandler for h in out.handlers):
        console = logging.StreamHandler()
        console.setLevel(os.environ.get("LOG_LEVEL", "INFO").upper())
        console.setFormatter(logging.Formatter(_LINE))
        out.addHandler(console)
    if path and not any(isinstance(h, logging.FileHandler) for h in out.handlers):
        file = logging.FileHandler(path)
        file.setLevel(logging.DEBUG)
        file.setFormatter(logging.Formatter(_LINE))
        out.addHandler(file)
    return out
