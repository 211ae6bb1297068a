"""One handler for the package, however often it is asked for."""

from __future__ import annotations

import logging


def get_logger(name: str = "ledgerline", level: int = logging.INFO) -> logging.Logger:
    root = logging.getLogger("ledgerline")
    if not root.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        root.addHandler(handler)
        root.setLevel(level)
    return logging.getLogger(name)
