"""The built-in contracts, from ``conf/contracts.yaml``."""

from __future__ import annotations

import functools
from pathlib import Path
from typing import Any

import yaml

FILE = Path(__file__).resolve().parent.parent / "conf" / "contracts.yaml"
#: Of the scoring population, which has no target, these columns hold no nulls.
SCORING, FULL_WHEN_SCORING = "application_test", ("AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "DAYS_LAST_PHONE_CHANGE")


@functools.cache
def _tables() -> dict[str, dict[str, Any]]:
    stated = yaml.safe_load(FILE.read_text())
    train = stated["application_train"]
    columns = {c: s | ({"nullable": False} if c in FULL_WHEN_SCORING else {}) for c, s in train["columns"].items() if c != "TARGET"}
    out = {}
    for table, spec in stated.items():
        out[table] = spec
        if table == "application_train":
            out[SCORING] = {"primary_key": train["primary_key"], "columns": columns}
    return out


TABLES = tuple(_tables())


def contract(table: str) -> dict[str, Any]:
    """In the layout of a contract file."""
    spec = _tables()[table]
    columns = {c: dict(s) for c, s in spec["columns"].items()}
    return {"table_name": table, "version": 1, "strict_schema": {"required_columns": [c for c, s in columns.items() if not s["nullable"]], "columns": columns, "primary_key": list(spec["primary_key"])}}
