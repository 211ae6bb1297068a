import importlib.util
import logging
from pathlib import Path

from ledgerline.logs import get_logger
from ledgerline.plans.pipeline import STEPS


def test_one_task_for_each_step():
    spec = importlib.util.spec_from_file_location("portfolio", Path(__file__).parent.parent / "dags" / "portfolio.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert list(module.TASKS) == list(STEPS)
    assert module.TASKS["diagnose"]["retries"] == 0 and "--fail-on critical" in module.TASKS["diagnose"]["bash_command"]
    assert module.TASKS["ingest"]["retries"] == 2


def test_one_handler():
    get_logger()
    get_logger("ledgerline.x")
    assert len(logging.getLogger("ledgerline").handlers) == 1
