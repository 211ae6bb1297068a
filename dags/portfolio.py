"""For a scheduler: a task per step, a day's run at a time. Without Airflow, ``TASKS`` alone is defined."""

from __future__ import annotations

from datetime import datetime, timedelta

from ledgerline.plans.pipeline import RETRIES, STEPS

COMMAND = "spark-submit --py-files ledgerline.zip -m ledgerline.cli {step} --data-dir {{{{ var.value.get('portfolio_data', 'data') }}}}"
TASKS = {step: {"bash_command": COMMAND.format(step=step) + (" --fail-on critical" if step == "diagnose" else ""), "retries": RETRIES[step]} for step in STEPS}

try:
    from airflow import DAG
    from airflow.operators.bash import BashOperator
except ImportError:
    DAG = None

if DAG is not None:
    with DAG("portfolio", schedule="@daily", start_date=datetime(2024, 1, 1), catchup=False, max_active_runs=1, default_args={"retry_delay": timedelta(minutes=5)}) as dag:
        made = {step: BashOperator(task_id=step, **settings) for step, settings in TASKS.items()}
        for step, needs in STEPS.items():
            for need in needs:
                made[need] >> made[step]
