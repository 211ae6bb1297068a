"""Command line: one step, all steps in one session, or a look at how a contract changed."""

from __future__ import annotations

import argparse
import logging
import os
import posixpath

from pyspark.sql import DataFrame, SparkSession

from .logs import get_logger
from .operators import contracts, default_model, diagnose, master_record, migration, stability
from .plans.pipeline import execution_order
from .session import get_session
from .sources.csv_ingest import CsvToParquet
from .sources.tables import exists, read_table, table_path, write_text

logger = logging.getLogger(__name__)

FAIL_ON = {"never": 99, "warning": 1, "critical": 2}


class Runner:
    def __init__(self, spark: SparkSession, data: str, schemas: str | None = None, fail_on: str = "never", narrator=None) -> None:
        self.spark, self.schemas, self.fail_on, self.narrator = spark, schemas, fail_on, narrator
        self.raw, self.processed, self.models = (posixpath.join(data, x) for x in ("raw", "processed", "models"))

    def run(self, step: str) -> None:
        logger.info("step %s", step)
        getattr(self, f"_{step}")()

    def _ingest(self) -> None:
        CsvToParquet(self.spark, self.raw, self.processed).convert_all()

    def _drift(self) -> None:
        for r in contracts.run_drift_report(self.spark, self.processed, self.schemas).collect():
            logger.warning("[%s] %s %s.%s: %s -> %s", r.severity, r.kind, r.table, r.column, r.baseline, r.observed)

    def _validate(self) -> None:
        found = contracts.validate_tables(self.spark, self.processed, self.schemas)
        for table, errors in found.items():
            for e in errors:
                logger.error("%s: %s", table, e)
        if any(found.values()):
            raise SystemExit("Schema validation failed")

    def _aggregate(self) -> None:
        master_record.build_master_record(self.spark, self.processed)
        if exists(self.spark, table_path(self.processed, "application_test")):
            master_record.build_master_record(self.spark, self.processed, "application_test")

    def _train(self) -> None:
        record = read_table(self.spark, self.processed, master_record.record_name("application_train"))
        default_model.train_model(self.spark, record, self.processed, self.models)

    def _score(self) -> None:
        default_model.score_test(self.spark, self.processed, self.models)

    def _stability(self) -> None:
        stability.run_stability(self.spark, self.processed)

    def _vintage(self) -> None:
        migration.build_vintage_reports(self.spark, self.processed)

    def _diagnose(self) -> None:
        verdict = diagnose.DiagnosticAgent(self.spark, self.processed, self.models, narrator=self.narrator).run()
        text = verdict.to_markdown()
        write_text(self.spark, text, posixpath.join(self.processed, "diagnostic_brief.md"))
        print(text)
        if diagnose.LEVELS[verdict.status] >= FAIL_ON[self.fail_on]:
            raise SystemExit(f"Diagnostic status {verdict.status.upper()} (fail-on {self.fail_on})")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="ledgerline", description="Credit-portfolio analytics on Spark")
    out.add_argument("command", choices=[*execution_order(), "run-all", "schema-diff", "draft-schema"])
    out.add_argument("--data-dir", default=os.environ.get("RISK_DATA_DIR", "data"))
    out.add_argument("--schemas", help="folder of contracts (default: the built-in ones)")
    out.add_argument("--table", help="schema-diff, draft-schema: the table")
    out.add_argument("--key", nargs="*", default=[], help="draft-schema: primary key")
    out.add_argument("--bump", action="store_true", help="draft-schema: add a version to those there are; its key carries over")
    out.add_argument("--from-version", type=int)
    out.add_argument("--to-version", type=int)
    out.add_argument("--no-narrative", action="store_true", help="diagnose: without prose")
    out.add_argument("--fail-on", choices=list(FAIL_ON), default="never", help="diagnose: fail at this status or worse")
    out.add_argument("--skip-ingest", action="store_true", help="run-all: keep the Parquet tables there are")
    return out


def _print_findings(report: DataFrame) -> None:
    findings = report.collect()  # a row for each column that differs
    for f in findings:
        print(f"[{f.severity}] {f.kind} {f.column}: {f.baseline} -> {f.observed}")
    print(f"{len(findings)} difference(s)")


def draft_schema(spark: SparkSession, data: str, folder: str, table: str, key: list[str], bump: bool) -> None:
    """A contract from what a table holds now."""
    registry = contracts.Registry(folder)
    if bump and not key:
        key = registry.load(table).primary_key
    path = registry.write_version(contracts.infer_contract(table, read_table(spark, posixpath.join(data, "processed"), table), key), bump)
    print(path)
    if bump:
        _print_findings(contracts.compare_versions(spark, table, folder=folder))


def main(argv: list[str] | None = None, spark: SparkSession | None = None, narrator=None) -> None:
    cli = parser()
    args = cli.parse_args(argv)
    if args.command in ("schema-diff", "draft-schema") and not args.table:
        cli.error(f"{args.command} requires --table")
    spark = spark or get_session()
    if args.command == "schema-diff":
        try:
            _print_findings(contracts.compare_versions(spark, args.table, args.from_version, args.to_version, args.schemas))
        except (ValueError, FileNotFoundError) as why:
            cli.error(str(why))
        return
    if args.command == "draft-schema":
        draft_schema(spark, args.data_dir, args.schemas or posixpath.join(args.data_dir, "schemas"), args.table, args.key, args.bump)
        return
    steps = execution_order() if args.command == "run-all" else [args.command]
    runner = Runner(spark, args.data_dir, args.schemas, args.fail_on, None if args.no_narrative else narrator)
    for step in steps:
        if not (args.skip_ingest and step == "ingest"):
            runner.run(step)


if __name__ == "__main__":
    get_logger()
    main()
