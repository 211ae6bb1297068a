"""A verdict on the portfolio from the reports of the other operators.

Every report is turned into facts of one shape: topic, scope (a source, a table, an analysis), item, measure,
value, support (the cases behind it) and a note. A table of rules says which value of a measure is a breach,
how grave it is, and what it calls for; rules may hold for one scope only. Facts and rules meet in one join,
whatever the report. Only the breaches that a brief names, and counts, come to the driver.
"""

from __future__ import annotations

import functools
import json
import logging
import posixpath
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.delinquency import DELINQUENT
from ..sources.tables import exists, read_text
from .migration import latest_against_trailing
from .stability import MODERATE, SIGNIFICANT

logger = logging.getLogger(__name__)

LEVELS = {"ok": 0, "warning": 1, "critical": 2, "error": 2}
DEFAULT_THRESHOLDS = Path(__file__).resolve().parent.parent / "conf" / "thresholds.yaml"
FACTS = "topic string, scope string, item string, measure string, value double, support double, note string"


@dataclass(frozen=True)
class Rule:
    """A value beyond ``limit`` is a breach (``side`` 1: above, -1: below; ``at``: at the limit too), given ``support`` cases. scope None: any scope without a rule of its own."""

    measure: str
    level: str
    limit: float
    advice: str
    side: int = 1
    at: bool = False
    support: float = 0.0
    scope: str | None = None


#: Limits that hold unless a thresholds file sets others.
VINTAGE_MOB, VINTAGE_ACCOUNTS, VINTAGE_TRAILING = 12, 1000, 4
RULES = (
    Rule("psi", "critical", SIGNIFICANT, "refit", at=True),
    Rule("psi", "warning", MODERATE, "trace", at=True),
    Rule("roll_in_max", "warning", 0.05, "grant"),
    Rule("forward_max", "warning", 0.15, "collect"),
    Rule("balance_roll_in_max", "warning", 0.05, "grant"),
    Rule("balance_forward_max", "warning", 0.15, "collect"),
    Rule("vintage_ratio", "warning", 1.25, "lend", support=30),
    Rule("min_auc", "warning", 0.70, "separate", side=-1),
    Rule("min_ks", "warning", 0.30, "separate", side=-1),
    Rule("max_calibration_error", "warning", 0.10, "calibrate"),
    Rule("contract_breaking", "critical", 0.0, "mend"),
    Rule("contract_warning", "warning", 0.0, "revise"),
)
_FOLLOWS = {"balance_roll_in_max": "roll_in_max", "balance_forward_max": "forward_max"}

ADVICE = {
    "trace": "Trace the drifted features back to the tables they come from, and measure another cohort",
    "refit": "List the models and scorecards that use a drifted feature; refit those that suffer",
    "grant": "Look at whom credit is granted, and at the first months of accounts: too many fall behind",
    "collect": "Start collections sooner: accounts that fall behind stay behind",
    "lend": "Go through recent lending by rule, channel and kind of applicant: its accounts go bad sooner",
    "separate": "Fit the default model anew: it tells defaulters from others too poorly",
    "calibrate": "Calibrate the default model: its level is not what occurred",
    "mend": "Mend the feed, or agree on a new contract version, before any metric is trusted",
    "revise": "Look through the changed columns; where a change is meant, add a contract version",
}
#: How a fact reads, by topic.
_READS = {
    "stability": "{item}: PSI {value:.4f}{note}",
    "contracts": "{item}: {note}",
    "model": "{item} {value:.3f}",
    "rolls": "{item}: {value:.1%}",
    "vintages": "{note}",
}


def rules_of(path: str | Path | None = DEFAULT_THRESHOLDS) -> list[Rule]:
    """The built-in rules under the limits of a file (roll_rates: default, and sources by name; model). A balance limit that is not set follows the limit by accounts."""
    given = (yaml.safe_load(Path(path).read_text()) or {}) if path and Path(path).is_file() else {}
    rolls = given.get("roll_rates", {})
    layers: list[tuple[str | None, dict[str, float]]] = [(None, rolls.get("default", {}) | given.get("model", {}))]
    layers += [(source, rolls.get("default", {}) | limits) for source, limits in rolls.get("sources", {}).items()]
    out = []
    for scope, limits in layers:
        for rule in RULES:
            key = rule.measure if rule.measure in limits else _FOLLOWS.get(rule.measure, rule.measure)
            if scope is None or key in limits:
                out.append(replace(rule, scope=scope, limit=float(limits.get(key, rule.limit))))
    return out


# ---------------------------------------------------------------------------------------------
# Facts


def _facts(df: DataFrame, topic: str, **columns) -> DataFrame:
    as_column = {k: v if not isinstance(v, str) else F.lit(v) for k, v in columns.items()}
    kinds = [x.split() for x in FACTS.split(", ")]
    return df.select(*(F.lit(topic).alias("topic") if c == "topic" else as_column.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds))


def with_missing(df: DataFrame, **defaults) -> DataFrame:
    """Reports of an older layout get the columns they lack."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def stability_facts(report: DataFrame) -> DataFrame:
    """A fact per feature; those of analyses without alerts are ``psi_quiet``, which no rule judges. Identifiers and undefined features go."""
    report = with_missing(report, analysis=F.lit("portfolio"), top_driver=F.lit(None).cast("string"), alerting=F.lit(True))
    known = report.where(F.col("psi_score").isNotNull() & ~F.isnan("psi_score") & ~F.col("feature_name").startswith("SK_ID"))
    note = F.concat(F.lit(", "), F.col("drift_status"), F.coalesce(F.concat(F.lit(", most of it in bin "), F.col("top_driver")), F.lit("")))
    return _facts(known, "stability", scope=F.col("analysis"), item=F.col("feature_name"), measure=F.when(F.col("alerting"), "psi").otherwise("psi_quiet"), value=F.col("psi_score"), note=note)


def contract_facts(report: DataFrame) -> DataFrame:
    place = F.concat_ws(".", "table", F.when(F.col("column") != "", F.col("column")))
    note = F.concat(F.col("baseline"), F.lit(" -> "), F.col("observed"))
    return _facts(report, "contracts", scope=F.col("table"), item=F.concat_ws(" ", "kind", place), measure=F.concat(F.lit("contract_"), F.col("severity")), value=F.lit(1.0), note=note)


def model_facts(spark: SparkSession, metrics: dict[str, Any]) -> DataFrame:
    rate = metrics["base_rate"]
    gap = abs(metrics["mean_predicted"] / rate - 1) if rate else float("inf")
    told = [("AUC", "min_auc", metrics["auc"]), ("KS", "min_ks", metrics["ks"]), ("Gini", "gini", metrics["gini"]), ("Distance from the observed level", "max_calibration_error", gap)]
    return spark.createDataFrame([("model", "default model", item, measure, float(value), float(metrics["n_holdout"]), None) for item, measure, value in told], FACTS)


#: Share of a bucket's accounts (or balance) that moves to certain buckets.
_MOVES = {
    "roll_in_max": ("current accounts that turn delinquent", "CURRENT", DELINQUENT),
    "forward_max": ("1-30 days late that get later", DELINQUENT[0], DELINQUENT[1:]),
    "cure": ("1-30 days late that cure", DELINQUENT[0], ("CURRENT",)),
}


def roll_summary(rates: DataFrame) -> DataFrame:
    """Per source: roll_in, forward and cure, by accounts and by balance, and whether there are balances."""
    rates = with_missing(rates, source=F.lit("bureau"), balance_roll_rate=F.lit(None).cast("double"))
    shares = []
    for value, mark in (("roll_rate", ""), ("balance_roll_rate", "balance_")):
        for measure, (_, start, ends) in _MOVES.items():
            moved = F.when((F.col("from_bucket") == start) & F.col("to_bucket").isin(*ends), F.col(value))
            shares.append(F.coalesce(F.sum(moved), F.lit(0.0)).alias(mark + measure.removesuffix("_max")))
    return rates.groupBy("source").agg(*shares, (F.count("balance_roll_rate") > 0).alias("has_balance"))


def roll_facts(rates: DataFrame) -> DataFrame:
    told = []
    for mark, words in (("", ""), ("balance_", "by balance, ")):
        for measure, (item, _, _) in _MOVES.items():
            told.append(F.struct(F.lit(words + item).alias("item"), F.lit(mark + measure).alias("measure"), F.col(mark + measure.removesuffix("_max")).alias("value"), F.lit(bool(mark)).alias("by_balance")))
    long = roll_summary(rates).select("source", "has_balance", F.explode(F.array(*told)).alias("x")).select("source", "has_balance", "x.*").where("has_balance or not by_balance")
    return _facts(long, "rolls", scope=F.col("source"), item=F.col("item"), measure=F.col("measure"), value=F.col("value"))


def vintage_facts(curves: DataFrame, mob: int = VINTAGE_MOB, least: int = VINTAGE_ACCOUNTS, trailing: int = VINTAGE_TRAILING) -> DataFrame:
    """Of each source, how many times the mean of the cohorts before it the newest one's bad rate is; no value where too few have come that far."""
    curves = with_missing(curves, source=F.lit("bureau"))
    latest = latest_against_trailing(curves, mob, least, trailing)
    rate, before = F.col("cumulative_bad_rate"), F.col("trailing_bad_rate")
    ratio = F.when(before != 0, rate / before).when(rate > 0, F.lit(float("inf"))).when(rate.isNotNull(), F.lit(1.0))
    told = F.format_string(f"cohort %d: %.2f%% bad by month {mob}, where the {trailing} cohorts before had %.2f%%; %d accounts", "cohort_start_month", rate * 100, before * 100, "accounts_bad")
    joined = curves.select("source").distinct().join(latest, "source", "left")
    return _facts(joined, "vintages", scope=F.col("source"), item="newest cohort", measure="vintage_ratio", value=ratio, support=F.col("accounts_bad"), note=F.when(F.col("cohort_start_month").isNotNull(), told).otherwise(f"too few cohorts have reached month {mob} for a trend"))


# ---------------------------------------------------------------------------------------------
# Judgement


def judged(facts: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Each fact with the gravest rule that it breaks: level ("ok" if none), limit, advice."""
    rules = list(rules)
    own = {r.scope for r in rules} - {None}
    rows = [(r.measure, r.scope, sorted(s for s in own if any(x.scope == s and x.measure == r.measure for x in rules)), LEVELS[r.level], r.level, r.limit, r.side, r.at, float(r.support), r.advice) for r in rules]
    table = facts.sparkSession.createDataFrame(rows, "rule string, only string, others array<string>, rank int, level string, limit double, side int, at boolean, least double, advice string")
    beyond = (F.col("value") - F.col("limit")) * F.col("side")
    broken = (beyond > 0) | (F.col("at") & (beyond == 0))
    meant = F.coalesce(F.col("only") == F.col("scope"), ~F.array_contains("others", F.col("scope")), F.lit(True))
    enough = F.coalesce(F.col("support") >= F.col("least"), F.lit(True))
    met = facts.join(F.broadcast(table), (F.col("measure") == F.col("rule")) & meant & enough & broken, "left")  # a row per rule
    columns = [x.split()[0] for x in FACTS.split(", ")]
    worst = F.max(F.struct("rank", "level", "limit", "advice"))
    return met.groupBy(*columns).agg(worst.alias("w")).select(*columns, F.coalesce("w.level", F.lit("ok")).alias("level"), "w.limit", "w.advice")


def level_counts(told: DataFrame) -> DataFrame:
    """Facts by topic, scope, measure and level."""
    return told.groupBy("topic", "scope", "measure", "level").agg(F.count("*").alias("facts"))


def breaches(told: DataFrame, top: int = 10) -> DataFrame:
    """The gravest breaches of each topic, then the largest values."""
    rank = F.when(F.col("level") == "critical", 0).otherwise(1)
    order = [F.col("topic"), rank, F.desc("value"), F.col("scope"), F.col("item")]
    wanted = told.where("level <> 'ok'")
    parts = [wanted.where(F.col("topic") == t).orderBy(*order[1:]).limit(top) for t in _READS]
    return functools.reduce(DataFrame.unionByName, parts)


@dataclass
class Verdict:
    status: str = "ok"
    findings: list[str] = field(default_factory=list)
    recommendations: list[str] = field(default_factory=list)
    narrative: str | None = None
    breaches: list[dict[str, Any]] = field(default_factory=list)

    def to_markdown(self) -> str:
        parts = [f"# Portfolio brief\n\nStatus: **{self.status.upper()}**"]
        if self.narrative:
            parts.append(f"## Summary\n\n{self.narrative}")
        for title, lines in (("Findings", self.findings), ("Recommendations", self.recommendations)):
            parts.append("\n".join([f"## {title}\n", *(f"- {x}" for x in lines)]))
        return "\n\n".join(parts) + "\n"


def _line(row: dict[str, Any]) -> str:
    text = f"[{row['scope']}] " + _READS[row["topic"]].format(**{**row, "note": row["note"] or ""})
    if row["level"] == "ok":
        return text
    limit = "" if row["topic"] == "contracts" else f" at a limit of {row['limit']:g}"
    return f"{row['level']}: {text}{limit}"


def verdict(facts: DataFrame, rules: Iterable[Rule] = RULES, top: int = 10) -> Verdict:
    told = judged(facts, rules).persist()
    try:
        counts = level_counts(told).orderBy("topic", "scope", "measure", "level").collect()  # a row per source or analysis and measure
        worst = [r.asDict() for r in breaches(told, top).collect()]
        # of the topics with a few facts for each source, all are told
        calm = [r.asDict() for r in told.where("topic in ('model', 'rolls', 'vintages') and level = 'ok'").orderBy("topic", "scope", "measure").collect()]
    finally:
        told.unpersist()
    out = Verdict(breaches=worst)
    out.status = max((r.level for r in counts), key=LEVELS.__getitem__, default="ok")
    for topic in _READS:
        here = [r for r in counts if r.topic == topic]
        if here:
            n = {level: sum(r.facts for r in here if r.level == level) for level in ("critical", "warning", "ok")}
            out.findings.append(f"{topic}: {n['critical']} critical, {n['warning']} to watch, {n['ok']} in order")
        out.findings += [_line(r) for r in worst + calm if r["topic"] == topic]
    broken = {r["advice"] for r in worst} | ({"trace"} if any(r["advice"] == "refit" for r in worst) else set())
    out.recommendations = [text for key, text in ADVICE.items() if key in broken]
    return out


class DiagnosticAgent:
    """Reads the reports in a folder; those that are missing are said to be left out. ``narrator`` may turn findings into prose; if it fails, the brief goes without."""

    #: report, the step that writes it, and how it becomes facts
    REPORTS = {
        "portfolio_stability_report": ("stability", stability_facts),
        "schema_drift_report": ("drift", contract_facts),
        "roll_rate_matrix": ("vintage", roll_facts),
        "vintage_curves": ("vintage", vintage_facts),
    }

    def __init__(self, spark: SparkSession, processed: str, models: str | None = None, thresholds: str | Path | None = DEFAULT_THRESHOLDS, narrator: Callable[[list[str]], str] | None = None, top: int = 10) -> None:
        self.spark, self.processed, self.top, self.narrator = spark, processed, top, narrator
        self.metrics = posixpath.join(models or posixpath.join(posixpath.dirname(processed.rstrip("/")), "models"), "model_metrics.json")
        self.rules = rules_of(thresholds)

    def run(self) -> Verdict:
        facts, absent = [], []
        for name, (step, make) in self.REPORTS.items():
            path = posixpath.join(self.processed, f"{name}.parquet")
            if exists(self.spark, path):
                facts.append(make(self.spark.read.parquet(path)))
            elif step == "stability":
                return Verdict("error", [f"{self.processed} holds no stability report"], ["The steps up to `stability` have to run first"])
            else:
                absent.append(f"{name} is not there (step `{step}`); left out")
        if exists(self.spark, self.metrics):
            facts.append(model_facts(self.spark, json.loads(read_text(self.spark, self.metrics))))
        else:
            absent.append("No model metrics (step `train`); left out")
        out = verdict(functools.reduce(DataFrame.unionByName, facts), self.rules, self.top)
        out.findings += absent
        if out.status == "ok":
            out.recommendations = ["Nothing to do but to keep watching"]
        elif self.narrator is not None:
            try:
                out.narrative = self.narrator(out.findings)
            except Exception as why:  # prose is optional
                logger.warning("no narrative: %s", why)
        return out
