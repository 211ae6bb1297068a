"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its content (SHA-256). The ledger holds which blobs were scanned
under which version of which rule, and what was found. A scan takes only the pairs of blob and rule
version that the ledger lacks, adds them to it, and joins the findings of all blobs back to every path
that holds them. Copies, unchanged files and moved files are thus never scanned again.

Places: ``split`` gives the text between a rule's matches and ``regexp_extract_all`` the matches, so
running sums of their lengths (in code points) are the spans. Matches are leftmost and do not overlap
within a rule, as in both functions.

Defined results: a null text is an empty text; a very long text is a blob like any other, scanned whole; a null path or doc_id is carried through; rows that repeat
each return a row; an empty table returns none; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .support import new_path, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, else the match is dropped; raise ``version`` with any change."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: Fixed values. Runs of hex digits and of letters and digits after AKIA are maximal, so their least length stands in the pattern itself.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
MASK = "[secret]"
#: Addresses (of 64 characters) that are broadcast at most, to pick the texts to scan.
BROADCAST_BLOBS = 200_000
SCANNED = "blob string, kind string, version int"
FOUND = "blob string, kind string, version int, start long, end long"


def content_address(text: str | Column = "text") -> Column:
    column = text_or_empty(text) if isinstance(text, str) else text
    return F.sha2(column.cast("binary"), 256)


class Ledger:
    """Two growing tables in one folder: pairs scanned, and findings. Appends only; a crash between the two costs a rescan, and findings are read as a set."""

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_path(spark, "ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    def findings(self) -> DataFrame:
        return self._read("findings", FOUND).distinct()

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")


def _matches(rule: Rule) -> Column:
    """An array of (kind, version, place in the array, length before, length, whether the match stands) for the column text."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    between = F.split("text", rule.pattern, -1)
    valued = found if rule.group == 0 else F.regexp_extract_all("text", pattern, F.lit(rule.group))
    lengths = lambda a: F.transform(a, lambda x: F.length(x).cast("long"))
    zipped = F.arrays_zip(lengths(F.slice(between, F.lit(1), F.size(found))).alias("gap"), lengths(found).alias("len"), lengths(valued).alias("val"))
    rows = F.transform(zipped, lambda x, i: F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"), (x["val"] >= rule.least).alias("stands")))
    return F.when(F.col("text").rlike(rule.pattern) & F.array_contains("kinds", rule.kind), rows).otherwise(F.array().cast("array<struct<kind:string,version:int,i:int,gap:bigint,len:bigint,stands:boolean>>"))


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, kind, version, start, end (code points, end exclusive) of blobs (blob, text, kinds: the rules to apply)."""
    rows = blobs.select("blob", F.explode(F.concat(*(_matches(rule) for rule in rules))).alias("m")).select("blob", "m.*")
    before = Window.partitionBy("blob", "kind").orderBy("i")
    start = F.sum("gap").over(before) + F.sum("len").over(before) - F.col("len")
    return rows.withColumn("start", start).where("stands").select("blob", "kind", "version", "start", (F.col("start") + F.col("len")).alias("end"))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what is new in ``versions`` (column text), add it to the ledger; the findings of its current rules.

    Returns blob, kind, version, start, end for all blobs in the ledger.
    """
    current = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    texts = versions.select(content_address().alias("blob"), text_or_empty().alias("text"))
    addresses, known = texts.select("blob").distinct(), ledger.scanned()
    if known.isEmpty():
        lacking = addresses.withColumn("pairs", current)
    else:
        # addresses meet the ledger before any text is moved
        seen = known.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
        left = F.array_except(current, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
        lacking = written(addresses.join(seen, "blob", "left").select("blob", left.alias("pairs")).where(F.size("pairs") > 0), "unseen")
        few = lacking.limit(BROADCAST_BLOBS + 1).count() <= BROADCAST_BLOBS
        texts = texts.join(F.broadcast(lacking.select("blob")) if few else lacking.select("blob"), "blob", "left_semi")
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
    unseen = blobs.withColumn("kinds", F.array(*(F.lit(r.kind) for r in rules))) if known.isEmpty() else blobs.join(lacking, "blob").select("blob", "text", F.col("pairs.kind").alias("kinds"))
    ledger.append("findings", find(unseen, rules))
    ledger.append("scanned", lacking.select("blob", F.explode("pairs").alias("pair")).select("blob", "pair.kind", F.col("pair.version").cast("int").alias("version")))
    wanted = F.lit(False)
    for rule in rules:
        wanted = wanted | ((F.col("kind") == rule.kind) & (F.col("version") == rule.version))
    return ledger.findings().where(wanted)


def spans(documents: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES, increments: int = 1) -> DataFrame:
    """One row per document: doc_id, n_<kind> for each rule, spans (kind:start:end by start, then rule order, comma-joined).

    With ``increments``, the ledger first meets the documents up to a quantile of doc_id, as they would arrive, and
    each later scan (the last is of them all) takes only blobs that it lacks.
    """
    ledger = ledger or Ledger(documents.sparkSession)
    cuts = documents.approxQuantile("doc_id", [k / increments for k in range(1, increments)], 0.05) if increments > 1 else []
    for cut in cuts:
        scan(documents.where(F.col("doc_id") <= int(cut)), ledger, rules)
    found = scan(documents, ledger, rules)
    rank = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind"))
    counts = [F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in rules]
    parts = F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")))
    words = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    by_blob = found.groupBy("blob").agg(*counts, words.alias("spans"))
    paths = documents.select("doc_id", content_address().alias("blob"))
    filled = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in rules]
    return paths.join(by_blob, "blob", "left").select("doc_id", *filled, F.coalesce("spans", F.lit("")).alias("spans"))


def redact(documents: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All documents and columns; each maximal run of found spans in ``text`` gives way to a mask. Texts without findings, null ones included, stay as they are."""
    found = scan(documents, ledger or Ledger(documents.sparkSession), rules)
    order = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("head", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("run", F.sum("head").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    by_blob = merged.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    keyed = documents.select(F.struct(*documents.columns).alias("row"), content_address().alias("blob")).join(by_blob, "blob", "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("cuts.end"))
    ends = F.concat(F.col("cuts.start"), F.array(F.length("row.text").cast("long")))
    kept = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda x: F.substring(F.col("row.text"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.array_join(kept, MASK))
    return keyed.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in documents.columns))
