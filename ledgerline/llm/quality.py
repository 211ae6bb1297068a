"""Quality classifier with hierarchical empirical Bayes.

Evidence: a document's byte classes, repetition and words give the log-odds that it is neither low in
quality nor toxic, from two logistic heads fitted in numpy on a bounded sample of labelled documents
(``LABELLED_ROWS``, by hash of doc_id). Sites: every document of the corpus adds its probability to its
path (host and section) and host. A path's posterior is its mean shrunk toward its host's, and that one's
toward the mean of all; how strongly follows from the variance between sites (method of moments). A
document's posterior odds are its evidence times the prior odds of its path. Sums are formed in each task
before they are shuffled, so a host with a third of all rows costs no more than another.

Defined results: a null or wordless text has probability 0 and is rejected; a null source is the host ''
and a source without a path has the path '', whose posterior is its host's; a very long text is measured whole, as any other; documents without labels take part in all but the fit; labels that are
null are ignored, and repeated ones count as often as they stand; without labels of both kinds a head has
no evidence and rejects nothing; an empty table returns no rows; repeated documents each return a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import as_bytes, small_batches, written

#: Labelled documents that the heads are fitted on, at most; their features (not texts) go to the driver.
LABELLED_ROWS = 20_000
#: Buckets of words; words of a document that count toward its word evidence are all its distinct words.
BUCKETS = 1 << 18
THRESHOLD = 0.5
_STRIP = b".,;:!?\"'()[]*&%$#|"
_KINDS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": (9, 10, 11, 12, 13, 32), "mark": b".,;:!?'\"()-", "odd": b"#$%&*|~^_=+<>@[]{}\\/`", "high": range(128, 256)}
_MASKS = np.stack([np.isin(np.arange(256), list(x)) for x in _KINDS.values()], 1).astype(np.float64)
SIZE = 12


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers about the whole text, and the buckets of its distinct words."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MASKS
    upper, lower, digit, space, mark, odd, high = counts
    distinct, lines = set(words), text.split(b"\n")
    n, letters = max(1, len(words)), max(1.0, upper + lower + high / 2)
    size = max(1, len(text))
    dense = [upper / letters, digit / size, mark / size, odd / size, high / size, space / size, len(distinct) / n, len(set(lines)) / len(lines), np.log1p(n), np.log1p(n) * len(distinct) / n, letters / n, odd / n]
    return np.array(dense), np.unique([zlib.crc32(w.strip(_STRIP).lower()) & (BUCKETS - 1) for w in distinct]).astype(np.int64)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton's method; the penalty spares the intercept, which is the last weight."""
    x = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step * min(1.0, 4 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Head:
    """Log-odds that a document is bad in one way."""

    words: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def row(self, dense: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        said = self.words[buckets]
        return np.concatenate([(dense - self.mean) / self.scale, [said.sum(), said.max(initial=0.0)]])

    def log_odds(self, dense: np.ndarray, buckets: np.ndarray) -> float:
        return float("-inf") if self.weights is None else float(np.clip(np.append(self.row(dense, buckets), 1.0) @ self.weights, -30, 30))


def _word_evidence(rows: list[np.ndarray], bad: np.ndarray) -> np.ndarray:
    """Log ratio of how often each word's bucket stands in bad and in other documents, where that is significant and positive."""
    counts = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for buckets, is_bad in zip(rows, bad, strict=True):
        counts[int(is_bad)][buckets] += 1
    n0, n1 = max(1, int((1 - bad).sum())), max(1, int(bad.sum()))
    p0, p1 = (counts[0] + 0.5) / (n0 + 1), (counts[1] + 0.5) / (n1 + 1)
    pooled = (counts[0] + counts[1] + 1) / (n0 + n1 + 2)
    z = (p1 - p0) / np.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    return np.where((z > 5) & (counts[1] >= 5), np.log(p1 / p0), 0.0).astype(np.float32)


def fit(dense: np.ndarray, buckets: list[np.ndarray], bad: np.ndarray) -> Head:
    """Word evidence comes from one half of the rows and the weights from the other, so that it isn't trusted too much."""
    if len(bad) < 20 or not 0 < bad.sum() < len(bad):
        return Head()
    half = np.arange(len(bad)) % 2 == 0
    head = Head(_word_evidence([b for b, h in zip(buckets, half, strict=True) if h], bad[half]), dense.mean(0), dense.std(0) + 1e-6)
    rest = np.flatnonzero(~half) if 0 < bad[~half].sum() < (~half).sum() else np.arange(len(bad))
    head.weights = _logistic(np.array([head.row(dense[k], buckets[k]) for k in rest]), bad[rest])
    return head


def train(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> tuple[Head, Head]:
    """The heads for low quality and for toxicity, from at most ``rows`` labelled documents."""
    usable = labels.where("doc_id is not null and quality is not null and toxic is not null")
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").alias("of"), "quality", "toxic")
    joined = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("of"))  # at most ``rows`` small rows

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            got = [features(x or b"") for x in as_bytes(batch.column(0))]
            arrays = [batch.column(1), batch.column(2), pa.array([d.tolist() for d, _ in got], pa.list_(pa.float64())), pa.array([b for _, b in got], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["quality", "toxic", "dense", "buckets"])

    out = joined.select("text", F.col("quality").cast("int"), F.col("toxic").cast("int"), "doc_id").select("text", "quality", "toxic").mapInArrow(measured, "quality int, toxic int, dense array<double>, buckets array<int>").toArrow()
    dense = np.array(out["dense"].to_pylist(), np.float64).reshape(out.num_rows, SIZE)
    buckets = [np.array(x, np.int64) for x in out["buckets"].to_pylist()]
    order = np.lexsort(dense.T) if out.num_rows else np.zeros(0, np.int64)  # however the rows arrived
    dense, buckets = dense[order], [buckets[k] for k in order]
    quality, toxic = (out[c].to_numpy()[order] for c in ("quality", "toxic"))
    return fit(dense, buckets, (quality == 0).astype(np.float64)), fit(dense, buckets, (toxic == 1).astype(np.float64))


def probability(text: bytes, heads: tuple[Head, Head]) -> float:
    """That the text is neither low in quality nor toxic, on its own evidence."""
    if not text.strip():
        return 0.0
    dense, buckets = features(text)
    good = 1.0
    for head in heads:
        good /= 1 + np.exp(head.log_odds(dense, buckets))
    return float(good)


def host_of(source: str | Column = "source") -> Column:
    """What stands before the first slash (after a scheme, if there is one)."""
    column = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.regexp_extract(column, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1), F.lit(""))


def section_of(source: str = "source") -> Column:
    """The first folder of a path; '' of a source without a path."""
    return F.coalesce(F.regexp_extract(F.col(source), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]+)", 1), F.lit(""))


def _scored(rows: DataFrame, heads: tuple[Head, Head]) -> DataFrame:
    """Adds p to rows (row struct with text, host, section); the text is read from the struct."""
    held = rows.sparkSession.sparkContext.broadcast(heads)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            p = [probability(x or b"", held.value) for x in as_bytes(batch.column(0).field("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "p"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(score, f"{kinds}, p double")


def _strength(sites: DataFrame, n: str, mean: str, overall: float) -> float:
    """Pseudo-documents that a parent's mean weighs: within-site over between-site variance (method of moments), from three sums."""
    m = sites.agg(F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(F.col(n) * F.pow(F.col(mean) - overall, 2)).alias("ss"), F.sum(F.col(n) * F.col(n)).alias("nn")).first()
    if not m.n or m.k < 2:
        return 50.0
    within = max(1e-6, overall * (1 - overall))
    between = (m.ss - (m.k - 1) * within) / max(1e-9, m.n - m.nn / m.n)
    return float(min(1e4, max(1.0, within / between))) if between > 1e-9 else 1e4


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float]:
    """host, section, host_posterior, path_posterior, n; and the mean of all. From (host, section, p)."""
    paths = written(scored.groupBy("host", "section").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    overall = min(1 - 1e-6, max(1e-6, total.s / total.n)) if total.n else 0.5
    strength = _strength(hosts.withColumn("mean", F.col("host_s") / F.col("host_n")), "host_n", "mean", overall)
    both = paths.join(hosts, "host").withColumn("host_posterior", (F.col("host_s") + strength * overall) / (F.col("host_n") + strength))
    below = _strength(both.withColumn("gap", F.col("s") / F.col("n") - F.col("host_posterior") + overall), "n", "gap", overall)
    shrunk = (F.col("s") + below * F.col("host_posterior")) / (F.col("n") + below)
    posterior = F.when(F.col("section") == "", F.col("host_posterior")).otherwise(shrunk)  # without a path, the host's is the last level
    return both.select("host", "section", "n", "host_posterior", posterior.alias("path_posterior")), overall


def _decided(scored: DataFrame, sites: DataFrame, overall: float, threshold: float) -> DataFrame:
    """Adds the sites' posteriors, the document's, and whether it is kept."""
    squeezed = lambda c: F.least(F.greatest(F.col(c), F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = lambda c: squeezed(c) / (1 - squeezed(c))
    after = odds("p") / (overall / (1 - overall)) * odds("path_posterior")
    joined = scored.join(sites.drop("n"), ["host", "section"])
    return joined.withColumn("posterior", F.when(F.col("p") > 0, after / (1 + after)).otherwise(F.lit(0.0))).withColumn("keep", F.col("posterior") >= threshold)


def _rows(documents: DataFrame, columns: list[str]) -> DataFrame:
    texted = [F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in columns]
    return documents.select(F.struct(*texted).alias("row"), host_of().alias("host"), section_of().alias("section"))


def assess(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, threshold: float = THRESHOLD, heads: tuple[Head, Head] | None = None) -> DataFrame:
    """One row per document: doc_id, host, section, p (own evidence), host_posterior, path_posterior, posterior, keep."""
    heads = heads or train(documents, labels, rows)
    scored = _scored(_rows(documents, ["doc_id", "text"]), heads).select(F.col("row.doc_id").alias("doc_id"), "host", "section", "p")
    scored = written(scored, "evidence")
    sites, overall = site_posteriors(scored)
    return _decided(scored, sites, overall, threshold).select("doc_id", "host", "section", "p", "host_posterior", "path_posterior", "posterior", "keep")


def keep_good(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, all columns. Evidence is computed once and written beside the rows, which the few site posteriors then meet."""
    heads = train(documents, labels, rows)
    scored = written(_scored(_rows(documents, documents.columns), heads), "evidence")
    sites, overall = site_posteriors(scored.select("host", "section", "p"))
    return _decided(scored, written(sites, "sites"), overall, threshold).where("keep").select("row.*")
