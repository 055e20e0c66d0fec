"""Quality classifier: hierarchical empirical Bayes over sites.

A document classifier (logistic regression on dense text features, trained
on a bounded labelled sample) gives each document evidence. Hosts and paths
gather it by grouped aggregation: pseudo-counts of good documents. A host's
rate is shrunk toward the global rate, a path's toward its host's, with
prior strengths estimated by the method of moments from the spread of the
rates, so a site of few documents leans on its parent. A document's
posterior log-odds are its own evidence plus its path's shift from the
global rate.

The grouped table has one row per host and path; it is broadcast only below
``BROADCAST_PATHS`` rows and joined by shuffle beyond. Aggregation is partial
before the shuffle, so a host with a third of all rows costs one row a task.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, column_names, labelled_sample, materialize, prepare, sided

SAMPLE_ROWS = 8000
THRESHOLD = 0.5
BROADCAST_PATHS = 20_000

_WORDISH = re.compile(r"\w")


def features(text: str | None) -> list[float]:
    """Dense features of one whole text; zeros for a text without words."""
    tokens = text.split() if text else []
    n = len(tokens)
    if not n:
        return [0.0] * 14
    chars = sum(map(len, tokens))
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:])) / n
    bare = sum(1 for t in tokens if not _WORDISH.search(t)) / n
    joined = "".join(tokens)
    letters = sum(map(str.isalpha, joined)) / chars
    digits = sum(map(str.isdigit, joined)) / chars
    upper = sum(map(str.isupper, joined)) / chars
    ends = sum(joined.count(c) for c in ".!?") / n
    # words per distinct word in stretches of 200: independent of length
    fresh = np.mean([len(set(tokens[i:i + 200])) / len(tokens[i:i + 200]) for i in range(0, n, 200)])
    return [repeats, bare, letters, digits, upper, ends, joined.count(",") / n, chars / n / 10,
            float(fresh), len(set(lines)) / len(lines), min(n / len(lines), 200) / 100,
            np.log1p(n) / 10, 1.0 if n < 5 else 0.0, sum(map(len, sorted(tokens, key=len)[-5:])) / 100]


class Logistic:
    """L2-regularised logistic regression by Newton steps on standardised
    features and their squares. Without both classes: the class's share."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30):
        self.mean = x.mean(0) if len(x) else np.zeros(14)
        self.sd = np.maximum(x.std(0), 1e-3) if len(x) else np.ones(14)
        share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        z = self._expand(x)
        self.w = np.zeros(z.shape[1])
        self.w[0] = np.log(share / (1 - share))
        self.prior = self.w[0]
        if len(y) and y.min() < y.max():
            keep = np.full(len(self.w), ridge)
            keep[0] = 1e-6
            for _ in range(steps):
                p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
                step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (y - p) - keep * self.w)
                self.w += np.clip(step, -2, 2)
                if np.abs(step).max() < 1e-6:
                    break

    def _expand(self, x: np.ndarray) -> np.ndarray:
        s = np.clip((x - self.mean) / self.sd, -6, 6) if len(x) else np.zeros((0, 14))
        return np.column_stack([np.ones(len(s)), s, s * s])

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([features(t) for t in texts], float).reshape(len(texts), 14)
        return np.clip(self._expand(x) @ self.w, -12, 12)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Logistic:
    """Train on at most about ``max_rows`` labelled rows (one text each of equal texts)."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", max_rows, fold=False).dropDuplicates(["text"])
    wide = append_columns(sample, "x array<double>", lambda texts: [
        pa.array([features(t) for t in texts], pa.list_(pa.float64()))]).select("doc_id", "y", "x").collect()
    wide.sort(key=lambda r: r["doc_id"])
    return Logistic(np.array([r["x"] for r in wide], float).reshape(len(wide), 14),
                    np.array([r["y"] for r in wide], float))


def evidence(docs: DataFrame, model: Logistic, name: str) -> DataFrame:
    """``docs`` with the classifier's log-odds of good quality."""
    return append_columns(docs, f"{name} double", lambda t: [pa.array(model.log_odds(t), pa.float64())])


def site_posteriors(seen: DataFrame, host: str, path: str, log_odds: str) -> DataFrame:
    """Per (host, path): number of documents, posterior rates and the shift in
    log-odds. Null hosts and paths are sites of their own."""
    p = 1 / (1 + F.exp(-F.col(log_odds)))
    paths = seen.groupBy(F.col(host).alias("host"), F.col(path).alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(p).alias("good"))
    hosts = paths.groupBy(F.col("host").alias("h")).agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))

    # method of moments: how far rates spread beyond binomial noise
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hgood").alias("good")).first()
    mean = min(max((total["good"] or 0.0) / (total["n"] or 1), 1e-4), 1 - 1e-4)

    def strength(groups: DataFrame, n: str, good: str, centre) -> float:
        s = groups.where(F.col(n) > 1).agg(
            F.count(F.lit(1)).alias("k"), F.sum(F.pow(F.col(good) / F.col(n) - centre, 2) * F.col(n)).alias("ss"),
            F.sum(n).alias("n"), F.sum(F.col(n) * F.col(n)).alias("n2")).first()
        if not s["k"] or s["k"] < 2:
            return 50.0
        noise = mean * (1 - mean)
        spread = (s["ss"] - (s["k"] - 1) * noise) / max(s["n"] - s["n2"] / s["n"], 1e-9)
        return 1000.0 if spread <= 0 else min(max(noise / spread - 1, 2.0), 1000.0)

    a = strength(hosts, "hn", "hgood", F.lit(mean))
    hosts = hosts.withColumn("host_rate", (F.col("hgood") + a * mean) / (F.col("hn") + a))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    b = strength(both, "n", "good", F.col("host_rate"))
    rate = (F.col("good") + b * F.col("host_rate")) / (F.col("n") + b)
    logit = F.log(F.col("path_rate") / (1 - F.col("path_rate"))) - float(np.log(mean / (1 - mean)))
    return (both.withColumn("path_rate", F.least(F.greatest(rate, F.lit(1e-4)), F.lit(1 - 1e-4)))
            .withColumn("shift", logit)
            .select("host", "path", "n", "host_rate", "path_rate", "shift"))


def combine(seen: DataFrame, sites: DataFrame, host: str, path: str, log_odds: str, out: str) -> DataFrame:
    """Posterior probability per row of ``seen``, as column ``out``; the
    sites' columns come along under names that ``seen`` does not have."""
    names = dict(zip(sites.columns, column_names(seen, *(f"_site_{c}" for c in sites.columns))))
    s = sided(sites.select(*(F.col(c).alias(n) for c, n in names.items())), BROADCAST_PATHS)
    joined = seen.join(s, F.col(host).eqNullSafe(F.col(names["host"])) & F.col(path).eqNullSafe(F.col(names["path"])), "left")
    post = 1 / (1 + F.exp(-(F.col(log_odds) + F.coalesce(F.col(names["shift"]), F.lit(0.0)))))
    return joined.withColumn(out, post)


def predictions(docs: DataFrame, model: Logistic, host: str = "source", path: str = "lang") -> DataFrame:
    """``doc_id, host, path, evidence, host_rate, path_rate, score, predicted``
    per row. The texts are read once; only narrow rows are kept and joined.
    Null and empty texts are scored as texts without words; null hosts and
    paths are sites like any other; repeated rows and null ids give a row each
    and count each in their site; other columns are left out; an empty table
    gives no rows."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"),
                         F.col(path).alias("path"), "text")
    seen = materialize(evidence(narrow, model, "evidence").drop("text"), "quality-evidence")
    sites = materialize(site_posteriors(seen, "host", "path", "evidence"), "quality-sites")
    return combine(seen, sites, "host", "path", "evidence", "score").select(
        "doc_id", "host", "path", "evidence", F.col("_site_host_rate").alias("host_rate"),
        F.col("_site_path_rate").alias("path_rate"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Logistic, host: str = "source", path: str = "lang") -> DataFrame:
    """``docs`` without the rows of a posterior under ``THRESHOLD``, columns as
    they were. Evidence is computed twice (once for the sites), which costs
    less than keeping or shuffling the texts."""
    ev, post = column_names(docs, "quality_evidence", "quality_score")
    narrow = docs.select(F.col(host).alias("host"), F.col(path).alias("path"), "text")
    seen = evidence(narrow, model, "evidence").drop("text")
    sites = materialize(site_posteriors(materialize(seen, "quality-evidence"), "host", "path", "evidence"), "quality-sites")
    return (combine(evidence(docs, model, ev), sites, host, path, ev, post)
            .where(F.col(post) >= THRESHOLD).select(*docs.columns))
