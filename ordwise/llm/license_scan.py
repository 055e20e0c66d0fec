"""Licence scan: a trained paragraph classifier with template confirmation.

Paragraphs (lines, and blank-line blocks of several lines) are classified by
multinomial logistic regression over sparse word n-grams (one and two words).
The model is trained when the scan is planned, on a fixed labelled table: its
features come from the same column expressions that the scan uses, and an
absolute-value penalty leaves most weights at zero. Probabilities are
calibrated on left-out paragraphs (Platt scaling of the winning family's
log-odds); below an even chance the family is ``unknown``. A prediction is
confirmed if most of the paragraph's three-word shingles, or of a template's,
are shared between the two.

Paragraphs without any of the model's ``signs`` are not scored, because their
class is known: the signs are chosen from the weights so that no paragraph
without one can score any class above ``none`` (``signs_of``).

The scan is built-in functions in one projection over the documents, with no
shuffle, join or Python: the weights and templates are literals whose size
depends on the labelled table only.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from textwrap import wrap
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare
from .license_texts import NONE, STOP_WORDS, TEMPLATES, UNKNOWN

FAMILIES = list(TEMPLATES)
CLASSES = [*FAMILIES, "unknown", "none"]
#: Least share of shared shingles that confirms a family.
CONFIRM = 0.6
#: Weight of the absolute-value penalty.
PENALTY = 0.03
#: Maps that the weights are dealt out over, by crc32 of the n-gram.
MAPS = 256


def tokens(paragraph: Column) -> Column:
    """Lower-case letter and number runs; a version's dots and the plus of
    names stay inside."""
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*"), F.lit(0))


def ngrams(words: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.concat(words, pairs))


def shingles(words: Column) -> Column:
    """Distinct runs of three words; all words as one run if fewer."""
    n = F.size(words)

    def after(k: int) -> Column:
        return F.slice(words, k, F.greatest(n, F.lit(1)))

    def joined(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)))

    runs = F.filter(joined(joined(words, after(2)), after(3)), lambda r: r.isNotNull())
    return (F.when(n > 2, F.array_distinct(runs)).when(n > 0, F.array(F.array_join(words, " ")))
            .otherwise(F.array().cast("array<string>")))


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _softmax_regression(x: np.ndarray, y: np.ndarray, k: int, steps: int = 600) -> np.ndarray:
    """Weights (features + bias, classes) by accelerated proximal gradient
    steps; the bias carries no penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    w, onehot = np.zeros((x.shape[1], k)), np.eye(k)[y]
    ahead, t, rate = w, 1.0, 2 * len(x) / np.linalg.norm(x, 2) ** 2
    for _ in range(steps):
        z = x @ ahead
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        new = ahead - rate * (x.T @ (p - onehot) / len(x))
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * PENALTY / len(x), 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """``a, b`` of P(right) = 1 / (1 + exp(-(a x + b))), Newton steps."""
    z, w = np.column_stack([x, np.ones(len(x))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2), z.T @ (y - p) - 0.1 * (w - [1.0, 0.0]))
    return float(w[0]), float(w[1])


class Model:
    """``weights``: n-gram -> weight per class; ``bias``; Platt ``a, b``;
    ``signs``: words of which every paragraph of another class than ``none``
    has one."""

    def __init__(self, weights: dict[str, list[float]], bias: list[float], a: float, b: float):
        self.weights, self.bias, self.a, self.b = weights, bias, a, b
        self.signs = signs_of(weights, bias)


def signs_of(weights: dict[str, list[float]], bias: list[float]) -> list[str]:
    """Words chosen so that ``none`` wins wherever all of them are missing.

    A paragraph of ``m`` n-grams, ``j`` of them in the model, scores class
    ``c`` over ``none`` by ``bias[c] - bias[none]`` and the sum of ``j``
    differences of weights over ``sqrt(m)``, hence by at most the ``j`` largest
    ones over ``sqrt(j)``. Words are added, each time for the class whose bound
    is highest, and the n-grams that hold them left out, until the bounds of
    all classes, for every ``j``, are below zero."""
    grams = sorted(weights)
    w, none = np.array([weights[g] for g in grams]), len(CLASSES) - 1
    over, lead = w - w[:, [none]], np.array(bias) - bias[none]
    parts, left, out = [g.split(" ") for g in grams], np.ones(len(grams), bool), []
    while True:
        best = np.sort(np.maximum(over[left], 0), 0)[::-1].cumsum(0)
        bound = lead + (best / np.sqrt(np.arange(1, len(best) + 1))[:, None]).max(0, initial=0)
        bound[none] = -np.inf
        worst = int(bound.argmax())
        if bound[worst] < -1e-6:
            return out
        gain: dict[str, float] = {}
        for j in np.flatnonzero(left & (over[:, worst] > 0)):
            for word in set(parts[j]) - STOP_WORDS:
                gain[word] = gain.get(word, 0.0) + over[j, worst] ** 2
        if not gain:
            raise ValueError(f"the model takes an ordinary paragraph for {CLASSES[worst]}")
        out.append(max(gain, key=lambda word: (gain[word], word)))
        left &= np.array([out[-1] not in p for p in parts])


_MODELS: dict[str, Model] = {}


def fit(spark: SparkSession) -> Model:
    """Train on the labelled table (kept per application)."""
    app = spark.sparkContext.applicationId
    if app not in _MODELS:
        rows = [(c, t) for c, ts in [*TEMPLATES.items(), ("unknown", UNKNOWN), ("none", NONE)] for t in ts]
        labelled = len(rows)
        # whole paragraphs, their beginnings, their lines as files wrap them, and two in a row as on one line
        wrapped = [(c, line) for c, t in rows if len(t) > 80 for line in wrap(t, 72) if len(line) > 40]
        rows += [(c, " ".join(t.split()[:max(4, len(t.split()) * 2 // 3)])) for c, t in rows if len(t.split()) > 6]
        rows += wrapped
        # what is licensed says nothing about how
        rows += [(c, f"{subject} {t[0].lower()}{t[1:]}") for c, t in rows[:labelled] for subject in ("This file is", "The code is", "It is")
                 if t.startswith(("Licensed", "Released", "Distributed"))]
        # ordinary text is also what says nothing
        rows += [("none", t) for t in ("", " ".join(sorted(STOP_WORDS)))]
        rows += [(c, f"{ts[i]} {ts[i + 1]}") for c, ts in TEMPLATES.items() for i in range(len(ts) - 1)]
        # the labelled rows as literals: the same expressions as in the scan, no Python on executors
        lit = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, (_, t) in enumerate(rows)))
        found = spark.range(1).select(F.explode(lit).alias("r")).select(
            "r.i", ngrams(tokens(F.col("r.t"))).alias("g")).collect()
        grams = {r["i"]: r["g"] for r in found}
        vocabulary = {g: j for j, g in enumerate(sorted({g for v in grams.values() for g in v if set(g.split(" ")) - STOP_WORDS}))}
        x, y = np.zeros((len(rows), len(vocabulary))), np.array([CLASSES.index(c) for c, _ in rows])
        for i, gs in grams.items():
            x[i, [vocabulary[g] for g in gs if g in vocabulary]] = 1 / np.sqrt(max(1, len(gs)))
        order = np.arange(len(rows)) * 7919 % 5
        odds, right = [], []
        for fold in range(5):
            out = order == fold
            w = _softmax_regression(x[~out], y[~out], len(CLASSES))
            z = np.column_stack([x[out], np.ones(out.sum())]) @ w
            top = z[:, :len(FAMILIES)].argmax(1)
            own = z[np.arange(len(z)), top]
            z[np.arange(len(z)), top] = -np.inf
            odds.append(own - np.log(np.exp(z - own[:, None]).sum(1)) - own)
            right.append(top == y[out])
        a, b = _platt(np.concatenate(odds), np.concatenate(right).astype(float))
        w = _softmax_regression(x, y, len(CLASSES))
        keep = {g: [round(float(v), 4) for v in w[j]] for g, j in vocabulary.items() if np.abs(w[j]).max() >= 5e-5}
        _MODELS[app] = Model(keep, [round(float(v), 4) for v in w[-1]], a, b)
    return _MODELS[app]


@lru_cache(maxsize=1)
def _template_runs() -> dict[str, list[list[str]]]:
    word = re.compile(r"[^\W_]+(?:\.[0-9]+)*")

    def runs(t: str) -> list[str]:
        w = word.findall(t.lower())
        return sorted({" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))})

    return {c: [runs(t) for t in ts] for c, ts in TEMPLATES.items()}


def _literal(value, ddl: str) -> Column:
    """A constant parsed from JSON at planning time."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


def classify(paragraph: Column, model: Model) -> Column:
    """``struct(family, probability, similarity, confirmed)`` of one paragraph."""
    k, f = len(CLASSES), len(FAMILIES)
    # a map is searched from its first key on: the weights are dealt out over small ones
    dealt: list[dict[str, list[float]]] = [{} for _ in range(MAPS)]
    for gram, w in model.weights.items():
        dealt[crc32(gram.encode()) % MAPS][gram] = w
    weights = _literal(dealt, "array<map<string,array<double>>>")
    templates = _literal(_template_runs(), "map<string,array<array<string>>>")

    def weight(gram: Column) -> Column:
        return F.try_element_at(F.element_at(weights, (F.crc32(gram.cast("binary")) % MAPS + 1).cast("int")), gram)

    def scores(grams: Column) -> Column:
        known = F.transform(F.filter(grams, lambda g: g.isin(*model.weights)), weight)
        total = F.aggregate(known, F.array_repeat(F.lit(0.0), k), lambda acc, w: F.zip_with(acc, w, lambda p, q: p + q))
        return let(F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double")), lambda scale: F.zip_with(
            total, F.array(*map(F.lit, model.bias)), lambda t, b: t / scale + b))

    def judged(z: Column) -> Column:
        return let(F.array_max(F.slice(z, 1, f)), lambda best: let(
            F.array_position(z, best).cast("int"), lambda at: family_of(z, best, at)))

    def family_of(z: Column, best: Column, at: Column) -> Column:
        rest = F.aggregate(F.transform(z, lambda v, i: F.when(i + 1 == at, F.lit(0.0)).otherwise(F.exp(v - best))),
                           F.lit(0.0), lambda p, q: p + q)
        none = F.element_at(z, k) > F.greatest(best, F.element_at(z, k - 1))

        def named(p: Column) -> Column:
            family = F.when(none, "none").when(p >= 0.5, F.element_at(F.array(*map(F.lit, FAMILIES)), at)).otherwise("unknown")
            return F.struct(family.alias("family"), p.alias("probability"))

        return let(1 / (1 + F.exp(-(F.lit(model.a) * -F.log(rest) + F.lit(model.b)))), named)

    def similarity(words: Column, family: Column) -> Column:
        ts = F.coalesce(F.try_element_at(templates, family), F.array().cast("array<array<string>>"))

        def nearest(runs: Column) -> Column:
            share = F.transform(ts, lambda t: F.size(F.array_intersect(runs, t)) / F.least(F.size(runs), F.size(t)))
            return F.coalesce(F.array_max(share), F.lit(0.0))

        return F.when(family.isin("none", "unknown"), F.lit(0.0)).otherwise(let(shingles(words), nearest))

    def compare(words: Column) -> Column:
        return let(let(let(ngrams(words), scores), judged), lambda j: let(similarity(words, j["family"]), lambda s: F.struct(
            j["family"].alias("family"), F.round(j["probability"], 6).alias("probability"),
            F.round(s, 6).alias("similarity"), (s >= CONFIRM).alias("confirmed"))))

    return let(tokens(paragraph), compare)


def either(words: set[str]) -> str:
    """A pattern for any of the words, common beginnings written once, so that
    a place in a text is held against a letter of each, not against all words."""
    rest: dict[str, set[str]] = {}
    for word in words - {""}:
        rest.setdefault(word[0], set()).add(word[1:])
    found = "|".join(re.escape(c) + either(ends) for c, ends in sorted(rest.items()))
    return "" if not rest else f"(?:{found})?" if "" in words else f"(?:{found})" if len(rest) > 1 else found


def sign_pattern(model: Model) -> str:
    """A pattern that finds, in lower-case text, every token that is a sign.
    A token may follow a digit ("2.0mit"), one with a dot may precede a letter."""
    plain, dotted = ({s for s in model.signs if ("." in s) == dot} for dot in (False, True))
    first = "".join(sorted({s[0] for s in model.signs}))
    return (rf"(?=[{first}])(?<!\p{{L}})(?:(?:{either(plain)})(?![\p{{L}}\p{{N}}])"
            + (rf"|{either(dotted)})" if dotted else ")"))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, the number of paragraphs (lines),
    the findings in page order (paragraph number from 1, family, probability,
    similarity to the nearest template of the family, confirmed), the same for
    blocks of several lines between blank lines (``block_findings``, block
    number from 1: a notice that is wrapped over lines), and the family of the
    surest confirmed finding, else of the surest one (ties: lines, then the
    first); null without findings. ``unknown`` findings never confirm. A null
    or empty text has no paragraph; other columns are left out."""
    prepare(docs.sparkSession)
    model = fit(docs.sparkSession)
    signs = sign_pattern(model)
    body, item = F.col("body"), "array<struct<at:int,p:string>>"
    # the whole text is searched for signs once, for lines and blocks
    docs = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
            .withColumn("signed", F.lower("body").rlike(signs)))

    def found(pieces: Column, at: str) -> Column:
        numbered = F.filter(F.transform(pieces, lambda p, i: F.struct((i + 1).alias("at"), p.alias("p"))),
                            lambda r: F.lower(r["p"]).rlike(signs))
        numbered = F.when(F.col("signed"), numbered).otherwise(F.array().cast(item))
        judged = F.filter(F.transform(numbered, lambda r: F.struct(
            r["at"].alias("at"), classify(r["p"], model).alias("c"))), lambda r: r["c"]["family"] != "none")
        return F.transform(judged, lambda r: F.struct(
            r["at"].alias(at), r["c"]["family"].alias("family"), r["c"]["probability"].alias("probability"),
            r["c"]["similarity"].alias("similarity"), r["c"]["confirmed"].alias("confirmed")))

    # a block of one line is that line: judged once, there
    blocks = F.transform(F.split(body, r"\n(?:[ \t\r]*\n)+"), lambda b: F.trim(b, F.lit("\n")))
    blocks = F.transform(blocks, lambda b: F.when(F.contains(b, F.lit("\n")), b).otherwise(""))
    n = F.when(F.length(body) > 0, F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).otherwise(0)

    def order(column: str, at: str, level: int) -> Column:
        return F.transform(F.col(column), lambda r: F.struct(
            (~r["confirmed"]).alias("a"), (-r["probability"]).alias("b"), F.lit(level).alias("l"), r[at].alias("p"),
            r["family"].alias("family")))

    surest = F.array_min(F.concat(order("findings", "paragraph", 0), order("block_findings", "block", 1)))
    return (docs.select("doc_id", n.alias("n_paragraphs"),
                        found(F.split(body, "\n"), "paragraph").alias("findings"), found(blocks, "block").alias("block_findings"))
            .withColumn("family", surest["family"]))
