"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: with the class prior p, the loss on negatives is the loss of all
unlabelled texts as negatives less p times that of the positives as negatives. The unbiased risk

    p * E_pos[loss(g, 1)] + max(0, E_unl[loss(g, 0)] - p * E_pos[loss(g, 0)])

is kept from falling below zero in its second part (non-negative risk): where that part goes under, the step undoes it instead.
``g`` is a small network with one hidden layer over counts and shares of a text, so its sigmoid, the
score, is the chance of a good text.

The prior is estimated from positives and unlabelled rows alone, whatever share of the labelled rows is good: a first network is
fitted to half of both, and above a score that held-out positives often reach, the share of the unlabelled rows over the share
of the positives bounds the prior; the score where that bound is least, with a margin for small samples, gives the estimate, and a
second network fitted with it a better one. It may be
given instead (``class_prior`` is the labelled rows' share). Learning reads about ``SAMPLE`` positives and as many unlabelled rows, drawn by a hash of the id (a documented bound); what reaches
the driver is one short vector for each of them. Scores cover all rows and whole texts.

Defined results: a text that is NULL or empty has zero for every figure and is scored by that; repeated rows get the same
score each; a document is a trusted positive if its labels, one or several, all say so; very long texts are read whole; without positives to learn from every score is 0, without unlabelled rows it is the prior; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import as_bytes, slices
from ebbline.llm.langid import bounded
from ebbline.llm.line_rules import repeated_words

SAMPLE = 15_000
THRESHOLD = 0.7
HIDDEN = 16
STEPS = 400
RATE = 0.02
DECAY = 1e-4
SEED = 7

_SYMBOLS, _DIGITS, _ENDS = b"#*$%&|<>", b"0123456789", (b".", b"!", b"?", b'"', b":", b"\xe2\x80\xa6")
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_RUN = re.compile(rb"([!-~])\1{2,}")
N_FEATURES = 20


def features(text: bytes | None) -> list[float]:
    """Counts and shares of one text."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    chars = sum(map(len, words))

    def share(of: bytes) -> float:
        return (len(text) - len(text.translate(None, of))) / chars

    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.float64, n)
    upper, lower = share(_UPPER), share(_LOWER)
    return [
        math.log1p(n),
        chars / n / 10,
        float(lengths.std()) / 10,
        upper / max(upper + lower, 1e-9),
        share(_PUNCTUATION),
        share(_SYMBOLS),
        share(_DIGITS),
        share(b"!?"),
        share(b"|"),
        len(counts) / n,
        len(counts) / math.sqrt(n) / 10,
        counts.most_common(1)[0][1] / n,
        sum(a == b for a, b in pairwise(words)) / n,
        repeated_words(words) / n,
        1 - len(set(lines)) / len(lines),
        math.log1p(n / len(lines)),
        sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
        len(_RUN.findall(text)) / n,
        sum(1 for w in words if w.isdigit()) / n,
        sum(len(w) > 30 for w in words) / n,
    ]


def feature_rows(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` and ``x``, the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=1024):
            found = [features(t) for t in part.column("_text").to_pylist()]
            yield pa.record_batch([*[part.column(c) for c in keep], pa.array(found, pa.list_(pa.float64()))], [*keep, "x"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return docs.select(*keep, as_bytes(text_col).alias("_text")).mapInArrow(run, f"{fields}, x array<double>")


class Network:
    """One hidden layer of tanh units over standardised features."""

    def __init__(self, mean, scale, weights):
        self.mean, self.scale, self.weights = mean, scale, weights

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


class Constant:
    """The score where there is nothing to learn from."""

    def __init__(self, value: float):
        self.value = value

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk, of logits: on positives, and on negatives before the cut at zero."""
    loss = lambda g: np.logaddexp(0, -g)
    return prior * loss(positive).mean(), loss(-unlabelled).mean() - prior * loss(-positive).mean()


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = SEED) -> Network | Constant:
    """Minimise the non-negative risk by Adam steps over all given rows."""
    if not len(positive):
        return Constant(0.0)
    if not len(unlabelled):
        return Constant(prior)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    n = positive.shape[1]
    weights = [rng.normal(0, 1 / math.sqrt(n), (n, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    network = Network(mean, scale, weights)
    xs = [np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    sigmoid = lambda g: 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    for step in range(1, steps + 1):
        a, b, c, d = weights
        hidden = [np.tanh(x @ a + b) for x in xs]
        gp, gu = hidden[0] @ c + d, hidden[1] @ c + d
        _, negative = risk(gp, gu, prior)
        if negative >= 0:
            slopes = [prior * (sigmoid(gp) - 1) / len(gp) - prior * sigmoid(gp) / len(gp), sigmoid(gu) / len(gu)]
        else:  # go back up on the negative part alone
            slopes = [prior * sigmoid(gp) / len(gp), -sigmoid(gu) / len(gu)]
        grads = [np.zeros_like(w) for w in weights]
        for x, h, slope in zip(xs, hidden, slopes):
            back = np.outer(slope, c) * (1 - h * h)
            for k, g in enumerate((x.T @ back, back.sum(axis=0), h.T @ slope, slope.sum())):
                grads[k] = grads[k] + g
        for k, w in enumerate(weights):
            g = grads[k] + DECAY * w
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = w - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    network.weights = weights
    return network


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED, doubt: float = 0.1) -> float:
    """The share of good rows among the unlabelled ones, from positives and unlabelled rows."""
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    prior = 0.5
    for _ in range(2):  # the second network is fitted with the first estimate
        network = fit(positive[::2], unlabelled[::2], prior, seed=seed)
        held = [np.sort(network.scores(x[1::2])) for x in (positive, unlabelled)]
        cuts = np.unique(held[0])
        reach = [1 - np.searchsorted(h, cuts, "left") / len(h) for h in held]
        margin = sum(math.sqrt(math.log(4 / doubt) / (2 * len(h))) for h in held)
        best = int(np.argmin((reach[1] + margin) / reach[0]))
        prior = float(np.clip(reach[1][best] / reach[0][best], 0.01, 0.99))
    return prior


def class_prior(labels: DataFrame, label_col: str = "quality") -> float | None:
    """Share of good rows among the labelled ones."""
    return labels.filter(F.col(label_col).isin(0, 1)).agg(F.avg(F.col(label_col).cast("double"))).first()[0]


def learn(docs: DataFrame, labels: DataFrame, prior: float | None = None, bound: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Network | Constant:
    """Fit on rows of ``docs``, all unlabelled, and those that ``labels`` trusts as good. Both must be training rows only."""
    judged = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_good"))
    good = judged.agg(F.min(label_col).alias("_least")).filter("_least = 1").select("_good")
    drawn = bounded(good, bound, F.col("_good"))
    known = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    # The drawn ids are bounded by the parameter.
    positive = feature_rows(known.join(F.broadcast(drawn), F.col("_id") == F.col("_good"), "left_semi"), ("_id",), "_t")
    unlabelled = feature_rows(bounded(known.select("_id", "_t"), bound, F.col("_id"), F.lit("unlabelled")), ("_id",), "_t")
    rows = lambda df: np.array([r["x"] for r in sorted(df.collect(), key=lambda r: (r["_id"], r["x"]))], np.float64).reshape(-1, N_FEATURES)
    xs = rows(positive), rows(unlabelled)
    return fit(*xs, estimated_prior(*xs) if prior is None else prior)


def score(docs: DataFrame, model: Network | Constant, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` with ``score`` and ``predicted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=1024):
            x = np.array([features(t) for t in part.column("_text").to_pylist()], np.float64).reshape(-1, N_FEATURES)
            found = model.scores(x)
            columns = [*[part.column(c) for c in keep], pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
            yield pa.record_batch(columns, [*keep, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return docs.select(*keep, as_bytes(text_col).alias("_text")).mapInArrow(run, f"{fields}, score double, predicted int")
