"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; everything else is unlabelled web
text, good and bad mixed. The class prior (share of good text) is estimated
from the data: a first classifier tells positives from unlabelled rows, and
the prior is the lowest ratio, over score thresholds, of the unlabelled to the
positive share above (both measured on a held-back half, with a confidence
margin). The final model minimises the non-negative unbiased risk
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

Text measures come from every whole text in one pass, without a shuffle. The
fit uses a bounded sample of at most ``limit`` positives and ``limit``
unlabelled rows (lowest hash of the id: the same rows in every run); every row
is scored.

Defined results: null and empty texts have all measures 0 and get a score like
any other; without positives or without unlabelled rows every score is 0.5;
repeated rows are scored row by row, several labels of one id count as good if
one of them is; a null id is never labelled; an empty table gives no rows;
other columns pass through if ``keep`` names them, but columns named as an
output (held_out, score, predicted) are replaced.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, staged
from .rules import STOP_WORDS

MEASURES = (
    "log_words", "word_length", "symbols", "marks", "commas", "capitals", "digits", "wide", "distinct", "top_word",
    "echo", "stops", "short_words", "log_line", "dup_lines", "entropy",
)
MEASURED = "__measures"
OUTPUTS = ("held_out", "score", "predicted")
_STOPS = frozenset(STOP_WORDS)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOLS, _MARKS, _COMMAS = _class("#*$%&|<>@~^_=+\\{}[]"), _class("!?"), _class(".,;:'\"-()/")
_UPPER, _LOWER, _DIGIT = (_class(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_WIDE = np.arange(256) >= 128


def measure(text: str | None) -> np.ndarray:
    """The measures of one text."""
    out = np.zeros(len(MEASURES), np.float32)
    words = (text or "").split()
    if not words:
        return out
    n = len(words)
    data = text.encode()
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = max(1, sum(map(len, words)))
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = count[count > 0] / len(data)
    letters = max(1, int(count[_UPPER].sum() + count[_LOWER].sum()))
    out[:] = (
        np.log1p(n), chars / n, count[_SYMBOLS].sum() / n, count[_MARKS].sum() / n, count[_COMMAS].sum() / n,
        count[_UPPER].sum() / letters, count[_DIGIT].sum() / chars, count[_WIDE].sum() / len(data),
        len(seen) / n ** 0.8, max(seen.values()) / n, sum(map(operator.eq, words, words[1:])) / n,
        sum(seen[w] for w in _STOPS & seen.keys()) / n, sum(map((3).__gt__, map(len, words))) / n,
        np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), -float((share * np.log2(share)).sum()),
    )
    return out


def measured(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``MEASURED`` (32-bit floats, binary) of every row."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(MEASURED, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            new = pa.array([measure(t).tobytes() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], new], names=[*keep, MEASURED])

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


# ------------------------------------------------------------------ the model
@dataclass(frozen=True)
class Model:
    """A logistic model on indicator features of quantile bins; ``weights`` None: no evidence, 0.5."""

    edges: np.ndarray | None
    weights: np.ndarray | None
    prior: float

    def features(self, x: np.ndarray) -> np.ndarray:
        """Thermometer code: for each measure and edge, whether the measure is above the edge; then 1."""
        return np.concatenate([(x[:, :, None] > self.edges[None]).reshape(len(x), -1), np.ones((len(x), 1))],
                              axis=1).astype(np.float32)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.features(x) @ self.weights, -30, 30).astype(np.float64)))


def _descend(x_p, x_u, grad, steps: int = 400, rate: float = 0.03, decay: float = 1e-4) -> np.ndarray:
    """Adam on the weights; ``grad`` gives the risk's derivatives by the two margins."""
    w = np.zeros(x_p.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        d_p, d_u = grad(x_p @ w, x_u @ w)
        g = x_p.T @ d_p + x_u.T @ d_u + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(score_p: np.ndarray, score_u: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of rows not used in the fit."""
    grid = np.unique(np.quantile(score_p, np.linspace(0, 0.95, 96)))
    q_p = np.array([(score_p >= c).mean() for c in grid])
    q_u = np.array([(score_u >= c).mean() for c in grid])
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(score_u)) + 1 / np.sqrt(len(score_p)))
    best = int(np.argmin((q_u + margin) / q_p))
    return float(np.clip(q_u[best] / q_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, bins: int = 12) -> Model:
    """Estimate the prior, then minimise the non-negative risk with the logistic loss."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return Model(None, None, 0.5)
    edges = np.quantile(unlabelled, np.linspace(0, 1, bins + 1)[:-1], axis=0).T.astype(np.float32)
    coder = Model(edges, None, 0.5)
    x_p, x_u = coder.features(positive), coder.features(unlabelled)

    def tell_apart(z_p, z_u):
        return (_sigmoid(z_p) - 1) / len(z_p), _sigmoid(z_u) / len(z_u)

    first = _descend(x_p[::2], x_u[::2], tell_apart, steps=200)
    prior = estimate_prior(x_p[1::2] @ first, x_u[1::2] @ first)

    def non_negative(z_p, z_u):
        as_negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        d_neg_u, d_neg_p = _sigmoid(z_u) / len(z_u), -prior * _sigmoid(z_p) / len(z_p)
        if as_negative < 0:  # the estimate of a risk cannot be negative: step back from over-fitting
            return -d_neg_p, -d_neg_u
        return prior * (_sigmoid(z_p) - 1) / len(z_p) + d_neg_p, d_neg_u

    return Model(edges, _descend(x_p, x_u, non_negative), prior)


# ------------------------------------------------------------------ on tables
def _sample(df: DataFrame, limit: int) -> np.ndarray:
    """Measures of the (at most) ``limit`` rows with the lowest hashes of their ids.

    Hashes are spread evenly, so a bound that half as many rows again stay
    under is known from the count; only rows under it are sorted.
    """
    n = df.count()
    rows = df.select(F.xxhash64("doc_id").alias("h"), MEASURED)
    if n > 2 * limit:
        rows = rows.where(F.col("h") <= int(-(2**63) + (1.5 * limit / n) * 2**64))
    rows = rows.orderBy("h", MEASURED).limit(limit).collect()
    return np.array([np.frombuffer(r[MEASURED], np.float32) for r in rows], np.float32).reshape(-1, len(MEASURES))


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, limit: int = 20_000,
             threshold: float = 0.3, folds: int = 5) -> DataFrame:
    """Columns ``keep`` (default doc_id) of every document with held_out, score and predicted.

    ``labels`` has (doc_id, quality); rows of the fold 0 (``held_out``) take no
    part in the fit. At most ``limit`` positives and ``limit`` unlabelled rows
    of (16 floats each) meet on the driver.
    """
    keep = [c for c in keep or ["doc_id"] if c not in OUTPUTS]
    rows = staged(measured(docs, list(dict.fromkeys(["doc_id", *keep]))), "pu-measures")
    train = rows.where(fold(F.col("doc_id"), folds) != 0).select("doc_id", MEASURED)
    good = labels.where("quality = 1").select("doc_id").distinct()
    model = fit(_sample(train.join(good, "doc_id", "left_semi"), limit), _sample(train, limit))
    schema = T.StructType([rows.schema[c] for c in rows.columns if c != MEASURED] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()), np.float32)
            score = model.score(x.reshape(-1, len(MEASURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], names=schema.names)

    scored = rows.mapInArrow(run, schema)
    return scored.select(*keep, (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
