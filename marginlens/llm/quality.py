"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad by a two-state chain whose
unary potentials see the line's own features and those of its neighbours. The
forward-backward marginals of "good", weighted by line length, average to the
document's score.

Training: line labels are the label of their document. The field is fitted by
full-batch gradient ascent on at most ``TRAIN_DOCS`` labelled documents -- the
documented bound -- taken in the order of a hash of the id. Of rows repeating
an id one trains, the one with the least hash of its text, and of a document of
more than ``TRAIN_CHAINS`` chains of ``TRAIN_LINES`` lines that many, evenly
spaced. So what reaches the driver, the features of that sample, has a fixed
bound; scoring runs where the rows are, over every line.

Defined cases: null text is empty; an empty text is one empty line; rows tied
or repeated are scored alike; labels with a null quality are ignored and of
conflicting labels the lower counts; without labels every score is 0.5; id,
language, source and labels are never features.
"""
from __future__ import annotations

import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.common import driver_table, ship_package, text_or_empty

TRAIN_DOCS = 2000     # bound of the labelled sample
TRAIN_LINES = 32      # longer documents train as several chains
TRAIN_CHAINS = 16     # of which at most so many
THRESHOLD = 0.3
ROUNDS, RATE, L2 = 80, 0.15, 1e-3
N_FEATURES = 20

_DOUBLED = re.compile(r"([!-/:-@\[-`{-~])\1")
_UPPER, _DIGITS = string.ascii_uppercase.encode(), string.digits.encode()
_MARKS = string.punctuation.encode()


def line_features(lines: list[str]) -> np.ndarray:
    """One row per line; every value depends on this document's text only."""
    out = np.zeros((len(lines), N_FEATURES), np.float32)
    seen = Counter(lines)
    for i, line in enumerate(lines):
        n = len(line)
        words = line.split()
        if not words:
            out[i, 0] = 1.0
            continue
        k = len(words)
        counts = Counter(words)
        pairs = list(zip(words, words[1:]))
        raw = line.encode("utf-8", "replace")
        size = len(raw)
        out[i] = (
            0.0,
            np.log1p(n),
            np.log1p(k),
            1 - len(raw.translate(None, _UPPER)) / size,
            1 - len(raw.translate(None, _DIGITS)) / size,
            1 - len(raw.translate(None, _MARKS)) / size,
            sum(map(str.isupper, words)) / k,
            len(counts) / k,
            sum(a == b for a, b in pairs) / k,
            len(set(pairs)) / len(pairs) if pairs else 1.0,
            max(counts.values()) / k,
            (n - k + 1) / k / 10,
            len(_DOUBLED.findall(line)) / k,
            line.count("|") / k,
            sum(not w[-1].isalnum() for w in words) / k,
            line.rstrip()[-1:] in ".!?",
            words[0][:1].isupper(),
            (seen[line] - 1) / len(lines),
            i == 0,
            k <= 3,
        )
    return out


def chain_inputs(f: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Own, previous and next line's standardised features, edge marks and a constant."""
    z = np.clip((f - mean) / scale, -5, 5)
    n = len(z)
    before, after = np.zeros_like(z), np.zeros_like(z)
    before[1:], after[:-1] = z[:-1], z[1:]
    first, last = np.zeros((n, 1), z.dtype), np.zeros((n, 1), z.dtype)
    first[0], last[-1] = 1, 1
    return np.hstack([z, before, after, first, last, np.ones((n, 1), z.dtype)])


def marginals(unary: np.ndarray, trans: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains, for training.

    ``unary`` (chains, steps): log-potential of "good" (that of "bad" is 0);
    ``trans`` (2, 2). Returns P(good) per step and P(state, next state) per
    step but the last; both are meaningless beyond a chain's length.
    """
    chains, steps = unary.shape
    u = np.zeros((chains, steps, 2))
    u[:, :, 1] = unary
    a, b = np.zeros_like(u), np.zeros_like(u)
    a[:, 0] = u[:, 0]
    for t in range(1, steps):
        step = np.logaddexp(a[:, t - 1, 0, None] + trans[0], a[:, t - 1, 1, None] + trans[1]) + u[:, t]
        a[:, t] = np.where((t < length)[:, None], step, a[:, t - 1])
    for t in range(steps - 2, -1, -1):
        m = u[:, t + 1] + b[:, t + 1]
        step = np.logaddexp(m[:, 0, None] + trans[:, 0], m[:, 1, None] + trans[:, 1])
        b[:, t] = np.where((t + 1 < length)[:, None], step, 0.0)
    logz = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
    good = np.exp(np.minimum(a[:, :, 1] + b[:, :, 1] - logz[:, None], 0))
    joint = a[:, :-1, :, None] + trans + (u[:, 1:] + b[:, 1:])[:, :, None, :] - logz[:, None, None, None]
    return good, np.exp(np.minimum(joint, 0))


def chain_marginals(unary: list[float], trans: np.ndarray) -> list[float]:
    """P(good) per step of one chain of any length, from log-odds recursions."""
    (t00, t01), (t10, t11) = np.exp(trans).tolist()
    exp, log = math.exp, math.log

    def through(odds: float, n0: float, n1: float, d0: float, d1: float) -> float:
        if odds > 300:
            return log(n1 / d1)
        e = exp(max(odds, -300.0))
        return log((n0 + e * n1) / (d0 + e * d1))

    ahead = [0.0] * len(unary)
    odds = None
    for t, u in enumerate(unary):
        odds = u if odds is None else u + through(odds, t01, t11, t00, t10)
        ahead[t] = odds
    back = 0.0
    for t in range(len(unary) - 1, -1, -1):
        total = ahead[t] + back
        back = through(unary[t] + back, t10, t11, t00, t01)
        ahead[t] = 1 / (1 + exp(-max(min(total, 300.0), -300.0)))
    return ahead


def fit(features: list[np.ndarray], labels: list[int]) -> dict:
    """Weights of the field from per-document line features and labels."""
    width = N_FEATURES * 3 + 3
    if not features or len(set(labels)) < 2:
        return {"mean": np.zeros(N_FEATURES), "scale": np.ones(N_FEATURES), "w": np.zeros(width), "trans": np.zeros((2, 2))}
    stacked = np.vstack(features)
    mean, scale = stacked.mean(0), np.maximum(stacked.std(0), 1e-3)
    chains = [(chain_inputs(f, mean, scale)[a:a + TRAIN_LINES], y)
              for f, y in zip(features, labels) for a in range(0, len(f), TRAIN_LINES)]
    length = np.array([len(x) for x, _ in chains])
    y = np.array([v for _, v in chains], float)
    steps = int(length.max())
    x = np.zeros((len(chains), steps, width), np.float32)
    for i, (own, _) in enumerate(chains):
        x[i, :len(own)] = own
    live = np.arange(steps) < length[:, None]
    # each document counts once however many lines it has
    weight = (1 / length)[:, None] * live
    w, trans = np.zeros(width), np.zeros((2, 2))
    want = np.zeros((2, 2))
    np.add.at(want, (y.astype(int), y.astype(int)), (length - 1) / length)
    m = [np.zeros(width), np.zeros((2, 2))]
    v = [np.zeros(width), np.zeros((2, 2))]
    for k in range(1, ROUNDS + 1):
        good, joint = marginals(x @ w, trans, length)
        pair = np.einsum("ij,ijkl->kl", weight[:, 1:], joint)
        grads = [np.einsum("ij,ijk->k", weight * (y[:, None] - good), x) / len(chains) - L2 * w,
                 (want - pair) / len(chains) - 10 * L2 * trans]
        for j, (p, g) in enumerate(zip((w, trans), grads)):
            m[j] = 0.9 * m[j] + 0.1 * g
            v[j] = 0.999 * v[j] + 0.001 * g * g
            p += RATE * (m[j] / (1 - 0.9 ** k)) / (np.sqrt(v[j] / (1 - 0.999 ** k)) + 1e-8)
    return {"mean": mean, "scale": scale, "w": w, "trans": trans}


def score_text(text: str | None, model: dict) -> float:
    """Length-weighted mean of P(good) over the lines."""
    lines = (text or "").split("\n")
    x = chain_inputs(line_features(lines), model["mean"], model["scale"]) @ model["w"]
    weights = np.array([len(s) for s in lines], float)
    if not weights.any():
        weights[:] = 1
    good = np.array(chain_marginals(x.tolist(), model["trans"]))
    return float(np.clip((good * weights).sum() / weights.sum(), 0, 1))


def spaced_chains(f: np.ndarray) -> np.ndarray:
    """The features of at most ``TRAIN_CHAINS`` chains, evenly spaced."""
    starts = np.arange(0, len(f), TRAIN_LINES)
    if len(starts) <= TRAIN_CHAINS:
        return f
    kept = starts[np.linspace(0, len(starts) - 1, TRAIN_CHAINS).round().astype(int)]
    return np.concatenate([f[a:a + TRAIN_LINES] for a in kept])


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> dict:
    """Fit on at most ``most`` labelled documents outside the held-out fold."""
    ship_package(docs.sparkSession)
    sample = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    text = text_or_empty("text")
    rows = (docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
            .select("quality", "text"))

    def features(batches):
        for batch in batches:
            own = [spaced_chains(line_features(t.as_py().split("\n"))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), pa.array([f.astype("<f4").tobytes() for f in own], pa.binary())],
                names=["quality", "f"])

    got = rows.mapInArrow(features, "quality int, f binary").toPandas()
    # the rows come in task order: sort for a reproducible fit
    got = got.sort_values(["quality", "f"])
    return fit([np.frombuffer(f, "<f4").reshape(-1, N_FEATURES) for f in got["f"]], got["quality"].tolist())


def score_documents(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score; all columns pass through."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: score_text(t, model))

    return docs.withColumn(out, score(F.coalesce(F.col(text_col), F.lit(""))))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = driver_table(spark, sf_dir, "documents")
    model = train(docs, driver_table(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
