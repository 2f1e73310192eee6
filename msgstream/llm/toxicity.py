"""Toxicity by a classifier chain: each category's linear model also sees the categories before it."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from msgstream.scratch import stored

# Labelled documents that the models are fitted on, at most (on average of the hash that picks them), the
# tokens they may weigh, and the documents of the sample that must hold a token.
FIT_ROWS = 20_000
TOKENS = 2048
LEAST_DOCS = 5
FOLDS = 2
PREFIXES = (4, 5)
# Penalty on squared weights, and the most steps of a fit.
L2 = 2e-4
STEPS = 60
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}

LETTERS = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> set[str]:
    """Distinct lower-case words of letters, and the beginnings of words, which inflected forms share."""
    words = set(LETTERS.findall((text or "").lower()))
    starts = {f"^{word[:n]}" for n in PREFIXES for word in words}
    return words | starts


@dataclass
class Linear:
    """A linear model: tokens it weighs, weights of the categories before it, intercept."""

    weights: dict[str, float]
    earlier: list[float]
    intercept: float

    def probability(self, held: set[str], before: list[float]) -> float:
        z = self.intercept + sum(w * p for w, p in zip(self.earlier, before, strict=True))
        z += sum(self.weights[token] for token in sorted(held & self.weights.keys()))
        return 1 / (1 + exp(-z)) if z > -700 else 0.0


@dataclass
class Constant:
    """A category that has but one class in the labels."""

    value: float

    def probability(self, held: set[str], before: list[float]) -> float:
        return self.value


@dataclass
class Chain:
    """Models in order of their categories, and the probability of the last from which it counts as found."""

    categories: list[str]
    models: list[Linear | Constant]
    threshold: float = 0.5

    def probabilities(self, text: str | None) -> list[float]:
        held, before = tokens(text), []
        for model in self.models:
            before.append(model.probability(held, before))
        return before


def _with_tokens(df: DataFrame) -> DataFrame:
    """The rows with ``tokens`` in place of ``text``, their last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                held = pa.array([sorted(tokens(text)) for text in part.column(part.num_columns - 1).to_pylist()], pa.list_(pa.string()))
                names = [*part.schema.names[:-1], "tokens"]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], held], names)

    schema = T.StructType([*df.schema.fields[:-1], T.StructField("tokens", T.ArrayType(T.StringType()))])
    return df.mapInArrow(run, schema)


def _with_places(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The rows with ``held``, the places in the vocabulary of those tokens that are in it, instead of ``tokens``, the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.string())
        for batch in batches:
            tokens = batch.column(batch.num_columns - 1)
            places = pc.index_in(tokens.flatten().cast(pa.string()), value_set=known)
            before = np.append(0, np.cumsum(places.is_valid().to_numpy(zero_copy_only=False)))
            starts = before[tokens.offsets.to_numpy() - tokens.offsets[0].as_py()]
            held = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), places.drop_null())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], held], [*batch.schema.names[:-1], "held"])

    schema = T.StructType([*df.schema.fields[:-1], T.StructField("held", T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(run, schema)


def _vocabulary(sample: DataFrame, categories: list[str], size: int) -> list[str]:
    """The tokens that tell the classes of a category apart best, by chi square; at most ``size`` of them."""
    held = sample.select(*categories, F.explode("tokens").alias("token"))
    counts = held.groupBy("token").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories])
    totals = sample.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    chosen: set[str] = set()
    for c in categories:
        share = (totals[c] or 0.0) / max(1, totals["n"])
        expected = F.col("n") * share
        spread = F.lit(max(share * (1 - share), 1e-12)) * F.col("n")
        score = F.pow(F.col(c) - expected, 2) / spread
        best = counts.where(F.col("n") >= LEAST_DOCS).orderBy(score.desc(), "token").limit(size // len(categories))
        chosen.update(row["token"] for row in best.select("token").collect())
    return sorted(chosen)


def logistic(indices: np.ndarray, starts: np.ndarray, extra: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Weights of tokens, then of the ``extra`` columns, then the intercept, of a logistic regression with a
    small L2 penalty, by L-BFGS. Row k holds the tokens ``indices[starts[k]:starts[k + 1]]``. Both classes
    weigh the same, so that a rare one is not drowned by the intercept."""
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share))
    n, rows = len(y), np.repeat(np.arange(len(y)), np.diff(starts))
    m = extra.shape[1]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(rows, weights=w[indices], minlength=n) + extra @ w[size : size + m] + w[-1]
        r = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gradient = np.concatenate([np.bincount(indices, weights=r[rows], minlength=size), extra.T @ r, [r.sum()]])
        penalty = np.append(np.full(size + m, L2), 0.0) * w
        return float((weight * (np.logaddexp(0, z) - y * z)).mean() + 0.5 * penalty @ w), gradient + penalty

    w = np.zeros(size + m + 1)
    value, gradient = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        q, alphas = gradient.copy(), []
        for s, t in reversed(steps):
            alphas.append((s @ q) / (s @ t))
            q -= alphas[-1] * t
        if steps:
            q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])
        for (s, t), alpha in zip(steps, reversed(alphas), strict=True):
            q += s * (alpha - (t @ q) / (s @ t))
        rate, slope = 1.0, gradient @ q
        while rate > 1e-8:
            new_value, new_gradient = loss(w - rate * q)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, t = -rate * q, new_gradient - gradient
        done = value - new_value < 1e-7
        w, value, gradient = w + s, new_value, new_gradient
        if s @ t > 1e-12:
            steps = [*steps[-9:], (s, t)]
        if done:
            break
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts the classes best, by F1: the middle between the last found and the next."""
    order = np.argsort(-p, kind="stable")
    f1 = 2 * np.cumsum(y[order]) / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    following = p[order][best + 1] if best + 1 < len(y) else 0.0
    return float((p[order][best] + following) / 2)


def _chain_of(
    labels: np.ndarray, fold: np.ndarray, held: list[np.ndarray], vocabulary: list[str], folds: int
) -> tuple[list, float]:
    """The models of the chain, in order, from a sample's labels, folds and tokens held, and the threshold."""
    size, counts = len(vocabulary), np.array([len(h) for h in held], np.int64)
    models, before = [], np.zeros((len(held), 0))

    def fit(which: np.ndarray, k: int) -> np.ndarray | float:
        y = labels[which, k]
        if not len(y) or y.min() == y.max():
            return float(y[0]) if len(y) else 0.0
        own = np.concatenate([held[i] for i in which])
        return logistic(own, np.append(0, np.cumsum(counts[which])), before[which], y, size)

    def predict(model: np.ndarray | float, which: np.ndarray) -> np.ndarray:
        if isinstance(model, float):
            return np.full(len(which), model)
        z = np.array([model[held[i]].sum() for i in which]) + before[which] @ model[size:-1] + model[-1]
        return 1 / (1 + np.exp(-z))

    everyone = np.arange(len(held))
    for k in range(labels.shape[1]):
        model = fit(everyone, k)
        if isinstance(model, float):
            models.append({"value": model})
        else:
            words = {t: float(w) for t, w in zip(vocabulary, model, strict=False) if w}
            models.append({"weights": words, "earlier": model[size:-1].tolist(), "intercept": float(model[-1])})
        out_of_fold = np.zeros(len(held))
        for f in range(folds):
            inside = np.flatnonzero(fold == f)
            out_of_fold[inside] = predict(fit(np.flatnonzero(fold != f), k), inside)
        before = np.column_stack([before, out_of_fold])
    last = labels[:, -1]
    return models, best_threshold(before[:, -1], last) if last.min() < last.max() else 0.5


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, fit_rows: int = FIT_ROWS,
    folds: int = FOLDS, size: int = TOKENS,
) -> Chain:
    """Fits the chain on labelled documents.

    ``categories`` names each category and the expression over ``labels`` that is 1 where it holds, in order
    of the chain. A model sees which tokens a text holds and the probabilities of the categories before its
    own. For the fit these are out-of-fold: a document's comes from a model that saw neither it nor a copy, as
    folds go by the hash of the text. The models kept for scoring are fitted on all of the sample.

    About ``fit_rows`` labelled ids at most are used, those of smallest hash, so the list of them is small
    enough to broadcast. Ids that occur more than once in ``labels`` count as positive if any row says so;
    NULL labels and ids take no part.
    """
    categories = CATEGORIES if categories is None else categories
    names = list(categories)
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.max(F.expr(rule).cast("double")).alias(name) for name, rule in categories.items()]
    ).dropna()
    total, steps = known.count(), 1 << 20
    below = min(steps, steps * fit_rows // max(1, total))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < below)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    fold = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(folds)).cast("int")
    sample = stored(_with_tokens(texts.select(*names, fold.alias("fold"), "text")), "toxicity-sample")
    vocabulary = _vocabulary(sample, names, size)
    if not vocabulary:
        shares = sample.agg(*[F.avg(name) for name in names]).first()
        return Chain(names, [Constant(float(round(share or 0.0))) for share in shares])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, fold_of, held = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns = batch.slice(at, 256).to_pydict()
                rows += list(zip(*(columns[name] for name in names), strict=True))
                fold_of += columns["fold"]
                held += [np.array(own, np.int64) for own in columns["held"]]
        models, threshold = _chain_of(np.array(rows), np.array(fold_of), held, vocabulary, folds)
        yield pa.RecordBatch.from_pydict({"models": [json.dumps(models)], "threshold": [threshold]})

    # The sample is bounded, so one task fits the whole chain, and is sent no more of it than the models weigh; rows
    # in one order make it the same each time.
    placed = _with_places(sample.select(*names, "fold", F.xxhash64("tokens").alias("tokens_hash"), "tokens"), vocabulary)
    in_order = placed.repartition(1).sortWithinPartitions("fold", *names, "tokens_hash")
    fitted = in_order.select(*names, "fold", "held").mapInArrow(run, "models string, threshold double").first()
    models = json.loads(fitted["models"])
    models = [Constant(m["value"]) if "value" in m else Linear(**m) for m in models]
    return Chain(names, models, fitted["threshold"])


def judged(docs: DataFrame, labels: DataFrame, reject_at: float | None = None, **settings) -> DataFrame:
    """All rows and columns of ``docs`` with ``p_<category>`` of each category and ``rejected``.

    A document is rejected where the chain's last category reaches ``reject_at``; left out, it is the
    probability that parts the labelled sample best, each document judged by a model that has not seen it.
    Documents are scored in one pass without a shuffle. A text without letters, NULL or empty ones too, gets the models' intercepts and is
    never rejected. A text of any length is read whole. Without labels a category's probability is 0; with
    labels of one class it is that class. Repeated rows and equal texts are judged alike. No rows give none.
    Columns of ``docs`` that bear a name of the result give way.
    """
    chain = fit_chain(docs, labels, **settings)
    reject_at = chain.threshold if reject_at is None else reject_at
    added = [f"p_{name}" for name in chain.categories]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in [*added, "rejected"]])
    place = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(place).to_pylist()
                p = np.array([chain.probabilities(text) for text in texts])
                worded = np.array([bool(text) and LETTERS.search(text) is not None for text in texts])
                rejected = (p[:, -1] >= reject_at) & worded
                columns = [*part.columns, *[pa.array(np.round(x, 6)) for x in p.T], pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *added, "rejected"])

    fields = [*[T.StructField(c, T.DoubleType()) for c in added], T.StructField("rejected", T.BooleanType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    rows = numbered.withColumnsRenamed({f"c{docs.columns.index(name)}": name for name in ("doc_id", "text")})
    kept = judged(rows, labels, **settings).where(~F.col("rejected")).select(rows.columns)
    return kept.toDF(*docs.columns)
