"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import LOWER, NOT_LETTERS, Words, held_out, mix, powers, slices, split

PREFIXES = (4, 5, 6)  # bytes; word families share their beginning
MAX_POSITIVE = 4000  # confirmed toxic texts to learn from
MAX_UNLABELLED = 6000  # unlabelled texts for each classifier
CLASSIFIERS = 3
FEATURES = 4096  # of each classifier
TELLING = 3.0  # times as frequent in confirmed texts as in all
DEFAULT_PRIOR = 0.1  # where there are no labels at all
SHARES = 1 << 30


class Classifier(NamedTuple):
    feature: np.ndarray  # uint32, ascending
    weight: np.ndarray
    bias: float


def text_features(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of words and word beginnings, with repeats."""
    rows, hashes = [words.row], [words.hash]
    power = powers(max(PREFIXES))
    for k in PREFIXES:
        longer = words.length > k
        start = words.start[longer]
        value = np.zeros(len(start), np.uint64)
        for j in range(k):
            value += (LOWER[data[start + j]].astype(np.uint64) + np.uint64(1)) * power[j]
        rows.append(words.row[longer])
        hashes.append(mix(value + np.uint64(k)))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(32)).astype(np.uint32)


def distinct(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((rows.astype(np.uint64) << np.uint64(32)) | features)
    return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)


def sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(classifier, positive, text) to (classifier, positive, features)."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(2)):
            words = split(data, offsets, NOT_LETTERS)
            row, feature = distinct(*text_features(data, words))
            ends = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.view(np.int32)))
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), lists],
                names=["classifier", "positive", "features"],
            )


def choose_features(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features that confirmed texts have more often than the others."""
    seen, n_pos = np.unique(np.concatenate(positive), return_counts=True)
    often = n_pos >= max(3, len(positive) // 1000)
    seen, n_pos = seen[often], n_pos[often]
    pool, counts = np.unique(np.concatenate([*unlabelled, seen]), return_counts=True)
    n_unl = counts[np.searchsorted(pool, seen)] - 1
    ratio = ((n_pos + 0.5) / (len(positive) + 1)) / ((n_unl + 0.5) / (len(unlabelled) + 1))
    gain = n_pos * np.log(ratio)
    best = np.lexsort((seen, -gain))[:FEATURES]
    return np.sort(seen[best[ratio[best] >= TELLING]])


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    epochs: int = 100,
    batches: int = 4,
    rate: float = 0.05,
    decay: float = 0.2,
) -> Classifier:
    """Logistic classifier of least non-negative positive-unlabelled risk.

    With loss l, class prior p, confirmed texts P and unlabelled texts U the risk
    is p E_P l(g, +1) + max(0, E_U l(g, -1) - p E_P l(g, -1)).  The second part
    estimates the risk on clean texts, which cannot be below zero; where a batch
    says so, the step goes the other way, as it would only learn P by heart.
    """
    feature = choose_features(positive, unlabelled)
    rng = np.random.default_rng(1)

    def batch(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        place = [np.searchsorted(feature, t[np.isin(t, feature)]) for t in texts]
        row = np.repeat(np.arange(len(texts)), [len(p) for p in place])
        return np.concatenate([*place, np.zeros(0, np.int64)]), row, len(texts)

    def parts(texts: list[np.ndarray]) -> list:
        order = rng.permutation(len(texts))
        split_up = [order[i::batches] for i in range(min(batches, len(texts)))]
        return [batch([texts[i] for i in part]) for part in split_up]

    known, open_ = parts(positive), parts(unlabelled)
    theta = np.zeros(len(feature) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def slope(texts: tuple, of_score) -> np.ndarray:
        place, row, n = texts
        score = np.bincount(row, theta[place], n) + theta[-1]
        by_text = of_score(score) / n
        out = np.bincount(place, by_text[row], len(theta))
        out[-1] = by_text.sum()
        return out

    def loss_clean(texts: tuple) -> float:
        place, row, n = texts
        return np.logaddexp(0, np.bincount(row, theta[place], n) + theta[-1]).mean()

    def up(score: np.ndarray) -> np.ndarray:  # slope of l(g, -1)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))

    for step in range(1, epochs * len(open_) + 1):
        u, p = open_[step % len(open_)], known[step % len(known)]
        clean = slope(u, up) - prior * slope(p, up)
        if loss_clean(u) - prior * loss_clean(p) >= 0:
            grad = prior * slope(p, lambda s: up(s) - 1) + clean
        else:
            grad = -clean
        grad[:-1] += decay / len(positive) * theta[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Classifier(feature, theta[:-1], float(theta[-1]))


def fit_group(table: pa.Table, prior: float) -> pa.Table:
    """One classifier from its bounded sample."""
    flags = table.column("positive").to_numpy()
    texts = [np.asarray(x, np.int32).view(np.uint32) for x in table.column("features").to_pylist()]
    order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), texts[i].tobytes()))
    positive = [texts[i] for i in order if flags[i]]
    unlabelled = [texts[i] for i in order if not flags[i]]
    if not positive or not unlabelled:
        found = Classifier(np.zeros(0, np.uint32), np.zeros(0), float(np.log(prior / (1 - prior))))
    else:
        found = fit_nnpu(positive, unlabelled, prior)
    return pa.table(
        {
            "classifier": table.column("classifier")[:1],
            "feature": pa.array([found.feature.tobytes()], pa.binary()),
            "weight": pa.array([found.weight.tobytes()], pa.binary()),
            "bias": pa.array([found.bias]),
        }
    )


def score_texts(
    batches: Iterator[pa.RecordBatch], model: list[Classifier]
) -> Iterator[pa.RecordBatch]:
    """(row, text) to (row, score): the classifiers' mean probability."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            words = split(data, offsets, NOT_LETTERS)
            rows, features = text_features(data, words)
            score = np.zeros(hi - lo)
            for part in model:
                total = np.full(hi - lo, part.bias)
                if len(part.feature):
                    at = np.minimum(np.searchsorted(part.feature, features), len(part.feature) - 1)
                    hit = part.feature[at] == features
                    row, feature = distinct(rows[hit], at[hit].astype(np.uint32))
                    total += np.bincount(row, part.weight[feature], hi - lo)
                score += 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo), pa.array(score / max(1, len(model)))],
                names=["row", "score"],
            )


def learn(docs: DataFrame, labels: DataFrame, fold_count: int = 5) -> list[Classifier]:
    """Classifiers from confirmed toxic texts and unlabelled ones of the learning folds.

    At most MAX_POSITIVE confirmed texts, and MAX_UNLABELLED unlabelled ones for
    each of CLASSIFIERS classifiers, drawn by a hash of the id, are learnt from;
    each classifier fits its sample in one task.  Unlabelled means any text, its
    label unused.  The class prior is the toxic share of the labelled ids.
    """
    learning = ~held_out(F.col("doc_id"), fold_count) & F.col("doc_id").isNotNull()
    marks = labels.filter(learning & F.col("toxic").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known, toxic = marks.agg(
        F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("int")), F.lit(0))
    ).first()
    prior = min(max(toxic / known, 0.001), 0.9) if known else DEFAULT_PRIOR
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter(learning)
    n_texts = texts.count()

    def drawn(salt: str, wanted: int, total: int):
        draw = F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id")), F.lit(SHARES))
        return draw < int(SHARES * min(1.0, wanted / max(total, 1)))

    confirmed = marks.filter((F.col("toxic") == 1) & drawn("confirmed", MAX_POSITIVE, toxic))
    confirmed = confirmed.select("doc_id", F.lit(True).alias("confirmed")).limit(2 * MAX_POSITIVE)
    open_ = drawn("open", MAX_UNLABELLED * CLASSIFIERS, n_texts)
    sample = (
        texts.join(F.broadcast(confirmed), "doc_id", "left")
        .withColumn("open", open_)
        .filter("confirmed OR open")
        .limit(4 * MAX_POSITIVE + 2 * MAX_UNLABELLED * CLASSIFIERS)
    )
    every = F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1))
    turn = F.pmod(F.xxhash64(F.lit("turn"), F.col("doc_id")), F.lit(CLASSIFIERS)).cast("int")
    positive = sample.filter("confirmed").select(
        F.explode(every).alias("classifier"), F.lit(True).alias("positive"), "text"
    )
    unlabelled = sample.filter("open").select(turn, F.lit(False), "text")
    rows = positive.union(unlabelled)
    models = (
        rows.mapInArrow(sample_features, "classifier int, positive boolean, features array<int>")
        .groupBy("classifier")
        .applyInArrow(
            lambda table: fit_group(table, prior),
            "classifier int, feature binary, weight binary, bias double",
        )
    )
    found = [
        Classifier(np.frombuffer(m.feature, np.uint32), np.frombuffer(m.weight), m.bias)
        for m in models.orderBy("classifier").collect()
    ]
    return found or [
        Classifier(np.zeros(0, np.uint32), np.zeros(0), float(np.log(prior / (1 - prior))))
    ]


def score_documents(docs: DataFrame, model: list[Classifier]) -> DataFrame:
    """``docs`` as a struct ``row`` with ``score`` and ``predicted``."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, F.col("text").cast("binary").alias("text"))
    kind = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(partial(score_texts, model=model), kind)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only texts are scored; ids decide the folds.  A null or empty text has no
    features, so its score is that of the bias.  Without confirmed texts every
    score is the prior.  Ids with several labels are toxic if one says so; rows
    that repeat are scored alike, and equal scores need no order; a null id is scored but
    never learnt from.  Very long texts are scored whole, in slices; an empty table gives
    no rows; other columns are not looked at.
    """
    model = learn(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id"), 5).alias("held_out"),
        "score",
        "predicted",
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic."""
    return score_documents(docs, learn(docs, labels)).filter("predicted = 0").select("row.*")
