"""Language identification by averaged hashed subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import LOWER, NOT_LETTERS, held_out, slices

BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (2, 3, 4)  # bytes
MAX_TEXTS = 4000  # learnt from, all languages together, but at least one of each
MAX_TEXTS_EACH = 600
REJECTED = 0.002  # share of calibration texts that may fall below the threshold
UNDETERMINED = "und"
SHARES = 1 << 30

# Letters by themselves, everything else one boundary.
CLASSES = LOWER.astype(np.uint32) + 1
CLASSES[NOT_LETTERS] = 0
CLASSES[ord("0") : ord("9") + 1] = 0


class Model(NamedTuple):
    languages: list[str]
    embedding: np.ndarray  # BUCKETS x DIMENSIONS
    output: np.ndarray  # DIMENSIONS x languages
    temperature: float
    threshold: float


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, buckets of all subwords and the number of them before each text.

    A subword lies within a word; a boundary may be its first or last byte.  Each
    text is met with a boundary before and after it.
    """
    n = len(offsets) - 1
    padded = np.zeros(len(data) + n + 1, np.uint32)
    shift = np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded[np.arange(len(data)) + shift] = CLASSES[data]
    begins = offsets + np.arange(n + 1)  # of each text's leading boundary
    for k in GRAMS:
        count = len(padded) - k + 1
        if count <= 0:
            yield np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
            continue
        value = np.zeros(count, np.uint32)
        whole = np.ones(count, bool)
        for j in range(k):
            part = padded[j : j + count]
            value = (value + part) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
            if 0 < j < k - 1:
                whole &= part > 0
        if k == 2:
            whole &= (padded[:count] > 0) | (padded[1 : 1 + count] > 0)
        value = (value * np.uint32(0x85EBCA6B + 2 * k)) >> np.uint32(16)
        places = np.flatnonzero(whole)
        yield value[places].astype(np.int32), np.searchsorted(places, begins)


def sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, draw, text) to (lang, draw, buckets, counts)."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(2)):
            keys = []
            for bucket, ends in subwords(data, offsets):
                row = np.repeat(np.arange(hi - lo), np.diff(ends))
                keys.append(row.astype(np.int64) * BUCKETS + bucket[: ends[-1]])
            key, count = np.unique(np.concatenate(keys), return_counts=True)
            ends = pa.array(np.searchsorted(key, np.arange(hi - lo + 1) * BUCKETS), pa.int32())
            yield pa.record_batch(
                [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(1).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(ends, pa.array((key % BUCKETS).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))),
                ],
                names=["lang", "draw", "buckets", "counts"],
            )


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(
    texts: list[tuple[np.ndarray, np.ndarray]],
    classes: np.ndarray,
    languages: list[str],
    epochs: int = 12,
    rate: float = 0.5,
    batch: int = 16,
) -> Model:
    """Stochastic gradient descent on random parts of texts, from a few subwords to many,
    so that short texts are learnt as well as long ones.  Every fifth text is kept for
    the temperature and the threshold."""
    rng = np.random.default_rng(9)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, len(languages)), np.float32)
    usable = np.array([i for i, t in enumerate(texts) if len(t[0])], np.int64)
    kept = usable[::5] if len(usable) >= 20 else usable
    learnt = np.setdiff1d(usable, kept) if len(usable) >= 20 else usable
    shares = np.bincount(classes[learnt], minlength=len(languages)) if len(learnt) else None

    def part(i: int) -> tuple[np.ndarray, np.ndarray]:
        bucket, count = texts[i]
        size = int(2 ** rng.uniform(2, 8))
        if size < len(bucket):
            chosen = rng.choice(len(bucket), size, replace=False)
            bucket, count = bucket[chosen], count[chosen]
        return bucket, (count / count.sum()).astype(np.float32)

    steps, step = max(1, epochs * len(learnt) // batch), 0
    for _ in range(epochs if len(learnt) else 0):
        odds = 1.0 / shares[classes[learnt]]
        order = rng.choice(learnt, len(learnt), p=odds / odds.sum())
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            parts = [part(i) for i in rows]
            bucket = np.concatenate([p[0] for p in parts])
            weight = np.concatenate([p[1] for p in parts])[:, None]
            ends = np.cumsum([0, *(len(p[0]) for p in parts)])
            hidden = np.add.reduceat(embedding[bucket] * weight, ends[:-1], axis=0)
            error = softmax(hidden @ output)
            error[np.arange(len(rows)), classes[rows]] -= 1
            speed = np.float32(rate * (1 - step / (steps + 1)))
            back = error @ output.T
            output -= speed * (hidden.T @ error)
            np.subtract.at(
                embedding, bucket, speed * weight * np.repeat(back, np.diff(ends), axis=0)
            )
            step += 1

    def logits(i: int, size: int | None) -> np.ndarray:
        bucket, count = texts[i]
        if size and size < len(bucket):
            chosen = rng.choice(len(bucket), size, replace=False)
            bucket, count = bucket[chosen], count[chosen]
        return (count / count.sum()) @ embedding[bucket] @ output

    if not len(kept):
        return Model(languages, embedding, output, 1.0, 0.0)
    short = np.array([logits(i, size) for i in kept for size in (8, 32, None)])
    truth = np.repeat(classes[kept], 3)
    scales = 2.0 ** np.arange(-6, 3.5, 0.5)

    def surprise(t: float) -> float:
        chance = softmax(short / t)[np.arange(len(truth)), truth]
        return float(-np.log(chance + 1e-12).mean())

    temperature = float(min(scales, key=surprise))
    whole = softmax(short[2::3] / temperature).max(axis=1)
    threshold = min(0.5, float(np.quantile(whole, REJECTED)))
    return Model(languages, embedding, output, temperature, threshold)


def fit_group(table: pa.Table, languages: list[str]) -> pa.Table:
    place = {name: i for i, name in enumerate(languages)}
    rows = sorted(
        zip(*(table.column(c).to_pylist() for c in ("draw", "lang", "buckets", "counts")), strict=True)
    )
    texts = [(np.array(b, np.int64), np.array(c, np.float64)) for _, _, b, c in rows]
    found = train(texts, np.array([place[x] for _, x, _, _ in rows], np.int64), languages)
    return pa.table(
        {
            "embedding": pa.array([found.embedding.tobytes()], pa.binary()),
            "output": pa.array([found.output.tobytes()], pa.binary()),
            "temperature": pa.array([found.temperature]),
            "threshold": pa.array([found.threshold]),
        }
    )


def predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(row, text) to (row, lang_pred, score): the most probable language of each text.

    The average of embeddings and the output are both linear, so whichever has
    fewer columns is summed over the text.
    """
    narrow = len(model.languages) <= DIMENSIONS
    table = model.embedding @ model.output if narrow else model.embedding
    columns = [np.ascontiguousarray(c) for c in table.T.astype(np.float64)]
    names = np.array(model.languages, object)
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            total = np.zeros((hi - lo, len(columns)))
            number = np.zeros(hi - lo)
            for bucket, ends in subwords(data, offsets):
                number += np.diff(ends)
                for c, column in enumerate(columns):
                    sums = np.concatenate([[0.0], np.cumsum(column[bucket])])
                    total[:, c] += sums[ends[1:]] - sums[ends[:-1]]
            mean = total / np.maximum(number, 1)[:, None]
            logits = mean if narrow else mean @ model.output.astype(np.float64)
            chance = softmax(logits / model.temperature)
            best = chance.argmax(axis=1)
            yield pa.record_batch(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(names[best], pa.string()),
                    pa.array(chance[np.arange(hi - lo), best]),
                ],
                names=["row", "lang_pred", "score"],
            )


def learn(docs: DataFrame, fold_count: int = 5) -> Model | None:
    """A model from at most MAX_TEXTS whole texts of the learning folds with a language.

    Every language is learnt, from MAX_TEXTS_EACH of its texts at most, and from one
    at least; they are drawn by a hash of id and text, and ordered by it, so reruns agree.
    None without any text.
    """
    learning = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), fold_count)
    )
    counts = learning.groupBy("lang").count()
    names = [r["lang"] for r in counts.select("lang").collect()]  # one row per language
    if not names:
        return None
    each = max(1, min(MAX_TEXTS_EACH, MAX_TEXTS // len(names)))
    # Enough to find that many in order, and so few that no task sorts many texts.
    share = F.least(F.lit(1.0), F.lit(4 * each + 20) / F.col("count"))
    draw = F.pmod(F.xxhash64(F.lit("lang"), F.col("doc_id"), F.col("text")), F.lit(SHARES))
    drawn = learning.select("lang", "text", draw.alias("draw"), "doc_id")
    drawn = drawn.join(F.broadcast(counts), "lang").filter(F.col("draw") < share * SHARES)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    sample = drawn.withColumn("place", place).filter(F.col("place") <= each)
    rows = sample.select("lang", "draw", F.col("text").cast("binary").alias("text"))
    languages = sorted(names)
    fitted = (
        rows.mapInArrow(
            sample_counts, "lang string, draw long, buckets array<int>, counts array<int>"
        )
        .withColumn("model", F.lit(0))
        .groupBy("model")
        .applyInArrow(
            lambda table: fit_group(table, languages),
            "embedding binary, output binary, temperature double, threshold double",
        )
        .first()
    )
    return Model(
        languages,
        np.frombuffer(fitted.embedding, np.float32).reshape(BUCKETS, DIMENSIONS),
        np.frombuffer(fitted.output, np.float32).reshape(DIMENSIONS, len(languages)),
        fitted.temperature,
        fitted.threshold,
    )


def identify_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` as a struct ``row`` with ``lang_pred``, ``score`` and ``accepted``."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        found = docs.select(own, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
        return found.withColumn("accepted", F.lit(False))
    rows = docs.select(F.struct(own, letters.alias("letters")).alias("row"), F.col("text").cast("binary").alias("text"))
    kind = T.StructType(
        [
            rows.schema["row"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    found = rows.mapInArrow(partial(predict, model=model), kind)
    known = F.col("row.letters")
    return found.select(
        F.col("row.row").alias("row"),
        F.when(known, F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        (known & (F.col("score") >= model.threshold)).alias("accepted"),
    )


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) for every row of ``docs``.

    ``lang_pred`` is one of the languages learnt from, or ``und`` with score 0 for
    a text that is null or has no letter.  ``score`` is the calibrated probability,
    and ``accepted`` is false for ``und`` and below the calibrated threshold.
    Of languages alike the first by name is told.  Without any labelled text all are
    ``und``.  Repeated rows are judged alike; a null id is judged but never learnt from.
    Very long texts are judged whole; an empty table gives no rows.  ``lang``,
    ``source`` and ``doc_id`` are no inputs of a prediction; other columns are not looked at.
    """
    model = learn(docs)
    found = identify_documents(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id"), 5).alias("held_out"),
        "lang_pred",
        "score",
        "accepted",
    )


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language was told with enough confidence."""
    return identify_documents(docs, learn(docs)).filter("accepted").select("row.*")
