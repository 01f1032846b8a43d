"""Language identification by a small convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.words import Slice, slices

WIDTHS, FILTERS = (2, 3, 4), 16
LENGTH, TRAIN_LENGTH, TRAIN_WINDOWS, PER_LANGUAGE = 256, 128, 8, 300
STEPS, BATCH, RATE, SEED = 900, 64, 0.01, 5
UNDETERMINED = "und"
#: Byte to class: 0 for breaks, a class for each letter of a-z, one for each byte beyond ASCII.
CLASSES = 155
CLASS_OF = np.zeros(256, dtype=np.uint8)
CLASS_OF[ord("a") : ord("z") + 1] = CLASS_OF[ord("A") : ord("Z") + 1] = np.arange(1, 27)
CLASS_OF[128:] = np.arange(27, CLASSES)

PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


@dataclass
class ByteNetwork:
    """``filters[w]`` has shape (w, classes, filters); then max pooling and softmax."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def tables(self) -> dict[int, list[np.ndarray]]:
        """The filters as sums over pairs of bytes: two bytes for each look-up."""
        made = {}
        for width, each in self.filters.items():
            made[width] = [
                (each[j][:, None] + each[j + 1][None]).reshape(-1, each.shape[2])
                if j + 1 < width
                else each[j]
                for j in range(0, width, 2)
            ]
        return made

    def log_probabilities(self, codes: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Of each language for each row of ``codes`` (windows of byte classes)."""
        pairs = codes[:, :-1].astype(np.int32) * CLASSES + codes[:, 1:]
        pooled = []
        for width, parts in tables.items():
            span = codes.shape[1] - width + 1
            total = None
            for k, part in enumerate(parts):
                j = 2 * k
                at = (pairs if j + 1 < width else codes)[:, j : j + span]
                found = part.take(at, axis=0)
                total = found if total is None else np.add(total, found, out=total)
            pooled.append(total.max(axis=1))
        return log_softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.weights + self.bias)


def log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def train(codes: np.ndarray, targets: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = SEED) -> ByteNetwork:
    """Fit by gradient descent (Adam) on windows ``codes`` of byte classes.

    Each step blanks the end of some windows, so that short texts are known too.
    Languages weigh the same, however many windows they have.
    """
    rng = np.random.default_rng(seed)
    net = ByteNetwork(
        languages,
        {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS},
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    params = [*net.filters.values(), net.weights, net.bias]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    odds = 1 / np.bincount(targets, minlength=len(languages)).astype(float)[targets]
    odds /= odds.sum()
    column = np.arange(FILTERS)
    for step in range(1, steps + 1):
        chosen = rng.choice(len(codes), BATCH, p=odds)
        x, y = codes[chosen].copy(), targets[chosen]
        ends = np.where(rng.random(BATCH) < 0.5, x.shape[1], rng.integers(12, x.shape[1] + 1, BATCH))
        x[np.arange(x.shape[1])[None] >= ends[:, None]] = 0
        pooled, places = [], []
        for width, each in net.filters.items():
            span = x.shape[1] - width + 1
            total = sum(each[j][x[:, j : j + span]] for j in range(width))
            at = total.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(total, at[:, None], axis=1)[:, 0])
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        error = np.exp(log_softmax(hidden @ net.weights + net.bias))
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ net.weights.T) * (hidden > 0)
        grads = []
        for k, (width, each) in enumerate(net.filters.items()):
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            grad = np.empty_like(each)
            for j in range(width):
                seen = np.take_along_axis(x, places[k] + j, axis=1).astype(np.int64)
                grad[j] = np.bincount(
                    (seen * FILTERS + column).ravel(), weights=part.ravel(), minlength=CLASSES * FILTERS
                ).reshape(CLASSES, FILTERS)
            grads.append(grad)
        grads += [hidden.T @ error, error.sum(axis=0)]
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def windows_of(part: Slice, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts of a slice, padded with breaks, and each one's row."""
    sizes = np.diff(part.offsets)
    counts = -(-sizes // length)
    codes = np.zeros(int(counts.sum()) * length, dtype=np.uint8)
    classes = CLASS_OF[part.data]
    start = np.concatenate([[0], np.cumsum(counts)[:-1]]) * length
    for to, low, size in zip(start.tolist(), part.offsets.tolist(), sizes.tolist()):
        codes[to : to + size] = classes[low : low + size]
    return codes.reshape(-1, length), np.repeat(np.arange(len(part)), counts)


def remainder_of_id(column: Column) -> Column:
    """crc32 of the id's text modulo 5; a NULL id counts as no text, which gives 0."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % 5


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some windows of each text, at places that its id decides."""
    for batch in batches:
        for i, (doc_id, lang, text) in enumerate(zip(*[c.to_pylist() for c in batch.columns])):
            body = (text or "").encode()
            rng = np.random.default_rng(abs(doc_id))
            last = max(0, len(body) - TRAIN_LENGTH)
            at = np.unique(rng.integers(0, last + 1, TRAIN_WINDOWS))
            cut = [body[a : a + TRAIN_LENGTH].ljust(TRAIN_LENGTH, b" ") for a in at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cut)), pa.array(cut, pa.binary())], names=["lang", "window"]
            )


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, steps: int = STEPS) -> ByteNetwork | None:
    """A network for ``docs`` (``doc_id, text, lang``); None if no row has a language.

    Learns from at most ``per_language`` documents of each language, those with
    the smallest hash of their id, and a few windows of each.
    """
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        docs.where("lang is not null and doc_id is not null")
        .select("doc_id", "lang")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= per_language)
        .select("doc_id", F.col("lang").alias("known"))
        .distinct()
    )
    cut = (
        docs.join(F.broadcast(chosen), "doc_id")
        .where("lang = known and text is not null")
        .select("doc_id", "lang", "text")
        .mapInArrow(_cutter, "lang string, window binary")
        .toPandas()  # at most per_language documents of a language, 8 windows each
        .sort_values(["lang", "window"])
    )
    if cut.empty:
        return None
    languages, targets = np.unique(cut["lang"].to_numpy().astype(str), return_inverse=True)
    codes = CLASS_OF[np.frombuffer(b"".join(cut["window"]), dtype=np.uint8)].reshape(len(cut), -1)
    return train(codes, targets, languages.tolist(), steps)


def _predictor(net: ByteNetwork | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else {}
        for batch in batches:
            for part in slices(batch.column(1), 1 << 18):
                letters = batch.column(2).slice(part.first, len(part)).to_numpy(zero_copy_only=False)
                if net:
                    codes, rows = windows_of(part, LENGTH)
                    found = np.zeros((len(codes), len(net.languages)))
                    for at in range(0, len(codes), 64):
                        found[at : at + 64] = net.log_probabilities(codes[at : at + 64], tables)
                    weight = (codes > 0).sum(axis=1).astype(float)
                    total = np.stack(
                        [np.bincount(rows, found[:, k] * weight, len(part)) for k in range(len(net.languages))], axis=1
                    )
                    share = np.exp(
                        log_softmax(total / np.maximum(np.bincount(rows, weight, len(part)), 1)[:, None])
                    )
                    best = share.argmax(axis=1)
                    names = np.where(letters, np.array(net.languages, dtype=object)[best], UNDETERMINED)
                    score = np.where(letters, share.max(axis=1), 0.0)
                else:
                    names, score = np.full(len(part), UNDETERMINED, dtype=object), np.zeros(len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, len(part)),
                        batch.column(3).slice(part.first, len(part)),
                        pa.array(names, pa.string()),
                        pa.array(score),
                    ],
                    schema=PREDICTED,
                )

    return predict


def identify_languages(
    docs: DataFrame,
    per_language: int = PER_LANGUAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    A network of byte filters of widths 2, 3 and 4, max pooling and softmax,
    trained in numpy on the driver with windows of at most ``per_language``
    labelled documents of each language, none of them held out (crc32 of the
    id's text is divisible by 5).  It reads every window of 256 bytes of every
    whole text; a text's log-probabilities are the mean of its windows',
    weighted by their letters.

    ``und`` with score 0 stands for a NULL text, one without any letter, and
    for everything if no document has a language.  A NULL id counts as held
    out.  Repeated rows are predicted each.  No rows give no rows.  Other
    columns are not read.
    """
    source = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).alias("lang"),
        (remainder_of_id(F.col(id_column)) == 0).alias("held_out"),
    )
    net = fit(source.where("not held_out"), per_language)
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return source.select("doc_id", "text", has_letter.alias("has_letter"), "held_out").mapInArrow(
        _predictor(net), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents."""
    return identify_languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
