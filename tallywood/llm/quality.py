"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywood.llm.prefix import running_totals
from tallywood.llm.rows import ROW, bitmaps, numbered_rows, pick_rows
from tallywood.llm.tables import stored, stored_alone
from tallywood.llm.words import U, Slice, SpanHasher, Words, mix, runs, slices, sums_by_row, windows, words_of

CELLS = 1 << 16
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
TRUSTED_KEPT = 0.998
#: Different ratios that a task sorts in the mean, to find the threshold.
SORTED = 500_000
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
# UTF-8: every byte of a character but its first.
FOLLOWS = (np.arange(256) & 0xC0) == 0x80

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTED = pa.schema([("cell", pa.int32()), ("n", pa.int64())])
SCORED = pa.schema(
    [("doc_id", pa.int64()), *[(n, pa.int64()) for n in STATS], ("ratio", pa.float64())]
)

SCORED_SHAPE = f"doc_id bigint, {', '.join(f'{n} bigint' for n in STATS)}, ratio double"


def ngram_cells(words: Words, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and row of every word and every pair of words."""
    at, pairs = windows(words, 2)
    hashed = np.concatenate([words.hashes, pairs])
    return (hashed % U(cells)).astype(np.int64), np.concatenate([words.rows, words.rows[at]])


def repeated(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per position: is its key found in another place, and in an earlier one, of its row."""
    order = np.lexsort((keys, rows))
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    anywhere, earlier = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    earlier[order] = same[:-1]
    anywhere[order] = same[:-1] | same[1:]
    return anywhere, earlier


def base_stats(part: Slice, words: Words) -> dict[str, np.ndarray]:
    """The five statistics of every text of a slice."""
    n = len(part)
    inside = np.zeros(len(part.data) + 1, dtype=np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1  # where one text's last word meets the next text's first, both cancel
    in_word = np.cumsum(inside[:-1], dtype=np.int8) > 0
    line_starts, line_ends = runs(part.data != 10, part.offsets)
    with_word = np.searchsorted(words.starts, line_starts) < np.searchsorted(words.starts, line_ends)
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_rows = np.searchsorted(part.offsets, line_starts, "right") - 1
    _, again = repeated(SpanHasher(part.data)(line_starts, line_ends), line_rows)
    at, hashed = windows(words, WINDOW)
    twice, _ = repeated(hashed, words.rows[at])
    cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    return {
        "n_words": words.counts,
        "word_chars": sums_by_row(in_word & ~FOLLOWS[part.data], part.offsets),
        "n_symbols": sums_by_row(SYMBOLS[part.data], part.offsets),
        "n_dup_lines": np.bincount(line_rows[again], minlength=n),
        "n_repeat_words": sums_by_row(np.cumsum(cover[:-1]) > 0, words.firsts),
    }


def mean_ratios(words: Words, ratios: np.ndarray, n: int) -> np.ndarray:
    """Mean log ratio over the n-grams of each text; 0 for a text without words."""
    cells, rows = ngram_cells(words, len(ratios))
    total = np.bincount(rows, weights=ratios[cells], minlength=n)
    return total / np.maximum(np.bincount(rows, minlength=n), 1)


def _counter(cells: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for part in slices(batch.column(1)):
                totals += np.bincount(ngram_cells(words_of(part, lower=False), cells)[0], minlength=cells)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(totals[used])], schema=COUNTED)

    return count


def _scorer(ratios: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                words = words_of(part, lower=False)
                stats = base_stats(part, words)
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        *[pa.array(stats[n].astype(np.int64)) for n in STATS],
                        pa.array(mean_ratios(words, ratios, len(part))),
                    ],
                    schema=SCORED,
                )

    return score


def _mean_scorer(ratios: np.ndarray):
    """The mean ratios alone, of texts long enough to be kept."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                words = words_of(part, lower=False)
                found = mean_ratios(words, ratios, len(part))[words.counts >= LEAST_WORDS]
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["ratio"])

    return score


def labelled_ids(labels: DataFrame) -> DataFrame:
    """``doc_id, kind`` of every id labelled good and not toxic (``trusted`` or ``good``, half of them each) or ``bad``.

    An id with labels of both kinds is good.  The halves follow from the id alone.
    """
    quality, toxic = F.coalesce("quality", F.lit(-1)), F.coalesce("toxic", F.lit(0))
    good = (quality == 1) & (toxic == 0)

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            kinds = np.where(mix(ids.view(U)) % U(2) == 0, "trusted", "good")
            kinds[~batch.column(1).to_numpy(zero_copy_only=False)] = "bad"
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.string())], names=["doc_id", "kind"])

    return (
        labels.where(F.col("doc_id").isNotNull() & (good | (quality == 0)))
        .select(F.col("doc_id").cast("bigint"), good.alias("good"))
        .groupBy("doc_id")
        .agg(F.bool_or("good").alias("good"))
        .mapInArrow(halve, "doc_id bigint, kind string")
    )


def labelled_texts(docs: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """All rows of ``docs`` of each kind of :func:`labelled_ids`, picked where they lie: only ids are shuffled."""
    numbered = numbered_rows(docs)
    found = stored(
        numbered.select("doc_id", F.col(ROW).alias("row")).join(labelled_ids(labels), "doc_id").select("row", "kind"),
        "quality-labelled",
    )

    def of(kind: str) -> DataFrame:
        mine = found.where(F.col("kind") == kind).select("row", F.lit(1).alias("times"))
        return pick_rows(numbered, stored_alone(docs.sparkSession, lambda: bitmaps(mine), f"quality-{kind}"))

    return {kind: of(kind) for kind in ("trusted", "good", "bad")}


def log_ratios(docs: DataFrame, trusted: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Log of the probability among ``trusted`` rows over that among all documents, for each cell."""

    def counted(texts: DataFrame, name: str) -> DataFrame:
        return texts.mapInArrow(_counter(cells), "cell int, n bigint").select("cell", "n", F.lit(name).alias("of"))

    rows = (
        counted(docs, "raw")
        .union(counted(trusted, "trusted"))
        .groupBy("cell")
        .agg(*[F.sum(F.when(F.col("of") == name, F.col("n")).otherwise(0)) for name in ("raw", "trusted")])
        .collect()  # at most one row for each cell
    )
    totals = np.zeros((2, cells))
    for cell, raw, known in rows:
        totals[:, cell] = raw, known
    share = (totals + 0.5) / (totals.sum(axis=1, keepdims=True) + 0.5 * cells)
    return np.log(share[1]) - np.log(share[0])


def threshold_for(scores: DataFrame, trusted_kept: float) -> float:
    """The lowest ratio a kept text may have, from ``ratio, is_good`` of labelled texts.

    Of the cuts that keep ``trusted_kept`` of the good texts, the one that
    rejects most of the bad for the good it costs.  Without good texts, no cut.
    Ratios are sorted in pieces; the driver gets single rows.
    """
    tallies = scores.groupBy("ratio").agg(
        F.count_if("is_good").alias("good"), F.count_if(~F.col("is_good")).alias("bad")
    )
    pieces = max(1, -(-scores.count() // SORTED))
    tallies = stored(
        tallies.repartitionByRange(pieces, "ratio").withColumn("piece", F.spark_partition_id()), "quality-tallies"
    )
    totals = stored(
        running_totals(tallies, [], "piece", ["ratio"], {"good_below": "good", "bad_below": "bad"}), "quality-totals"
    )
    n_good, n_bad = totals.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in ("good", "bad")]).first()
    if not n_good:
        return float("-inf")
    # The quantile lies between two of the sorted good ratios, as numpy has it.
    place = (n_good - 1) * (1 - trusted_kept)
    first = int(place)
    upto = F.col("good_below") + F.col("good")
    near = totals.where("good > 0").agg(
        *[F.min(F.when(upto > n, F.col("ratio"))) for n in (first, min(first + 1, n_good - 1))]
    )
    most = float(np.quantile(np.array(near.first()), place - first))

    def gain(bad: Column, good: Column) -> Column:
        return bad / F.lit(max(1, n_bad)) - good / F.lit(n_good)

    below = totals.where(F.col("ratio") < most)
    at_most, best = below.agg(
        gain(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))),
        F.max(F.when(F.col("bad") > 0, F.struct(gain(F.col("bad_below"), F.col("good_below")).alias("gain"), -F.col("ratio")))),
    ).first()
    cut = -best[1] if best and best[0] >= at_most else most
    before = totals.where(F.col("ratio") < cut).agg(F.max("ratio")).first()[0]
    return cut if before is None else (cut + before) / 2


@dataclass
class Rules:
    """Log ratio of each cell, and the least mean ratio a kept text has."""

    ratios: np.ndarray
    threshold: float


def fit_rules(docs: DataFrame, labels: DataFrame, cells: int = CELLS, trusted_kept: float = TRUSTED_KEPT) -> Rules:
    """Rules from all documents (``doc_id, text``) and all labelled ones among them."""
    # Texts whose n-grams were counted as trusted look better than they are: the
    # threshold is set on the other half.
    texts = labelled_texts(docs, labels)
    ratios = log_ratios(docs, texts["trusted"], cells)
    good, bad = (
        texts[kind].mapInArrow(_mean_scorer(ratios), "ratio double").withColumn("is_good", F.lit(kind == "good"))
        for kind in ("good", "bad")
    )
    return Rules(ratios, threshold_for(stored(good.union(bad), "quality-scores"), trusted_kept))


def _two_columns(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    cells: int = CELLS,
    trusted_kept: float = TRUSTED_KEPT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, five statistics, ``ratio``, ``base_failed``, ``kept``.

    ``ratio`` is the mean, over all words and pairs of words of the whole
    text, of log(p_trusted / p_raw).  The n-grams are hashed to ``cells``
    cells; p_raw counts those of every document, p_trusted those of half of all
    documents labelled good and not toxic.  The threshold comes
    from the other half and all bad ones: it keeps at least
    ``trusted_kept`` of the good and, within that, tells good from bad best.  Every document is
    then held against that one number.  Of a frame that isn't a plain scan of
    Parquet files the two columns are stored first.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in
    8-word windows found twice.  A NULL or empty text has no words and fails.
    Documents without id are scored like others but count as unlabelled.
    Repeated rows are judged each.  Without labels only the base rules reject.
    No rows give no rows.  Other columns are not read.
    """
    source = _two_columns(docs, id_column, text_column)
    rules = fit_rules(source, labels, cells, trusted_kept)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return source.mapInArrow(_scorer(rules.ratios), SCORED_SHAPE).select(
        "doc_id",
        *STATS,
        "ratio",
        failed.alias("base_failed"),
        (~failed & (F.col("ratio") >= F.lit(rules.threshold))).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`quality_rules` keeps.

    Rows are judged where they are read; no text is shuffled.
    """
    rules = fit_rules(_two_columns(docs, id_column, text_column), labels)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(at)):
                words = words_of(part, lower=False)
                n, repeats = words.counts, base_stats(part, words)["n_repeat_words"]
                good = (n >= LEAST_WORDS) & (100 * repeats <= MOST_REPEATED * n)
                good &= mean_ratios(words, rules.ratios, len(part)) >= rules.threshold
                yield batch.slice(part.first, len(part)).filter(pa.array(good))

    # By place, as names with a dot in them can't be handed over.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, against the good ones among the labelled."""
    return quality_rules(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )
