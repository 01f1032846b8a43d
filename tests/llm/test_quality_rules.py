"""Rules fitted on every labelled row, and the threshold over ratios sorted in pieces."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywood.llm import quality
from tallywood.llm.words import U, mix, slices, words_of


def plain_threshold(good, bad, kept):
    """The cut by hand, over all ratios at once."""
    if not len(good):
        return float("-inf")
    most = np.quantile(good, 1 - kept)
    cuts = np.unique(np.concatenate([[most], bad[bad < most]]))
    gains = [(bad < c).sum() / max(1, len(bad)) - (good < c).sum() / len(good) for c in cuts]
    cut = cuts[int(np.argmax(gains))]
    below = np.concatenate([good, bad])
    below = below[below < cut]
    return (cut + below.max()) / 2 if len(below) else cut


@pytest.mark.parametrize("n_good, n_bad, digits, kept", [(1500, 700, 9, 0.998), (900, 900, 2, 0.9), (1, 5, 9, 0.998), (0, 9, 3, 0.998)])
def test_threshold_in_pieces(spark, monkeypatch, n_good, n_bad, digits, kept):
    monkeypatch.setattr(quality, "SORTED", 400)
    rng = np.random.default_rng(n_good + n_bad)
    good, bad = rng.normal(0.2, 0.5, n_good).round(digits), rng.normal(-0.8, 0.6, n_bad).round(digits)
    made = [(float(r), True) for r in good] + [(float(r), False) for r in bad]
    scores = spark.createDataFrame(made, "ratio double, is_good boolean").repartition(3)
    assert quality.threshold_for(scores, kept) == plain_threshold(good, bad, kept)


def test_all_labelled_rows_count(spark, tmp_path):
    """More than 20,000 labelled rows of each kind; ids twice, labelled both ways, without document or NULL."""
    n, cells = 66_000, 512
    text = "case when id % 97 = 0 then null when id % 89 = 0 then 'few words' else concat_ws(' ', transform(sequence(0, 19 + id % 3), i -> concat('w', hash(id, i) & if(id % 3 = 0, 255, 511)))) end"
    docs = spark.range(n).selectExpr(f"{text} as text", "if(id % 5000 = 7, null, id % 65900) as doc_id")
    docs.repartition(6).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").select("doc_id", "text")
    labels = spark.range(n + 50).selectExpr("id as doc_id", "if(id % 3 = 0, 0, 1) as quality", "if(id % 50 = 1, 1, null) as toxic")
    labels = labels.union(spark.createDataFrame([(None, 1, 0), (None, 0, 0), (3, 1, 0), (3, 1, 0), (6, None, None)], "doc_id bigint, quality int, toxic int"))

    rows = docs.collect()
    part = next(slices(pa.array([r["text"] for r in rows]), 1 << 30))
    words = words_of(part, lower=False)
    found, row = quality.ngram_cells(words, cells)
    missing = np.array([r["doc_id"] is None for r in rows])
    ids = np.array([-1 if r["doc_id"] is None else r["doc_id"] for r in rows])
    good = ~missing & (((ids % 3 != 0) & (ids % 50 != 1)) | (ids == 3))
    bad = ~missing & (ids % 3 == 0) & ~good
    half = mix(ids.astype(np.int64).view(U)) % U(2) == 0
    counts = np.array([np.bincount(found, minlength=cells), np.bincount(found[(good & half)[row]], minlength=cells)])
    share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * cells)
    ratios = np.log(share[1]) - np.log(share[0])
    means = quality.mean_ratios(words, ratios, len(part))
    long = words.counts >= 20
    assert good.sum() > 40_000 and bad.sum() > 20_000

    rules = quality.fit_rules(docs, labels, cells)
    assert (rules.ratios == ratios).all()
    assert rules.threshold == plain_threshold(means[good & ~half & long], means[bad & long], 0.998)
    judged = quality.quality_rules(docs, labels, cells).where(F.col("kept")).count()
    assert 0 < judged < n


def test_no_text_is_shuffled(spark, tmp_path):
    spark.range(2_000).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 30) as text").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").select("doc_id", "text")
    labels = spark.range(2_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic")
    for texts in quality.labelled_texts(docs, labels).values():
        plan = texts._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert "tallywood-rows" not in plan
        assert texts.count() > 0
