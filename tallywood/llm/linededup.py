"""Repeated runs of lines, found in the suffix order of line ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.prefix import hash_piece, piece_bits, running_totals
from tallywood.llm.tables import stored
from tallywood.llm.text import word_count

MIN_WORDS = 50
ROWS_PER_PIECE = 50_000


def line_table(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, row, at, line, words``: all lines with a word, ``at`` counting every line from 0."""
    texts = docs.select(
        F.col(id_column).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    lines = texts.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("at", "text"))
    return (
        lines.select("doc_id", "row", "at", F.xxhash64("text").alias("line"), word_count(F.col("text")).alias("words"))
        .where("words > 0")
    )


def minimal_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``row, doc_id, start, length``: the shortest runs of ``min_words`` words from and up to each line.

    Lines are ``row, doc_id, n, total`` with ``total`` words before the n-th
    line, and one more behind the last.  A line of a longer run lies in one of
    these runs: in the one that begins with it, or ends with it, or, in the
    middle, in the one from the run's beginning.
    """
    fewer = Window.partitionBy("row").orderBy("total").rangeBetween(Window.unboundedPreceding, -min_words)
    more = Window.partitionBy("row").orderBy(F.desc("total")).rangeBetween(Window.unboundedPreceding, -min_words)
    found = lines.select(
        "row", "doc_id", "n", F.max("n").over(fewer).alias("from"), F.min("n").over(more).alias("to")
    )
    onward = found.where("to is not null").select("row", "doc_id", F.col("n").alias("start"), (F.col("to") - F.col("n")).alias("length"))
    back = found.where("from is not null").select("row", "doc_id", F.col("from").alias("start"), (F.col("n") - F.col("from")).alias("length"))
    return onward.union(back).distinct()


def _next_ranks(ranked: DataFrame, shift: int, rows_per_piece: int) -> DataFrame:
    """``row, n, left, rank, earlier``: ranks by twice as many lines, and by how much they grew.

    ``ranked`` (``row, n, left, rank``) is ordered by its first ``shift`` lines.
    Suffixes of one rank are told apart by the rank ``shift`` lines on; none
    there, as at the end of a stretch, comes first.  A rank counts the suffixes
    before it, so it only grows by those of its old rank that now come earlier.
    """
    along = Window.partitionBy("row").orderBy("n")
    there = F.lead("n", shift).over(along) == F.col("n") + shift
    pairs = ranked.select(
        "row", "n", "left", "rank", F.when(there, F.lead("rank", shift).over(along)).otherwise(-1).alias("after")
    )
    groups = pairs.groupBy("rank", "after").agg(F.count("*").alias("size"))
    groups = groups.withColumn("piece", F.floor(F.col("after") / rows_per_piece))
    earlier = running_totals(groups, ["rank"], "piece", ["after"], {"earlier": "size"})
    grown = pairs.join(earlier.select("rank", "after", "earlier"), ["rank", "after"])
    return stored(grown.select("row", "n", "left", (F.col("rank") + F.col("earlier")).alias("rank"), "earlier"), "line-ranks")


def suffix_levels(lines: DataFrame, depth: int, rows_per_piece: int = ROWS_PER_PIECE) -> list[DataFrame]:
    """``row, n, left, rank`` of all suffixes, by their first 1, 2, 4, ... lines.

    ``lines`` has ``row, n, name``; a suffix goes from a line to the end of its
    stretch of successive numbers, ``left`` lines on.  Equal ranks are equal
    beginnings; a rank counts the suffixes before it.  Prefix doubling stops
    once ``depth`` lines are looked at, or no rank is split.
    """
    along = Window.partitionBy("row").orderBy("n")
    stretch = Window.partitionBy("row", F.col("n") - F.col("k"))
    counts = stored(lines.groupBy("name").agg(F.count("*").alias("size")), "line-sizes")
    bits = piece_bits(counts.count(), rows_per_piece)
    first = running_totals(counts.withColumn("piece", hash_piece(F.col("name"), bits)), [], "piece", ["name"], {"rank": "size"})
    levels = [
        stored(
            lines.join(first.select("name", "rank"), "name")
            .withColumn("k", F.row_number().over(along))
            .select("row", "n", (F.max("n").over(stretch) - F.col("n") + 1).alias("left"), "rank"),
            "line-ranks",
        )
    ]
    while 1 << (len(levels) - 1) < depth:
        ranked = _next_ranks(levels[-1], 1 << (len(levels) - 1), rows_per_piece)
        if ranked.where("earlier > 0").isEmpty():
            break
        levels.append(ranked.drop("earlier"))
    return levels


def common_prefixes(levels: list[DataFrame]) -> DataFrame:
    """``rank, common``: how many first lines each rank of the last level shares with the rank before.

    One suffix stands for all of a rank.  Two ranks share fewer lines than the
    last level looks at; how many is found by descending the levels.
    """
    ranks = stored(
        levels[-1].groupBy("rank").agg(F.count("*").alias("size"), F.min(F.struct("row", "n")).alias("at")), "line-groups"
    )
    before = ranks.select(
        (F.col("rank") + F.col("size")).alias("rank"), F.col("at.row").alias("row_2"), F.col("at.n").alias("n_2")
    )
    pairs = ranks.join(before, "rank", "left").select(
        F.col("rank").alias("place"), "at.row", F.col("at.n").alias("n"), "row_2", "n_2", F.lit(0).alias("common")
    )
    for k, level in reversed(list(enumerate(levels[:-1]))):
        whole = level.where(F.col("left") >= 1 << k)
        one = whole.select("row", "n", "rank")
        two = whole.select(F.col("row").alias("row_2"), F.col("n").alias("n_2"), F.col("rank").alias("rank_2"))
        step = F.when(F.col("rank") == F.col("rank_2"), 1 << k).otherwise(0)
        pairs = stored(
            pairs.join(one, ["row", "n"], "left")
            .join(two, ["row_2", "n_2"], "left")
            .select(
                "place", "row", (F.col("n") + step).alias("n"), "row_2", (F.col("n_2") + step).alias("n_2"),
                (F.col("common") + step).alias("common"),
            ),
            "line-common",
        )
    return pairs.select(F.col("place").alias("rank"), "common")


def repeated_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_deleted, deleted_words, deleted``.

    Lines with a word form the sequence of a text; ``n_lines`` counts them.  A
    run of lines with at least ``min_words`` words that also occurs earlier, in
    a smaller id or further up in the text, is a later copy and its lines are
    deleted: ``deleted`` has their numbers, counting all lines from 0.  Runs do
    not cross texts.  Lines are told apart by 64-bit hashes.

    The suffixes of all texts, of lines that occur more than once, are put in
    order by prefix doubling (:func:`suffix_levels`), as deep as the longest
    run looked up, at most ``min_words`` lines.  Where neighbours share fewer
    lines than a run has, an interval of equal runs of that length begins; its
    earliest run stays.  Every maximal repeated run is the union of the
    shortest runs of enough words in it, and the intervals are looked up at
    their lengths.  The lines of one text are numbered in one task, as its text
    is one row.

    A NULL or empty text has no lines.  Of repeated rows, one comes first and
    the others are its copies.  A NULL id comes before all others.  No rows
    give no rows.  Other columns are not read.
    """
    lines = stored(line_table(docs, id_column, text_column), "line-table")
    several = stored(lines.groupBy("line").agg(F.count("*").alias("times")).where("times > 1").select("line"), "line-several")
    along = Window.partitionBy("row").orderBy("at")
    numbered = lines.join(several.withColumn("name", F.col("line")), "line", "left").select(
        "row",
        "doc_id",
        "at",
        "name",
        "words",
        (F.row_number().over(along) - 1).alias("n"),
        (F.sum("words").over(along) - F.col("words")).alias("total"),
    )
    numbered = stored(numbered, "line-numbered")
    ends = numbered.groupBy("row", "doc_id").agg(
        (F.max("n") + 1).alias("n"), F.sum("words").alias("total"), F.count("name").alias("known")
    )
    # Texts without any repeated line are done.
    bounds = numbered.select("row", "doc_id", "n", "total").unionByName(ends.where("known > 0").drop("known"))
    runs = stored(minimal_runs(bounds, min_words), "line-runs")
    longest = runs.agg(F.coalesce(F.max("length"), F.lit(1))).first()[0]
    levels = suffix_levels(numbered.where("name is not null").select("row", "n", "name"), longest, rows_per_piece)
    suffixes = levels[-1].withColumnRenamed("n", "start")
    wanted = stored(
        runs.join(suffixes, ["row", "start"])
        .where(F.col("left") >= F.col("length"))
        .select("row", "start", "length", "rank", F.struct("doc_id", "row", "start").alias("place")),
        "line-wanted",
    )
    alike = wanted.groupBy("length", "rank").agg(F.min("place").alias("first"), F.count("*").alias("times"))
    begun = F.when(F.col("common") < F.col("length"), 1).otherwise(0).cast("bigint")
    alike = alike.join(common_prefixes(levels), "rank").withColumns(
        {"begun": begun, "piece": F.floor(F.col("rank") / rows_per_piece)}
    )
    intervals = running_totals(stored(alike, "line-alike"), ["length"], "piece", ["rank"], {"before": "begun"})
    named = stored(intervals.withColumn("run", F.col("before") + F.col("begun")).select("length", "rank", "run", "first", "times"), "line-named")
    runs_first = (
        named.groupBy("length", "run")
        .agg(F.min("first").alias("first"), F.sum("times").alias("times"))
        .where("times > 1")
        .drop("times")
    )
    first = named.select("length", "rank", "run").join(runs_first, ["length", "run"]).select("length", "rank", "first")
    deleted = (
        wanted.join(first, ["length", "rank"])
        .where("place > first")
        .select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("n"))
        .distinct()
    )
    per_text = (
        numbered.select("row", "n", "at", "words").join(deleted.withColumn("gone", F.lit(True)), ["row", "n"], "left")
        .groupBy("row")
        .agg(
            F.count("*").alias("n_lines"),
            F.count("gone").alias("n_deleted"),
            F.sum(F.when(F.col("gone"), F.col("words")).otherwise(0)).alias("deleted_words"),
            F.array_sort(F.collect_list(F.when(F.col("gone"), F.col("at")))).alias("deleted"),
        )
    )
    nothing = F.lit(0).cast("bigint")
    # Texts without lines have no row so far; ids alone are read again for them.
    lined = per_text.join(numbered.groupBy("row").agg(F.first("doc_id").alias("doc_id")), "row")
    bare = docs.where(word_count(F.col(text_column)) == 0).select(
        F.col(id_column).alias("doc_id"),
        nothing.alias("n_lines"),
        nothing.alias("n_deleted"),
        nothing.alias("deleted_words"),
        F.array().cast("array<int>").alias("deleted"),
    )
    return lined.select(*bare.columns).union(bare)


def without_lines(text, deleted):
    """Column: the text without its lines of those numbers."""
    kept = F.filter(
        F.transform(F.split(text, "\n"), lambda line, i: F.when(~F.array_contains(deleted, i), line)),
        lambda line: line.isNotNull(),
    )
    return F.array_join(kept, "\n")


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with what later copies of line runs take from them; ``deleted`` joined by commas."""
    found = repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("deleted", F.array_join("deleted", ","))


# Every run by its text, window by window.
OP5_SQL = r"""
WITH a AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) AS pos
           FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
w AS (SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM a),
l AS (SELECT doc_id, line, words, pos,
             row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS n,
             CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY pos) - words AS BIGINT) AS total
      FROM w WHERE words > 0),
seq AS (SELECT doc_id, list(line ORDER BY n) AS lines FROM l GROUP BY doc_id),
b AS (SELECT doc_id, n, total FROM l
      UNION ALL SELECT doc_id, max(n) + 1, CAST(sum(words) AS BIGINT) FROM l GROUP BY doc_id),
f AS (SELECT doc_id, n,
             max(n) OVER (PARTITION BY doc_id ORDER BY total RANGE BETWEEN UNBOUNDED PRECEDING AND 50 PRECEDING) AS lo,
             min(n) OVER (PARTITION BY doc_id ORDER BY total RANGE BETWEEN 50 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi
      FROM b),
r AS (SELECT doc_id, n AS s, hi AS e FROM f WHERE hi IS NOT NULL
      UNION SELECT doc_id, lo, n FROM f WHERE lo IS NOT NULL),
t AS (SELECT doc_id, s, e, array_to_string(lines[s + 1:e], chr(10)) AS run FROM r JOIN seq USING (doc_id)),
d AS (SELECT doc_id, s, e, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS copy FROM t),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e)) AS n FROM d WHERE copy > 1)
SELECT documents.doc_id, count(l.n) AS n_lines, count(gone.n) AS n_deleted,
       CAST(coalesce(sum(l.words) FILTER (WHERE gone.n IS NOT NULL), 0) AS BIGINT) AS deleted_words,
       coalesce(string_agg(CAST(pos - 1 AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE gone.n IS NOT NULL), '') AS deleted
FROM documents LEFT JOIN l USING (doc_id) LEFT JOIN gone USING (doc_id, n)
GROUP BY documents.doc_id
"""
