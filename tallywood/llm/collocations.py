"""Phrases whose words come together, from count streams in prefix and in suffix order.

Phrases of one to four words and their counts form one stream.  In prefix order
(by first word, second word, ...) the beginnings of a phrase come right before
it; in suffix order (by last word, last but one, ...) its ends do.  So one
sorted pass each, which keeps no more than the phrases it is inside of, finds
the counts of all beginnings and ends, and which phrase each one extends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywood.llm.tables import stored
from tallywood.llm.words import SLICE_BYTES, SpanHasher, U, Words, lowered, mix, runs, slices, windows

LONGEST, LEAST, SHARE, TOP, SCALE = 4, 30, 80, 2000, 2_000_000
# Fixed value: bytes that end a piece of text.
IS_CUT = np.zeros(256, dtype=bool)
IS_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IS_GAP = IS_CUT.copy()
IS_GAP[[0x20, 0x09]] = True
TABLE_BITS, MARK_BITS = 1 << 26, 48
COUNTED = "lang string, phrase string, mark bigint, n bigint"


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, order: int) -> pa.Array:
    """The words ``at`` to ``at + order - 1`` of each place as one string with single spaces."""
    index = (at[:, None] + np.arange(order)).ravel()
    begin, lengths = starts[index], ends[index] - starts[index] + 1
    inner = np.cumsum(lengths)
    source = np.repeat(begin - inner + lengths, lengths) + np.arange(inner[-1] if len(inner) else 0)
    out = data[np.minimum(source, len(data) - 1)]
    out[inner - 1] = 0x20  # the byte after each word
    last = np.zeros(len(out), dtype=bool)
    last[inner[order - 1 :: order] - 1] = True
    offsets = np.concatenate([[0], inner[order - 1 :: order] - np.arange(1, len(at) + 1)]).astype(np.int64)
    strings = pa.Array.from_buffers(
        pa.large_string(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[~last].tobytes())]
    )
    return strings.cast(pa.string())


def counted(docs: DataFrame, order: int, table: np.ndarray | None, ahead: int) -> DataFrame:
    """``lang, phrase, mark, f`` of phrases of ``order`` words, and ``mark, f`` of those of ``ahead`` words.

    ``table`` tells by marks which phrases of ``ahead - 1`` words may be
    frequent: of ``order`` words (the same number, or 0 for none) only those
    are counted, of ``ahead`` words those that begin and end with one, without
    spelling them out.  Without a table all words are counted and those of each
    language, with a NULL ``phrase``.  ``mark`` stands for language and phrase.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            names, codes = coded.dictionary, coded.indices.to_numpy()
            salts = np.array(
                [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in names.to_pylist()],
                dtype=U,
            )
            for part in slices(batch.column(0), 4 * SLICE_BYTES):
                data = lowered(part.data)
                starts, ends = runs(~IS_GAP[data], part.offsets)
                rows = np.searchsorted(part.offsets, starts, "right") - 1
                pieces = np.cumsum(IS_CUT[data])[starts] + rows
                words = Words(SpanHasher(data)(starts, ends), pieces, rows, starts, ends)
                of = codes[part.first + rows]

                def marks(size: int) -> tuple[np.ndarray, np.ndarray]:
                    at, hashes = windows(words, size)
                    return at, mix(hashes ^ salts[of[at]])

                def rows_of(at: np.ndarray, own: np.ndarray, spelled: bool) -> tuple:
                    own, first, n = np.unique(own, return_index=True, return_counts=True)
                    at = at[first]
                    langs, phrases = names.take(pa.array(of[at])), pa.nulls(len(at), pa.string())
                    if spelled:
                        phrases = joined(data, starts, ends, at, order)
                    else:
                        langs = pa.nulls(len(at), pa.string())
                    return langs, phrases, (own >> U(64 - MARK_BITS)).astype(np.int64), n

                if table is None:
                    yield batch_of(*rows_of(*marks(order), spelled=True))
                    yield batch_of(names, pa.nulls(len(names), pa.string()), None, np.bincount(of, minlength=len(names)))
                    continue
                at, own = marks(ahead - 1)
                place = (own >> U(64 - MARK_BITS)).astype(np.int64) % TABLE_BITS
                hit = ((table[place // 63] >> (place % 63)) & 1).astype(bool)
                if order:
                    yield batch_of(*rows_of(at[hit], own[hit], spelled=True))
                if ahead <= LONGEST:
                    may = np.zeros(len(starts), dtype=bool)
                    may[at[hit]] = True
                    at, own = marks(ahead)
                    keep = may[at] & may[at + 1]
                    yield batch_of(*rows_of(at[keep], own[keep], spelled=False))

    return docs.mapInArrow(count, COUNTED).groupBy("lang", "phrase", "mark").agg(F.sum("n").alias("f"))


def batch_of(langs: pa.Array, phrases: pa.Array, marks: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    numbers = pa.nulls(len(n), pa.int64()) if marks is None else pa.array(marks, pa.int64())
    return pa.RecordBatch.from_arrays([langs, phrases, numbers, pa.array(n, pa.int64())], names=["lang", "phrase", "mark", "n"])


def bit_table(marks: DataFrame) -> np.ndarray:
    """``TABLE_BITS`` bits with those of ``marks`` set, 63 to a number; its size never grows."""
    place = F.col("mark") % TABLE_BITS
    words = (
        marks.select(F.floor(place / 63).alias("word"), F.expr(f"shiftleft(1L, cast(mark % {TABLE_BITS} % 63 as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toPandas()  # bounded by the table
    )
    table = np.zeros(TABLE_BITS // 63 + 1, dtype=np.int64)
    table[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return table


def lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, key, f, own, carried`` in order of ``lang, key``, with ``found``: counts of the key's beginnings.

    All orders go through at once: the open phrases are those that the current
    one continues.  Rows that are not a part's ``own`` only open it.
    """
    opened: list[tuple[list[str], int]] = []
    lang_now = None
    for batch in batches:
        found = []
        for lang, key, f in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if lang != lang_now:
                lang_now, opened = lang, []
            while opened and opened[-1][0] != key[: len(opened[-1][0])]:
                opened.pop()
            if len(opened) != len(key) - 1:
                raise RuntimeError(f"a beginning of {key} is missing in the stream")
            found.append([count for _, count in opened])
            opened.append((key, f))
        kind = pa.list_(pa.int64())
        made = pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), batch.column(4), pa.array(found, kind)],
            names=["lang", "key", "f", "carried", "found"],
        )
        yield made.filter(batch.column(3))


def in_order(stream: DataFrame) -> DataFrame:
    """``stream`` (``lang, key, f, carried``) plus ``found``, the counts of all beginnings of ``key``.

    Rows are dealt by ranges of the order, so a beginning with any number of
    continuations is spread over parts.  Each part also gets the beginnings of
    its first phrase, at most one for each order, from the parts before.
    """
    ranged = stored(
        stream.repartitionByRange("lang", "key").withColumn("part", F.spark_partition_id()), "collocation-ranges"
    )
    parts = (ranged.agg(F.max("part")).first()[0] or 0) + 1
    firsts = ranged.groupBy("part").agg(F.min(F.struct("lang", "key")).alias("first"))
    beginnings = (
        firsts.where(F.size("first.key") > 1)
        .select(
            F.col("part").alias("for_part"),
            F.col("first.lang").alias("lang"),
            F.explode(F.expr("transform(sequence(1, size(first.key) - 1), j -> slice(first.key, 1, j))")).alias("key"),
        )
        # At most three rows for each part.
    )
    columns = ["lang", "key", "f", "own", "carried", "part"]
    opening = (
        ranged.join(F.broadcast(beginnings), ["lang", "key"])
        .select("lang", "key", "f", F.lit(False).alias("own"), "carried", F.col("for_part").alias("part"))
    )
    laid = ranged.withColumn("own", F.lit(True)).select(*columns).union(opening)
    return (
        laid.repartitionById(parts, F.col("part"))
        .sortWithinPartitions("lang", "key")
        .select(*columns[:-1])
        .mapInArrow(lockstep, "lang string, key array<string>, f bigint, carried array<bigint>, found array<bigint>")
    )


def best_cut() -> Column:
    """``score, k, l, r`` of the lowest cut of ``words``; decimals, since products pass 64 bits."""
    return F.array_min(
        F.expr(
            f"""transform(sequence(1, size(words) - 1), k -> named_struct(
                'score', (cast({SCALE} as decimal(10,0)) * cast(f as decimal(20,0)))
                         div (cast(lefts[k - 1] as decimal(20,0)) + cast(rights[size(words) - k - 1] as decimal(20,0))),
                'k', k, 'l', lefts[k - 1], 'r', rights[size(words) - k - 1]))"""
        )
    )


def collocations(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    share: int = SHARE,
    top: int | None = TOP,
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends,
    and pieces into words at spaces and tabs.  Phrases are 2 to 4 words within
    a piece found at least ``least`` times (``a``) in their language.  Of the
    cuts of a phrase in two, that with the lowest floor(2000000 * a / (l + r))
    counts (then the first), where ``l`` and ``r`` are how often its parts are
    found.  A phrase goes if a longer one that contains it has ``share`` percent
    of its count.  That needs one word more at most: anything longer contains
    such a one, which is found no less often.  ``top`` None gives all.

    Phrases are counted order by order, first by marks of 48 bits; only those
    whose marks are frequent are spelled out and counted, in the scan that marks
    the phrases one word longer which begin and end with such a one.  Scans know
    frequent marks by a table of 2**26 bits.  Marks and table never rule out a
    frequent phrase; with more than some ten million of them the table lets
    others pass, which costs shuffling, not results.  The stream of all
    frequent phrases is then sorted twice, and each time read in lockstep.
    Equal words and phrases of a slice of a task are found by 64-bit hashes.

    NULL or empty texts have no words; a NULL language is ``und``; repeated
    rows count again; ties are ordered by phrase, in order of its UTF-8 bytes.
    No rows give no rows.  Other columns are not read.
    """
    source = docs.select(F.col(text_column).alias("text"), F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"))
    frequent = F.col("f") >= least

    def counts(order: int, table: np.ndarray | None, ahead: int) -> DataFrame:
        return stored(counted(source, order, table, ahead).where(F.col("mark").isNull() | frequent), "collocation-counts")

    words = counts(1, None, 0)
    totals = words.where("mark is null").select("lang", F.col("f").alias("n"))
    orders = [words.where("mark is not null")]
    found = counts(0, bit_table(orders[0]), 2)
    for order in range(2, LONGEST + 1):
        found = counts(order, bit_table(found.where("phrase is null")), order + 1)
        # A phrase may share its mark with a frequent one.
        orders.append(found.where("phrase is not null"))
    stream = reduce(DataFrame.union, orders).select(
        "lang", F.split("phrase", " ").alias("key"), "f", F.lit(None).cast("array<bigint>").alias("carried")
    )
    lefts = in_order(stream)
    rights = in_order(lefts.select("lang", F.reverse("key").alias("key"), "f", F.col("found").alias("carried")))
    both = stored(
        rights.where(F.size("key") > 1).select(
            "lang", F.reverse("key").alias("words"), "f", F.col("carried").alias("lefts"), F.col("found").alias("rights")
        ),
        "collocation-both",
    )
    longer = both.where(F.size("words") > 2).withColumn("m", F.size("words") - 1)
    covers = F.lit(100) * F.col("f") >= F.lit(share) * F.col("of")
    covered = (
        longer.select("lang", F.expr("slice(words, 1, m)").alias("words"), "f", F.element_at("lefts", -1).alias("of"))
        .union(longer.select("lang", F.expr("slice(words, 2, m)").alias("words"), "f", F.element_at("rights", -1).alias("of")))
        .where(covers)
        .select("lang", "words")
        .distinct()
    )
    scored = (
        both.join(covered.hint("merge"), ["lang", "words"], "left_anti")
        .withColumn("cut", best_cut())
        .select(
            "lang",
            F.array_join("words", " ").alias("phrase"),
            F.col("f").alias("a"),
            F.col("cut.l").alias("l"),
            F.col("cut.r").alias("r"),
            F.col("cut.score").alias("score"),
        )
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
w AS (SELECT lang, piece, unnest(ws) AS w1, generate_subscripts(ws, 1) AS i FROM listed),
led AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4
        FROM w WINDOW p AS (PARTITION BY piece ORDER BY i)),
f AS MATERIALIZED (SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM led GROUP BY ALL HAVING count(*) >= 30 UNION ALL
      SELECT lang, 2, w1 || ' ' || w2, count(*) FROM led WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30 UNION ALL
      SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM led WHERE w3 IS NOT NULL
      GROUP BY ALL HAVING count(*) >= 30 UNION ALL
      SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM led WHERE w4 IS NOT NULL
      GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM led GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
covered AS (
  SELECT DISTINCT c.lang, c.phrase
  FROM c JOIN (SELECT lang, a, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
               FROM c, range(2, 4) AS t(m) WHERE m < k) AS d USING (lang, phrase)
  WHERE 100 * d.a >= 80 * c.a),
parts AS (SELECT lang, phrase, a, j, array_to_string(ws[:j], ' ') AS one, array_to_string(ws[j + 1:], ' ') AS rest
          FROM c, range(1, 4) AS t(j) WHERE j < k),
cuts AS (
  SELECT p.lang, p.phrase, p.a, j, l.f AS l, r.f AS r, 2000000::HUGEINT * a // (l.f + r.f) AS score
  FROM parts AS p JOIN f AS l ON l.lang = p.lang AND l.phrase = p.one JOIN f AS r ON r.lang = p.lang AND r.phrase = p.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best ANTI JOIN covered USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
