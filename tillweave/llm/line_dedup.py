"""Line deduplication: range-partitioned hashes, first occurrences, keep bitmaps.

Lines become 16-byte hashes. The hashes are dealt by range and sorted by document and position,
so that each run's first row is the first occurrence; what goes back to the documents is a
sparse bitmap of dropped lines, never text. Only DataFrame functions are used.

A hash that holds more than 1/HOT_KEYS of all rows would make one range too heavy. There are at
most HOT_KEYS of these, so their first documents (found by a pre-aggregated minimum) are
broadcast and their rows are decided where they lie.

Defined results: null or empty text is one empty line; a null doc_id takes no part and keeps all
its lines; rows that repeat a doc_id count as one document, each keeping its own lines; keys of
fewer than min_chars code points always stay; columns beside doc_id and text pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillweave.llm.shared import BLANKS, ascii_lower, fresh, need, settled, text_of

#: Bound of the broadcast of hot hashes (32 bytes each), and the rows below which none is hot.
HOT_KEYS, HOT_ROWS = 131_072, 2_000


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row per line that can be dropped: doc_id, row hash, position, two 64-bit hashes."""
    lines = docs.filter("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    )
    keyed = lines.filter(F.length("line") >= min_chars).select("doc_id", "th", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, th, n_dropped, dropped: map from pos div 64 to a word of dropped-line bits.

    Documents without a dropped line have no row; a word that is absent keeps all 64 lines.
    """
    need(docs, "doc_id", "text")
    rows = settled(line_hashes(docs, min_chars))
    limit = max(HOT_ROWS, rows.count() // HOT_KEYS)
    hot = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter(F.col("n") > limit)
    hot = settled(hot.select("h1", "h2", "first_doc"))
    cold = rows.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    order = W.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    streamed = cold.withColumn("first_doc", F.first("doc_id").over(order))
    decided = streamed.unionByName(rows.join(F.broadcast(hot), ["h1", "h2"]))
    words = (
        decided.filter("doc_id > first_doc")
        .groupBy("doc_id", "th", F.expr("cast(pos div 64 as int)").alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("bits"))
    )
    return words.groupBy("doc_id", "th").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("dropped"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs with the kept text, and n_lines and n_dropped (replacing columns of those names)."""
    key, text_hash, n, words = (fresh(docs, name) for name in ("ld_id", "ld_hash", "ld_n", "ld_words"))
    marks = bitmaps.select(F.col("doc_id").alias(key), F.col("th").alias(text_hash), F.col("n_dropped").alias(n), F.col("dropped").alias(words))
    both = docs.join(marks, (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(text_hash)), "left")
    kept = F.expr(
        "array_join(filter(split(text, '\\n', -1), (x, i) -> "
        f"(shiftright(coalesce({words}[cast(i div 64 as int)], 0L), i % 64) & 1L) = 0), '\\n')"
    )
    whole = text_of()
    return both.withColumns(
        {
            "n_lines": (F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1).cast("long"),
            "n_dropped": F.coalesce(n, F.lit(0)).cast("long"),
            "text": F.when(F.col(n).isNull(), F.col("text")).otherwise(kept),
        }
    ).drop(key, text_hash, n, words)


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
