"""Benchmark decontamination with DataFrame functions only.

Every window of ten benchmark words (or a shorter item as a whole) is known by
its longest word, the anchor. The words of each text are generated once and
probed against a hash table of anchors, which is broadcast; where an anchor is
met, the words around it are compared with the whole window. So no window of a
training text is ever built unless its anchor matches, and what is shuffled are
hits and one row a document. A table of more than a million windows is broadcast
in parts, each for a pass over the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What a word is, in lower-cased and in untouched text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Windows that are broadcast at once (some 200 MB); more take further passes over the texts.
MAX_BROADCAST_WINDOWS = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    found = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: ``anchor, offset, size, words (joined by spaces), items``."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w"))
    items = items.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    windows = items.select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.slice("w", F.col("at") + 1, F.lit(window)).alias("w")
    )
    longest = F.array_min(F.transform("w", lambda x, i: F.struct((-F.length(x)).alias("size"), i.alias("at"))))
    return (
        windows.groupBy("w")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("offset", longest["at"])
        .select(
            F.element_at("w", F.col("offset") + 1).alias("anchor"),
            "offset",
            F.size("w").alias("size"),
            F.array_join("w", " ").alias("words"),
            "items",
        )
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Benchmark windows in every whole text, a row per row of ``docs``.

    Columns: ``row, doc_id, n_words, n_hit, n_items, items (sorted as strings),
    hits (array of start and size in words), contaminated``. A null text has no
    words; rows of the same id are judged one by one; null ids stay null; items
    without an id hit but are not listed; repeated items count once; an empty
    benchmark hits nothing. Other columns are not read.
    """
    return _leaks(docs, benchmark, F.col(id_col).cast("long"), window, text_col)


def _leaks(docs: DataFrame, benchmark: DataFrame, known_by: Column, window: int, text_col: str) -> DataFrame:
    """``find_leaks``, with what ``known_by`` gives as ``doc_id``."""
    spark = docs.sparkSession
    windows = benchmark_windows(benchmark, window).select(
        F.xxhash64("anchor").alias("key"), "anchor", "offset", "size", "words", "items"
    )
    # The empty word ends each document and meets this row, so that every document gives a row.
    last = spark.range(1).select(
        F.xxhash64(F.lit("")).alias("key"),
        F.lit("").alias("anchor"),
        F.lit(0).alias("offset"),
        F.lit(0).alias("size"),
        F.lit("").alias("words"),
        F.array().cast("array<string>").alias("items"),
    )
    passes = max(1, -(-windows.count() // MAX_BROADCAST_WINDOWS))
    tables = [windows.filter(F.pmod(F.xxhash64("words"), F.lit(passes)) == i) for i in range(passes)]
    tables[0] = tables[0].union(last)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        known_by.alias("doc_id"),
        words_of(F.col(text_col)).alias("w"),
    )
    met = texts.select("row", "doc_id", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "word"))
    met = met.select("row", "doc_id", "w", "pos", "word", F.xxhash64("word").alias("word_key")).alias("d")
    start = F.col("d.pos") - F.col("b.offset")
    around = F.array_join(F.slice("d.w", F.greatest(start, F.lit(0)) + 1, F.col("b.size")), " ")
    whole = (F.col("b.size") == 0) | (
        (start >= 0) & (start + F.col("b.size") <= F.size("d.w")) & (around == F.col("b.words"))
    )
    meets = (F.col("d.word_key") == F.col("b.key")) & (F.col("d.word") == F.col("b.anchor")) & whole
    hits = reduce(
        DataFrame.union,
        [
            met.join(F.broadcast(table.alias("b")), meets).select(
                "row",
                "doc_id",
                F.when(F.col("b.size") == 0, F.size("d.w")).alias("n_words"),
                F.when(F.col("b.size") > 0, F.struct(start.alias("start"), F.col("b.size").alias("size"))).alias("hit"),
                "items",
            )
            for table in tables
        ],
    )
    found = hits.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(a["end"], x["start"]))).alias("n"),
            F.greatest(a["end"], x["start"] + x["size"]).alias("end"),
        ),
        lambda a: a["n"].cast("long"),
    )
    found = found.withColumn("n_hit", covered)
    return found.select(
        "row",
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        "hits",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", by_row: bool = False
) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns stay.

    Of repeated ids, all rows go if one is hit, unless ``by_row``: then each row
    goes by its own text. Rows with a null id always do. Null and empty texts,
    and all rows if the benchmark is empty, stay.
    """
    key = F.col("doc_id").cast("long")
    content = F.unhex(F.sha2(F.col(text_col).cast("binary"), 256))
    if not by_row:
        content = F.when(key.isNull(), content)
    known_by = F.struct(key.alias("id"), content.alias("content"))
    leaks = _leaks(docs, benchmark, known_by, window, text_col).filter("contaminated")
    its, digest = unused(docs, "leaked", "content")
    leaks = leaks.select(F.col("doc_id.id").alias(its), F.col("doc_id.content").alias(digest)).distinct()
    return docs.join(leaks, key.eqNullSafe(F.col(its)) & content.eqNullSafe(F.col(digest)), "left_anti")


def cut_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """``docs`` with the hit words, and what parts them from the word before, cut out of the texts.

    All rows and columns stay, in no certain order. Each row goes by its own text, also where ids are
    repeated or null; null and empty texts stay as they are, and so do all if the benchmark is empty.
    """
    key = F.col("doc_id").cast("long")
    content = F.unhex(F.sha2(F.col(text_col).cast("binary"), 256))
    known_by = F.struct(key.alias("id"), content.alias("content"))
    leaks = _leaks(docs, benchmark, known_by, window, text_col).filter("contaminated")
    its, digest, hits = unused(docs, "leaked", "content", "hits")
    # Rows of the same id and text have the same hits.
    leaks = leaks.groupBy("doc_id").agg(F.first("hits").alias(hits))
    leaks = leaks.select(F.col("doc_id.id").alias(its), F.col("doc_id.content").alias(digest), hits)
    text = F.col(text_col)
    pieces = F.regexp_extract_all(text, F.lit(rf"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*{CASED_WORD}"), F.lit(0))
    tail = F.regexp_extract(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    kept = F.filter(
        pieces,
        lambda p, i: ~F.exists(hits, lambda h: (h["start"] <= i) & (i < h["start"] + h["size"])),
    )
    joined = docs.join(leaks, key.eqNullSafe(F.col(its)) & content.eqNullSafe(F.col(digest)), "left")
    cut = F.when(F.col(hits).isNull(), text).otherwise(F.concat(F.array_join(kept, ""), tail))
    return joined.withColumn(text_col, cut).select(docs.columns)
