"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Texts are lower-cased in A-Z and cut into words (``text.alnum_words``). A window
is ``n`` consecutive words of a benchmark item; a shorter item is one window. The
windows of all items form a hash table that every task holds; each task slides
over the words of its own documents, looks the 64-bit hash of every window up and
compares the words themselves on a hit, so hash collisions do no harm. The table holds
no items: these are joined to the documents' distinct hits by the windows' keys. Only
hits and one row per document are shuffled. A benchmark beyond ``MAX_WINDOWS`` windows
is looked up in blocks of that size, each a scan of its own.

Defined cases: a NULL or empty text has no words and no hits. A NULL benchmark
text has no windows; a NULL item id is written as the empty text. Rows that agree
in id and text are documents of their own with equal results. Ties do not occur:
a word is hit or not. Empty tables give empty or hit-free results. Only the named
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.text import alnum_words, text_key
from pricelens.session import join_on, stage_table

N_WORDS = 10
#: Windows in one broadcast table; of about 150 bytes each.
MAX_WINDOWS = 200_000
KEY = ["_id", "_k1", "_k2"]


def test_windows(benchmark: DataFrame, n: int = N_WORDS, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A row per item and distinct window of it: the window's words, length and 128-bit key."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        alnum_words(F.col(text_col)).alias("_w"),
    ).filter(F.size("_w") > 0)
    length = F.least(F.size("_w"), F.lit(n))
    starts = items.select("item", "_w", length.alias("w_len"), F.explode(F.sequence(F.lit(1), F.size("_w") - length + 1)).alias("_p"))
    window = starts.select("item", "w_len", F.slice("_w", F.col("_p"), F.col("w_len")).alias("_win"))
    text = F.array_join("_win", " ")
    return window.select(
        "item", text.alias("w_text"), "w_len", F.xxhash64("_win").alias("w_hash"), F.xxhash64(F.lit(1), text).alias("w_check")
    ).distinct()


def window_hits(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document (``pos`` 0) and one per verified window (``pos`` from 1).

    Columns: ``_id``, the text key, ``n_words``, ``pos``, ``w_len`` and the window's key
    ``w_hash``, ``w_check``. The broadcast table holds a window once, however many items
    have it, and no item.
    """
    return _hits(docs, stage_table(test_windows(benchmark, n), "test_windows"), n, id_col, text_col)


def _hits(docs: DataFrame, item_windows: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    windows = stage_table(item_windows.drop("item").distinct(), "windows")
    lengths = [r.w_len for r in windows.select("w_len").distinct().collect()] or [n]  # at most n rows
    blocks = max(1, -(-windows.count() // MAX_WINDOWS))
    k1, k2 = text_key(F.col(text_col))
    words = docs.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), alnum_words(F.col(text_col)).alias("_w"))
    places = words.select(*KEY, "_w", F.size("_w").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("_w"))).alias("pos"))
    places = places.withColumn("d_len", F.explode(F.array(*map(F.lit, lengths))) if len(lengths) > 1 else F.lit(lengths[0]))
    fits = (F.col("pos") > 0) & (F.col("pos") + F.col("d_len") - 1 <= F.col("n_words"))
    first = (F.col("pos") == 0) & (F.col("d_len") == lengths[0])
    found = F.slice("_w", F.greatest("pos", F.lit(1)), F.col("d_len"))
    hashed = places.filter(fits | first).withColumn("d_hash", F.when(fits, F.xxhash64(found)))

    def scan(block: int) -> DataFrame:
        part = windows.filter(F.pmod("w_hash", F.lit(blocks)) == block) if blocks > 1 else windows
        same = (F.col("d_hash") == F.col("w_hash")) & (F.col("w_text") == F.array_join(found, " "))
        hits = hashed.join(F.broadcast(part), same, "left")
        kept = F.col("w_hash").isNotNull() | ((F.col("pos") == 0) & F.lit(block == 0))
        return hits.filter(kept).select(*KEY, "n_words", "pos", F.when(F.col("pos") > 0, F.col("w_len")).otherwise(0).alias("w_len"), "w_hash", "w_check")

    return reduce(DataFrame.unionAll, [scan(b) for b in range(blocks)])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its words, hit words, the items found and the hit spans.

    ``spans`` holds the maximal runs of hit words as (start, length), words
    counted from 0.
    """
    item_windows = stage_table(test_windows(benchmark, n), "test_windows")
    hits = stage_table(_hits(docs, item_windows, n, id_col, text_col), "window_hits")
    order = Window.partitionBy(*KEY).orderBy("pos")
    end = F.col("pos") + F.col("w_len") - 1
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    is_hit = F.col("pos") > 0
    marked = hits.withColumn("_before", F.greatest(before, F.lit(0))).withColumns(
        {
            "_new": F.when(is_hit, F.greatest(F.lit(0), end - F.greatest(F.col("pos") - 1, F.col("_before")))).otherwise(0),
            "_run": F.sum(F.when(is_hit & (F.col("pos") > F.col("_before") + 1), 1).otherwise(0)).over(order),
        }
    )
    runs = marked.groupBy(*KEY, "_run").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(~is_hit).alias("copies"),
        F.sum("_new").alias("hit"),
        F.min(F.when(is_hit, F.col("pos") - 1)).alias("start"),
    )
    span = F.when(F.col("hit") > 0, F.struct(F.col("start").cast("long").alias("start"), F.col("hit").cast("long").alias("length")))
    found = runs.groupBy(*KEY).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum("hit").cast("long").alias("n_hit"),
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.max("copies").alias("copies"),
    )
    met = hits.filter(is_hit).select(*KEY, "w_hash", "w_check").distinct()
    listed = met.join(item_windows.select("w_hash", "w_check", "item"), ["w_hash", "w_check"]).select(*KEY, "item").distinct()
    items = listed.groupBy(*KEY).agg(F.sort_array(F.collect_list("item")).alias("items"))
    full = join_on(found, items, KEY, "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return full.select(F.col("_id").alias(id_col), "_k1", "_k2", "n_words", "n_hit", "items", "spans", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def report(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """The digest of ``contamination``: one row per document."""
    found = contamination(docs, benchmark, n)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which no window occurs, with all their columns.

    Only ids and text keys of contaminated documents travel to the join.
    """
    hits = window_hits(docs, benchmark, n, id_col, text_col).filter("pos > 0").select(*KEY).distinct()
    hits = stage_table(hits, "contaminated")
    k1, k2 = text_key(docs[text_col])
    same = docs[id_col].eqNullSafe(hits["_id"]) & (k1 == hits["_k1"]) & (k2 == hits["_k2"])
    return docs.join(hits, same, "left_anti")


def cut_spans(docs: DataFrame, benchmark: DataFrame, n: int = N_WORDS) -> DataFrame:
    """Documents as their normalised words without the hit ones (``clean_words``)."""
    found = contamination(docs, benchmark, n).filter("n_hit > 0").select(F.col("doc_id").alias("_id"), "_k1", "_k2", "spans").dropDuplicates(KEY)
    k1, k2 = text_key(docs["text"])
    # The document travels as one struct, so no column of its own can clash.
    rows = docs.select(F.struct("*").alias("row"), docs["doc_id"].alias("_id"), k1.alias("_k1"), k2.alias("_k2"), alnum_words(docs["text"]).alias("_words"))
    clean = F.expr(
        "filter(_words, (w, i) -> not exists(coalesce(spans, array()), s -> i >= s.start and i < s.start + s.length))"
    )
    joined = join_on(rows, found, KEY, "left").withColumn("clean", clean)
    return joined.select(*[F.col(f"row.`{c}`") for c in docs.columns], F.col("clean").alias("clean_words"))
