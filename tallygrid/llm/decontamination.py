"""Benchmark decontamination by winnowing.

A text becomes hashes of ``k`` consecutive words, and of every ``w`` consecutive hashes the
smallest one is kept as a fingerprint. Two texts that share ``k + w - 1`` words in a row share a
whole window of hashes and so at least one fingerprint. With k = 5 and w = 6 that is every span
of ten words. Items of fewer words have a class of fingerprints of their own (k about half their
length, w the rest), which is built only for lengths that occur.

Fingerprints of documents are joined to those of the benchmark. In documents with a common
fingerprint each hit is extended to the whole window of words around it, and the windows are
compared word by word; windows that overlap merge into spans. Only DataFrame functions are used,
no text leaves its row before the first join, and only documents with a hit are read again.

Defined results for odd input: a null or empty text has no words and no windows; items without
words match nothing; a null item_id marks words as hit and is no item; rows that repeat an id
and text get the same result each; rows that share an id but not the text are told apart; an
empty table on either side gives no hits; other columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import without
from tallygrid.staging import Staging

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 10


def _low(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words of a text whose letters A to Z are in lower case; none for null."""
    return F.array_remove(F.split(_low(F.coalesce(text, F.lit(""))), SPLIT), "")


def _after(values: Column, n: int) -> Column:
    """The array without its first ``n`` elements."""
    return F.slice(values, n + 1, F.greatest(F.lit(0), F.size(values) - n))


def _first(values: Column, n: Column) -> Column:
    return F.slice(values, 1, F.greatest(F.lit(0), n))


def _runs(df: DataFrame, source: str, length: int, name: str, join) -> DataFrame:
    """Add ``name``: ``join`` over every ``length`` consecutive values, by doubling.

    The last ``length`` - 1 values are over incomplete runs; callers cut them off. Each step is
    a column of its own, so that no step is worked out twice.
    """
    have, have_length, todo = source, 1, length
    done, done_length, step = None, 0, 0
    while todo:
        if todo & 1:
            if done is None:
                done, done_length = have, have_length
            else:
                step += 1
                new = f"{name}_d{step}"
                df = df.withColumn(new, F.zip_with(F.col(done), _after(F.col(have), done_length), join))
                done, done_length = new, done_length + have_length
        todo >>= 1
        if todo:
            step += 1
            new = f"{name}_h{step}"
            df = df.withColumn(new, F.zip_with(F.col(have), _after(F.col(have), have_length), join))
            have, have_length = new, have_length * 2
    return df.withColumn(name, F.col(done))


def winnowed(df: DataFrame, span: int) -> DataFrame:
    """Add ``minima``: for every ``span`` words of ``words``, the smallest hash of a k-gram in it."""
    k = (span + 1) // 2
    w = span - k + 1
    keep = df.columns
    df = df.withColumn("_hash", F.transform("words", lambda x: F.xxhash64(x, F.lit(span))))
    df = _runs(df, "_hash", k, "_gram", lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_gram", _first(F.col("_gram"), F.size("words") - (k - 1)))
    df = _runs(df, "_gram", w, "_min", lambda a, b: F.least(a, b))
    return df.withColumn(
        "minima", _first(F.col("_min"), F.size("words") - (span - 1))
    ).select(*keep, "minima")


def windows(df: DataFrame, span: int) -> DataFrame:
    """Every ``span`` consecutive words with their place, text and fingerprint, a row each.

    The words are taken one by one: slicing an array reads all of it. The outer form keeps Spark
    from testing, in a filter of its own, whether there are any, which works everything out again;
    its one row without a window for a short text has no fingerprint and joins nothing.
    """
    keep = [c for c in df.columns if c not in ("words", "minima")]
    spans = F.transform(
        "minima",
        lambda m, i: F.struct(
            i.alias("start"),
            m.alias("hash"),
            F.concat_ws(" ", *[F.get("words", i + j) for j in range(span)]).alias("window"),
        ),
    )
    return df.withColumn("_spans", spans).select(*keep, F.inline_outer("_spans"))


def contamination(
    docs: DataFrame, items: DataFrame, staging: Staging, span: int = SPAN
) -> tuple[DataFrame, DataFrame]:
    """Hit words of documents, and the items they are from.

    Returns (spans, pairs): doc_id, _text, start, end (exclusive, in words) of every window that
    occurs; doc_id, _text, item_id for every document and item with a common window.
    """
    by_length = staging.write(
        "items",
        items.select(F.col("item_id"), words(items["text"].cast("string")).alias("words"))
        .withColumn("span", F.least(F.lit(span), F.size("words")))
        .where(F.col("span") > 0),
    )
    lengths = sorted(r[0] for r in by_length.select("span").distinct().collect())
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    keys = [docs["doc_id"].alias("doc_id"), F.xxhash64(text).alias("_text")]
    texts = docs.select(*keys, docs["text"].cast("string").alias("text"))
    if not lengths:
        spans = texts.limit(0).select("doc_id", "_text", F.lit(0).alias("start"), F.lit(0).alias("end"))
        return spans, spans.select("doc_id", "_text", F.lit(None).cast("long").alias("item_id"))
    item_windows = staging.write(
        "item_windows",
        reduce(
            DataFrame.unionByName,
            [
                windows(winnowed(by_length.where(F.col("span") == n), n), n)
                .select("span", "hash", "window", "item_id")
                .distinct()
                for n in lengths
            ],
        ),
    )
    prints = staging.write("item_prints", item_windows.select("hash").distinct())
    distinct_windows = staging.write(
        "windows", item_windows.select("span", "hash", "window").distinct()
    )

    hashes = texts.select("doc_id", "_text", words(F.col("text")).alias("words"))
    for n in lengths:
        hashes = winnowed(hashes, n).withColumnRenamed("minima", f"_m{n}")
    candidates = staging.write(
        "candidates",
        hashes.select(
            "doc_id",
            "_text",
            F.explode_outer(F.array_distinct(F.concat(*[f"_m{n}" for n in lengths]))).alias("hash"),
        )
        .join(prints, "hash", "left_semi")
        .select("doc_id", "_text")
        .distinct(),
    )
    again = candidates.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"))
    read = (
        texts.join(
            again,
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")),
            "left_semi",
        )
        .dropDuplicates(["doc_id", "_text"])
        .select("doc_id", "_text", words(F.col("text")).alias("words"))
    )
    found = reduce(
        DataFrame.unionByName,
        [
            windows(winnowed(read, n), n)
            .join(prints, "hash", "left_semi")
            .withColumn("span", F.lit(n))
            for n in lengths
        ],
    )
    hits = staging.write(
        "hits",
        found.join(distinct_windows, ["span", "hash", "window"], "left_semi").select(
            "doc_id", "_text", "start", "span", "hash", "window"
        ),
    )
    spans = hits.select("doc_id", "_text", "start", (F.col("start") + F.col("span")).alias("end"))
    pairs = (
        hits.select("doc_id", "_text", "span", "hash", "window")
        .join(item_windows, ["span", "hash", "window"])
        .select("doc_id", "_text", "item_id")
        .distinct()
    )
    return spans, pairs


def _covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        spans,
        start,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["end"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
    )["n"]


def decontamination_table(docs: DataFrame, items: DataFrame, staging: Staging) -> DataFrame:
    """Per document: words, hit words, items found and their digest."""
    spans, pairs = contamination(docs, items, staging)
    hit = spans.groupBy("doc_id", "_text").agg(
        _covered(F.sort_array(F.collect_set(F.struct("start", "end")))).cast("long").alias("n_hit")
    )
    named = pairs.groupBy("doc_id", "_text").agg(
        F.concat_ws(",", F.sort_array(F.collect_set(F.col("item_id").cast("string")))).alias("ids"),
        F.count("item_id").alias("n_items"),
    )
    found = hit.join(
        named.withColumnsRenamed({"doc_id": "_id", "_text": "_hash"}),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")),
    ).select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "n_hit", "ids", "n_items")
    found = staging.write("contaminated", found)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # A word of the lowered text is one of the text itself with A to Z added to the letters.
    count = F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("_text"), count.cast("long").alias("n_words"))
    joined = rows.join(
        found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, staging: Staging) -> DataFrame:
    """The documents without any hit."""
    spans, _ = contamination(docs, items, staging)
    bad = staging.write("hit", spans.select("doc_id", "_text").distinct())
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return without(docs, [docs["doc_id"], own], bad)
