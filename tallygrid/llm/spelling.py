"""Spelling variants: words of a corpus that differ by one letter, found in FM-indexes.

Words are counted in Arrow batches, a dictionary at a time, and summed on Spark. Two words one edit
apart share the first or the second half of either of them, so words are dealt by their halves: a
word is indexed under the halves that words of its own length or one letter less or more can ask
for, and asks under its own two. Several halves form a shard of a bounded number of letters, with a
bidirectional FM-index (``fmindex``) of its words, and each of the words that ask is searched by two
schemes. A half with more letters than a shard is cut into blocks of words, each indexed on its own,
and its questions go to all of them: a search takes steps by the length of the word, not by the
number of words, so a hot half is neither capped nor compared in pairs.

A word's form is its near word with most occurrences (ties: the first in code-point order), if it
has ``TIMES`` times its own at least. Counts double from form to form, so the way to the root is
short and free of circles; it is found by doubling steps.

Defined results for odd input: null and empty texts have no words; a null doc_id counts as an empty
one where words are changed by document; rows that repeat are counted again; an empty table gives an
empty result; other columns are ignored. Words are made of A-Z, a-z and U+00C0 to U+00FF.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.fmindex import BidirectionalIndex
from tallygrid.staging import Staging

SHORTEST, LEAST, TIMES = 5, 3, 2
SLIPS = 97  # a word of a document loses a letter if this divides its hash
SHARD = 1 << 17  # letters of the words of an index, if one word is not longer
HELD = 1 << 18  # words that a task counts before it passes them on
WORD = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)


def counted(doc_id: int | None, text: str | None, slips: int, into: Counter) -> None:
    """Add the words of a document of ``SHORTEST`` letters and more, as Latin-1."""
    found = Counter(WORD.findall((text or "").encode("latin-1", "replace").lower()))
    if slips:
        name = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        name = zlib.crc32(b":", name)
        for word in [*found]:
            spelled = word if word.isascii() else word.decode("latin-1").encode()
            h = zlib.crc32(spelled, name)
            if h % slips == 0:
                n, at = found.pop(word), h % len(word)
                if len(word) > SHORTEST:
                    into[word[:at] + word[at + 1 :]] += n
    into.update(found)


def vocabulary(docs: DataFrame, slips: int = 0, least: int = LEAST) -> DataFrame:
    """word and n, its occurrences in all texts, for words of ``least`` occurrences and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.record_batch([words, pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counted(doc_id, text.as_py(), slips, held)
                if len(held) > HELD:
                    yield passed_on()
        if held:
            yield passed_on()

    some = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return (
        some.mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )


def _halves(words: DataFrame) -> DataFrame:
    """word, n, half and asks: the halves under which words are indexed, and whether they ask there."""
    word, size = F.col("word"), F.length("word")
    rows = []
    for less in (-1, 0, 1):
        first = F.floor((size + less) / 2).cast("int")
        asks = F.lit(less == 0)
        rows.append(F.struct(F.concat(F.lit("<"), F.substring(word, F.lit(1), first)).alias("half"), asks.alias("asks")))
        rows.append(F.struct(F.concat(F.lit(">"), F.right(word, size + less - first)).alias("half"), asks.alias("asks")))
    # Two of three lengths share a half on either side.
    short = F.filter(F.array(*rows), lambda r: F.length(r["half"]) <= size + 1)
    return words.select("word", "n", F.inline(short)).groupBy("word", "half").agg(
        F.first("n").alias("n"), F.max("asks").alias("asks")
    )


def near_words(words: DataFrame, staging: Staging, shard: int = SHARD) -> DataFrame:
    """word, near and n_near: all pairs of words one edit apart, in both directions."""
    halves = _halves(words)
    letters = F.sum(F.length("word") + 1)
    sums = halves.groupBy("half").agg(letters.alias("letters"), F.count(F.lit(1)).alias("words"))
    sums = staging.write("halves", sums)
    total = sums.agg(F.sum("letters")).first()[0] or 0
    shards = max(1, -(-total // shard))
    large = sums.where(F.col("letters") > shard).select(
        "half", F.least(F.ceil(F.col("letters") / shard), "words").cast("int").alias("blocks")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("word"), blocks).cast("int")
    # A word is indexed in its own block of a large half and asks in all of them.
    to = F.when(F.col("asks"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(mine))
    dealt = (
        halves.join(large, "half", "left")
        .select("word", "n", "half", "asks", mine.alias("mine"), "blocks", F.explode(to).alias("block"))
        .select(
            F.pmod(F.xxhash64("half", "block"), F.lit(shards)).cast("int").alias("shard"),
            "word",
            "n",
            "asks",
            (F.col("mine") == F.col("block")).alias("indexed"),
        )
    )
    return _searched(dealt).distinct()


def _searched(dealt: DataFrame) -> DataFrame:
    """Pairs found in each shard."""

    def search(rows: list[tuple]) -> pa.RecordBatch:
        n_of: dict[str, int] = {}
        asks: set[str] = set()
        indexed: set[str] = set()
        for _, word, n, asking, here in rows:
            n_of[word] = n
            if asking:
                asks.add(word)
            if here:
                indexed.add(word)
        # Those that only ask are indexed as well, so that a pattern always occurs, and left out of
        # what others find: their own block finds them.
        names = sorted(n_of)
        index = BidirectionalIndex([w.encode("latin-1") for w in names])
        query, found = index.near(np.array([i for i, w in enumerate(names) if w in asks], np.int64))
        pairs = [(names[a], names[b]) for a, b in zip(query.tolist(), found.tolist(), strict=True) if names[b] in indexed]
        return pa.record_batch(
            [
                pa.array([a for a, _ in pairs], pa.string()),
                pa.array([b for _, b in pairs], pa.string()),
                pa.array([n_of[b] for _, b in pairs], pa.int64()),
            ],
            names=["word", "near", "near_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][0] != row[0]:
                    yield search(held)
                    held = []
                held.append(row)
        if held:
            yield search(held)

    ordered = dealt.repartition("shard").sortWithinPartitions("shard")
    return ordered.mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame, staging: Staging) -> DataFrame:
    """word and root, the last of the forms that follow from a word."""
    ways = staging.write("forms", forms.select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        longer = ways.join(on, F.col("root") == F.col("_from"), "left")
        moved = staging.write(
            "ways", longer.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("open"))
        )
        ways = moved.drop("open")
        if moved.where("open").isEmpty():
            return ways


def variants(words: DataFrame, staging: Staging, times: int = TIMES, shard: int = SHARD) -> DataFrame:
    """word, form, root, n, n_near and form_n of a stored table of words and their occurrences."""
    first = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    best = near_words(words, staging, shard).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    told = staging.write(
        "told",
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.less")).cast("long").alias("form_n"),
        ),
    )
    found = roots(told.where(F.col("form").isNotNull()), staging)
    root: Column = F.coalesce("root", "word").alias("root")
    return told.join(found, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def spelling_table(docs: DataFrame, staging: Staging) -> DataFrame:
    """Variants among the words of all documents, some of which lose a letter first."""
    words = staging.write("vocabulary", vocabulary(docs, SLIPS))
    return variants(words, staging)
