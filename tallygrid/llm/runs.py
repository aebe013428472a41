"""Periodic runs of words, from the suffix array and common prefixes of many documents at once.

Words are numbers; documents are laid one after the other with an end mark of its own behind
each, so that no repeat reaches from one into another. Every cut of the suffix array with a
common prefix of q words parts an interval into two sides. The suffixes i of the smaller side ask
the inverse suffix array whether i + q or i - q lies on the other side: then q words are
repeated at once and the word behind them differs, a branching square. All other squares are
rotations of these, so each is rotated to the left as long as the word before it agrees; squares
that meet in one stretch are merged into a run with the smallest period. Intervals are pairs of
numbers throughout; there are no nodes.

The words of a stretch are q apart identical; a run has at least ``LEAST`` words and ``POWER``
periods, and no neighbouring word extends it.

Defined results for odd input: a null or empty text, or one of blanks only, has no words and no
runs; a null doc_id keeps its row and its words as they are; repeated rows keep their rows; an
empty table gives an empty result; other columns are ignored. A text of any length is searched
whole; texts are put together up to about ``PIECE`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.suffixes import Suffixes, sides

LEAST, POWER = 24, 3
PIECE = 1 << 18
SLICE = 1 << 22  # suffixes of smaller sides that are looked at together

Run = tuple[int, int, int]  # first word, words, period

RESULT = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("runs", _RUNS), ("collapsed", pa.string())])


def branching_squares(suffixes: Suffixes, least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and period of every square whose next word differs from the one a period before,
    if its text is long enough for a run of that period."""
    common = suffixes.common()
    order, place, n = suffixes.order, suffixes.place, len(common)
    # A run of period q is max(least, power * q) words long at least.
    cuts = np.flatnonzero((common > 0) & (common <= n // power))
    if not len(cuts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = sides(common, cuts)
    smaller = np.minimum(cuts - left, right - cuts)
    found_at, found_q = [], []
    ends = np.cumsum(smaller)
    begin = 0
    while begin < len(cuts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        own = slice(begin, end)
        size = smaller[own]
        total = int(size.sum())
        which = np.repeat(np.arange(begin, end), size)
        nth = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        is_left = (cuts[own] - left[own] <= right[own] - cuts[own]).repeat(size)
        cut = cuts[which]
        i = order[np.where(is_left, left[which], cut) + nth].astype(np.int64)
        q = common[cut].astype(np.int64)
        low, high = np.where(is_left, cut, left[which]), np.where(is_left, right[which], cut)
        for step, first in ((q, i), (-q, i - q)):
            other = i + step
            inside = (other >= 0) & (other < n)
            rank = place[np.where(inside, other, 0)]
            hit = inside & (rank >= low) & (rank < high)
            found_at.append(first[hit])
            found_q.append(q[hit])
        begin = end
    return np.concatenate(found_at), np.concatenate(found_q)


def rotated(codes: np.ndarray, first: int, period: int, step: int = 64) -> int:
    """Where the stretch of a square begins: rotated to the left while the word before agrees."""
    while first > 0:
        low = max(0, first - step)
        differ = np.flatnonzero(codes[low:first] != codes[low + period : first + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        first, step = low, 2 * step
    return first


def find_runs(codes: np.ndarray, least: int = LEAST, power: int = POWER) -> list[Run]:
    """All runs of a sequence, by first word and period."""
    if len(codes) < max(least, power):
        return []
    at, q = branching_squares(Suffixes(codes), least, power)
    end = at + 2 * q
    # The farthest rotation that a run needs, and two on the way, turn nearly all squares away.
    needed = end - np.maximum(least, power * q)
    keep = needed >= 0
    at, q, end, needed = at[keep], q[keep], end[keep], needed[keep]
    for share in (0, 1, 2):
        probe = needed + np.maximum(at - 1 - needed, 0) * share // 2
        keep = (codes[probe] == codes[probe + q]) | (probe >= at)
        at, q, end, needed = at[keep], q[keep], end[keep], needed[keep]
    stretches: dict[tuple[int, int], int] = {}
    for first, period, stop, upto in zip(at.tolist(), q.tolist(), end.tolist(), needed.tolist(), strict=True):
        begin = rotated(codes, first, period)
        if begin <= upto:
            known = stretches.get((begin, stop))
            stretches[begin, stop] = period if known is None else min(known, period)
    return sorted((begin, stop - begin, period) for (begin, stop), period in stretches.items())


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Whether each word stays when every run is cut down to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def texts_with_runs(
    texts: list[bytes | None], least: int = LEAST, power: int = POWER
) -> Iterator[tuple[list[bytes], list[Run]]]:
    """Words and runs of some texts, searched together."""
    split = [(text or b"").split() for text in texts]
    sizes = np.array([len(words) for words in split], np.int64)
    flat = pa.array([w for words in split for w in words], pa.large_binary()).dictionary_encode()
    codes = np.empty(int(sizes.sum()) + len(split), np.int64)
    marks = np.cumsum(sizes + 1) - 1
    is_word = np.ones(len(codes), bool)
    is_word[marks] = False
    codes[is_word] = flat.indices.to_numpy()
    codes[marks] = len(flat.dictionary) + np.arange(len(split))
    found: list[list[Run]] = [[] for _ in split]
    for start, length, period in find_runs(codes, least, power):
        nth = int(np.searchsorted(marks, start))
        found[nth].append((start - (int(marks[nth - 1]) + 1 if nth else 0), length, period))
    yield from zip(split, found, strict=True)


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by blanks, with every run cut down to its first period."""
    if runs:
        words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
    return b" ".join(words)


def _pieces(texts: Iterator[bytes | None]) -> Iterator[list[bytes | None]]:
    """Texts put together; a word takes six bytes or so."""
    held, size = [], 0
    for text in texts:
        n = len(text or b"") // 6 + 1
        if held and size + n > PIECE:
            yield held
            held, size = [], 0
        held.append(text)
        size += n
    if held:
        yield held


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, all runs by first word and period, and the text in which every run is cut down to
    its first period, its words joined by blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for piece in _pieces(t.as_py() for t in batch.column(1)):
                rows, texts = [], []
                for words, runs in texts_with_runs(piece, least, power):
                    rows.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                    texts.append(collapsed(words, runs).decode("utf-8", "replace"))
                names = batch.column(0).slice(at, len(piece))
                at += len(piece)
                yield pa.record_batch([names, pa.array(rows, _RUNS), pa.array(texts)], schema=_ARROW)

    text = docs["text"].cast("string").cast("binary")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, RESULT)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, with repeats laid into about a tenth of the documents, by the hash of their ids."""
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.crc32(doc_id.cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, split))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, g % n)
    rows = rows.withColumn("n", n).withColumn("a", a)
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    laid = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
        lambda i: F.element_at("words", place(i).cast("int") + 1),
    )
    return rows.withColumn("p", p).select(
        "doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", laid)).otherwise(F.col("text")).alias("text")
    )


def runs_table(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, the strongest one, and digests of all runs and of the collapsed
    text, after repeats are laid into some documents."""
    found = periodic_runs(with_repeats(docs))
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def stronger(best: Column, run: Column) -> Column:
        # Runs come by first word and period, so the first of equals stays.
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    def line(run: Column) -> Column:
        return F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))

    listed = F.concat_ws("", F.transform("runs", line))
    best = F.aggregate("runs", nothing, stronger).alias("best")
    return found.select("doc_id", "runs", "collapsed", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
