"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one of target text, labelled documents of
good quality, and one of raw text, all documents. A document's importance is the ratio of its
likelihoods under both. Documents are then drawn without replacement in proportion to their
importance: the logarithm of the importance plus Gumbel noise is the key, and the k largest keys
are kept (Gumbel top-k). Ties of keys go to the smaller doc_id.

n-grams are words (n = 1) and runs of two and three word shapes: lower case, capitalised, upper
case, digits, a repetition of the word before, or the marks themselves. The log-likelihood ratio
is taken per n-gram and counts as that of ``LENGTH`` n-grams, so that a long document is not
certain to be kept or dropped for its length alone.

k is a share of all documents: that of good ones among the labels, at the upper end of its
confidence interval, so that good documents are not lost to the error of the estimate. The share
counts what the target model is fitted on: a document that its label calls toxic is not good.

Toxic documents of good quality differ from target text in a few words only, which a mean hides. The
raw text therefore has them as a component of its own: buckets found in ``EXCESS`` times as many of
them as expected from target documents add up to the likelihood of that component, over the whole
text and whatever its length, and the importance is divided by one plus its odds.

The target and the toxic model are fitted on at most ``SAMPLE`` labelled documents each, those with the
smallest hash of their id; the raw model, the share and the selection cover all documents. Models have
``BUCKETS`` numbers each, whatever the input; only they reach the driver.

Defined results for odd input: null and empty texts have no n-grams and ratio 0; null ids are
ranked like others and are never labelled; repeated rows are documents of their own; labels that
repeat an id count as good if one of them is; without labels of good documents, or without
others, everything is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.common import uniform, without
from tallygrid.operators.ranking import number_rows
from tallygrid.staging import Staging

SAMPLE = 20_000
BUCKETS = 1 << 14
LENGTH = 60.0
SMOOTHING = 1.0
EXCESS, TOXIC_SMOOTHING = np.e, 5.0
CONFIDENCE = 2.0  # standard errors
SEED = 7
REMEMBERED = 200_000

TOKEN = re.compile(r"\w+|[^\w\s]+")


def _shape(word: str) -> str:
    if not word[0].isalnum():
        return word[:3]
    if word.isdigit():
        return "9"
    if word.isupper():
        return "X" if len(word) > 1 else "A"
    return "A" if word[0].isupper() else "a"


class Features:
    """Buckets of the n-grams of a text; what is remembered of words is bounded."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[int, int]] = {}

    def _of(self, word: str) -> tuple[int, int]:
        found = self._known.get(word)
        if found is None:
            low = word.lower().encode("utf-8", "surrogatepass")
            found = zlib.crc32(low), zlib.crc32(_shape(word).encode("utf-8", "surrogatepass"), 1)
            if len(self._known) < REMEMBERED:
                self._known[word] = found
        return found

    def buckets(self, text: str) -> np.ndarray:
        words = TOKEN.findall(text)
        if not words:
            return np.zeros(0, np.int64)
        pairs = np.array(list(map(self._of, words)), np.int64)
        hashes, shapes = pairs[:, 0], pairs[:, 1].copy()
        shapes[1:][hashes[1:] == hashes[:-1]] = 77
        two = (shapes[:-1] * 1_000_003 + shapes[1:]) & 0x7FFFFFFF
        three = (two[:-1] * 1_000_003 + shapes[2:]) & 0x7FFFFFFF
        mixed = np.concatenate((hashes, two * 31 + 1, three * 37 + 2))
        return (mixed ^ mixed >> 17) % BUCKETS


def is_good(labels: DataFrame) -> Column:
    """Whether a label is one of good quality and not toxic."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) if "toxic" in labels.columns else F.lit(0)
    return (F.col("quality") == 1) & (toxic == 0)


def good_share(labels: DataFrame, confidence: float = CONFIDENCE) -> float | None:
    """Upper end of the confidence interval of the share of good documents; None without both."""
    each = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    each = each.groupBy("doc_id").agg(F.max(is_good(labels)).alias("good"))
    n, good = each.agg(F.count(F.lit(1)), F.count(F.when(F.col("good"), 1))).first()
    if not good or good == n:
        return None
    p, z = good / n, confidence * confidence / n
    upper = (p + z / 2 + confidence * sqrt(p * (1 - p) / n + z / (4 * n))) / (1 + z)
    return min(1.0, upper)


def models(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Logarithm of target over raw probability of every bucket, and of toxic over target documents
    with that bucket (0 below ``EXCESS``), followed by that of their numbers."""
    each = (
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.max(is_good(labels)).alias("_good"))
    )
    order = F.xxhash64("_labelled"), F.col("_labelled")
    good = each.where("_good").orderBy(*order).limit(sample)
    toxic = each.where(~F.col("_good")).orderBy(*order).limit(sample)
    # At most two times ``sample`` ids, so the broadcast is bounded.
    chosen = F.broadcast(good.unionByName(toxic))
    texts = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    marked = texts.join(chosen, F.col("doc_id") == F.col("_labelled"), "left").select("text", "_good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        # In rows: raw and target n-grams; target and toxic documents, whose number comes last.
        counts = np.zeros((4, BUCKETS + 1), np.int64)
        for batch in batches:
            for t, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(features.buckets(t.as_py() or ""), minlength=BUCKETS + 1)
                counts[0] += found
                if good is not None:
                    there = found > 0
                    there[BUCKETS] = True
                    counts[2 if good else 3] += there
                    if good:
                        counts[1] += found
        some = np.flatnonzero(counts.any(0))
        yield pa.record_batch([some, *counts[:, some]], names=["bucket", *"abcd"])

    found = marked.mapInArrow(run, "bucket long, a long, b long, c long, d long").groupBy("bucket")
    counts = np.zeros((4, BUCKETS + 1))
    for bucket, *sums in found.agg(*[F.sum(x) for x in "abcd"]).collect():  # BUCKETS + 1 rows at most
        counts[:, bucket] = sums
    raw, target = counts[0, :BUCKETS] + SMOOTHING, counts[1, :BUCKETS] + SMOOTHING
    ratios = np.log(target / target.sum()) - np.log(raw / raw.sum())
    n_target, n_toxic = counts[2:, BUCKETS]
    if not n_target or not n_toxic:
        return ratios, np.zeros(0)
    expected = counts[2, :BUCKETS] * (n_toxic / n_target)
    excess = np.log((counts[3, :BUCKETS] + TOXIC_SMOOTHING) / (expected + TOXIC_SMOOTHING))
    excess[excess < np.log(EXCESS)] = 0.0
    return ratios, np.append(excess, np.log(n_toxic / n_target))


def log_ratios(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Logarithm of target over raw probability of every bucket."""
    return models(docs, labels, sample)[0]


def importance(
    docs: DataFrame,
    ratios: np.ndarray,
    length: float = LENGTH,
    seed: int = SEED,
    toxic: np.ndarray | None = None,
) -> DataFrame:
    """doc_id, n_grams, log_ratio (per n-gram) and key (with noise) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            counts, means, odds = [], [], []
            for t in batch.column(2):
                found = features.buckets(t.as_py() or "")
                counts.append(len(found))
                means.append(float(ratios[found].mean()) if len(found) else 0.0)
                seen = 0.0
                if toxic is not None and len(toxic):
                    seen = float(toxic[:-1][np.unique(found)].sum())
                odds.append(float(np.logaddexp(0.0, toxic[-1] + seen)) if seen else 0.0)
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(means, pa.float64()),
                    pa.array(odds, pa.float64()),
                ],
                names=["doc_id", "noise", "n_grams", "log_ratio", "toxic"],
            )

    text = docs["text"].cast("string")
    noise = -F.log(-F.log(uniform(docs["doc_id"], F.xxhash64(text), F.lit(seed))))
    scored = docs.select(docs["doc_id"].cast("long"), noise.alias("noise"), text.alias("text")).mapInArrow(
        run, "doc_id long, noise double, n_grams long, log_ratio double, toxic double"
    )
    key = F.lit(length) * F.col("log_ratio") - F.col("toxic") + F.col("noise")
    return scored.select("doc_id", "n_grams", "log_ratio", key.alias("key"))


def ranked(
    docs: DataFrame, labels: DataFrame, staging: Staging, share: float | None = None
) -> tuple[DataFrame, int]:
    """All documents with their rank by key, and how many of them are drawn."""
    share = good_share(labels) if share is None else share
    ratios, toxic = models(docs, labels) if share is not None else (np.zeros(BUCKETS), None)
    scored = staging.write("importance", importance(docs, ratios, toxic=toxic))
    k = scored.count() if share is None else round(share * scored.count())
    order = [F.col("key").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_grams")]
    return number_rows(scored, order, "rank", staging), k


def resample(
    docs: DataFrame, labels: DataFrame, staging: Staging, share: float | None = None
) -> DataFrame:
    """The drawn documents: doc_id, n_grams, log_ratio, key and their rank by key."""
    rows, k = ranked(docs, labels, staging, share)
    return rows.where(F.col("rank") <= k)


def kept(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    """The documents that are drawn; all rows of an id of which one is."""
    rows, k = ranked(docs, labels, staging)
    best = rows.groupBy("doc_id").agg(F.min("rank").alias("rank"))
    gone = staging.write("not_drawn", best.where(F.col("rank") > k).select("doc_id"))
    return without(docs, [docs["doc_id"].cast("long")], gone)
