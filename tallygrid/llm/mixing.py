"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, target over size of
the source. Its whole part is sure; its fractional part is rounded together with that of the
other documents: two of them are paired, and words move from one to the other in a random
direction until one is rounded up or down. The direction is drawn so that the expected copies of
both stay as they were, and what one loses the other gains, so the words of a source stay at its
target until a single unrounded document is left.

The pairing is a reduction tree. Leaves are chunks of documents of one source. A chunk goes from
its longest document to its shortest and pairs each with all that follow it, so that long
documents are settled while many short ones can still make up for them. What stays open, at most
one document per chunk, mostly a short one, meets the open ones of other chunks on the next
level, until a source has one left, which is rounded by its own number. Only DataFrame functions
are used; a chunk holds ``fan_in`` small rows about, however large a source is.

Defined results for odd input: a null text has size 0; documents of size 0 and those of sources
whose target is 0 are taken 0 times; null ids and null sources are ordinary values, the null
source comes last; repeated rows are documents of their own; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm.common import LOWEST, free, uniform
from tallygrid.operators.ranking import number_rows
from tallygrid.staging import Staging

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3.0
SEED = 20240607
TINY = 1e-9


def sized(docs: DataFrame) -> DataFrame:
    """Id, hash of the text, source and number of words of every document."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        F.xxhash64(text).alias("_text"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def targets(
    documents: DataFrame,
    staging: Staging,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
) -> DataFrame:
    """Source, its size and documents, and its share of all words.

    ``weights`` repeat over the sources in order. A source gets at most ``most`` times its size;
    what is left over goes to the others by weight: the level, words per unit of weight, is
    raised until no other source is above its limit. Each step sends two sums to the driver.
    """
    sums = documents.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count(F.when(F.col("size") > 0, 1)).alias("filled"),
    )
    ranked = number_rows(sums, [F.col("source").asc_nulls_last()], "place", staging, start=0)
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = staging.write(
        "sources",
        ranked.withColumn(
            "weight", F.get(cycle, (F.col("place") % len(weights)).cast("int"))
        ).withColumn("limit", F.col("source_size") * F.lit(float(most))),
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("limit") < F.lit(level) * F.col("weight")
        held, free, count = weighed.agg(
            F.sum(F.when(above, F.col("limit"))),
            F.sum(F.when(~above, F.col("weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if count == full or not free:
            break
        level, full = (total - (held or 0.0)) / free, count
    share = F.least(F.col("limit"), F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", "filled", share.alias("target"))


def _rounded(x: Column) -> Column:
    return F.when(x < TINY, F.lit(0.0)).when(x > 1 - TINY, F.lit(1.0)).otherwise(x)


def _settle_chunk(docs: Column, chance: Column) -> Column:
    """Pair each document of a sorted chunk with all that follow it.

    Gives ``taken`` (one 0 or 1 per document) and the place and chance of the open one, if any.
    """

    def step(state: Column, doc: Column) -> Column:
        size, p, rest = doc["size"], state["p"], state["rest"] - doc["size"]
        own, other = p * size, p * rest
        up, down = F.least(size - own, other), F.least(own, rest - other)
        gains = doc["u"] * (up + down) < down
        moved = F.when(gains, up).otherwise(-down)
        settled = (p == 0.0) | (p == 1.0)
        last = rest <= 0
        mine = F.when(settled | last, p).otherwise(_rounded((own + moved) / size))
        theirs = F.when(settled | last, p).otherwise(_rounded((other - moved) / rest))
        is_open = (mine > 0.0) & (mine < 1.0)
        return F.struct(
            rest.alias("rest"),
            theirs.alias("p"),
            F.when(is_open, F.size(state["taken"])).otherwise(state["open"]).alias("open"),
            F.when(is_open, mine).otherwise(state["chance"]).alias("chance"),
            F.concat(state["taken"], F.array(mine.cast("int"))).alias("taken"),
        )

    total = F.aggregate(docs, F.lit(0.0), lambda a, d: a + d["size"])
    start = F.struct(
        total.alias("rest"),
        _rounded(chance).alias("p"),
        F.lit(-1).alias("open"),
        F.lit(0.0).alias("chance"),
        F.array().cast("array<int>").alias("taken"),
    )
    return F.aggregate(docs, start, step)


def _settle_pairs(docs: Column) -> Column:
    """Pair open documents of different chances one after the other."""
    kind = "struct<chunk:long,size:double,chance:double,u:double>"

    def step(state: Column, doc: Column) -> Column:
        held = state["held"]
        own, other = held["chance"] * held["size"], doc["chance"] * doc["size"]
        up, down = F.least(held["size"] - own, other), F.least(own, doc["size"] - other)
        moved = F.when(doc["u"] * (up + down) < down, up).otherwise(-down)
        first = _rounded((own + moved) / held["size"])
        second = _rounded((other - moved) / doc["size"])

        def done(which: Column, x: Column) -> Column:
            return F.array(F.struct(which["chunk"].alias("chunk"), x.cast("int").alias("taken")))

        def still(which: Column, x: Column) -> Column:
            return F.struct(
                which["chunk"].alias("chunk"),
                which["size"].alias("size"),
                x.alias("chance"),
                which["u"].alias("u"),
            )

        first_done = (first == 0.0) | (first == 1.0)
        second_done = (second == 0.0) | (second == 1.0)
        nothing = F.lit(None).cast(kind)
        empty = F.array().cast("array<struct<chunk:long,taken:int>>")
        return (
            F.when(
                held.isNull(),
                F.struct(doc.cast(kind).alias("held"), state["done"].alias("done")),
            )
            .otherwise(
                F.struct(
                    F.when(first_done & second_done, nothing)
                    .when(first_done, still(doc, second))
                    .otherwise(still(held, first))
                    .cast(kind)
                    .alias("held"),
                    F.concat(
                        state["done"],
                        F.when(first_done, done(held, first)).otherwise(empty),
                        F.when(second_done, done(doc, second)).otherwise(empty),
                    ).alias("done"),
                )
            )
            .cast(f"struct<held:{kind},done:array<struct<chunk:long,taken:int>>>")
        )

    start = F.struct(
        F.lit(None).cast(kind).alias("held"),
        F.array().cast("array<struct<chunk:long,taken:int>>").alias("done"),
    )
    return F.aggregate(docs, start, step)


def _numbered(rows: DataFrame, block: int = 4096) -> DataFrame:
    """Rows with the number of each among its equals (``_copy``), so that they part when hashed.

    Equal rows are counted before the exchange and told apart again in blocks, never gathered.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times"))
    first = F.sequence(F.lit(0).cast("long"), F.col("_times") - 1, F.lit(block).cast("long"))
    blocks = counted.withColumn("_first", F.explode(first))
    last = F.least(F.col("_first") + (block - 1), F.col("_times") - 1)
    return blocks.withColumn("_copy", F.explode(F.sequence("_first", last))).drop("_first", "_times")


def mix(
    docs: DataFrame,
    staging: Staging,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
    seed: int = SEED,
    fan_in: int = 512,
) -> DataFrame:
    """Every document with the copies that the mix takes of it.

    Columns: doc_id, _text (hash of the text), source, size, source_size, target, copies.
    """
    documents = sized(docs)
    sources = staging.write("targets", targets(documents, staging, weights, most))
    ratio = F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")
    ).otherwise(F.lit(0.0))
    known = F.broadcast(sources) if sources.count() <= 10_000 else sources
    known = known.withColumnRenamed("source", "_source")
    joined = (
        documents.join(known, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_ratio", ratio)
        .withColumn("_sure", F.floor(F.col("_ratio") + TINY))
        .withColumn("_chance", F.greatest(F.lit(0.0), F.col("_ratio") - F.col("_sure")))
    )
    chunk = F.pmod(
        F.xxhash64("doc_id", "_text", "_copy", F.lit(seed)),
        F.greatest(F.lit(1), F.ceil(F.col("filled") / F.lit(fan_in))),
    )
    doc = F.struct(
        (-F.col("size")).cast("double").alias("order"),
        F.col("doc_id"),
        F.col("_text"),
        F.col("size").cast("double").alias("size"),
        uniform("doc_id", "_text", "_copy", F.lit(seed + 1)).alias("u"),
    )
    chunks = (
        _numbered(joined.where(F.col("size") > 0))
        .withColumn("chunk", chunk)
        .groupBy("source", "chunk")
        .agg(
            F.sort_array(F.collect_list(doc)).alias("docs"),
            F.any_value("_sure").alias("_sure"),
            F.any_value("_chance").alias("_chance"),
            F.any_value("source_size").alias("source_size"),
            F.any_value("target").alias("target"),
        )
    )
    leaves = staging.write(
        "leaves", chunks.withColumn("settled", _settle_chunk(F.col("docs"), F.col("_chance")))
    )
    at = F.col("settled.open")
    open_ones = leaves.where(at >= 0).select(
        "source",
        "chunk",
        F.get("docs", at)["size"].alias("size"),
        F.col("settled.chance").alias("chance"),
        uniform("source", "chunk", F.lit(seed + 2)).alias("u"),
    )
    decided, level = [], 0
    while True:
        counts = open_ones.groupBy("source").agg(F.count(F.lit(1)).alias("_open"))
        widest = counts.agg(F.max("_open")).first()[0] or 0
        if widest <= 1:
            break
        level += 1
        kept = F.struct(
            (-F.col("size")).alias("order"), "chunk", "size", "chance", "u"
        )
        counts = counts.withColumnRenamed("source", "_source")
        groups = (
            open_ones.join(counts, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn(
                "_group",
                F.pmod(
                    F.xxhash64("chunk", F.lit(seed + level)), F.ceil(F.col("_open") / F.lit(fan_in))
                ),
            )
            .groupBy("source", "_group")
            .agg(F.sort_array(F.collect_list(kept)).alias("docs"))
        )
        docs_of = F.transform(
            "docs",
            lambda d: F.struct(
                d["chunk"].alias("chunk"),
                d["size"].alias("size"),
                d["chance"].alias("chance"),
                uniform(d["chunk"], F.lit(seed + 100 + level)).alias("u"),
            ),
        )
        tree = staging.write(
            f"level_{level}",
            groups.withColumn("settled", _settle_pairs(docs_of)).select("source", "settled"),
        )
        decided.append(
            tree.select("source", F.explode("settled.done").alias("_d")).select(
                "source", "_d.chunk", "_d.taken"
            )
        )
        open_ones = tree.where(F.col("settled.held").isNotNull()).select(
            "source", "settled.held.*"
        )
    decided.append(
        open_ones.select(
            "source", "chunk", (F.col("u") < F.col("chance")).cast("int").alias("taken")
        )
    )
    last = reduce(DataFrame.unionByName, decided).select(
        F.col("source").alias("_source"), F.col("chunk").alias("_chunk"), F.col("taken").alias("_last")
    )
    settled = (
        leaves.join(
            last,
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("chunk") == F.col("_chunk")),
            "left",
        )
        .select(
            "source",
            "source_size",
            "target",
            "_sure",
            at.alias("_open"),
            F.coalesce("_last", F.lit(0)).alias("_last"),
            F.posexplode(F.arrays_zip(F.col("docs").alias("d"), F.col("settled.taken").alias("t"))),
        )
        .select(
            F.col("col.d.doc_id").alias("doc_id"),
            F.col("col.d._text").alias("_text"),
            "source",
            F.col("col.d.size").cast("long").alias("size"),
            "source_size",
            "target",
            (
                F.col("_sure")
                + F.when(F.col("pos") == F.col("_open"), F.col("_last")).otherwise(F.col("col.t"))
            ).alias("copies"),
        )
    )
    empty = joined.where(F.col("size") == 0).select(
        "doc_id", "_text", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("copies")
    )
    return settled.unionByName(empty)


def mixed(docs: DataFrame, staging: Staging, **options) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    plan = mix(docs, staging, **options)
    key, own, nth, named, text, copies, times, each = free(
        docs, "_key", "_own", "_nth", "_named", "_plan", "_copies", "_times", "_each"
    )
    # Few numbers of copies occur, so equal rows are a short list of how often each does.
    plan = (
        plan.groupBy(
            F.coalesce("doc_id", F.lit(LOWEST)).alias(named), F.col("_text").alias(text), "copies"
        )
        .agg(F.count(F.lit(1)).alias(times))
        .groupBy(named, text)
        .agg(F.sort_array(F.collect_list(F.struct("copies", F.col(times).alias("n")))).alias(copies))
    )

    def copies_of(state: Column, some: Column) -> Column:
        mine = (state["left"] > 0) & (state["left"] <= some["n"])
        return F.struct(
            (state["left"] - some["n"]).alias("left"),
            F.when(mine, some["copies"]).otherwise(state["copies"]).alias("copies"),
        )

    start = F.struct(F.col(nth).cast("long").alias("left"), F.lit(0).cast("long").alias("copies"))
    # Numbering and join use the same two columns without nulls, so the texts move once.
    same = Window.partitionBy(key, own).orderBy(key)
    return (
        docs.withColumn(key, F.coalesce(docs["doc_id"].cast("long"), F.lit(LOWEST)))
        .withColumn(own, F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))))
        .withColumn(nth, F.row_number().over(same))
        .join(plan, (F.col(key) == F.col(named)) & (F.col(own) == F.col(text)))
        .withColumn(times, F.aggregate(copies, start, copies_of)["copies"].cast("int"))
        .where(F.col(times) > 0)
        .withColumn(each, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def mixing_table(docs: DataFrame, staging: Staging) -> DataFrame:
    """The digest of a mix: id, sizes, target and words taken."""
    return mix(docs, staging).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        "source",
        F.col("copies").cast("long").alias("copies"),
    )
