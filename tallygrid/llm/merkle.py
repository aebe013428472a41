"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

Paragraphs are lines. A paragraph is cut into pieces after punctuation of any script and after some
word ends; in scripts written without blanks after some characters, chosen by their code points.
Such cuts depend on the text beside them, so an edit moves no cut elsewhere. Only what has none of
them for 512 characters is cut there. The hash of a paragraph is over those of its pieces; a section
ends after a paragraph whose hash starts with one of four digits and its hash is over those of its
paragraphs; the root is over the sections. All of them are whole SHA-256 digests and nothing is
thrown away by the cuts, so equal roots mean equal texts.

A fingerprint is written as root, a colon, and the first digits of the hashes of the pieces with a full stop between
pieces, a semicolon between paragraphs and a slash between sections. Two fingerprints are equal
or are compared branch by branch: their likeness is twice the number of different pieces in both
over the sum of the different pieces of each, and the first unequal piece locates an edit.
Only DataFrame functions are used.

Defined results for odd input: a null text counts as empty, an empty text has one empty piece;
null ids sort first, rows of one id by their text, so repeated rows follow each other; the only
row of a table is its own next document; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm.common import LOWEST, boundaries, bucket_of, partitions

PARAGRAPH = r"(?<=\n)"
LONGEST = 512
#: every sixteenth character of the scripts between Thai and Hangul, in blocks of four
SPACELESS = "".join(
    f"\\u{low:04X}-\\u{low + 3:04X}"
    for first, last in ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF))
    for low in range(first, last, 64)
) + "".join(f"\\u{low:04X}-\\u{low + 63:04X}" for low in range(0x3400, 0xD7A0, 1024))
PIECE = (
    r"(?<=[.!?,;:|%#&*$ns] )"
    r"|(?<=[^\x00-\x7F])(?:(?<=[。，、！？；：．｡।॥۔؟،؛።፣])|(?<=[" + SPACELESS + r"]))"
    r"|(?<=[^\x00-\x7F] )"
    rf"|(?<=\G[\s\S]{{{LONGEST}}})"
)
PIECE_DIGITS = 8
SECTION_ENDS = "0123"


def pieces(text: Column) -> Column:
    """Array of paragraphs, each an array of pieces; joined they are the text."""
    cut = F.transform(F.split(text, PARAGRAPH), lambda p: F.split(p, PIECE))
    # The pattern counts a character beyond the first plane as two and misses the cut behind it.
    return F.transform(
        cut,
        lambda p: F.when(
            F.exists(p, lambda x: F.length(x) > LONGEST), F.flatten(F.transform(p, _parts))
        ).otherwise(p),
    )


def _parts(piece: Column) -> Column:
    """A piece in parts of the greatest length; an empty one stays."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(piece), F.lit(1)), F.lit(LONGEST))
    return F.transform(starts, lambda at: F.substring(piece, at, F.lit(LONGEST)))


def fingerprinted(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text column that has no nulls."""
    leaves, nodes, ends = f"_{name}_leaves", f"_{name}_nodes", f"_{name}_ends"
    columns = df.columns
    df = df.withColumn(
        leaves, F.transform(pieces(F.col(text)), lambda p: F.transform(p, lambda x: F.sha2(x, 256)))
    )
    df = df.withColumn(nodes, F.transform(F.col(leaves), lambda p: F.sha2(F.array_join(p, "."), 256)))
    df = df.withColumn(
        ends,
        F.transform(
            F.col(nodes),
            lambda h: F.when(F.left(h, F.lit(1)).isin(list(SECTION_ENDS)), "/").otherwise(";"),
        ),
    )
    sections = F.split(F.array_join(F.zip_with(nodes, ends, lambda h, e: F.concat(h, e)), ""), "/")
    root = F.sha2(F.array_join(F.transform(sections, lambda s: F.sha2(s, 256)), ","), 256)
    printed = F.transform(
        leaves, lambda p: F.array_join(F.transform(p, lambda x: F.left(x, F.lit(PIECE_DIGITS))), ".")
    )
    body = F.array_join(F.zip_with(printed, ends, lambda p, e: F.concat(p, e)), "")
    return df.select(*columns, F.concat(root, F.lit(":"), body).alias(name))


def root_of(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def branch(fingerprint: Column) -> Column:
    """The hashes of the pieces, in order."""
    body = F.substring_index(fingerprint, ":", -1)
    return F.array_remove(F.split(body, r"[.;/]"), "")


def likeness(a: Column, b: Column) -> Column:
    """0 for nothing in common up to 1 for equal fingerprints."""
    shared = F.size(F.array_intersect(branch(a), branch(b)))
    total = F.size(F.array_distinct(branch(a))) + F.size(F.array_distinct(branch(b)))
    return F.when(root_of(a) == root_of(b), F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), 2.0 * shared / total)
    )


def first_difference(a: Column, b: Column) -> Column:
    """Place of the first piece in which two fingerprints differ, from 0; null if they are equal."""
    same = F.zip_with(branch(a), branch(b), lambda x, y: x.eqNullSafe(y))
    place = F.array_position(same, False)
    return F.when(root_of(a) == root_of(b), F.lit(None)).when(
        place > 0, place - 1
    ).otherwise(F.size(same).cast("long"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text of the next document by doc_id, the first after the last.

    Documents are dealt into buckets of neighbouring ids, one exchange. Each bucket also gets a
    copy of the first document of the bucket after it; one id per bucket reaches the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(LOWEST)).alias("_key"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    cuts = boundaries(rows, "_key", partitions(spark))
    rows = rows.withColumn("_bucket", bucket_of(F.col("_key"), cuts))
    firsts = rows.groupBy("_bucket").agg(F.min("_key").alias("_first")).orderBy("_bucket").collect()
    follows = [(firsts[(i + 1) % len(firsts)]["_first"], r["_bucket"]) for i, r in enumerate(firsts)]
    guards = spark.createDataFrame(follows or [(0, -1)], "_first long, _for int")
    ends = (
        rows.join(F.broadcast(guards), F.col("_key") == F.col("_first"))
        .groupBy("_for", "_key")
        .agg(F.min("text").alias("text"))
        .select(
            F.lit(None).cast("long").alias("doc_id"),
            "_key",
            "text",
            F.col("_for").alias("_bucket"),
            F.lit(1).alias("_guard"),
        )
    )
    order = Window.partitionBy("_bucket").orderBy("_guard", "_key", "text")
    return rows.withColumn("_guard", F.lit(0)).unionByName(ends).withColumn(
        "next_text", F.lead("text").over(order)
    )


def merkle_table(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    order = Window.partitionBy("_bucket").orderBy("_guard", "_key", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    df = fingerprinted(df, "text", "fingerprint")
    df = df.withColumn("_next", F.lead("fingerprint").over(order)).where(F.col("_guard") == 0)
    df = df.withColumn(
        "_edited",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring(F.col("next_text"), F.lit(1), half),
        ),
    ).select("doc_id", "n_chars", "fingerprint", "_next", "_edited")
    df = fingerprinted(df, "_edited", "edited_fingerprint")
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
        first_difference(F.col("fingerprint"), F.col("edited_fingerprint")).alias("first_edited_piece"),
    )
