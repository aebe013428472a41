"""Token files: ids of all documents in ascending doc_id order, range coded in blocks.

Documents are dealt into buckets of neighbouring ids, sorted, tokenised and written, a file per
bucket. A file is a sequence of segments of about ``SEGMENT`` ids that end with a document:

    magic "TGIDS002", then as unsigned 32-bit numbers: documents, ids, blocks, bytes of the
    order-0 table; then for every document its id (signed 64 bits), whether it has one (8 bits)
    and its number of ids (32 bits); then for every block its ids, its bytes and the CRC-32 of
    its bytes (32 bits each); then the order-0 table (compressed) and its CRC-32; then the blocks.

Every block starts afresh and can be checked and decoded with the head of its segment alone. The
list of segments (file, place, documents, ids) is a Parquet table; it is the index of the files
and says where each segment starts in the sequence of all ids.

Texts are cut at blanks, and a worker tokenises a word once and remembers it, up to a bounded
number; the ids are the same because the tokenizer never joins text across white space. Words of
letters, with or without marks behind them, skip its normaliser and its pattern, which would
leave them as they are but for the case.

Defined results for odd input: a null or empty text is a document with only the end id; null
ids sort first; rows of one id are ordered by their text, repeated rows are documents of their
own; an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.llm import idcoder
from tallygrid.llm.common import LOWEST, boundaries, bucket_of, partitions
from tallygrid.llm.storage import Output, read_range, unique
from tallygrid.staging import Staging

MAGIC = b"TGIDS002"
VOCABULARY = "word_bpe_49k.json"
END = 1
BLOCK = 1024
SEGMENT = 1 << 22
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 1 << 25  # words that a worker remembers, and their bytes
#: Letters that the normaliser of the vocabulary changes by simple lower case at most.
LATIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+$"
LETTERS = string.ascii_letters + "".join(map(chr, {*range(0xC0, 0x250)} - {0xD7, 0xF7, 0x130}))
PIECE = 1 << 24  # bytes of texts that are tokenised together, but always whole texts

INDEX = "bucket int, segment int, path string, offset long, bytes long, docs long, ids long"
ROWS = "bucket int, segment int, nth int, doc_id long, start long, n_tokens long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes without a printable one in the vocabulary."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - printable))}


def _strings(words: pa.Array) -> list[str]:
    # to_pylist makes an Arrow scalar of each word first
    return words.to_numpy(zero_copy_only=False).tolist()


def gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of values one after the other."""
    upto = np.cumsum(size)
    return values.take(np.arange(size.sum()) + np.repeat(begin - upto + size, size))


class Known(dict):
    """Number of each word; one that is asked for first gets the next number."""

    def __init__(self, known: dict[str, int], first: int = 0):
        super().__init__(known)
        self.first, self.new = first, []

    def __missing__(self, word: str) -> int:
        code = self[word] = self.first + len(self)
        self.new.append(word)
        return code


class Tokens:
    """Ids of texts as 16-bit numbers, by the tokenizers library."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary has more than 65536 ids")
        # Words with the places of their ids; the first one is empty.
        self._known = Known({"": 0})
        self._held = 0
        self._ids = np.zeros(0, np.uint16)
        self._begin, self._size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self._byte_letters = _byte_letters()
        # Only a tokenizer that lowers the case and cuts at letters treats them alike.
        self._short_cut = path.endswith(VOCABULARY)

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _model(self, words: list[str]) -> list[list[int]]:
        """Ids of words of lower case letters."""
        model, letters, out = self._tokenizer.model, self._byte_letters, []
        for word in words:
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(letters)
            out.append([x.id for x in model.tokenize(word)])
        return out

    def _forget(self) -> None:
        """Keep what was met first, as common words are."""
        known, new = self._known, self._known.new
        known.new = []
        n = len(known) - len(new)
        for word in new:
            if n >= REMEMBERED or self._held + len(word) > REMEMBERED_BYTES:
                break
            self._held += len(word)
            n += 1
        n = min(n, max(1, REMEMBERED))
        if n == len(known):
            return
        for word in [*known][n:]:
            del known[word]
        self._begin, self._size = self._begin[:n].copy(), self._size[:n].copy()
        self._ids = self._ids[: self._begin[-1] + self._size[-1]].copy()

    def _places(self, words: pa.Array, encode: Callable[[list[str]], list[list[int]]]) -> np.ndarray:
        """Where words are among those known; ``encode`` gives the ids of new ones."""
        known = self._known
        before = len(known.new)
        names = _strings(words)
        place = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        new = known.new[before:]
        if new:
            found = encode(new)
            size = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint16, size.sum())
            self._begin = np.concatenate((self._begin, len(self._ids) + np.cumsum(size) - size))
            self._size = np.concatenate((self._size, size))
            self._ids = np.concatenate((self._ids, ids))
        return place

    def _words(self, words: pa.Array) -> np.ndarray:
        """Places of the two parts of words: letters, or all of an odd word, and the marks behind."""
        place = np.zeros((len(words), 2), np.int64)
        if not self._short_cut:
            place[:, 0] = self._places(words, self._encode)
            return place
        heads = pc.utf8_rtrim(words, string.punctuation)
        plain = pc.match_substring_regex(heads, LATIN)
        odd = pc.invert(plain)
        marked = pc.and_(plain, pc.not_equal(words, heads))
        # Few kinds of marks stand behind many words.
        marks = pc.utf8_ltrim(words.filter(marked), LETTERS).dictionary_encode()
        for mask, part, some, encode in (
            (plain, 0, pc.utf8_lower(heads.filter(plain)), self._model),
            (odd, 0, words.filter(odd), self._encode),
        ):
            place[mask.to_numpy(zero_copy_only=False), part] = self._places(some, encode)
        of_marks = self._places(marks.dictionary, self._encode)
        place[marked.to_numpy(zero_copy_only=False), 1] = of_marks.take(marks.indices.to_numpy())
        return place

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and the number of ids of each."""
        self._forget()
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        coded = cut.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        place = self._words(coded.dictionary)
        parts = self._size[place]
        own = gather(self._ids, self._begin[place].ravel(), parts.ravel())
        sizes = parts.sum(1)
        counts = sizes.take(codes)
        ids = gather(own, (np.cumsum(sizes) - sizes).take(codes), counts)
        upto = np.concatenate(([0], np.cumsum(counts)))
        return ids, np.diff(upto[ends], prepend=0)


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[pa.Array]:
    """Consecutive parts of an array of about so many bytes, or one text."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + size, "right")))
        yield texts.slice(at, end - at)
        at = end


_LOADED: dict[str | None, Tokens] = {}


def tokens(path: str | None) -> Tokens:
    """One tokenizer per worker and file, with what it remembers."""
    if path not in _LOADED:
        _LOADED[path] = Tokens(path)
    return _LOADED[path]


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment of some documents."""
    order0 = idcoder.frequencies(ids)
    sizes = idcoder.block_lengths(len(ids), block)
    blocks = idcoder.encode(ids, sizes, order0)
    table = zlib.compress(order0.astype("<u4").tobytes(), 1)
    return b"".join(
        [
            MAGIC,
            struct.pack("<4I", len(doc_ids), len(ids), len(blocks), len(table)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array(lengths, "<u4").tobytes(),
            np.array(sizes, "<u4").tobytes(),
            np.array([len(b) for b in blocks], "<u4").tobytes(),
            np.array([zlib.crc32(b) for b in blocks], "<u4").tobytes(),
            table,
            struct.pack("<I", zlib.crc32(table)),
            *blocks,
        ]
    )


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, and all ids of a segment; every checksum is checked."""
    if data[:8] != MAGIC:
        raise ValueError("not a segment of token ids")
    docs, n, count, table_bytes = struct.unpack_from("<4I", data, 8)
    at = 24

    def column(kind: str, rows: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, rows, at)
        at += out.nbytes
        return out

    named, valid = column("<i8", docs), column("u1", docs)
    lengths, sizes = column("<u4", docs), column("<u4", count)
    stored, sums = column("<u4", count), column("<u4", count)
    table = data[at : at + table_bytes]
    at += table_bytes
    if zlib.crc32(table) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError("the order-0 table is damaged")
    at += 4
    blocks = []
    for size, check in zip(stored.tolist(), sums.tolist(), strict=True):
        blocks.append(data[at : at + size])
        at += size
        if zlib.crc32(blocks[-1]) != check:
            raise ValueError("a block is damaged")
    order0 = np.frombuffer(zlib.decompress(table), "<u4").astype(np.int64)
    ids = idcoder.decode(blocks, sizes.tolist(), order0)
    if len(ids) != n:
        raise ValueError("a segment is incomplete")
    return [int(d) if v else None for d, v in zip(named, valid, strict=True)], lengths, ids


def write_tokens(
    docs: DataFrame, folder: str, staging: Staging, vocabulary: str | None = None, end: int = END
) -> DataFrame:
    """Write the files and return their index."""
    cuts_key = F.coalesce(docs["doc_id"].cast("long"), F.lit(LOWEST))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        cuts_key.alias("key"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    n = partitions(docs.sparkSession)
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), boundaries(rows, "key", n)))
    ordered = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens(vocabulary)
        out: Output | None = None
        path, segment, bucket = "", 0, None
        names: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        last = np.array([end], np.uint16)

        def flush() -> dict:
            nonlocal segment
            ids = np.concatenate(parts)
            data = pack(names, lengths, ids)
            place = out.place
            out.write(data)
            row = {
                "bucket": bucket, "segment": segment, "path": path, "offset": place,
                "bytes": len(data), "docs": len(names), "ids": len(ids),
            }
            names.clear(), lengths.clear(), parts.clear()
            segment += 1
            return row

        held, index = 0, []
        for batch in batches:
            texts, at = batch.column(2), 0
            for piece in pieces(texts):
                ids, counts = encoder.ids(piece)
                here = batch.slice(at, len(piece))
                at += len(piece)
                upto = 0
                for d, b, n in zip(
                    here.column(0).to_pylist(), here.column(1).to_pylist(), counts.tolist(), strict=True
                ):
                    if b != bucket:
                        if parts:
                            index.append(flush())
                        if out is not None:
                            out.close()
                        bucket, segment, held = b, 0, 0
                        path = unique(folder, ".ids")
                        out = Output(path)
                    names.append(d)
                    lengths.append(n + 1)
                    parts += [ids[upto : upto + n], last]
                    upto += n
                    held += n + 1
                    if held >= SEGMENT:
                        index.append(flush())
                        held = 0
        if parts:
            index.append(flush())
        if out is not None:
            out.close()
        if index:
            yield pa.RecordBatch.from_pylist(index, schema=_INDEX)

    return staging.write("token_index", ordered.select("doc_id", "bucket", "text").mapInArrow(run, INDEX))


_INDEX = pa.schema(
    [
        ("bucket", pa.int32()), ("segment", pa.int32()), ("path", pa.string()), ("offset", pa.int64()),
        ("bytes", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()),
    ]
)
_ROWS = pa.schema(
    [
        ("bucket", pa.int32()), ("segment", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()),
        ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ]
)


def read_documents(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Document ids and their token ids."""
    names, lengths, ids = unpack(data)
    at = 0
    for name, n in zip(names, lengths.tolist(), strict=True):
        yield name, ids[at : at + n]
        at += n


def read_tokens(index: DataFrame) -> DataFrame:
    """A row per document, from the files: place of its first id, number of ids, their CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                names: list[int | None] = []
                sizes: list[int] = []
                sums: list[int] = []
                for name, ids in read_documents(read_range(r["path"], r["offset"], r["bytes"])):
                    names.append(name)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4")))
                n = np.array(sizes, np.int64)
                columns = [
                    np.full(len(n), r["bucket"]), np.full(len(n), r["segment"]), np.arange(len(n)), names,
                    r["base"] + np.cumsum(n) - n, n, sums,
                ]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=_ROWS)

    # Places of segments: sums per bucket (one per partition) first, then within the bucket.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("bucket").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    buckets = index.groupBy("bucket").agg(F.sum("ids").alias("n"))
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start"))
    placed = (
        index.withColumn("segment_start", F.coalesce(F.sum("ids").over(within), F.lit(0)))
        .join(buckets, "bucket")
        .withColumn("base", F.col("bucket_start") + F.col("segment_start"))
    )
    n = partitions(index.sparkSession)
    return (
        placed.repartition(n, "bucket", "segment")
        .mapInArrow(run, ROWS)
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )


def token_table(docs: DataFrame, staging: Staging, vocabulary: str | None = None) -> DataFrame:
    """Write all documents and read them back."""
    index = write_tokens(docs, f"{staging.folder}/tokens", staging, vocabulary)
    return read_tokens(index)
