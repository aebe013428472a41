"""Byte-level BPE: texts to ids and back, by rounds of merges over many words at once.

A text is cut into words by the pattern of the tokenizer. The symbols of all words that are new to
a worker lie in one flat array, one after the other. In a round every word merges its pair of
lowest rank wherever it occurs; ranks are found by binary search over the sorted keys of all pairs
that the vocabulary merges, and only next to what has just been merged. Words are cut beforehand
where no merge of the vocabulary can ever join two bytes. What is still longer than ``LONG`` symbols
takes its merges from a queue by rank instead, so that a text without a blank costs about its length
times the logarithm of it and not its length times its merges. Both orders give the ids of one
merge after the other: a merge never makes a pair that ranks before it.

Decoding puts the bytes of all tokens one after the other; bytes that are no UTF-8 become U+FFFD.

Defined results for odd input: a null or empty text has no ids and decodes to an empty text; null
ids keep their rows; special tokens in a text are one id each; repeated rows keep their rows; an
empty table gives an empty result; other columns are ignored. The vocabulary must be a byte-level
BPE without normaliser and without a blank put in front, or a ``ValueError`` says so.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.tokens import Known, gather, pieces

VOCABULARY = "byte_bpe_50k.json"
LONG = 256
REMEMBERED, REMEMBERED_BYTES = 400_000, 1 << 24  # words that a worker remembers, and their bytes
PIECE = 1 << 22  # bytes of texts that are taken together, but always whole texts
LATIN = 0x250  # characters from here on need the larger pattern
NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it can be printed, else one from 256 up."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    out: list[list[int]] = []
    for c in sorted(points):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


def latin_words() -> re.Pattern:
    """Words of texts with characters below ``LATIN`` only."""
    points = [chr(c) for c in range(LATIN)]
    letter, number = (
        "".join(c for c in points if unicodedata.category(c)[0] == kind) for kind in ("L", "N")
    )
    blank = "".join(c for c in points if c.isspace() and not "\x1c" <= c <= "\x1f")
    blank = re.escape(blank)
    return re.compile(
        rf" ?[{letter}]++|'(?:s|t|re|ve|m|ll|d)| ?[{number}]++| ?[^{blank}{letter}{number}]++"
        rf"|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


def all_words(path: str):
    """Words of any text. Characters that only a newer Unicode calls letters or numbers are left out
    of these classes: the tokenizer is asked for all."""
    import regex
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, chain(range(LATIN, 0xD800), range(0xE000, 0x110000))))
    sets = []
    for kind, sample in (("L", "a"), ("N", "1")):
        points = regex.findall(rf"\p{{{kind}}}", every)
        joined = {a // 3 for _, (a, b) in cut("\n".join(sample + c for c in points)) if b - a == 2}
        young = [ord(c) for i, c in enumerate(points) if i not in joined]
        sets.append(rf"[\p{{{kind}}}--[{_ranges(young)}]]" if young else rf"\p{{{kind}}}")
    letter, number = sets
    return regex.compile(
        rf"(?V1) ?{letter}++|'(?:s|t|re|ve|m|ll|d)| ?{number}++| ?[^\s{letter}{number}]++|\s+(?!\S)|\s+"
    )


class Vocabulary:
    """Symbols, pairs and words of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model, before = said["model"], said["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and said["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before["add_prefix_space"]
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t[k] for t in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            raise ValueError("not a plain byte-level BPE")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.size = max(*ids.values(), *self.special.values(), 0) + 1
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        spelled: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            spelled[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(s) for s in spelled], np.int64)
        self.spelled_begin = np.cumsum(self.spelled_size) - self.spelled_size
        self.of_byte = np.array([ids[c] for c in letters], np.int32)

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        keys = left * self.size + right
        by_key = np.argsort(keys)
        self.keys, self.key_rank = np.append(keys[by_key], -1), np.append(by_key, NO_RANK).astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        self.joins = np.zeros((256, 256), bool)
        last = self.spelled[self.spelled_begin[left] + self.spelled_size[left] - 1]
        self.joins[last, self.spelled[self.spelled_begin[right]]] = True
        self._path = path
        self._latin, self._any = latin_words(), None
        longest = sorted(self.special, key=len, reverse=True)
        self._special_pattern = re.compile("(" + "|".join(map(re.escape, longest)) + ")")

    def pattern(self, text: str) -> re.Pattern:
        """The pattern that cuts a text into words: a quicker one where all letters are Latin."""
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
        if not len(units) or units.max() < LATIN:
            return self._latin
        if self._any is None:
            self._any = all_words(self._path)
        return self._any

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two symbols."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys[:-1], wanted)
        return np.where(self.keys[at] == wanted, self.key_rank[at], NO_RANK)

    def parts(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Words up to each special token and its id; the last part has none."""
        if any(token in text for token in self.special):
            *parts, last = self._special_pattern.split(text)
            for part, token in zip(parts[::2], parts[1::2], strict=True):
                yield self.pattern(part).findall(part), self.special[token]
            text = last
        yield self.pattern(text).findall(text), None

    # --- merges

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one word after the other, and the number of ids of each."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        begins = np.ones(len(data), bool)
        begins[1:] = (word[1:] != word[:-1]) | ~self.joins[data[:-1], data[1:]]
        part = np.cumsum(begins) - 1
        length = np.bincount(part)
        is_long = (length > LONG)[part] if len(part) else np.zeros(0, bool)
        symbols = self.of_byte[data]
        places, out = [], []
        for mask, how in ((~is_long, self._rounds), (is_long, self._queue)):
            at = np.flatnonzero(mask)
            if len(at):
                stayed, ids = how(symbols[at], part[at])
                places.append(at[stayed])
                out.append(ids)
        if not out:
            return np.zeros(0, np.int32), sizes
        place = np.concatenate(places)
        order = np.argsort(place, kind="stable")
        counts = np.bincount(word[place], minlength=len(words))
        return np.concatenate(out)[order], counts

    @staticmethod
    def _every_other(hit: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """Of hits that overlap in a row (each ``follows`` the one before) the first, third, ..."""
        at = np.arange(len(hit))
        first = np.maximum.accumulate(np.where(follows, 0, at))
        return hit[(at - first) % 2 == 0]

    def _rounds(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and ids of the symbols left when every part has made all its merges."""
        place = np.arange(len(symbols))
        rank = np.full(len(symbols), NO_RANK, np.int32)
        inner = np.flatnonzero(part[1:] == part[:-1])
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        done_place, done_ids = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(part)))
            over = np.repeat(least == NO_RANK, sizes)
            if over.any():
                done_place.append(place[over])
                done_ids.append(symbols[over])
                stay = ~over
                symbols, part, place, rank = symbols[stay], part[stay], place[stay], rank[stay]
                sizes, least = sizes[least != NO_RANK], least[least != NO_RANK]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            follows = np.zeros(len(hit), bool)
            follows[1:] = (hit[1:] == hit[:-1] + 1) & (part[hit[1:]] == part[hit[:-1]])
            if follows.any():
                hit = self._every_other(hit, follows)
            symbols[hit] = self.merged[rank[hit]]
            gone = np.zeros(len(symbols), bool)
            gone[hit + 1] = True
            changed = np.zeros(len(symbols), bool)
            changed[hit] = True
            changed[hit[hit > 0] - 1] = True
            # What stands before a merge may itself have gone: then the one before that changes.
            before = hit[hit > 1]
            changed[before[gone[before - 1]] - 2] = True
            stay = ~gone
            symbols, part, place = symbols[stay], part[stay], place[stay]
            rank, changed = rank[stay], changed[stay]
            again = np.flatnonzero(changed)
            rank[again] = NO_RANK
            again = again[again + 1 < len(part)]
            again = again[part[again] == part[again + 1]]
            rank[again] = self.ranks(symbols[again], symbols[again + 1])
        return np.concatenate(done_place), np.concatenate(done_ids)

    def _queue(self, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for long parts: merges in the order of their ranks over all parts at once."""
        n = len(symbols)
        ends = np.append(part[1:] != part[:-1], True)
        after = np.where(ends, -1, np.arange(1, n + 1))
        before = np.where(np.concatenate(([True], ends[:-1])), -1, np.arange(-1, n - 1))
        alive = np.ones(n, bool)
        rank = np.full(n, NO_RANK, np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look(at: np.ndarray) -> None:
            """Ranks of the pairs that begin at these places, put into the queue."""
            rank[at] = NO_RANK
            at = at[after[at] >= 0]
            rank[at] = self.ranks(symbols[at], symbols[after[at]])
            at = at[rank[at] != NO_RANK]
            at = at[np.argsort(rank[at], kind="stable")]
            cuts = np.flatnonzero(np.diff(rank[at])) + 1
            for group in np.split(at, cuts) if len(at) else ():
                r = int(rank[group[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(group)

        look(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            hit = np.unique(np.concatenate(waiting.pop(r)))
            hit = hit[rank[hit] == r]
            if not len(hit):
                continue
            follows = np.zeros(len(hit), bool)
            follows[1:] = after[hit[:-1]] == hit[1:]
            if follows.any():
                hit = self._every_other(hit, follows)
            gone = after[hit]
            symbols[hit] = self.merged[r]
            alive[gone] = False
            rank[gone] = NO_RANK
            after[hit] = after[gone]
            inner = after[hit] >= 0
            before[after[hit[inner]]] = hit[inner]
            look(np.unique(np.concatenate((hit, before[hit][before[hit] >= 0]))))
        stayed = np.flatnonzero(alive)
        return stayed, symbols[stayed]

    def spell(self, ids: np.ndarray) -> bytes:
        return gather(self.spelled, self.spelled_begin[ids], self.spelled_size[ids]).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.spell(ids).decode("utf-8", "replace")


class Encoder:
    """Ids of texts, with the words that a worker remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary = vocabulary
        special = np.array(sorted(vocabulary.special.values()), np.int32)
        self._special = {i: k for k, i in enumerate(special.tolist())}
        self._known = Known({}, len(special))
        self._ids = special
        self._size = np.ones(len(special), np.int64)
        self._bytes = 0

    def _forget(self) -> None:
        """Keep what was met first, as common words are."""
        known, new = self._known, self._known.new
        before = len(known) - len(new)
        known.new = []
        for keep, word in enumerate(new):
            if before + keep >= REMEMBERED or self._bytes > REMEMBERED_BYTES:
                break
            self._bytes += len(word)
        else:
            return
        for word in new[keep:]:
            del known[word]
        n = known.first + len(known)
        self._size = self._size[:n].copy()
        self._ids = self._ids[: self._size.sum()].copy()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and the number of ids of each."""
        known = self._known
        codes: list[int] = []
        ends = []
        for text in texts:
            for words, token in self._vocabulary.parts(text):
                codes.extend(map(known.__getitem__, words))
                if token is not None:
                    codes.append(self._special[token])
            ends.append(len(codes))
        if known.new:
            ids, size = self._vocabulary.merge([w.encode("utf-8", "surrogatepass") for w in known.new])
            self._ids, self._size = np.concatenate((self._ids, ids)), np.concatenate((self._size, size))
        at = np.array(codes, np.int64)
        begin = np.cumsum(self._size) - self._size
        sizes = self._size[at]
        ids = gather(self._ids, begin[at], sizes)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        self._forget()
        return ids, np.diff(upto[ends], prepend=0)


_LOADED: dict[str, tuple[Vocabulary, Encoder]] = {}


def loaded(path: str | None) -> tuple[Vocabulary, Encoder]:
    """One vocabulary per worker and file, with what is remembered."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _LOADED:
        vocabulary = Vocabulary(path)
        _LOADED[path] = vocabulary, Encoder(vocabulary)
    return _LOADED[path]


def encoded(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids of the whole text. ``vocabulary`` is a path that executors can read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = loaded(vocabulary)
        for batch in batches:
            at = 0
            for piece in pieces(batch.column(1), PIECE):
                ids, counts = encoder.encode(piece.to_pylist())
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                names = batch.column(0).slice(at, len(piece))
                at += len(piece)
                yield pa.record_batch([names, pa.ListArray.from_arrays(offsets, pa.array(ids))], names=["doc_id", "ids"])

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, ids and the text that they stand for; null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, _ = loaded(vocabulary)
        for batch in batches:
            ids = batch.column(1)
            texts = [
                table.decode(ids[i].values.to_numpy()) if n else ""
                for i, n in enumerate(pc.list_value_length(ids).to_pylist())
            ]
            yield pa.record_batch([batch.column(0), ids, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    ids = rows["ids"].cast("array<int>")
    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )


def bpe_table(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Number of ids per document, and digests of the ids and of the text decoded from them."""
    return decoded(encoded(docs, vocabulary), vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
