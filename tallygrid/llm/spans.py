"""Spans found in texts: how scanners are run over documents and how their spans are written."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, start and end in code points (end exclusive), score, and whether it is a base span
Span = tuple[str, int, int, float, bool]

SPAN_TYPE = "array<struct<kind:string,start:long,end:long,score:double,base:boolean>>"
_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()),
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("score", pa.float64()),
            ("base", pa.bool_()),
        ]
    )
)
_NAMES = ("kind", "start", "end", "score", "base")


class Taken:
    """Parts of a text that spans cover; each question takes a search in the sorted parts."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def gaps(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """What of a stretch is not covered."""
        i = bisect_right(self.ends, start)
        while i < len(self.starts) and self.starts[i] < end:
            if start < self.starts[i]:
                yield start, self.starts[i]
            start = self.ends[i]
            i += 1
        if start < end:
            yield start, end


def scan(docs: DataFrame, find: Callable[[str], list[Span]]) -> DataFrame:
    """doc_id and the spans that ``find`` gives for the whole text; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(_NAMES, s, strict=True)) for s in find(t.as_py() or "")]
                for t in batch.column(1)
            ]
            yield pa.record_batch([batch.column(0), pa.array(found, _ARROW)], names=["doc_id", "found"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(
        run, f"doc_id long, found {SPAN_TYPE}"
    )


def count(found: Column, kind: str) -> Column:
    """Base spans of a kind."""
    return F.size(F.filter(found, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def listed(found: Column, kinds: tuple[str, ...], by_start: bool, base_only: bool) -> Column:
    """kind:start:end of the spans, comma-joined, by kind and start or by start and kind."""
    place = F.create_map(*[F.lit(x) for pair in zip(kinds, range(len(kinds))) for x in pair])

    def key(s: Column) -> Column:
        kind = F.element_at(place, s["kind"]).alias("k")
        start = s["start"].alias("s")
        text = F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        order = (start, kind) if by_start else (kind, start)
        return F.struct(*order, s["end"].alias("e"), text.alias("t"))

    chosen = F.filter(found, lambda s: s["base"]) if base_only else found
    return F.concat_ws(",", F.transform(F.array_sort(F.transform(chosen, key)), lambda x: x["t"]))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping ones by the first."""
    out, at = [], 0
    for kind, start, end, _, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
