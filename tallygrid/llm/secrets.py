"""Secrets: entropy of a sliding window over candidate strings, by class of characters.

Runs of characters that keys are written in are cut at base spans and at what the allow list names:
UUIDs, and parts between separators that are made of words (``FooBarFactory``, ``main``, ``step2``).
What is left are candidates. A candidate that holds an example's name or a counting sequence, or is
a row of short lower-case parts (an address), is passed over; nothing beside it is. A candidate
belongs to a class by what it holds: hexadecimal digits, lower-case letters and digits, letters of
both cases and digits, or letters of both cases; letters of one case or digits alone belong to none. A window slides over
the candidate; two counts change with each step, and with them the window's Shannon entropy. Windows
at or above the entropy of the class are merged into spans.

Base spans (assign, access, hex) are always reported. All patterns take time in proportion to the
text, and base spans are found among the others by a search in their sorted starts.

Defined results for odd input: a null text counts as empty and has no spans; null ids and
repeated rows keep their rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.spans import Span, Taken, count, listed, masked, scan

BASE = ("assign", "access", "hex")
KINDS = BASE + ("entropy",)
WINDOW = 20

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
SOME_DIGIT, SOME_LOWER, SOME_UPPER = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")
ONLY_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")

#: class: bits per character that a window of a key reaches
BITS = {"hex": 2.9, "lower": 3.4, "mixed": 3.7, "letters": 3.7}

#: a UUID, or a part between separators
PART = re.compile(
    r"(?<![0-9a-fA-F])([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})(?![0-9a-fA-F])"
    r"|[A-Za-z0-9+]+"
)
#: words that follow each other, with a short number behind any of them
WORDS = re.compile(r"(?:(?:[A-Z]?[a-z]{3,}+|[A-Z][a-z]{2})++[0-9]{0,3}+)++|[A-Z]{3,}+[0-9]{0,3}+")
ALLOWED = re.compile(
    r"(?i:example|sample|dummy|placeholder|changeme)"
    r"|(?:0123456789|1234567890|abcdefghij|ABCDEFGHIJ)"
    r"|^[-_/=]*(?:[a-z0-9]{1,12}[-_/]){2,}[a-z0-9]{1,12}[-_/=]*$"
)
GAIN = [0.0, 0.0] + [n * log2(n) for n in range(2, WINDOW + 1)]


def char_class(candidate: str) -> str | None:
    lower, upper = SOME_LOWER.search(candidate), SOME_UPPER.search(candidate)
    if not SOME_DIGIT.search(candidate):
        return "letters" if lower and upper else None
    if not lower and not upper:
        return None
    if ONLY_HEX.fullmatch(candidate):
        return "hex"
    return "mixed" if lower and upper else "lower"


def entropies(text: str, width: int = WINDOW) -> list[float]:
    """Bits per character of every window of a text, by counts that change with each step."""
    gain = GAIN if width == WINDOW else [0.0, 0.0] + [n * log2(n) for n in range(2, width + 1)]
    counts: dict[str, int] = {}
    total, out, top = 0.0, [], log2(width)
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += gain[n + 1] - gain[n]
        if i >= width:
            old = text[i - width]
            n = counts[old]
            counts[old] = n - 1
            total += gain[n - 1] - gain[n]
        if i >= width - 1:
            out.append(top - total / width)
    return out


def _dense(candidate: str, least: float) -> list[tuple[int, int, float]]:
    """Merged windows of a candidate at or above an entropy, with the largest one."""
    spans: list[list] = []
    for i, bits in enumerate(entropies(candidate)):
        if bits >= least:
            if spans and i <= spans[-1][1]:
                spans[-1][1] = i + WINDOW
                spans[-1][2] = max(spans[-1][2], bits)
            else:
                spans.append([i, i + WINDOW, bits])
    return [tuple(s) for s in spans]


def _candidates(text: str, base: Taken) -> Iterator[tuple[int, int]]:
    """Stretches as long as a window at least, without base spans, UUIDs and words."""
    for m in RUN.finditer(text):
        for a, b in base.gaps(*m.span()):
            start = a
            for part in PART.finditer(text, a, b):
                if part[1] or WORDS.fullmatch(part[0]):
                    if part.start() - start >= WINDOW:
                        yield start, part.start()
                    start = part.end()
            if b - start >= WINDOW:
                yield start, b


def find(text: str) -> list[Span]:
    """All spans of a text, in no order; the score of an entropy span is its bits per character."""
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [
            ("assign", *m.span(), 1.0, True)
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 6
        ]
    if "AKIA" in text:
        out += [("access", *m.span(), 1.0, True) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), 1.0, True) for m in HEX.finditer(text)]
    base = Taken((a, b) for _, a, b, _, _ in out)
    for start, end in _candidates(text, base):
        candidate = text[start:end]
        kind = char_class(candidate)
        if kind is not None and not ALLOWED.search(candidate):
            out += [
                ("entropy", start + a, start + b, bits, False)
                for a, b, bits in _dense(candidate, BITS[kind])
            ]
    return out


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, found: array of (kind, start, end, score, base)."""
    return scan(docs, find)


def redact(text: str | None) -> str:
    return masked(text or "", find(text or ""))


def secret_table(docs: DataFrame) -> DataFrame:
    found = F.col("found")
    return secret_spans(docs).select(
        "doc_id",
        *[count(found, k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(found, KINDS, by_start=True, base_only=True), 256).alias("base_sha256"),
        listed(found, KINDS, by_start=True, base_only=False).alias("spans"),
    )
