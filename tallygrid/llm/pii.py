"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Every kind has a pattern, a check, and words that speak for it. A span that fails its check is
dropped and its text is not tried again. An IBAN is cut at the length of its country, or, where that
is not known, at the last blank that makes its check digits right, and its text is tried again from the
next place that could start one; it is reported beside a base span that it meets. The score starts at that of the kind, rises if a
checksum (Luhn, mod 97) confirms the span and if one of the words stands near it. Base kinds
(email, ip, card, phone) are always reported with their score; the other kinds only from
``THRESHOLD`` up, so a number that looks like a social security number counts beside the words
for it and not elsewhere. All patterns take time in proportion to the text.

Defined results for odd input: a null text counts as empty and has no spans; null ids and
repeated rows keep their rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.spans import Span, Taken, count, listed, masked, scan

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "account")
KINDS = BASE + ADDED
THRESHOLD = 0.6
NEAR = 60  # code points before a span, and half as many after it

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: a later start could not do better.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){1,30}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,14}(?![0-9])")
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
        32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
NOT_DIGIT = re.compile(r"[^0-9]")

CONTEXT = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social-security"),
    "account": ("card", "amex", "account", "credit", "konto", "cuenta"),
}
START = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "account": 0.1}
CHECKSUM_BONUS, CONTEXT_BONUS = 0.3, 0.35
WORDS = {
    kind: re.compile(r"(?<![a-z])(?:" + "|".join(map(re.escape, words)) + ")", re.ASCII)
    for kind, words in CONTEXT.items()
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    total += sum(d // 5 + d * 2 % 10 for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def mod97(number: str) -> bool:
    """Whether an account number with country and check digits is right (ISO 7064, mod 97)."""
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from one @ to the next: every character is seen once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def _matches(pattern: re.Pattern, text: str, check: Callable[[str], bool]) -> Iterator[tuple[int, int]]:
    for m in pattern.finditer(text):
        if check(m[0]):
            yield m.span()


def _ip(found: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in found.split("."))


def _card(found: str) -> bool:
    digits = _digits(found)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _phone(found: str) -> bool:
    return 8 <= len(_digits(found)) <= 15


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping numbers with right check digits, as long as their country says."""
    done = 0
    for m in IBAN_START.finditer(text):
        start = m.start()
        rest = IBAN_REST.match(text, m.end()) if start >= done else None
        if rest is None:
            continue
        found, length = text[start : rest.end()], IBAN_LENGTHS.get(m[0][:2])
        size = sum(c != " " for c in found)
        for end in range(len(found), 0, -1):
            # A number ends before a blank or another mark, never within a word.
            after = text[start + end : start + end + 1]
            if found[end - 1] != " ":
                if size < 15 or length and size < length:
                    break
                whole = not (after.isascii() and after.isalnum())
                if whole and size == (length or size) and mod97(found[:end].replace(" ", "")):
                    done = start + end
                    yield start, done
                    break
                size -= 1


def _account(found: str) -> bool:
    return luhn(_digits(found))


def _score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR // 2]
    score = START[kind] + CHECKSUM_BONUS * confirmed
    return min(1.0, score + CONTEXT_BONUS * bool(WORDS[kind].search(near.lower())))


def find(text: str) -> list[Span]:
    """All spans of a text, in no order."""
    found: list[tuple[str, int, int]] = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", a, b) for a, b in _matches(IP, text, _ip)]
    found += [("card", a, b) for a, b in _matches(CARD, text, _card)]
    if "+" in text:
        found += [("phone", a, b) for a, b in _matches(PHONE, text, _phone)]
    out = [(k, a, b, _score(text, k, a, b, k == "card"), True) for k, a, b in found]
    taken = Taken((a, b) for _, a, b in found)
    out += [("iban", a, b, _score(text, "iban", a, b, True), False) for a, b in _ibans(text)]
    for kind, pattern, check in (
        ("ssn", SSN, lambda _: True),
        ("account", ACCOUNT, _account),
    ):
        for a, b in _matches(pattern, text, check):
            score = _score(text, kind, a, b, kind != "ssn")
            if score >= THRESHOLD and not taken.meets(a, b):
                out.append((kind, a, b, score, False))
    return out


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id, found: array of (kind, start, end, score, base)."""
    return scan(docs, find)


def redact(text: str | None) -> str:
    return masked(text or "", find(text or ""))


def pii_table(docs: DataFrame) -> DataFrame:
    found = F.col("found")
    return pii_spans(docs).select(
        "doc_id",
        *[count(found, k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(found, KINDS, by_start=False, base_only=True), 256).alias("base_sha256"),
        listed(found, KINDS, by_start=False, base_only=False).alias("spans"),
        F.array_max(F.transform(found, lambda s: s["score"])).alias("best_score"),
    )
