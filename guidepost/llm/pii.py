"""Personal data in texts, also where it is disguised.

Identifiers are first found as they stand. Then transducers rewrite a copy of the text
(look-alike letters, spelled digits, "at" and "dot") and keep, for every character they put
out, the piece of the source it stands for. Identifiers found in the copy are mapped back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guidepost.functions import column
from guidepost.llm.frames import id_and_bytes, per_row

KINDS = ("email", "ip", "card", "phone")

# The base patterns. None can begin in the middle of a run that it failed on, so
# the look-behind and the possessive repeats only save time on long runs.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Look-alikes and what they stand for.
LOOK_ALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХаеѕіјорсухԁһ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα" "＠．＋－（）０１２３４５６７８９。・",
        "ABESIJKMHOPCTXaesijopcyxdh" "ABEZHIKMNOPTYXoa" "@.+-()0123456789..",
    )
)
LOOK_ALIKES |= {chr(0xFF21 + i): chr(ord("A") + i) for i in range(26)}  # full width
LOOK_ALIKES |= {chr(0xFF41 + i): chr(ord("a") + i) for i in range(26)}
LOOK_ALIKES |= {chr(0x0660 + i): str(i) for i in range(10)}  # Arabic digits
INVISIBLE = "­​‌‍⁠﻿"
SPELLED = {
    word: str(value)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(words.split())
} | {"oh": "0"}
_ODD = re.compile("[" + re.escape("".join(LOOK_ALIKES) + INVISIBLE) + "]")
_DIGIT_WORD = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + ")"
_DIGIT_RUN = re.compile(
    rf"(?<!\w){_DIGIT_WORD}(?:[\x20-]{{1,3}}(?:{_DIGIT_WORD}|[0-9]+)(?!\w)){{2,}}", re.IGNORECASE
)
_DIGIT_TOKEN = re.compile(rf"{_DIGIT_WORD}|[0-9]+", re.IGNORECASE)
_AT = r"\s{0,3}[\[({<]\s{0,2}(?:at|arroba|ät)\s{0,2}[\])}>]\s{0,3}"
_DOT = r"\s{0,3}[\[({<]\s{0,2}(?:dot|punkt|point|punto)\s{0,2}[\])}>]\s{0,3}"
_BRACKETED_AT = re.compile(rf"(?<=[A-Za-z0-9]){_AT}(?=[A-Za-z0-9])", re.IGNORECASE)
_BRACKETED_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9])", re.IGNORECASE)
# Bare words count only together: " at ", a label, and at least one " dot ".
_PLAIN = re.compile(
    r"(?<=[A-Za-z0-9])(?P<at>\x20at\x20|@)"
    r"(?P<name>[A-Za-z0-9-]{1,63}(?:(?:\x20dot\x20|\.)[A-Za-z0-9-]{1,63})*\x20dot\x20[A-Za-z]{2,24})"
    r"(?![A-Za-z0-9])",
    re.IGNORECASE,
)
# A bare " at " also counts before a domain of which a dot was rewritten from something longer.
_BARE_AT = re.compile(
    r"(?<=[A-Za-z0-9])\x20at\x20"
    r"(?=(?P<name>[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24})(?!\.?[A-Za-z0-9-]))",
    re.IGNORECASE,
)


@dataclass
class Rewritten:
    """A text with, for each character, the piece ``start:end`` of the source it stands for."""

    text: str
    start: list[int]
    end: list[int]

    @classmethod
    def of(cls, text: str) -> Rewritten:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def replace(self, pattern: re.Pattern, write: Callable[[re.Match], list]) -> Rewritten:
        """``write`` gives, for a match, the characters put out with the piece each stands for."""
        out: list[str] = []
        start: list[int] = []
        end: list[int] = []
        done = 0
        for match in pattern.finditer(self.text):
            a, b = match.span()
            out.append(self.text[done:a])
            start += self.start[done:a]
            end += self.end[done:a]
            for char, i, j in write(match):
                out.append(char)
                start.append(self.start[i])
                end.append(self.end[j - 1])
            done = b
        out.append(self.text[done:])
        return Rewritten("".join(out), start + self.start[done:], end + self.end[done:])


def _write_odd(match: re.Match) -> list:
    plain = LOOK_ALIKES.get(match[0])
    return [(plain, *match.span())] if plain else []


def _write_digits(match: re.Match) -> list:
    out = []
    for token in _DIGIT_TOKEN.finditer(match[0]):
        i, j = match.start() + token.start(), match.start() + token.end()
        if token[0].isdigit():
            out += [(c, i + k, i + k + 1) for k, c in enumerate(token[0])]
        else:
            out.append((SPELLED[token[0].lower()], i, j))
    return out


def _write_plain(match: re.Match) -> list:
    out = [("@", *match.span("at"))]
    at = match.start("name")
    for part in re.split(r"(\x20dot\x20)", match["name"], flags=re.IGNORECASE):
        if part.lower() == " dot ":
            out.append((".", at, at + len(part)))
        else:
            out += [(c, at + k, at + k + 1) for k, c in enumerate(part)]
        at += len(part)
    return out


def _write_bare_at(copy: Rewritten, match: re.Match) -> list:
    """An at sign if a dot of the domain stands for more than one character, else what was there."""
    domain = range(*match.span("name"))
    if any(copy.text[k] == "." and copy.end[k] - copy.start[k] > 1 for k in domain):
        return [("@", *match.span())]
    return [(c, match.start() + k, match.start() + k + 1) for k, c in enumerate(match[0])]


# Cheap necessary conditions, so that the patterns of the transducers only run where they can
# match: first bytes of the odd characters, an opening bracket before a first letter, and
# neighbouring tokens.
_NOT_ODD = bytes(set(range(256)) - {c.encode()[0] for c in (*LOOK_ALIKES, *INVISIBLE)})
_OPENED = re.compile(r"[\[({<]\s{0,2}[AaDdPpÄä]")
_TOKENS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)
_SPELLED_BYTES = {w.encode() for w in SPELLED} | {
    "".join(c if c.isascii() else c.upper() for c in w).encode() for w in SPELLED
}


def _may_be_odd(text: str) -> bool:
    return not text.isascii() and bool(text.encode().translate(None, _NOT_ODD))


def _may_be_opened(text: str) -> bool:
    return _OPENED.search(text) is not None


def _tokens(text: str) -> list[bytes]:
    return text.encode().translate(_TOKENS).split()


def _may_be_spelled(text: str) -> bool:
    tokens = _tokens(text)
    spelled = [i for i, token in enumerate(tokens[:-2]) if token in _SPELLED_BYTES]
    return any(tokens[i + 1] in _SPELLED_BYTES or tokens[i + 1].isdigit() for i in spelled)


def _may_be_plain(text: str) -> bool:
    return " dot " in text or " dot " in text.lower()


TRANSDUCERS: tuple[tuple[Callable[[str], bool], re.Pattern, Callable[[re.Match], list]], ...] = (
    (_may_be_odd, _ODD, _write_odd),
    (_may_be_spelled, _DIGIT_RUN, _write_digits),
    (_may_be_opened, _BRACKETED_AT, lambda m: [("@", *m.span())]),
    (_may_be_opened, _BRACKETED_DOT, lambda m: [(".", *m.span())]),
    (_may_be_plain, _PLAIN, _write_plain),
)


def _emails(text: str) -> list[tuple[int, int]]:
    found = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        else:
            done = max(done, at)
        at = text.find("@", at + 1)
    return found


def _is_ip(value: str) -> bool:
    parts = [p.lstrip("0") for p in value.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _digits(value: str) -> list[int]:
    return [ord(c) - 48 for c in value if "0" <= c <= "9"]


def _is_card(value: str) -> bool:
    digits = _digits(value)
    if not 13 <= len(digits) <= 19:
        return False
    doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _is_phone(value: str) -> bool:
    return 9 <= len(_digits(value)) <= 15


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Identifiers as they stand: leftmost, not overlapping within a kind."""

    def having(pattern: re.Pattern, test: Callable[[str], bool]) -> list[tuple[int, int]]:
        return [m.span() for m in pattern.finditer(text) if test(m[0])]

    return {
        "email": _emails(text),
        "ip": having(IP, _is_ip),
        "card": having(CARD, _is_card),
        "phone": having(PHONE, _is_phone) if "+" in text else [],
    }


def added_spans(
    text: str, base: dict[str, list[tuple[int, int]]]
) -> dict[str, list[tuple[int, int]]]:
    """Identifiers seen only after rewriting, as spans of the source that no base span of the
    kind contains."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    copy = None
    for may_match, pattern, write in TRANSDUCERS:
        now = copy.text if copy else text
        if may_match(now) and pattern.search(now):
            copy = (copy or Rewritten.of(text)).replace(pattern, write)
    if copy is not None and _BARE_AT.search(copy.text):
        copy = copy.replace(_BARE_AT, partial(_write_bare_at, copy))
    if copy is None or copy.text == text:
        return found
    for kind, spans in base_spans(copy.text).items():
        known = base[kind]
        for a, b in spans:
            start, end = copy.start[a], copy.end[b - 1]
            is_new = text[start:end] != copy.text[a:b]
            if is_new and not any(s <= start and end <= t for s, t in known):
                found[kind].append((start, end))
    return found


def _listed(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


RESULT = (
    *((f"n_{kind}", T.LongType()) for kind in KINDS),
    ("base_sha256", T.StringType()),
    ("spans", T.StringType()),
    ("n_added", T.LongType()),
)


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of each row.

    The counts and the digest are those of the identifiers as they stand; ``spans`` also has the
    ``n_added`` disguised ones. Positions are code points. A null text counts as empty; repeated
    rows are treated alike; other columns are not looked at; an empty table stays empty.
    """
    fields = [T.StructField("id", docs.schema[doc_id].dataType)]
    fields += [T.StructField(name, kind) for name, kind in RESULT]

    def run(ids: list, texts: list[bytes | None]) -> dict[str, list]:
        out: dict[str, list] = {"id": ids} | {name: [] for name, _ in RESULT}
        for raw in texts:
            value = _text(raw)
            base = base_spans(value)
            added = added_spans(value, base)
            for kind in KINDS:
                out[f"n_{kind}"].append(len(base[kind]))
            digest = hashlib.sha256(_listed(base).encode()).hexdigest()
            out["base_sha256"].append(digest)
            out["spans"].append(_listed({k: base[k] + added[k] for k in KINDS}))
            out["n_added"].append(sum(map(len, added.values())))
        return out

    found = per_row(id_and_bytes(docs, doc_id, text), T.StructType(fields), run)
    return found.withColumnRenamed("id", doc_id)


def redacted(text: str | None) -> str | None:
    """``text`` with each piece of personal data replaced by its kind, as in ``<EMAIL>``.

    Where spans overlap, the whole piece gets the kind of the one that begins first.
    """
    if text is None:
        return None
    base = base_spans(text)
    added = added_spans(text, base)
    spans = sorted((a, b, kind) for kind in KINDS for a, b in base[kind] + added[kind])
    if not spans:
        return text
    merged = [list(spans[0])]
    for a, b, kind in spans[1:]:
        if a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    ends = [0, *(b for _, b, _ in merged)]
    pieces = [text[e : m[0]] + f"<{m[2].upper()}>" for e, m in zip(ends, merged)]
    return "".join(pieces) + text[ends[-1] :]


def redact(docs: DataFrame, text: str = "text", size: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced by its kind; ``size``, if given, is a column that
    gets the new number of characters. Null texts stay null, all other columns as they are."""

    @F.pandas_udf(T.StringType())
    def clean(values: pd.Series) -> pd.Series:
        return values.map(redacted)

    found = docs.withColumn(text, clean(column(text)))
    if size is None:
        return found
    length = F.length(column(text)).cast(docs.schema[size].dataType)
    return found.withColumn(size, F.coalesce(length, column(size)))
