"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Kinds of the base set (email, ip, card, phone) are kept whenever their own rule confirms them. The kinds added here are
kept when their score reaches a threshold: `iban` (length of its country and mod-97), `national_phone` and `ssn`
(shape alone is weak, so that a context word is needed).

A null text has no spans, like an empty one. Whole texts are scanned; each expression is linear in the text's length.
Rows, ties and further columns pass through; one that has the result's name is replaced. Repeated rows get the same spans each, null ids
are let through, and an empty table gives no rows.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from helixframe.llm.common import read_table, small_batches

#: The base kinds in the order in which ties are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_phone", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS

_AT = re.compile("@")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: These begin with a digit or capital class, which the engine looks for fast; what may stand before it is checked next.
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11,30}+")
_NATIONAL = re.compile(r"[0-9](?<![0-9+-][0-9])[0-9]{2}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])")
_SSN = re.compile(r"[0-9](?<![0-9-][0-9])[0-9]{2}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: The registered IBAN length of each country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

#: Words near a span that raise its score, and the score that each kind starts from.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "credit", "visa", "mastercard", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "national_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "ssn": ("ssn", "social", "security"),
}
START = {"email": 0.7, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "national_phone": 0.3, "ssn": 0.3}
CONTEXT_BONUS, CONTEXT_CHARS, THRESHOLD = 0.3, 48, 0.5
_WORD = re.compile(r"[^\W\d_](?:[\w-]*\w)?")

SPAN = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
)


def luhn(digits: str) -> bool:
    """Whether the digits, of which the last is the check digit, pass the Luhn test."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the IBAN, without spaces, leaves 1 modulo 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[str, int, int]]:
    found, free = [], 0
    for at in _AT.finditer(text):
        i = at.start()
        if i < free or not (domain := _DOMAIN.match(text, i)):
            continue
        start = i
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < i:
            found.append(("email", start, domain.end()))
            free = domain.end()
    return found


def _ip_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _iban(text: str, start: int, end: int) -> int:
    """Where the IBAN that begins at start ends, or 0."""
    want = IBAN_LENGTHS.get(text[start : start + 2], 99)
    have = 0
    for i in range(start, end):
        have += text[i] != " "
        if have == want:
            code = text[start : i + 1].replace(" ", "")
            return i + 1 if mod97(code) else 0
    return 0


def propose(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans (kind, start, end) of all kinds, in code points, before scoring."""
    found = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_ip_part, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    phones = [m.span() for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m.group())) <= 15] if "+" in text else []
    found += [("phone", *span) for span in phones]
    at = 0
    while m := _IBAN.search(text, at):  # a match runs on into what follows, so the search goes on from the IBAN's own end
        if end := _iban(text, *m.span()):
            found.append(("iban", m.start(), end))
        at = end or m.start() + 1
    for m in _NATIONAL.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b in phones):
            found.append(("national_phone", m.start() - (text[m.start() - 1 : m.start()] == "("), m.end()))
    found += [("ssn", *m.span()) for m in _SSN.finditer(text) if m.group()[0] != "9" and m.group()[:3] not in ("000", "666")]
    return found


def scored(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans that are kept, with scores, by start and then by kind."""
    kept = []
    for kind, start, end in propose(text) if text else ():
        near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS])}
        score = min(1.0, START[kind] + CONTEXT_BONUS * (not near.isdisjoint(CONTEXT[kind])))
        if kind in BASE_KINDS or score >= THRESHOLD:
            kept.append((kind, start, end, score))
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


@pandas_udf(SPAN)
def pii_spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("kind", "start", "end", "score"), s)) for s in scored(t)] for t in texts])


@pandas_udf(T.StringType())
def redacted(texts: pd.Series) -> pd.Series:
    """The texts with each span replaced by its kind in brackets; of spans that overlap, the first names the whole."""
    return pd.Series([redact_text(t) for t in texts], dtype=object)


def redact_text(text: str | None) -> str | None:
    spans = scored(text)
    if not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end, _ in spans:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(end, merged[-1][2])
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def find_pii(df: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """Adds the spans of each text: array of (kind, start, end, score); empty for null and empty texts."""
    small_batches(df.sparkSession)
    return df.withColumn(out_col, pii_spans(F.col(text_col)))


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Replaces the spans in each text; null stays null, all other columns stay as they are."""
    small_batches(df.sparkSession)
    return df.withColumn(text_col, redacted(F.col(text_col)))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = find_pii(docs).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), F.array_join(F.transform("pii", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"))


QUERIES = {"op2_pii": op2_pii}
ORACLES: dict[str, str] = {}
