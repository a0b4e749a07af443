"""Personal data in texts: spans proposed by patterns, confirmed by checksums, scored by the words around them.

Base kinds are e-mail, IPv4 address, payment card and phone number; whatever their patterns and validators accept is
reported. Further kinds are reported from a score of ACCEPT upwards: international bank account numbers (mod 97 and the
country's length), cards of 13 to 15 digits and social security numbers (both only near words that speak of them).

Offsets are code points, ends exclusive. Defined results: null and empty texts have no spans; null ids stay null; rows
that repeat an id are answered each; other columns are not carried, except by ``redact``, which keeps all.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
ACCEPT, NEAR = 0.7, 40

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a run of digits that fails from its start fails throughout
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
# Lengths of international bank account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22,
    "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30,
    "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# Words that raise a kind's score when they stand near a span.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security"),
}
#: Score of a span before its surroundings are read.
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.9, "ssn": 0.4}
SHORT_CARD, RAISE = 0.5, 0.3


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        if not (m := _AT.match(text, at)):
            at = text.find("@", at + 1)
            continue
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done if start < at else at + 1))


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        size = IBAN_LENGTHS.get(m.group()[:2])
        if not size:
            continue
        kept, at = m.group(), m.end()
        while len(kept) < size and at < len(text) and (text[at].isascii() and (text[at].isdigit() or text[at].isupper()) or text[at] == " " and text[at - 1] != " "):
            kept += text[at].strip()
            at += 1
        if len(kept) == size and not text[at : at + 1].isalnum() and mod97(kept):
            yield m.start(), at


def _near(text: str, start: int, end: int, kind: str) -> bool:
    around = text[max(0, start - NEAR) : start].lower() + " " + text[end : end + NEAR].lower()
    return any(re.search(rf"(?<!\w){re.escape(w)}", around) for w in CONTEXT[kind])


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by kind as in KINDS, then by start."""
    found = [("email", a, b, PRIOR["email"]) for a, b in _emails(text)]
    found += [("ip", *m.span(), PRIOR["ip"]) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span(), PRIOR["card"] if len(digits) >= 16 else SHORT_CARD))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            found.append(("phone", *m.span(), PRIOR["phone"]))
    found += [("iban", a, b, PRIOR["iban"]) for a, b in _ibans(text)]
    found += [("ssn", *m.span(), PRIOR["ssn"]) for m in _SSN.finditer(text)]
    scored = [(k, a, b, min(1.0, s + RAISE * _near(text, a, b, k))) for k, a, b, s in found]
    return [x for x in scored if x[3] >= ACCEPT]


def is_base(kind: str, text: str) -> bool:
    return kind in BASE and (kind != "card" or sum("0" <= c <= "9" for c in text) >= 16)


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, counts of base spans by kind, ``base_sha256``, ``spans``, and ``found`` with the scores."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    schema = pa.schema([("id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()),
                        ("spans", pa.string()), ("found", pa.list_(span))])

    def over(batches):
        for batch in batches:
            rows = []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = find_spans(body)
                shown = [f"{k}:{a}:{b}" for k, a, b, _ in spans]
                base = [is_base(k, body[a:b]) for k, a, b, _ in spans]
                counts = [sum(y for x, y in zip(spans, base) if x[0] == k) for k in BASE]
                digest = hashlib.sha256(",".join(s for s, y in zip(shown, base) if y).encode()).hexdigest()
                rows.append((i, *counts, digest, ",".join(shown), [dict(zip(("kind", "start", "end", "score"), x)) for x in spans]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    own = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    kinds = "id long, " + ", ".join(f"n_{k} long" for k in BASE) + (
        ", base_sha256 string, spans string, found array<struct<kind:string,start:int,end:int,score:double>>")
    return own.mapInArrow(over, kinds).withColumnRenamed("id", key)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` with each span of ``text`` replaced by its kind in angle brackets; overlapping spans become
    one, named after the first."""
    schema, at = df.schema, df.columns.index(text)

    def changed(body):
        out, done = [], 0
        for kind, a, b, _ in sorted(find_spans(body), key=lambda x: (x[1], -x[2])):
            if a >= done:
                out += [body[done:a], f"<{kind}>"]
            done = max(done, b)
        return "".join(out) + body[done:]

    def over(batches):
        for batch in batches:
            new = pa.array([None if b is None else changed(b) for b in batch.column(at).to_pylist()], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return df.mapInArrow(over, schema)
