"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

Kinds in order: email, ip, card (Luhn), phone, and beyond these iban (mod 97) and ssn. The first four stand by their
pattern and check alone, matches left to right without overlap within a kind; a score below the threshold never takes
them away. An iban or ssn counts only with a score of at least `THRESHOLD`, so that a number needs a word nearby
that says what it is. Spans are in code points, the end is exclusive. Patterns are written so that no text takes more than
linear time: a run of digits or letters is never tried again from its middle, where it cannot match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.5
CONTEXT_CHARS = 40
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.6, "ssn": 0.2}
BONUS = 0.35
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|contact|write to|mailto)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|login)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|mobile|fax|call|telefon|handy)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|cuenta|compte)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
}

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ ]?[A-Z0-9])")
_IBAN_TOKEN = re.compile(r"[ ]?[A-Z0-9]+")
_IBAN_LENGTH = {
    c: int(n)
    for n, of in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
        "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
        "28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
    ).split())
    for c in of.split(",")
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """An IBAN ends where a token does: at its country's length or else at the last one within 34 characters, where no length is known at the last that passes."""
    end = 0
    for m in _IBAN.finditer(text):
        if m.start() < end:
            continue
        code, ends, at = m[0], [], m.end()
        while len(code) < 34 and (token := _IBAN_TOKEN.match(text, at, at + 35 - len(code))):
            code, at = code + token[0].lstrip(" "), token.end()
            if 15 <= len(code) <= 34 and not (at < len(text) and text[at].isascii() and text[at].isalnum()):
                ends.append((len(code), at))
        known = _IBAN_LENGTH.get(m[0][:2])
        for size, stop in [e for e in ends if e[0] == known] + (ends[-1:] if known else ends[::-1]):
            if mod97(code[:size]):
                end = stop
                yield m.start(), end
                break


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, number of the kind, end) of everything that fits a pattern and passes its check."""
    for start, end in _emails(text):
        yield start, 0, end
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            yield m.start(), 1, m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), 2, m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield m.start(), 3, m.end()
    for start, end in _ibans(text):
        yield start, 4, end
    for m in _SSN.finditer(text):
        yield m.start(), 5, m.end()


def spans(text: str) -> list[dict]:
    """All spans of a text by start, then kind, with their scores."""
    out = []
    for start, kind, end in sorted(proposals(text)):
        name = KINDS[kind]
        near = CONTEXT[name].search(text, max(0, start - CONTEXT_CHARS), start) or CONTEXT[name].search(text, end, end + CONTEXT_CHARS)
        score = SCORE[name] + (BONUS if near else 0)
        if kind < len(BASE) or score >= THRESHOLD:
            out.append({"kind": name, "start": start, "end": end, "score": min(1.0, score)})
    return out


FOUND = "array<struct<kind:string,start:int,end:int,score:double>>"


def masked(text: str, found: list[dict]) -> str:
    """Each span replaced by its kind in angle brackets; of overlapping spans the first names the whole."""
    at, kept = 0, []
    for s in found:
        if s["start"] >= at:
            kept += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join((*kept, text[at:]))


def _searched(docs: DataFrame, text: str, mask: bool) -> DataFrame:
    """(row, found), and with `mask` the masked text of the rows with spans: one pass, as a second would need a second worker a core."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            at = rows.type.get_field_index(text)
            for start in range(0, len(rows), 256):
                part = rows.slice(start, 256)
                texts = part.flatten()[at].to_pylist()
                found = [spans(t) if t else [] for t in texts]
                columns, names = [part, pa.array(found, kind)], ["row", "found"]
                if mask:
                    columns.append(pa.array([masked(t, f) if f else None for t, f in zip(texts, found)], pa.string()))
                    names.append("masked")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("found", T._parse_datatype_string(FOUND))])
    return rows.mapInArrow(find, schema.add("masked", T.StringType()) if mask else schema)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, found) for every document: its columns, whatever their names, and its spans. Null and empty texts have none."""
    return _searched(docs, text, False)


def listed(found: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with all personal data masked; no row is dropped."""
    found = _searched(docs, text, True)
    clean = F.when(F.size("found") > 0, F.col("masked")).otherwise(F.col(f"row.`{text}`"))
    return found.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
