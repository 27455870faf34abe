"""Personal data in texts: patterns propose spans, checksums confirm them, context scores them.

Every pattern is tried at places where it can begin only, so a text takes time in proportion to
its length whatever it holds. Spans are counted in code points, the end is exclusive.

Base kinds (email, ip, card, phone) are always reported once pattern and validator agree; their
score only tells how sure they are. Added kinds (iban, ssn, local_phone) are reported from a
score of ``REPORT_FROM`` on, where no base span overlaps them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import values

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
REPORT_FROM = 0.5
CONTEXT_CHARS = 40

_LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\w-])")
_WORTH_A_LOOK = re.compile(r"[0-9@]")
_NO_DIGIT = re.compile(r"[^0-9]")

# Score of a confirmed span, and words nearby that raise or lower it.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3}
RAISE, LOWER = 0.3, 0.3
# In English, French, German and Spanish.
CONTEXT = {
    "email": re.compile(
        r"\b(?:e-?mail|contact|write to|reach|courriel|kontakt|schreiben|correo|escribir)\b", re.I
    ),
    "ip": re.compile(
        r"\b(?:ip|address|host|server|login|adresse|serveur|rechner|direcci\u00f3n|servidor)\b", re.I
    ),
    "card": re.compile(
        r"\b(?:card|credit|visa|mastercard|payment|carte|paiement|karte|kreditkarte|zahlung|"
        r"tarjeta|cr\u00e9dito|pago)\b",
        re.I,
    ),
    "phone": re.compile(
        r"\b(?:phone|tel|call|mobile|fax|t\u00e9l\u00e9phone|portable|appeler|telefon|handy|anrufen|"
        r"tel\u00e9fono|m\u00f3vil|llamar)\b",
        re.I,
    ),
    "iban": re.compile(
        r"\b(?:iban|account|bank|transfer|compte|banque|virement|konto|\u00fcberweisung|cuenta|"
        r"banco|transferencia)\b",
        re.I,
    ),
    "ssn": re.compile(
        r"\b(?:ssn|social security|s\u00e9curit\u00e9 sociale|sozialversicherung|seguridad social)\b",
        re.I,
    ),
}
CONTEXT["local_phone"] = CONTEXT["phone"]
AGAINST = re.compile(
    r"\b(?:isbn|version|part no|order no|serial|example|exemple|beispiel|ejemplo)\b", re.I
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d)
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: moved to the front and read as a number, it leaves 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern, found from its @: the local part is all that precedes it unbroken."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done:  # backwards in steps, so that a long run is sliced once
            piece = _LOCAL_PART.search(text, max(done, start - 64), start)
            if piece is None:
                break
            reached_edge = piece.start() == max(done, start - 64)
            start = piece.start()
            if not reached_edge:
                break
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 37:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        compact = m.group().replace(" ", "")
        if 15 <= len(compact) <= 34 and mod97(compact):
            yield m.span()


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _LOCAL_PHONE.finditer(text):
        yield m.span()


_FINDERS = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "ssn": _ssns,
    "local_phone": _local_phones,
}


def _score(kind: str, text: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    score = START[kind]
    if CONTEXT[kind].search(near):
        score += RAISE
    if AGAINST.search(near):
        score -= LOWER
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) by kind as listed, then start."""
    if not text or not _WORTH_A_LOOK.search(text):
        return []
    found = []
    for kind in BASE_KINDS:
        found += [(kind, s, e, _score(kind, text, s, e)) for s, e in _FINDERS[kind](text)]
    starts, ends = _covered(found)
    for kind in KINDS[len(BASE_KINDS) :]:
        for s, e in _FINDERS[kind](text):
            score = _score(kind, text, s, e)
            if score < REPORT_FROM:
                continue
            before = bisect_left(starts, e)  # stretches that start before the span ends
            if not before or ends[before - 1] <= s:
                found.append((kind, s, e, score))
    return found


def _covered(spans: list[tuple]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that some spans cover together, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted((s, e) for _, s, e, _ in spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def masked(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    parts, done = [], 0
    merged: list[list] = []
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        parts += [text[done:s], f"[{kind.upper()}]"]
        done = e
    return "".join([*parts, text[done:]])


SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_ARROW_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )
)


def _as_rows(spans: list[tuple]) -> list[dict]:
    return [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in spans]


def _pii_spans(texts: pa.Array) -> pa.Array:
    """Spans of personal data of each text; none for null."""
    return pa.array([_as_rows(find_spans(t)) for t in values(texts)], _ARROW_SPANS)


def _redacted(texts: pa.Array) -> pa.Array:
    """Texts with personal data replaced by its kind; null stays null."""
    out = []
    for text in values(texts):
        spans = find_spans(text)
        out.append(masked(text, spans) if spans else text)
    return pa.array(out, pa.string())


def _joined(spans: Column) -> Column:
    one = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.array_join(one, ",")


def _count_of(kind: str) -> Column:
    return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")


def detect(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``pii`` (all spans with scores) and digests, one row per input row.

    Null and empty texts have no spans; repeated rows are reported each; other columns are not
    read.
    """
    spans = F.arrow_udf(_pii_spans, SPANS)
    found = documents.select("doc_id", spans(F.col("text").cast("string")).alias("pii"))
    counts = [_count_of(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        "pii",
    )


def redact(documents: DataFrame) -> DataFrame:
    """The same rows and columns with personal data in ``text`` replaced by its kind."""
    redacted = F.arrow_udf(_redacted, "string")
    return documents.withColumn("text", redacted(F.col("text").cast("string")))
