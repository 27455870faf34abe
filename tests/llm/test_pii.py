from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from burstline.llm import pii
from burstline.llm.queries import op4_pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    """The base kinds straight from the patterns."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = {
        "email": (EMAIL, lambda m: True),
        "ip": (IP, lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        "card": (CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    }
    return [
        (kind, *m.span())
        for kind, (pattern, good) in rules.items()
        for m in re.finditer(pattern, text)
        if good(m)
    ]


def base(text):
    return [x[:3] for x in pii.find_spans(text) if x[0] in pii.BASE_KINDS]


PIECES = ["a", "@", "b.c", ".", "-", "+", "1", "12", "255", "256", "4111111111111111", " ", "(", ")", "é", "_", "\n", "0007"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_kinds_equal_the_patterns(text):
    assert base(text) == plain(text)


@pytest.mark.parametrize(
    "text",
    [
        "",
        "x@y",
        "a@b.c@d.e",
        "a" * 200 + "@ex.com",
        "..%+-@-.-",
        "a@@b.c",
        "1.2.3.4.5.6.7.8",
        "1.2.3.4444 1.2.3.4",
        "4111 1111-1111 1111",
        "4111  1111 1111 1111",
        "+1 (652) 555-5229.",
        "+1 2 ",
        "++1 555 555 5555",
    ],
)
def test_cases(text):
    assert base(text) == plain(text)


def test_long_runs_take_linear_time():
    for run in ("a" * 400_000, "1" * 400_000, "+" * 400_000, "1." * 200_000, "a@" * 200_000):
        assert len(pii.find_spans(run + " x@y.z")) >= 1


def test_added_kinds_need_checksum_or_context():
    iban = "GB82 WEST 1234 5698 7654 32"
    assert ("iban", 4, 4 + len(iban)) in [x[:3] for x in pii.find_spans(f"pay {iban} now")]
    assert not pii.find_spans("pay GB82 WEST 1234 5698 7654 33 now")
    kinds = lambda t: [x[0] for x in pii.find_spans(t)]
    assert kinds("ssn 123-45-6789") == ["ssn"]
    assert kinds("code 123-45-6789") == []
    assert kinds("call (652) 555-5229 today") == ["local_phone"]
    assert kinds("call +1 (652) 555-5229 today") == ["phone"]


def test_context_moves_the_score():
    near = pii.find_spans("card 4111111111111111")[0][3]
    plain_score = pii.find_spans("noun 4111111111111111")[0][3]
    against = pii.find_spans("isbn 4111111111111111")[0][3]
    assert near > plain_score > against


def test_masking_merges_overlaps():
    text = "to +1 (652) 555-5229 or a@b.co."
    assert pii.masked(text, pii.find_spans(text)) == "to [PHONE] or [EMAIL]."
    assert pii.masked("abcdef", [("a", 1, 4, 1.0), ("b", 2, 5, 1.0)]) == "a[A]f"


def test_rows(spark):
    rows = [(1, "a@b.co é 1.2.3.4", 5), (2, None, 5), (3, "", 5), (1, "a@b.co é 1.2.3.4", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans long")
    out = {r.doc_id: r for r in pii.detect(frame).collect()}
    assert pii.detect(frame).count() == 4
    assert out[1].spans == "email:0:6,ip:9:16" and out[1].n_ip == 1
    assert out[1].base_sha256 == hashlib.sha256(b"email:0:6,ip:9:16").hexdigest()
    assert out[2].spans == out[3].spans == "" and out[2].pii == []
    masked = pii.redact(frame)
    assert masked.columns == frame.columns
    assert [r.text for r in masked.orderBy("doc_id").collect()][-2:] == [None, ""]
    assert pii.detect(frame.limit(0)).count() == 0


def test_query_equals_patterns(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    rows = op4_pii(spark, tables).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = plain(texts[row.doc_id] or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert row.n_email == sum(k == "email" for k, _, _ in spans)
        assert row.n_phone == sum(k == "phone" for k, _, _ in spans)


def test_many_spans_take_time_in_proportion():
    import time

    def seconds(n):
        text = "ssn 123-45-6789 a@b.co " * n
        start = time.perf_counter()
        found = pii.find_spans(text)
        assert len(found) == 2 * n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(32_000) < 24 * max(seconds(4_000), 0.02)


def test_added_spans_that_touch_base_ones():
    text = "tel 555-123-4567 and tel (555) 123-4567@site.org, call 555.123.4567"
    found = pii.find_spans(text)
    base = [(s, e) for k, s, e, _ in found if k in pii.BASE_KINDS]
    added = [(s, e) for k, s, e, _ in found if k not in pii.BASE_KINDS]
    assert base and added
    assert not any(a < e and s < b for a, b in base for s, e in added)
    assert pii._covered([("x", 5, 9, 1), ("x", 0, 3, 1), ("x", 8, 12, 1), ("x", 12, 14, 1)]) == (
        [0, 5, 12], [3, 12, 14]
    )


@pytest.mark.parametrize("text", ["virement au compte", "Überweisung auf Konto", "transferencia a la cuenta"])
def test_context_in_four_languages(text):
    iban = "DE89 3704 0044 0532 0130 00"
    plain = pii.find_spans(f"xx {iban} yy")[0][3]
    assert pii.find_spans(f"{text} {iban}")[0][3] > plain
