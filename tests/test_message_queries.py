"""Queries that send the whole feed as messages: users drawn, bursts repeated, fraud marked."""

import hashlib
from datetime import datetime, timedelta

import pytest

from burstline.plans.table_queries import registered

EVENTS = (
    "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double, props string"
)
BEGIN = datetime(2024, 1, 1)


def starts_burst(number):
    return int(hashlib.md5(str(number).encode()).hexdigest()[:8], 16) % 10000 < 200


@pytest.fixture(scope="module")
def numbers():
    bursts = [n for n in range(2000) if starts_burst(n)][:4]
    calm = [n for n in range(2000) if not starts_burst(n)][:6]
    return bursts, calm


@pytest.fixture(scope="module")
def events(spark, numbers, tmp_path_factory):
    bursts, calm = numbers
    rows = [(n, 1, "view", BEGIN + timedelta(seconds=n), float(n), "{}") for n in bursts[1:] + calm]
    # Fraud is never a burst.
    rows.append((bursts[0], 1, "error", BEGIN, 5.0, "{}"))
    folder = tmp_path_factory.mktemp("messages")
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    for name in ("customer", "supplier"):
        key = name[0]
        listed = f"{key}_{'cust' if key == 'c' else 'supp'}key bigint, {key}_acctbal double, "
        listed += "c_mktsegment string" if key == "c" else "s_nationkey int"
        spark.createDataFrame([], listed).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["envelope_json", "stream_feed"])
def test_the_whole_feed_is_sent(spark, events, numbers, name):
    bursts, calm = numbers
    rows = registered()[name](spark, events).collect()
    assert len(rows) == 1 + 5 * 3 + 6
    assert all(r.message_key == r.User_ID for r in rows)
    sent = sorted((r.Transaction_ID, r.Timestamp) for r in rows if r.in_burst)
    assert {r.User_ID for r in rows if r.in_burst} == {"User_Bot"}
    expected = []
    for n in bursts[1:]:
        for k in range(5):
            when = BEGIN + timedelta(seconds=n, milliseconds=10 * k)
            millis = (when - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
            expected.append((f"TXN_{millis}_{n}", when.strftime("%Y-%m-%dT%H:%M:%S.%f")))
    assert sent == sorted(expected)
    (fraud,) = [r for r in rows if r.Class == 1]
    assert (fraud.User_ID, fraud.Amount, fraud.in_burst) == ("User_Hacker", 5.0, False)
    assert sorted(r.Amount for r in rows if not r.in_burst and r.Class == 0) == sorted(map(float, calm))
