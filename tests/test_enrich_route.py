import math

import pytest

from burstline.config import DetectionConfig
from burstline.operators.enrich import categorize, enrich, mark_blocked
from burstline.operators.route import (
    fraud_alerts,
    normal_transactions,
    routed_transactions,
    unrouted,
    with_route,
)
from burstline.schemas import ALERT, BLACKLIST, NORMAL
from burstline.sources.blacklist import (
    INITIAL_ROWS,
    read_blacklist,
    require_unique,
    store_initial_blacklist,
    unique_blacklist,
)
from tests.conftest import at

COLUMNS = "Transaction_ID string, User_ID string, Amount double, Class int, event_time timestamp"


def transactions(spark, *rows):
    full = [(str(i), user, amount, label, at(0)) for i, (user, amount, label) in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


def blacklist(spark, rows=INITIAL_ROWS):
    return spark.createDataFrame(rows, BLACKLIST)


@pytest.mark.parametrize(
    "amount, category",
    [
        (500.0, "Normal"),
        (500.01, "Macro"),
        (20.0, "Normal"),
        (19.99, "Micro"),
        (-5.0, "Micro"),
        (None, "Normal"),
        (math.nan, "Macro"),
        (math.inf, "Macro"),
        (-math.inf, "Micro"),
    ],
)
def test_category(spark, amount, category):
    assert categorize(transactions(spark, ("u", amount, 0))).first().Category == category


ROUTES = [
    ("User_Hacker", 0, "alert", "BLOCKED_USER"),
    ("User_Hacker", 1, "alert", "BLOCKED_USER"),
    ("User_Hacker", None, "alert", "BLOCKED_USER"),
    ("User_0001", 1, "alert", "FRAUD_DETECTED"),
    ("User_Bot", 1, "alert", "FRAUD_DETECTED"),
    (None, 1, "alert", "FRAUD_DETECTED"),
    ("User_0001", 0, "normal", None),
    ("User_Bot", 0, "unrouted", None),
    (None, 0, "unrouted", None),
    ("User_0001", None, "unrouted", None),
    ("User_0001", 2, "unrouted", None),
    (None, None, "unrouted", None),
]


def test_routing_matrix(spark):
    rows = [(user, 30.0, label) for user, label, _, _ in ROUTES]
    enriched = enrich(transactions(spark, *rows), blacklist(spark))
    expected = {str(i): route for i, (_, _, route, _) in enumerate(ROUTES)}
    types = {str(i): kind for i, (_, _, route, kind) in enumerate(ROUTES) if route == "alert"}

    def ids(route):
        return {i for i, r in expected.items() if r == route}

    normal = normal_transactions(enriched)
    alerts = fraud_alerts(enriched)
    assert {r.Transaction_ID for r in normal.collect()} == ids("normal")
    assert {r.Transaction_ID: r.Alert_Type for r in alerts.collect()} == types
    assert {r.Transaction_ID for r in unrouted(enriched).collect()} == ids("unrouted")
    assert {r.Transaction_ID: r.Route for r in with_route(enriched).collect()} == expected
    rows = routed_transactions(enriched).collect()
    folded = {r.Transaction_ID: (r.Route, r.Alert_Type) for r in rows}
    assert folded == {
        i: (route, types.get(i)) for i, route in expected.items() if route != "unrouted"
    }


def test_output_schemas(spark):
    enriched = enrich(transactions(spark, ("u", 1.0, 0)), blacklist(spark))
    assert enriched.columns[0] == "User_ID"
    for output, schema in [(normal_transactions, NORMAL), (fraud_alerts, ALERT)]:
        fields = output(enriched).schema.fields
        assert [(f.name, f.dataType) for f in fields] == [(f.name, f.dataType) for f in schema]


def test_users_kept_out_are_a_setting(spark):
    enriched = enrich(transactions(spark, ("User_Bot", 1.0, 0), ("a", 1.0, 0)), blacklist(spark))
    for users, count in [((), 2), (("a",), 1), (("a", "User_Bot"), 0)]:
        config = DetectionConfig(users_kept_out_of_normal=users)
        assert normal_transactions(enriched, config).count() == count


def test_match_without_reason_is_active(spark):
    enriched = enrich(
        transactions(spark, ("u", 1.0, 0)), blacklist(spark, [("u", None, "2024-01-01")])
    )
    row = enriched.first()
    assert (row.User_Status, row.Block_Reason, row.Block_Date) == ("ACTIVE", None, "2024-01-01")


DUPLICATES = [
    ("a", "later", "2024-02-01"),
    ("a", "earlier", "2024-01-01"),
    ("b", None, "2020-01-01"),
    ("b", "stated", "2024-01-01"),
    ("c", "y", "2024-01-01"),
    ("c", "x", "2024-01-01"),
    ("d", "no date", None),
    ("d", "dated", "2024-05-05"),
    ("e", None, None),
    (None, "nobody", "2024-01-01"),
]


def test_blacklist_has_one_row_per_user(spark):
    rows = unique_blacklist(blacklist(spark, DUPLICATES)).collect()
    assert {r.User_ID: (r.Block_Reason, r.Block_Date) for r in rows} == {
        "a": ("earlier", "2024-01-01"),
        "b": ("stated", "2024-01-01"),
        "c": ("x", "2024-01-01"),
        "d": ("dated", "2024-05-05"),
        "e": (None, None),
    }
    assert len(rows) == 5


@pytest.mark.parametrize("salt_buckets", [1, 4])
def test_join_keeps_every_transaction_once(spark, salt_buckets):
    rows = [("a", float(i), 0) for i in range(50)] + [(None, 1.0, 0)] * 9 + [("z", 1.0, 0)]
    joined = mark_blocked(
        transactions(spark, *rows), blacklist(spark, DUPLICATES), salt_buckets=salt_buckets
    )
    out = joined.collect()
    assert len(out) == 60 and "_salt" not in joined.columns
    assert {r.Block_Reason for r in out if r.User_ID == "a"} == {"earlier"}
    assert {r.User_Status for r in out if r.User_ID != "a"} == {"ACTIVE"}


def test_stored_blacklist(spark, tmp_path):
    path = str(tmp_path / "blacklist")
    store_initial_blacklist(spark, path)
    rows = read_blacklist(spark, path).collect()
    assert sorted(tuple(r) for r in rows) == sorted(INITIAL_ROWS)
    with pytest.raises(Exception, match="(?i)exists"):
        store_initial_blacklist(spark, path)
    store_initial_blacklist(spark, path, replace=True)
    require_unique(read_blacklist(spark, path))
    with pytest.raises(ValueError, match="rows for"):
        require_unique(read_blacklist(spark, path).union(read_blacklist(spark, path)))
