"""The wide table: what travels on its way, and rows whose ids repeat."""

import datetime
from types import SimpleNamespace

import pytest
from helpers import as_dicts

from tideline.checks.workload import crm_tables
from tideline.plans import retrieve, values

DAY = datetime.datetime(1996, 5, 1)


@pytest.fixture
def tables(rows):
    orders = [(o, 1 + o % 2, "FPO"[o % 3], 60_000.0 + o, DAY + datetime.timedelta(days=o), "3-MEDIUM") for o in range(1, 7)]
    orders.append(orders[2])  # a deal that is there twice
    parts = [(1, "a", "B#1", "PROMO", 10, 90.0), (2, "b", "B#2", "LARGE", 9, 80.0), (2, "b", "B#3", "LARGE", 9, 70.0), (3, "c", "B#4", "LARGE", 15, 60.0)]
    lines = [(o, p, 7, n, 2.0, 0.1, "AR"[n % 2], "FO"[p % 2], DAY) for o in range(1, 7) for n, p in enumerate((1, 2, 3), 1)]
    return crm_tables(
        SimpleNamespace(
            customer=rows([(1, "x", 3, 7000.0, "MACHINERY"), (2, "y", 4, 100.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            orders=rows(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
            part=rows(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            lineitem=rows(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
            events=rows([(3, DAY, 3, "view"), (4, DAY, 0, "view")], "event_id long, ts timestamp, user_id long, event_type string"),
            region=rows([(3, "ASIA")], "r_regionkey int, r_name string"),
        )
    )


def test_rows_travel_without_the_columns_of_deals_and_courses(tables, monkeypatch):
    written = {}

    def spy(df, label):
        written[label] = set(df.columns)
        return write(df, label)

    write = retrieve.materialize
    monkeypatch.setattr(retrieve, "materialize", spy)
    assert retrieve.retrieve(tables, per="row").count() > 0
    wide = {*values.COURSE_COLUMNS, *values.DEAL_COLUMNS}
    assert not written["anchored"] & wide and not written["placed"] & wide


def test_repeated_deals_and_courses_multiply_as_in_a_join(tables):
    out = [r for r in as_dicts(retrieve.retrieve(tables, per="row"))]
    seen = sorted((r["deal_id"], r["course_id"], r["sku_tuition"]) for r in out)
    once = [(1, "B#1"), (2, "B#2"), (2, "B#3")]  # course 3 is not given in Italy
    # The deal that is there twice has two rows of stage times as well.
    assert seen == sorted((o, *c) for o in range(1, 7) for c in once for _ in range(4 if o == 3 else 1))
    assert all(r["n_calls"] == 3 and r["contact_id"] == 1 + r["deal_id"] % 2 for r in out)
    assert {(r["interview_done"], r["interview_scheduled"]) for r in out if r["deal_id"] == 1} == {(1, 1)}
    one = as_dicts(retrieve.retrieve(tables))
    assert sorted(r["contact_id"] for r in one) == [1, 2]
