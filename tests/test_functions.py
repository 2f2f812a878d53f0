import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tideline.functions import dates, hashing, numeric, pvalues, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_sanitize_text(rows):
    df = rows([(" Master  Degree ",), ("MASTER-DEGREE",), (None,), ("--",), ("Caffè 2",)], "s string")
    assert values(df, text.sanitize_text(F.col("s"))) == ["master_degree", "master_degree", "none", "", "caff_2"]


def test_human_duration(rows):
    df = rows([(0,), (999,), (61000,), (90061000,), (None,), (-1,), (86400000,), (3600000,)], "ms long")
    assert values(df, text.human_duration(F.col("ms"))) == [
        "0 seconds", "0 seconds", "1 minutes 1 seconds", "1 days 1 hours", "0 seconds",
        "23 hours 59 minutes", "1 days", "1 hours",
    ]
    assert values(rows([("abc",), ("12",), (None,)], "ms string"), text.human_duration(F.col("ms"))) == ["", "", "0 seconds"]


def test_replace_values_lowers_before_and_after(rows):
    df = rows([("Master Degree",), ("PHD",), ("Other",), (None,)], "s string")
    got = values(df, text.replace_values(F.col("s"), {"master degree": "Master's Degree", "phd": "Doctorate/Ph.D."}))
    assert got == ["master's degree", "doctorate/ph.d.", "other", None]
    numbers = rows([(1,), (2,)], "n int")
    assert values(numbers, text.replace_values(F.col("n"), {1: 10}, textual=False)) == [10, 2]


def test_map_values_unknown_is_null_or_default(rows):
    df = rows([("a",), ("z",), (None,)], "s string")
    assert values(df, text.map_values(F.col("s"), {"a": "x"})) == ["x", None, None]
    assert values(df, text.map_values(F.col("s"), {"a": "x"}, F.lit("d"))) == ["x", "d", "d"]


def test_location_key_needs_a_country(rows):
    df = rows([("Lazio", None, "Italy"), (None, "Rome", "Italy"), (None, None, "Italy"), ("Lazio", None, None)], "a string, b string, c string")
    assert values(df, text.location_key(F.col("a"), F.col("b"), F.col("c"))) == ["lazio_italy", "rome_italy", "_italy", None]


def test_leading_digit_keeps_only_the_first_character(rows):
    df = rows([(12.0,), (0.5,), (7.0,), (None,)], "n double")
    assert values(df, text.leading_digit(F.col("n"))) == [1, 0, 7, None]
    assert values(df, text.whole_number(F.col("n"))) == [12, 0, 7, None]


def test_recency_points_band_edges(rows):
    days = [None, -5, 0, 1, 6, 7, 29, 30, 89, 90, 179, 180, 4000]
    df = rows([(d,) for d in days], "d int")
    assert values(df, dates.recency_points(F.col("d"))) == [None, 0, 0, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1]


def test_whole_days_are_floored_not_calendar_days(rows):
    a = dt.datetime(2024, 1, 10, 1, 0)
    df = rows([(a, dt.datetime(2024, 1, 9, 23, 0)), (a, dt.datetime(2024, 1, 10, 2, 0)), (a, dt.datetime(2024, 1, 3, 1, 0))], "a timestamp, b timestamp")
    assert values(df, dates.whole_days_between(F.col("a"), F.col("b"))) == [0, -1, 7]


def test_anchor_date(rows):
    won, lost = dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    df = rows(
        [("Closed Won", won, lost, "2024-05-01"), ("Closed Lost", won, lost, "2024-05-01"), ("Open", won, lost, "2024-05-01"),
         (None, won, lost, "2024-05-01"), ("Closed Won", None, lost, "2024-05-01"), ("Open", won, lost, "soon")],
        "s string, w timestamp, l timestamp, d string",
    )
    at = dates.anchor_date(F.col("s"), F.col("w"), F.col("l"), F.col("d"))
    opening = dt.datetime(2024, 5, 1, 13)
    assert values(df, at) == [won, lost, opening, opening, None, None]


def test_numeric_helpers(rows):
    df = rows([(100.0, "DKK"), (100.0, "EUR"), (100.0, None)], "a double, c string")
    assert values(df, F.round(numeric.krone_to_euro(F.col("a"), F.col("c")), 6)) == [13.4, 100.0, 100.0]
    sizes = rows([(None,), (49,), (50,), (249,), (250,)], "s int")
    assert values(sizes, numeric.company_size_band(F.col("s"))) == [-1, 1, 2, 2, 3]
    pair = rows([("a", "a"), (None, ""), (None, "b")], "a string, b string")
    assert values(pair, numeric.changed_flag(F.col("a"), F.col("b"))) == [0, 0, 1]
    days = rows([(0,), (86400000,), (None,)], "ms long")
    assert values(days, numeric.ms_to_days(F.col("ms"))) == [None, 1.0, None]


def test_hash_is_stable(rows):
    df = rows([(1,), (2,)], "k long")
    import hashlib

    want = [hashlib.md5(f"{k}|42".encode()).hexdigest() for k in (1, 2)]
    assert values(df, hashing.key_hash(F.col("k"), "42")) == want
    got = values(df, hashing.hash_unit(hashing.key_hash(F.col("k"), "42")))
    assert got == [int(h[:8], 16) / 2**32 for h in want]


@pytest.mark.parametrize(
    "got, want",
    [
        (pvalues.chi_square_p(3.841458820694124, 1), 0.05),
        (pvalues.chi_square_p(18.307038053275146, 10), 0.05),
        (pvalues.chi_square_p(0.0, 3), 1.0),
        (pvalues.student_t_p(2.2281388519649385, 10), 0.05),
        (pvalues.student_t_p(0.0, 5), 1.0),
        (pvalues.f_p(4.964602743730711, 1, 10), 0.05),
        # Groups above the limit of the exact form take the asymptotic one.
        (pvalues.kolmogorov_p(1.3580986393225505 / math.sqrt(10_000), 20_000, 20_000), 0.05),
    ],
)
def test_p_values_at_known_quantiles(got, want):
    assert got == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("n0, n1", [(1, 1), (2, 3), (4, 4), (3, 6), (5, 4)])
def test_distribution_p_values_of_small_groups_equal_all_orders(n0, n1):
    from itertools import combinations

    gaps = []
    for first in combinations(range(n0 + n1), n0):
        seen, gap = 0, 0.0
        for place in range(n0 + n1):
            seen += place in first
            gap = max(gap, abs(seen / n0 - (place + 1 - seen) / n1))
        gaps.append(gap)
    for d in set(gaps):
        want = sum(g >= d - 1e-12 for g in gaps) / len(gaps)
        assert pvalues.kolmogorov_p(d, n0, n1) == pytest.approx(want, abs=1e-12)


def test_exact_and_asymptotic_distribution_p_values_meet():
    n = pvalues.EXACT_ROWS
    d = 150 / n
    assert pvalues.kolmogorov_p(d, n, n) == pytest.approx(pvalues.kolmogorov_p(d, n + 1, n + 1), rel=0.02)


@pytest.mark.parametrize("dof", [1e5, 9e5, 1.1e6, 1e9, 1e12])
def test_t_keeps_its_digits_with_many_rows(dof):
    normal = math.erfc(1 / math.sqrt(2))
    density = math.exp(-0.5) / math.sqrt(2 * math.pi)
    assert pvalues.student_t_p(1.0, dof) == pytest.approx(normal + density / dof, abs=1e-10)


def test_chi_square_with_very_many_categories():
    assert pvalues.chi_square_p(1e6, 10**6) == pytest.approx(0.49981, abs=1e-4)


def test_p_values_of_nothing():
    assert pvalues.chi_square_p(None, 3) is None
    assert pvalues.student_t_p(1.0, 0) is None
    assert pvalues.f_p(1.0, 1, 0) is None
