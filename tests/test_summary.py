"""Counts and message texts."""

import random

import pytest

import tidemark as td
from tidemark import presets as P

COUNTS = "table_schema string, violations long"


def line_of(name, n):
    shown = name if len(name) <= P.NAME_LIMIT else name[: P.NAME_KEPT] + "..."
    return P.LINE_FORMAT % (shown, n)


def assert_fits(counts, budget, row):
    """A summary's properties: the most lines, from the top of the order, that the budget holds."""
    order = sorted(counts, key=lambda c: c[0])
    order.sort(key=lambda c: c[1], reverse=True)
    head = P.HEADER_FORMAT % (sum(n for _, n in counts), len(counts))
    shown = [line_of(*c) for c in order[: row.shown]]
    body = "\n".join([head, *shown])
    assert row.summary_text.startswith(body)
    assert not shown or len(body) <= budget
    left = len(counts) - row.shown
    if left:
        assert len("\n".join([body, line_of(*order[row.shown])])) > budget
    tail = {0: "", 1: "\n" + P.TAIL_ONE % 1}.get(left, "\n" + P.TAIL_MANY % left)
    assert row.summary_text == body + tail


def test_messages_written_out(spark):
    counts = spark.createDataFrame([("beta", 2), ("alpha", 2), ("gamma", 7)], COUNTS)
    (row,) = td.summary_text(counts).collect()
    assert row.summary_text == (
        "Found 11 table violations across 3 datasets:\n"
        "• *gamma*: 7 tables violate threshold\n"
        "• *alpha*: 2 tables violate threshold\n"
        "• *beta*: 2 tables violate threshold"
    )
    (row,) = td.summary_text(counts, budget=90).collect()
    assert row.summary_text == (
        "Found 11 table violations across 3 datasets:\n"
        "• *gamma*: 7 tables violate threshold\n\n"
        "_...and 2 more datasets (see attached file for complete list)_"
    )


@pytest.mark.parametrize("seed", range(6))
def test_text_has_its_properties(spark, seed):
    rng = random.Random(seed)
    names = {"d" * rng.choice([1, 5, 40, 79, 80, 81, 120]) + str(i) for i in range(rng.choice([1, 20, 60, 300]))}
    counts = [(name, rng.choice([1, 2, 9, 10, 1000])) for name in sorted(names)]
    budget = rng.choice([2800, 500, 120])
    (row,) = td.summary_text(spark.createDataFrame(counts, COUNTS), budget=budget).collect()
    assert_fits(counts, budget, row)


def test_shortest_lines_fill_the_whole_budget(spark):
    """Names of one character: no candidate is missing when the most lines fit."""
    counts = [(chr(0x4E00 + i), 1) for i in range(300)]
    (row,) = td.summary_text(spark.createDataFrame(counts, COUNTS)).collect()
    assert_fits(counts, 2800, row)


def test_one_dataset_left_out(spark):
    counts = [("a" * 70, 2), ("b" * 70, 1)]
    (row,) = td.summary_text(spark.createDataFrame(counts, COUNTS), budget=200).collect()
    assert row.shown == 1 and row.summary_text.endswith("and 1 more dataset (see attached file for complete list)_")


def test_no_line_fits(spark):
    (row,) = td.summary_text(spark.createDataFrame([("a", 2), ("b", 1)], COUNTS), budget=10).collect()
    assert row.shown == 0
    assert_fits([("a", 2), ("b", 1)], 10, row)


def test_stops_at_the_first_line_that_does_not_fit(spark):
    counts = [("a", 9), ("b" * 75, 8), ("c", 7)]
    lines = td.summary_lines(spark.createDataFrame(counts, COUNTS), budget=120)
    assert [r.table_schema for r in lines.collect()] == ["a"]


def test_by_group(spark):
    rng = random.Random(1)
    rows = [(g, f"{'x' * rng.randint(1, 90)}{i}", rng.randint(1, 50)) for g in "pqr" for i in range(100)]
    counts = spark.createDataFrame(rows, "g string, " + COUNTS)
    for row in td.summary_text(counts, ["g"]).collect():
        assert_fits([r[1:] for r in rows if r[0] == row.g], 2800, row)


def test_counts_totals_and_top(spark):
    records = spark.createDataFrame(
        [(n,) for n in ["b", "a", None, "b", "c", "d", "e", "f"]], "table_schema string"
    )
    counts = td.dataset_counts(records)
    assert {tuple(r) for r in counts.collect()} == {
        ("b", 2), ("a", 1), ("Unknown", 1), ("c", 1), ("d", 1), ("e", 1), ("f", 1),
    }
    assert tuple(td.totals(counts).first()) == (8, 7)
    assert [r[0] for r in td.top_datasets(counts).collect()] == ["b", "Unknown", "a", "c", "d"]
