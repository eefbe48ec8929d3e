"""Declared rules as rows: every kind, values behind arrays, conditions, missing paths and documents."""

import pytest

from noticespark.functions import constants as K
from noticespark.operators.quality import Rule, rule_violations

SCHEMA = """id int, confidence_raw double, data struct<title: string, day: string, until: string, kind: string,
            parts: array<struct<code: string, tags: array<string>>>>"""
ROWS = [
    (1, 0.9, ("a", "2024-01-02", "2024-01-02", "x", [("11", ["p"]), ("2", None)])),
    (2, 0.5, ("", "2024-01-02", "2024-01-03", "y", [("33", []), (None, ["q", None])])),
    (3, None, (None, "no date", "2024-01-01", None, [])),
    (4, 0.2, (None, "2024-05-01", "2024-01-01", "x", None)),
    (5, 0.7, None),
]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize(
    "rule, violations",
    [
        (Rule("r", "error", "required", "title"), 4),
        (Rule("r", "error", "required", "parts.code"), 3),
        (Rule("r", "error", "required", "no.such.path"), 5),
        (Rule("r", "error", "pattern", "parts.code", "^[0-9]{2}$"), 1),
        (Rule("r", "error", "pattern", "parts.tags", "^p$"), 1),
        (Rule("r", "error", "pattern", "no.such.path", "^p$"), 0),
        (Rule("r", "error", "length", "parts.code", "2"), 1),
        (Rule("r", "error", "one_of", "kind", "x|z"), 1),
        (Rule("r", "error", "not_before", "until", "day"), 1),
        (Rule("r", "error", "after", "until", "day"), 2),
        (Rule("r", "error", "after", "until", "day", "kind", "x"), 2),
        (Rule("r", "error", "required", "title", "", "kind", "y"), 1),
        (Rule("r", "info", "band", "confidence_raw", "0.5,0.9"), 2),
        (Rule("r", "info", "band", "confidence_raw", ",0.5"), 1),
        (Rule("r", "info", "band", "confidence_raw", "0.9,"), 1),
    ],
)
def test_rule(events, rule, violations):
    assert [tuple(r) for r in rule_violations(events, [rule]).collect()] == [("r", rule.severity, violations)]


def test_rules_may_come_from_a_table(spark, events):
    table = spark.createDataFrame([Rule("one", "warning", "one_of", "kind", "x"), Rule("two", "error", "required", "day")])
    assert {tuple(r) for r in rule_violations(events, table.collect()).collect()} == {("one", "warning", 1), ("two", "error", 1)}


def test_no_rules_no_events_and_unknown_kinds(events):
    assert rule_violations(events, []).count() == 0
    none = rule_violations(events.limit(0), [Rule("r", "error", "required", "title")]).collect()
    assert [tuple(r) for r in none] == [("r", "error", 0)]
    with pytest.raises(ValueError, match="unknown kind"):
        rule_violations(events, [Rule("r", "error", "sounds_like", "title")])


def test_declared_rules_have_distinct_names():
    assert len({r[0] for r in K.RULES}) == len(K.RULES)
