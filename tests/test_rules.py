"""Routing config texts."""

import pytest

import tidemark as td
from tidemark import presets as P

BAD = [
    ("", "empty_text"),
    (" \n\t ", "empty_text"),
    (None, "empty_text"),
    ('{"default": "C0",}', "bad_json"),
    ('{"default": "C0"', "bad_json"),
    ("{'default': 'C0'}", "bad_json"),
    ('{"default": "C0"} tail', "bad_json"),
    ('{"default": "C0"}] tail', "bad_json"),
    ('{"default": "C0"}, {"a": "b"}', "bad_json"),
    ('["C0"]', "not_an_object"),
    ('"C0"', "not_an_object"),
    ("null", "not_an_object"),
    ('{"a": "C0"}', "no_default"),
    ('{" default ": "C0"}', "no_default"),
    ('{"default": null}', "null_value"),
    ('{"default": 5}', "not_a_string"),
    ('{"default": "C0", "a": ["C1"]}', "not_a_string"),
    ('{"default": ", ,"}', "no_channel"),
    ('{"default": "C0", "a": " "}', "no_channel"),
    ('{"default": "C0", " ": "C1"}', "empty_pattern"),
]


@pytest.mark.parametrize("text, problem", BAD)
def test_bad_config(spark, text, problem):
    configs = spark.createDataFrame([(7, text)], "id int, config string")
    assert [(r.id, r.problem) for r in td.check_rules(configs).collect()] == [(7, problem)]
    assert td.parse_rules(configs).isEmpty()
    assert td.failure_channels(configs, fallback=["F"]).first().channels == ["F"]
    with pytest.raises(ValueError, match=problem):
        td.rules_from_json(spark, text)


@pytest.mark.parametrize("pattern", ["(", "a{2,1}", "[z-a]"])
def test_bad_regex(spark, pattern):
    with pytest.raises(ValueError, match="bad_regex"):
        td.rules_from_json(spark, f'{{"{pattern}": "C1", "default": "C0"}}')


def test_regex_that_only_python_knows(spark):
    with pytest.raises(ValueError, match="bad_regex"):
        td.rules_from_json(spark, '{"(?P<n>a)": "C1", "default": "C0"}')


def test_every_problem_is_listed_and_the_default_raises_first(spark):
    text = '{"a": 1, "": "C1", "default": null, "b": ","}'
    configs = spark.createDataFrame([(1, text)], "id int, config string")
    found = sorted((r.rule_no, r.problem) for r in td.check_rules(configs).collect())
    assert found == [(1, "not_a_string"), (2, "empty_pattern"), (3, "null_value"), (4, "no_channel")]
    with pytest.raises(ValueError, match="null_value in rule 3"):
        td.rules_from_json(spark, text)


def rules(spark, text):
    return [tuple(r) for r in td.rules_from_json(spark, text).orderBy("rule_no").collect()]


def test_rules(spark):
    text = ' {"77|nexus": " C1 ,C2,\\tC1", "default": "C0,C9,C0", "b": "C3"} '
    assert rules(spark, text) == [
        (1, "77|nexus", ["C1", "C2", "C1"], False),
        (2, None, ["C0", "C9", "C0"], True),
        (3, "b", ["C3"], False),
    ]


def test_repeated_key_keeps_its_first_place_and_last_value(spark):
    text = '{"a": 5, "b": "C2", "default": "C0", "a": "C3", "default": "C1"}'
    assert rules(spark, text) == [
        (1, "a", ["C3"], False), (2, "b", ["C2"], False), (3, None, ["C1"], True),
    ]


def test_only_the_exact_key_is_the_default(spark):
    assert rules(spark, '{" default ": "C1", "default": "C0"}') == [
        (1, "default", ["C1"], False), (2, None, ["C0"], True),
    ]


def test_many_configs_at_once(spark):
    configs = spark.createDataFrame(
        [(1, '{"default": "A"}'), (2, "{"), (3, '{"x": "B", "default": "C, D"}')], "id int, config string"
    )
    assert sorted((r.id, r.rule_no) for r in td.parse_rules(configs).collect()) == [(1, 1), (3, 1), (3, 2)]
    got = {r.id: r.channels for r in td.failure_channels(configs).collect()}
    assert got == {1: ["A"], 2: list(P.FALLBACK_CHANNELS), 3: ["C", "D"]}


def test_bad_patterns_are_found_in_many_configs(spark):
    configs = spark.createDataFrame(
        [(1, '{"(": "C1", "default": "C0"}'), (2, '{"a|b": "C1", "[z-a]": "C2", "default": "C0"}'), (3, '{"a": "C1", "default": "C9"}')],
        "id int, config string",
    )
    got = sorted((r.id, r.rule_no, r.problem) for r in td.check_rules(configs).collect())
    assert got == [(1, 1, "bad_regex"), (2, 2, "bad_regex")]
    assert {r.id for r in td.parse_rules(configs).collect()} == {3}
    assert {r.id: r.channels for r in td.failure_channels(configs).collect()} == {
        1: list(P.FALLBACK_CHANNELS), 2: list(P.FALLBACK_CHANNELS), 3: ["C9"],
    }
