"""Routing rules: a JSON object from regular expression to channels.

The config texts are a column, one text per row, so many of them are read at once.
Each text is taken apart inside its own row, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.presets import DEFAULT_RULE, FALLBACK_CHANNELS

# Problems that concern the whole text come first; the rest in the order they are tested.
EMPTY_TEXT = "empty_text"
BAD_JSON = "bad_json"
NOT_AN_OBJECT = "not_an_object"
NO_DEFAULT = "no_default"
EMPTY_PATTERN = "empty_pattern"
NULL_VALUE = "null_value"
NOT_A_STRING = "not_a_string"
NO_CHANNEL = "no_channel"
BAD_REGEX = "bad_regex"

_RULE = pa.schema(
    [
        ("rule_no", pa.int32()),
        ("pattern", pa.string()),
        ("channels", pa.list_(pa.string())),
        ("is_default", pa.bool_()),
    ]
)
_PROBLEMS = "array<struct<rule_no:int,pattern:string,problem:string>>"


def split_channels(text: Column) -> Column:
    """Comma-separated channels as an array, blanks dropped, repeats kept."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda channel: channel != "")


def _problem(is_default: Column, pattern: Column, kind: Column, channels: Column) -> Column:
    return (
        F.when(~is_default & (pattern == ""), F.lit(EMPTY_PATTERN))
        .when(kind == "VOID", F.lit(NULL_VALUE))
        .when(kind != "STRING", F.lit(NOT_A_STRING))
        .when(F.size(channels) == 0, F.lit(NO_CHANNEL))
        .when(~is_default & _is_bad_regex(pattern), F.lit(BAD_REGEX))
    )


def _is_bad_regex(pattern: Column) -> Column:
    """Whether Java refuses to compile a pattern."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), pattern).isNull()


def _parsed(configs: DataFrame, text_column: str) -> DataFrame:
    """Each text with ``_rules``, its rules in the order of the text, and ``_problem``.

    Spark's JSON reader stops after the first value and so accepts text that goes on
    after the object. The text is therefore read as the first element of an array
    whose second holds the text's own digest, which a text cannot contain.

    A repeated key keeps its first place and its last value.
    """
    text = F.col(text_column)
    digest = F.md5(text.cast("binary"))
    wrapped = F.concat(F.lit("["), text, F.lit(',{"'), digest, F.lit('":0}]'))
    strict = {"allowSingleQuotes": "false"}
    objects = F.col("_objects")
    whole = (F.size(objects) == 2) & F.map_contains_key(F.try_element_at(objects, F.lit(2)), digest)

    # One column per step: each is computed once per row, and the lambdas of the next
    # step only look it up.
    entries, keys = F.col("_entries"), F.col("_keys")
    steps = configs.withColumn("_objects", F.from_json(wrapped, "array<map<string,variant>>", strict))
    steps = steps.withColumn(
        "_entries", F.map_entries(F.when(whole, F.try_element_at(objects, F.lit(1))))
    )
    steps = steps.withColumn("_keys", F.transform(entries, lambda entry: entry["key"]))
    numbered = F.transform(entries, lambda entry, at: F.struct(entry["key"].alias("key"), at.alias("at")))
    steps = steps.withColumn(
        "_places",
        F.filter(numbered, lambda each: F.array_position(keys, each["key"]) == each["at"] + 1),
    )

    def value_of(place: Column, at: Column) -> Column:
        value = F.element_at(F.filter(entries, lambda entry: entry["key"] == place["key"]), -1)["value"]
        is_default = place["key"] == DEFAULT_RULE
        return F.struct(
            (at + 1).alias("rule_no"),
            F.when(~is_default, strip(place["key"])).alias("pattern"),
            is_default.alias("is_default"),
            F.schema_of_variant(value).alias("kind"),
            split_channels(F.try_variant_get(value, "$", "string")).alias("channels"),
        )

    def rule(found: Column) -> Column:
        is_text = found["kind"] == "STRING"
        return F.struct(
            found["rule_no"].alias("rule_no"),
            found["pattern"].alias("pattern"),
            F.when(is_text, found["channels"]).alias("channels"),
            found["is_default"].alias("is_default"),
            _problem(found["is_default"], found["pattern"], found["kind"], found["channels"]).alias("problem"),
        )

    steps = steps.withColumn("_found", F.transform("_places", value_of))
    steps = steps.withColumn("_rules", F.transform("_found", rule))
    is_json = F.size(F.from_json(wrapped, "array<variant>", strict)) == 2
    problem = (
        F.when(text.isNull() | (strip(text) == ""), F.lit(EMPTY_TEXT))
        .when(entries.isNull(), F.when(is_json, F.lit(NOT_AN_OBJECT)).otherwise(F.lit(BAD_JSON)))
        .when(~F.exists("_rules", lambda r: r["is_default"]), F.lit(NO_DEFAULT))
    )
    return steps.withColumn("_problem", problem).select(*configs.columns, "_rules", "_problem")


def _is_sound() -> Column:
    return F.col("_problem").isNull() & ~F.exists("_rules", lambda r: r["problem"].isNotNull())


def parse_rules(configs: DataFrame, text_column: str = "config") -> DataFrame:
    """The rules of every sound config: number, pattern, channels, whether the default."""
    kept = [column for column in configs.columns if column != text_column]
    # Not a filter: Spark would evaluate the rules once more below it.
    sound = F.when(_is_sound(), F.col("_rules"))
    return _parsed(configs, text_column).select(*kept, F.inline(sound)).drop("problem")


def check_rules(configs: DataFrame, text_column: str = "config") -> DataFrame:
    """Everything wrong with each config. ``rule_no`` is NULL for the text as a whole."""
    kept = [column for column in configs.columns if column != text_column]
    parsed = _parsed(configs, text_column)
    whole = F.struct(
        F.lit(None).cast("int").alias("rule_no"),
        F.lit(None).cast("string").alias("pattern"),
        F.col("_problem").alias("problem"),
    )
    each = F.transform("_rules", lambda r: F.struct(r["rule_no"], r["pattern"], r["problem"]))
    problems = F.filter(
        F.concat(F.array(whole), F.coalesce(each, F.array().cast(_PROBLEMS))),
        lambda p: p["problem"].isNotNull(),
    )
    return parsed.select(*kept, F.inline(problems))


def failure_channels(
    configs: DataFrame, text_column: str = "config", fallback: Sequence[str] = FALLBACK_CHANNELS
) -> DataFrame:
    """Where to report a failure: the default channels, or the fallback if the config is bad."""
    kept = [column for column in configs.columns if column != text_column]
    default = F.element_at(F.filter("_rules", lambda r: r["is_default"]), 1)["channels"]
    return _parsed(configs, text_column).select(
        *kept,
        F.when(_is_sound(), default)
        .otherwise(F.array(*(F.lit(channel) for channel in fallback)))
        .alias("channels"),
    )


def _check_patterns(rules: DataFrame, patterns: list[str]) -> None:
    """Raise if a pattern is no regular expression, to Python or to Spark."""
    try:
        for pattern in patterns:
            re.compile(pattern)
        rules.select(F.rlike(F.lit(""), F.col("pattern"))).collect()
    except (re.error, PySparkException) as error:
        raise ValueError(f"{BAD_REGEX}: {error}") from error


def rules_from_json(spark: SparkSession, text: str) -> DataFrame:
    """The rules of one config text. Raises ValueError naming the first problem.

    The driver holds the text already, so it may hold the rules in it as well.
    """
    config = spark.range(1).select(F.lit(text).alias("config"))
    parsed = _parsed(config, "config").first()
    if parsed["_problem"]:
        raise ValueError(parsed["_problem"])
    for rule in sorted(parsed["_rules"], key=lambda r: not r["is_default"]):
        if rule["problem"]:
            raise ValueError(f"{rule['problem']} in rule {rule['rule_no']}")
    rules = spark.createDataFrame(
        pa.Table.from_pylist(
            [{name: rule[name] for name in _RULE.names} for rule in parsed["_rules"]], schema=_RULE
        )
    )
    _check_patterns(rules, [r["pattern"] for r in parsed["_rules"] if not r["is_default"]])
    return rules
