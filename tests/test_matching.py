"""Pattern joins: both ways of running them give what brute force gives."""

import random
import re

import pytest

from pyspark.sql import functions as F

import tidemark as td
from tidemark.operators import matching

FIXED_PATTERNS = [
    "", "%", "_", "%%", "a%", "%a", "%a%", "a", "a%b", "%_%", "__%", "a\\_b%", "%\\_", "\\_%", "\\%%",
    "a\\%", "_\\_b", "\\_", "a\\_%\\_b", "\\\\%", "%\\\\", "a.b%", "(%", "%$", "^a%", "a%\nb",
    "a\\b%", "\\a\\.%", "%\\.", "a\\", "\\", "\\\\\\", "%\\(\\$_",
]


def fits(name, pattern):
    out, i = "", 0
    while i < len(pattern):
        if pattern[i] == "\\":
            i = min(i + 1, len(pattern) - 1)
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(pattern[i], re.escape(pattern[i]))
        i += 1
    return re.fullmatch(out, name, re.DOTALL) is not None


@pytest.mark.parametrize("nested_loop_rules", [10_000, 0])
def test_like_join_equals_brute_force(spark, nested_loop_rules):
    rng = random.Random(7)

    def word(letters, longest):
        return "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))

    tables = sorted({(rng.choice("de"), word("abC_é1.$(\\\n", 7)) for _ in range(400)})
    rules = [(word("abc%_é1.$(", 6), rng.randint(1, 5)) for _ in range(300)]
    rules += [(p, 1) for p in FIXED_PATTERNS] + [("a%", 1), ("a%", None), (None, 3)]
    usable = [(p, h) for p, h in rules if p is not None and h is not None]
    expected = []
    for dataset, name in tables:
        found = [(dataset, name, p, h) for p, h in usable if fits(name.lower(), p)]
        expected += found or [(dataset, name, None, None)]
    matched = td.match_thresholds(
        spark.createDataFrame(tables, "table_schema string, table_name string"),
        spark.createDataFrame(rules, "table_pattern string, latency_threshold int"),
        nested_loop_rules,
    )
    assert sorted(map(tuple, matched.collect()), key=str) == sorted(expected, key=str)


def test_no_rules_at_all(spark):
    tables = spark.createDataFrame([("d", "t")], "table_schema string, table_name string")
    none = spark.createDataFrame([], "table_pattern string, latency_threshold int")
    for nested_loop_rules in (64, -1):
        (row,) = td.match_thresholds(tables, none, nested_loop_rules).collect()
        assert tuple(row) == ("d", "t", None, None)


def test_rules_that_look_alike_do_not_meet_every_name(spark):
    """A thousand rules with one beginning: the key is the part in which they differ."""
    from tidemark.operators.matching import _with_anchor

    rules = spark.range(1000).selectExpr(
        "concat('orders_', id, '%') AS table_pattern", "1 AS latency_threshold"
    )
    shared = _with_anchor(rules).groupBy("at", "piece").count().agg({"count": "max"}).first()[0]
    assert shared <= 20


@pytest.mark.parametrize("nested_loop_rules", [64, 3])
def test_regex_join_equals_brute_force(spark, nested_loop_rules):
    ids = [f"{a}{b}" for a in ("daton_", "x", "Acme") for b in range(30)]
    rules = [(i, p) for i, p in enumerate(["daton", "^x1", "2$", "acme|Acme", "(3|4)5?", ".", "zzz", "daton"])]
    matched = td.match_regex(
        spark.createDataFrame([(i,) for i in ids], "id string"),
        spark.createDataFrame(rules, "rule_no int, pattern string"),
        "id",
        nested_loop_rules,
    )
    expected = sorted((i, n) for i in ids for n, p in rules if re.search(p, i))
    assert sorted((r.id, r.rule_no) for r in matched.collect()) == expected


def test_tables_without_a_name_stay_however_many_rules(spark):
    tables = spark.createDataFrame([("d", None), ("d", "orders_1"), (None, "orders_1"), ("d", "")], "table_schema string, table_name string")
    rules = spark.createDataFrame([("orders%", 5), ("%", 9), ("___", 1), ("%_1", 2)], "table_pattern string, latency_threshold int")
    found = [
        sorted(map(tuple, td.match_thresholds(tables, rules, n).collect()), key=str) for n in (0, 1, 64)
    ]
    assert found[0] == found[1] == found[2]
    assert ("d", None, None, None) in found[0] and len(found[0]) == 8


def test_regexes_meet_the_same_ids_however_many_rules(spark):
    ids = spark.createDataFrame([("acme",), ("acme",), ("daton_x",), ("zz",), (None,), ("",)], "name string")
    patterns = ["acme|zz", "^a", "x$", "a.me", "(daton|zz)", "q", "acme|zz", "zz$|^acme$"]
    rules = spark.createDataFrame(list(enumerate(patterns)), "rule_no int, pattern string")
    found = [sorted(map(tuple, td.match_regex(ids, rules, "name", n).collect())) for n in (0, 1, 64)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 16


def test_a_piece_in_a_third_of_all_names(spark):
    name = F.when(F.col("id") % 3 == 0, F.concat(F.lit("hot_"), "id")).otherwise(F.concat(F.lit("t"), "id"))
    tables = spark.range(3000).select(F.lit("d").alias("table_schema"), name.alias("table_name"))
    rules = spark.range(100).select(F.concat(F.lit("hot%"), "id").alias("table_pattern"), F.lit(1).alias("latency_threshold"))
    got = td.match_thresholds(tables, rules, 8).filter("table_pattern is not null")
    names = [f"hot_{i}" for i in range(0, 3000, 3)]
    assert got.count() == sum(n.endswith(str(k)) for n in names for k in range(100))


REGEXES = [
    "^(click|view)_12", "a(b|c)d|efg$", "ab?c", "ab*cd", "ab+cd", "x{2}yz", "x{0,1}yz", "[abc]de", "a.c", "\\d+x", "a\\.b", "(ab)?cd", "(?:ab)+cd", "(a(b(c)))d",
    "(?i)abc", "a|", "", "^$", "a\\Q.\\Eb", "[]a]b", "(?=ab)a", "a[^b]c", "ab|[cd]", "\\(ab\\)", "é+l", "a\\|b", "ab{2}c|d+e", "\\(?ab", "a(?:b|)c",
]


def test_pieces_are_in_every_match(spark):
    """What a pattern finds holds a piece of it; which patterns have pieces is as expected."""
    from tidemark.operators.matching import literal_pieces

    patterns = spark.createDataFrame([(p,) for p in REGEXES], "pattern string")
    keys = {}
    for p, key in literal_pieces(patterns).collect():
        keys.setdefault(p, set()).add(key)
    rng = random.Random(11)
    ids = ["".join(rng.choice("abcdefgxyz_12.(|)é") for _ in range(rng.randint(0, 7))) for _ in range(30_000)]
    ids += ["click_12", "view_123", "abc", "ac", "acd", "abbcd", "xxyz", "yz", "ade", "a.b", "cd", "ababcd", "abcd", "éél", "(ab)", "a|b", "ABC"]
    for p in REGEXES:
        for i in ids:
            if p in keys and re.search(p, i):
                assert any(key in i for key in keys[p]), (p, i)
    without = {p for p in REGEXES if p not in keys}
    assert without == {"(?i)abc", "a|", "", "^$", "a\\Q.\\Eb", "[]a]b", "(?=ab)a", "ab|[cd]", "\\(?ab"}


@pytest.mark.parametrize("nested_loop_rules", [10_000, 0])
def test_regex_join_equals_brute_force(spark, nested_loop_rules):
    from tidemark.operators.matching import match_regex

    patterns = [p for p in REGEXES if p not in ("a\\Q.\\Eb", "[]a]b")]
    rng = random.Random(12)
    ids = ["".join(rng.choice("abcdexy_12.é") for _ in range(rng.randint(0, 6))) for _ in range(300)] + ["click_12", "ABC", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    rules = spark.createDataFrame([(p, n) for n, p in enumerate(patterns)], "pattern string, n int")
    got = {(r.id, r.pattern) for r in match_regex(df, rules, "id", nested_loop_rules).collect()}
    assert got == {(i, p) for i in ids if i is not None for p in patterns if re.search(p, i)}


def test_candidates_grow_with_what_matches(spark):
    """A piece that many patterns share is not the one that ids meet them by."""
    from tidemark.operators.matching import candidate_pairs, literal_pieces

    patterns = spark.createDataFrame([(f"^(click|view)_{n:03d}x?$",) for n in range(400)], "pattern string")
    ids = spark.createDataFrame([(f"click_{n:03d}",) for n in range(400)], "id string")
    pairs = candidate_pairs(ids, literal_pieces(patterns), "id").collect()
    assert {(f"click_{n:03d}", f"^(click|view)_{n:03d}x?$") for n in range(400)} <= set(map(tuple, pairs))
    assert len(pairs) < 10 * 400


def test_a_pattern_listed_often_is_tested_once_for_a_name(spark):
    """The side that is tested has each pattern once; its thresholds come after, repeats included."""
    rules = spark.createDataFrame([("a%", 1)] * 2500 + [("a%", 2)] * 3 + [("%", 7), ("b_", 4)], "table_pattern string, latency_threshold int")
    tables = spark.createDataFrame([("d", "ab"), ("d", "b1"), ("e", None), (None, "ab")], "table_schema string, table_name string")
    matched = td.match_thresholds(tables, rules, 8)
    tested = [line for line in matched._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "_regex#" in line]
    assert tested and not any("latency_threshold" in line for line in tested)
    count = {tuple(row)[:4]: row["count"] for row in matched.groupBy(matched.columns).count().collect()}
    ab = {("a%", 1): 2500, ("a%", 2): 3, ("%", 7): 1}
    assert count == {
        **{(d, "ab", *rule): n for d in ("d", None) for rule, n in ab.items()},
        ("d", "b1", "%", 7): 1, ("d", "b1", "b_", 4): 1, ("e", None, None, None): 1,
    }


def test_pieces_of_many_rules_are_made_in_many_tasks(spark, monkeypatch):
    tasks, made = [], matching.literal_pieces
    monkeypatch.setattr(matching, "literal_pieces", lambda p: tasks.append(p.rdd.getNumPartitions()) or made(p))
    ids = spark.createDataFrame([("abc1",), ("abd2",), (None,)], "id string")
    rules = spark.createDataFrame([("c1$",), ("d2|zz",), ("c1$",), (None,)], "pattern string")
    found = matching.match_regex(ids, rules, "id", nested_loop_rules=1)
    assert sorted(tuple(r) for r in found.collect()) == [("abc1", "c1$"), ("abc1", "c1$"), ("abd2", "d2|zz")]
    assert tasks == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_rows_of_a_long_result_are_made_in_many_tasks_and_move_once(spark, tmp_path):
    """A result of tables x rules is made last, in as many tasks as a shuffle has; what matched before does not move."""
    names = spark.range(200).selectExpr("CASE WHEN id % 9 > 0 THEN concat('d', id % 3) END AS table_schema", "CASE WHEN id % 7 > 0 THEN concat('t_', id) END AS table_name")
    rules = spark.range(4000).selectExpr("concat(CASE id % 3 WHEN 0 THEN '%_' WHEN 1 THEN 't__' ELSE '%' END, id % 10, '%') AS table_pattern", "CAST(id % 2 AS INT) AS latency_threshold")
    rules = rules.union(spark.createDataFrame([("%", 1)] * 2100 + [("%", None), (None, 2)], "table_pattern string, latency_threshold int"))
    names.write.parquet(f"{tmp_path}/names")
    tables = spark.read.parquet(f"{tmp_path}/names")
    matched = td.match_thresholds(tables, rules, 8)
    text = matched._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("REPARTITION_BY_NUM" in line for line in moved)
    assert matched.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = td.match_thresholds(tables, rules, 10_000)
    counts = [{tuple(r)[:4]: r["count"] for r in m.groupBy(m.columns).count().collect()} for m in (matched, plain)]
    assert counts[0] == counts[1] and counts[0]["d1", "t_1", "%", 1] == 2100
    assert (None, None, None, None) in counts[0]


def test_matches_stay_where_the_schema_is_never_null(spark, tmp_path):
    spark.range(700).write.parquet(f"{tmp_path}/raw")
    tables = spark.read.parquet(f"{tmp_path}/raw").selectExpr("CASE WHEN id % 2 = 0 THEN 'd' ELSE '' END AS table_schema", "concat('t_', id) AS table_name")
    rules = spark.range(2000).selectExpr("concat(CASE id % 2 WHEN 0 THEN '%_' ELSE 't__' END, id % 50) AS table_pattern", "CAST(id % 3 AS INT) AS latency_threshold")
    matched = td.match_thresholds(tables, rules, 8)
    moved = [line for line in matched._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 2 and all("REPARTITION_BY_NUM" in line for line in moved)
    plain = td.match_thresholds(tables, rules, 10_000)
    counts = [{tuple(r)[:4]: r["count"] for r in m.groupBy(m.columns).count().collect()} for m in (matched, plain)]
    assert counts[0] == counts[1] and ("d", "t_698", "%_8", 0) in counts[0] and ("", "t_1", None, None) in counts[0]


def test_no_schema_and_an_empty_one_stay_apart(spark):
    tables = spark.createDataFrame([(None, "a"), ("", "a"), ("=", "a"), (None, "b"), ("", None), (None, None)], "table_schema string, table_name string")
    rules = spark.createDataFrame([("a", 1), ("%", 2), ("_b", 3)], "table_pattern string, latency_threshold int")
    got = sorted(map(tuple, td.match_thresholds(tables, rules, 0).collect()), key=str)
    expected = [(d, "a", *r) for d in (None, "", "=") for r in (("a", 1), ("%", 2))] + [(None, "b", "%", 2), ("", None, None, None), (None, None, None, None)]
    assert got == sorted(expected, key=str)


def test_lists_of_thresholds_stay_short(spark):
    rules = spark.createDataFrame([("a%", 5)] * 4500 + [("a%", n) for n in range(3000)] + [("b", 1)], "table_pattern string, latency_threshold int")
    lists = [(r.table_pattern, list(r._hours)) for r in matching._listed(rules).collect()]
    assert sorted((p, h) for p, hours in lists for h in hours) == sorted(map(tuple, rules.collect()))
    assert len(lists) > 3 and max(len(hours) for _, hours in lists) <= 5 * matching._MOST_TIMES
