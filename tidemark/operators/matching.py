"""Joins on a LIKE pattern or a regular expression held in a column.

Spark plans such a join as a nested loop over a broadcast rule table. That is
right for a short rule list and wrong for a long one, so each join here first
counts the rules, up to a limit, and takes another way beyond it. Both ways give
the same rows, NULLs and repeats included; tests hold them against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.stored import stored

NESTED_LOOP_RULES = 64
_BROADCAST_BYTES = 1 << 20
_LONGEST_PIECE = 3
_SPREAD = 32
_MOST_TIMES = 1000


def is_short(rules: DataFrame, pattern: str, limit: int) -> bool:
    """Whether the rules are few and small enough to broadcast.

    Reads ``limit`` + 1 rows at most and brings their lengths, not the rules, to the driver.
    """
    lengths = rules.select(F.coalesce(F.octet_length(pattern), F.lit(0))).take(limit + 1)
    return len(lengths) <= limit and sum(length for (length,) in lengths) <= _BROADCAST_BYTES


def _many_tasks(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out to as many tasks as a shuffle has.

    Matching costs far more time per byte than other work, so partitions must not be
    merged by their size; Spark leaves a number that is asked for as it is.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


# A wildcard that no escape stands before, or an even number of backslashes.
_FREE = r"(?<!\\)((?:\\\\)*)"


def _with_tests(rules: DataFrame) -> DataFrame:
    """Add what is cheap to test in place of LIKE.

    Spark compiles a LIKE pattern from a column anew for every pair, after quoting each
    of its characters; that costs some hundred times as much as comparing text.

    ``_head`` and ``_tail`` are the literal text before the first and after the last
    wildcard, ``_least`` the shortest text that fits. ``_decided`` marks the patterns
    for which these are the whole answer: one ``%``, or ``%middle%``. For the others
    ``_regex`` says the same as the pattern and is compiled without the quoting.
    """
    pattern = F.col("table_pattern")
    parts = F.split(pattern, "%")
    plain = ~F.contains(pattern, F.lit("_")) & ~F.contains(pattern, F.lit("\\"))
    around = plain & (F.size(parts) == 3) & pattern.startswith("%") & pattern.endswith("%")
    # A backslash stands for itself at the end, and for nothing before an ordinary character.
    kept = F.regexp_replace(pattern, _FREE + r"\\$", r"$1\\\\")
    kept = F.regexp_replace(kept, _FREE + r"\\([^%_\\])", "$1$2")
    escaped = F.regexp_replace(kept, r"([.\[\]{}()*+?^$|])", r"\\$1")
    regex = F.regexp_replace(F.regexp_replace(escaped, _FREE + "%", "$1.*"), _FREE + "_", "$1.")
    return rules.withColumns(
        {
            "_head": F.regexp_extract(pattern, r"^[^%_\\]*", 0),
            # A tail starts behind a wildcard or behind an escaped character.
            "_tail": F.regexp_extract(pattern, r"(?:^|[%_]|\\.)([^%_\\]*)$", 1),
            "_least": F.length(F.regexp_replace(F.regexp_replace(pattern, r"\\(.)", "x"), "%", "")),
            "_middle": F.when(around, F.get(parts, F.lit(1))),
            "_decided": around | (plain & (F.size(parts) == 2)),
            "_regex": F.concat(F.lit(r"(?s)\A"), regex, F.lit(r"\z")),
        }
    )


def _fits(name: Column) -> Column:
    """Whether a name fits a pattern. Cheap tests first; each stops the ones after it."""
    return (
        (F.length(name) >= F.col("_least"))
        & name.startswith(F.col("_head"))
        & name.endswith(F.col("_tail"))
        & F.when(F.col("_middle").isNotNull(), F.contains(name, F.col("_middle"))).otherwise(F.lit(True))
        & (F.col("_decided") | F.rlike(name, F.col("_regex")))
    )


def _usable(thresholds: DataFrame) -> DataFrame:
    """Thresholds that can match: with a pattern and a number of hours."""
    return thresholds.select("table_pattern", "latency_threshold").filter(
        F.col("table_pattern").isNotNull() & F.col("latency_threshold").isNotNull()
    )


def match_thresholds(
    tables: DataFrame, thresholds: DataFrame, nested_loop_rules: int = NESTED_LOOP_RULES
) -> DataFrame:
    """Every table with every threshold whose pattern its lower-cased name fits.

    A left join: a table nothing fits keeps one row with NULLs. Patterns without a
    threshold do not count. ``tables`` has one row per (table_schema, table_name).
    """
    rules = _usable(thresholds)
    named = tables.withColumn("_name", F.lower("table_name"))
    if is_short(rules, "table_pattern", nested_loop_rules):
        tested = F.broadcast(_with_tests(rules))
        matched = named.join(tested, _fits(F.col("_name")), "left")
    else:
        matched = _match_by_piece(named, rules)
    return matched.select(*tables.columns, "table_pattern", "latency_threshold")


def _pieces(text: Column, first: Column) -> Column:
    """All substrings of a text up to the longest size, numbered by place from ``first``.

    ``first`` 0 leaves the place out: then all have place 0.
    """
    def of_size(size: int) -> Column:
        last = F.length(text) - size + 1
        return F.when(
            last >= 1,
            F.transform(
                F.sequence(F.lit(1), last),
                lambda at: F.struct((at * first).alias("at"), F.substr(text, at, F.lit(size)).alias("piece")),
            ),
        ).otherwise(F.array().cast("array<struct<at:int,piece:string>>"))

    return F.concat(*(of_size(size) for size in range(1, _LONGEST_PIECE + 1)))


def _with_anchor(rules: DataFrame) -> DataFrame:
    """Add to each pattern a piece of its literal text, the one that fewest patterns share.

    A name can only fit a pattern whose literal text it contains, so equality on one
    piece finds every candidate. Up to the first ``%`` the place of a piece is known as
    well, and is part of the key; later pieces have place 0. Taking the piece fewest
    patterns share keeps apart patterns that look alike. A pattern of wildcards only
    has the empty piece.
    """
    pattern = F.col("table_pattern")
    fixed = F.regexp_extract(pattern, r"^[^%\\]*", 0)
    runs = F.split(F.substr(pattern, F.length(fixed) + 1), r"\\.|[%_]")
    loose = F.flatten(F.transform(runs, lambda run: _pieces(run, F.lit(0))))
    literal = F.filter(
        F.concat(_pieces(fixed, F.lit(1)), loose), lambda p: ~F.contains(p["piece"], F.lit("_"))
    )
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("piece"))
    pieces = (
        rules.select("table_pattern")
        .distinct()
        .select("table_pattern", F.explode_outer(F.array_distinct(literal)).alias("key"))
        .select("table_pattern", F.coalesce("key", nothing).alias("key"))
        .select("table_pattern", "key.at", "key.piece")
    )
    shared = pieces.groupBy("at", "piece").agg(F.count(F.lit(1)).alias("shared"))
    rarest = F.min(
        F.struct("shared", (-F.length("piece")).alias("short"), (-F.col("at")).alias("back"), "piece")
    )
    anchors = (
        pieces.join(shared, ["at", "piece"])
        .groupBy("table_pattern")
        .agg(rarest.alias("rarest"))
        .select("table_pattern", (-F.col("rarest.back")).alias("at"), "rarest.piece")
    )
    return rules.join(anchors, "table_pattern")


def counted(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """Equal rows as one, with ``_times``: how often they occur, or the sum of ``times``.

    More than ``_MOST_TIMES`` are told in several rows, so that no list of them is long.
    """
    number = F.count(F.lit(1)) if times is None else F.sum(times)
    turns = rows.groupBy(*rows.columns if times is None else [c for c in rows.columns if c != "_times"]).agg(number.alias("_times"))
    turns = turns.withColumn("_turn", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / _MOST_TIMES))))
    return turns.withColumn("_times", F.least(F.lit(_MOST_TIMES), F.col("_times") - F.col("_turn") * _MOST_TIMES).cast("int"))


def _keys_of_size(name: Column, size: int, places: list[int]) -> list[Column]:
    """The pieces of a name that patterns may have as anchor: at these places, or anywhere (0)."""
    last = F.length(name) - size + 1
    placed = [at for at in places if at > 0]
    keys = []
    if placed:  # a name is looked at where patterns have their pieces, nowhere else
        within = F.filter(F.lit(placed), lambda at: at <= last)
        keys.append(F.transform(within, lambda at: F.struct(at.alias("at"), F.substr(name, at, F.lit(size)).alias("piece"))))
    if 0 in places:
        every = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        held = F.array_distinct(F.transform(every, lambda at: F.substr(name, at, F.lit(size))))
        keys.append(F.transform(held, lambda piece: F.struct(F.lit(0).alias("at"), piece.alias("piece"))))
    return keys


def _fitting_pairs(names: DataFrame, anchored: DataFrame, found: list[str]) -> DataFrame | None:
    """Rows of ``names`` once for each row of ``anchored`` whose pattern their ``_name`` fits; None where there are no patterns.

    Equality on a piece of text, then LIKE. One join for pieces of all kinds, so names are read once, and what
    is found stays in the task of its name while Spark can broadcast the patterns.
    """
    # The places are those within one pattern's length, and there are three sizes. No size: wildcards only.
    kinds: dict[int, list[int]] = {}
    for at, size in sorted(anchored.select("at", F.length("piece").alias("size")).distinct().collect()):
        kinds.setdefault(size, []).append(at)
    if not kinds:
        return None
    kept = [column for column in names.columns if column != "_name"]
    name = F.col("_name")
    keys = []
    for size, places in sorted(kinds.items()):
        if size == 0:
            # Equality again, on one of a few numbers below 0: wildcards only are told apart by length alone.
            spread = (-1 - F.pmod(F.xxhash64("_name"), F.lit(_SPREAD))).cast("int")
            keys.append(F.array(F.struct(spread.alias("at"), F.lit("").alias("piece"))))
            parts = F.when(F.col("piece") == "", F.sequence(F.lit(-_SPREAD), F.lit(-1))).otherwise(F.array("at"))
            anchored = anchored.withColumn("at", F.explode(parts))
            continue
        keys += _keys_of_size(name, size, places)
    pieces = names.withColumn("_key", F.explode(F.concat(*keys))).withColumns({"_at": F.col("_key.at"), "_piece": F.col("_key.piece")})
    same = (F.col("_at") == F.col("at")) & (F.col("_piece") == F.col("piece"))
    return pieces.join(anchored, same & _fits(name)).select(*kept, *found)


_KEYS = ["table_schema", "table_name"]


def _of_table(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with their keys renamed, and that these are the keys of a table."""
    renamed = rows.withColumnsRenamed({key: f"_{key}" for key in _KEYS})
    return renamed, F.col("table_schema").eqNullSafe(F.col("_table_schema")) & (F.col("table_name") == F.col("_table_name"))


def _listed(rules: DataFrame) -> DataFrame:
    """table_pattern, _hours: the thresholds of each pattern, repeats included, in lists of about ``_MOST_TIMES``."""
    turns = stored(counted(rules))
    number = turns.groupBy("table_pattern").agg(F.sum("_times").alias("_all"))
    part = F.pmod(F.xxhash64("latency_threshold", "_turn"), F.ceil(F.col("_all") / _MOST_TIMES))
    hours = F.flatten(F.collect_list(F.array_repeat("latency_threshold", F.col("_times"))))
    parted = turns.join(number, "table_pattern").groupBy("table_pattern", part.alias("_part"))
    return parted.agg(hours.alias("_hours")).drop("_part")


def _match_by_piece(named: DataFrame, rules: DataFrame) -> DataFrame:
    """The same left join for a long rule list: names meet distinct patterns, the rules of a pattern come last.

    Patterns with their pieces are stored, so that they are worked out once. Only key and
    name of a table are multiplied by its pieces; what matches comes back to the tables
    by key, and a table nothing fits, or without a name, stays one row. However often a pattern is
    listed, it is tested and shuffled once for a name. The result has a row for each rule that fits a table,
    so it may be far larger than both: its rows are made from lists, last of all, in as many tasks as a shuffle has.
    """
    listed = stored(_listed(rules))
    anchored = stored(_with_tests(_with_anchor(listed.select("table_pattern").distinct())))
    # The schema may be null: as one text that tells null from empty, it is an ordinary key that no optimization takes
    # apart, and what is dealt out by it need not move again.
    schema = F.coalesce(F.concat(F.lit("="), "table_schema"), F.lit(""))
    keys = ["_schema", "table_name"]
    tables = _many_tasks(named.withColumn("_schema", schema), *keys)
    names = tables.filter(F.col("_name").isNotNull()).select(*keys, "_name").distinct()
    pairs = _fitting_pairs(names, anchored, ["table_pattern"])
    if pairs is None:
        return named.withColumns({"table_pattern": F.lit(None).cast("string"), "latency_threshold": F.lit(None).cast("int")})
    matched = tables.join(pairs, keys, "left").join(listed, "table_pattern", "left")
    return matched.withColumn("latency_threshold", F.explode_outer("_hours"))


def match_violated(
    tables: DataFrame, thresholds: DataFrame, violated: Column, nested_loop_rules: int = NESTED_LOOP_RULES
) -> DataFrame:
    """Of ``match_thresholds`` the rows from which the threshold to report is picked, for one threshold per pattern.

    A short list gives all. A long one gives for each table, of the matches for which ``violated`` holds, the one
    with the longest pattern, and no row for a table that fits patterns but violates none. So as not to
    sort all matches, patterns are numbered in that order and the least number of a table is a hash aggregate.
    """
    rules = _usable(thresholds)
    if is_short(rules, "table_pattern", nested_loop_rules):
        return match_thresholds(tables, rules, nested_loop_rules)
    # Numbers rise with the order; that they leave gaps does not matter.
    ordered = rules.orderBy(F.desc(F.length("table_pattern")), "table_pattern", "latency_threshold")
    ranked = stored(ordered.withColumn("_rank", F.monotonically_increasing_id()))
    anchored = stored(_with_tests(_with_anchor(ranked)))
    named = tables.withColumn("_name", F.lower("table_name"))
    names = _many_tasks(named.filter(F.col("_name").isNotNull()), "table_name", "table_schema")
    pairs = _fitting_pairs(names, anchored, ["latency_threshold", "_rank"])
    if pairs is None:
        return match_thresholds(tables, rules, nested_loop_rules)
    best = pairs.groupBy(*_KEYS).agg(F.min(F.when(violated, F.col("_rank"))).alias("_rank"))
    best, same_table = _of_table(best)
    met = tables.join(best, same_table, "left").filter(F.col("_table_name").isNull() | F.col("_rank").isNotNull())
    return met.join(ranked, "_rank", "left").select(*tables.columns, "table_pattern", "latency_threshold")


def match_regex(
    ids: DataFrame, rules: DataFrame, id_column: str, nested_loop_rules: int = NESTED_LOOP_RULES
) -> DataFrame:
    """Ids joined to the rules whose regular expression is found in them.

    A short list is tested with literal patterns, each compiled once. Of a long one, a pattern meets
    only the ids that hold a piece of text which its matches must hold, see ``literal_pieces``. Patterns
    without such a piece have no key to join on: they are cut into blocks of ``_BLOCK`` and the ids
    into parts, as many as a shuffle has; each block meets each part in a task of its own.
    """
    if not is_short(rules, "pattern", nested_loop_rules):
        return _found_pairs(ids, rules, id_column)
    # So few, and so small, that they may be held here.
    listed = [p for (p,) in rules.select("pattern").distinct().collect() if p is not None]
    found = [F.when(F.rlike(F.col(id_column), F.lit(p)), F.lit(p)) for p in sorted(listed)]
    patterns = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    pairs = ids.withColumn("_pattern", F.explode(patterns))
    return pairs.join(rules, F.col("_pattern") == F.col("pattern")).drop("_pattern")


_BLOCK = 64
_SLOTS = 1 << 16
_GAP = "\x00"
# What stands between the literal runs of an alternative, in the order in which it is taken out.
_NOT_LITERAL = (
    r"\\[^A-Za-z0-9]|\\[dDwWsSbBAZ]",  # an escape of one character
    r"\[\^?[^\[\]]+\]",  # a class of characters
    *[r"\([^()]*\)"] * 4,  # groups, from the inside out
)
# What may be left out of a match, or repeat.
_NOT_FIXED = (r".[?*][?+]?", r".\{[^{}]*\}[?+]?", r"\+[?+]?", r"[.^$]")
# Signs of what is not taken apart: other escapes, odd classes, open groups.
_UNKNOWN = r"[\\()\[\]{}]"


def _parted(texts: Column, sign: str) -> Column:
    return F.transform(texts, lambda x: F.regexp_replace(x, sign, _GAP))


def _literal_runs(pattern: Column) -> Column:
    """For each alternative the texts that all its matches hold; null for a pattern that is not taken apart.

    Nothing is guessed: what is not known to be literal only parts the runs.
    """
    plain = F.regexp_replace(pattern, r"\(\?:", "(")
    text = plain
    for sign in _NOT_LITERAL:
        text = F.regexp_replace(text, sign, _GAP)
    fixed = F.split(text, "[|]")
    for sign in _NOT_FIXED:
        fixed = _parted(fixed, sign)
    known = ~F.contains(pattern, F.lit(_GAP)) & ~F.contains(plain, F.lit("(?")) & ~F.exists(fixed, lambda x: F.rlike(x, F.lit(_UNKNOWN)))
    return F.when(known, F.transform(fixed, lambda x: F.filter(F.split(x, _GAP), lambda run: run != "")))


def literal_pieces(patterns: DataFrame) -> DataFrame:
    """pattern, _key: for each alternative of a pattern, of the pieces all its matches hold the one that fewest patterns share.

    Patterns with an alternative that need not hold any text are left out.
    """
    runs = patterns.select("pattern", _literal_runs(F.col("pattern")).alias("runs"))
    runs = runs.filter(F.col("runs").isNotNull() & ~F.exists("runs", lambda x: F.size(x) == 0))
    alternatives = runs.select("pattern", F.posexplode("runs").alias("nth", "texts"))
    pieces = F.flatten(F.transform("texts", lambda run: F.transform(_pieces(run, F.lit(0)), lambda p: p["piece"])))
    pieces = alternatives.select("pattern", "nth", F.explode(F.array_distinct(pieces)).alias("_key"))
    shared = pieces.select("pattern", "_key").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("shared"))
    best = F.min(F.struct("shared", (-F.length("_key")).alias("short"), "_key")).alias("best")
    chosen = pieces.join(shared, "_key").groupBy("pattern", "nth").agg(best)
    return chosen.select("pattern", F.col("best._key").alias("_key")).distinct()


def candidate_pairs(ids: DataFrame, keyed: DataFrame, id_column: str) -> DataFrame:
    """Ids with the patterns a piece of which they hold, once for each such piece; what is left is to look for a match."""
    pieces = F.transform(_pieces(F.col(id_column), F.lit(0)), lambda p: p["piece"])
    held = ids.withColumn("_key", F.explode(F.array_distinct(pieces)))
    # pieces move only where their hash shares a slot with that of a key; there are _SLOTS of them at most
    slot = F.xxhash64("_key").bitwiseAND(F.lit(_SLOTS - 1)).alias("_slot")
    slots = keyed.select(slot).distinct()
    held = held.select("*", slot).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")
    return held.join(keyed, "_key").drop("_key")


def _found_pairs(ids: DataFrame, rules: DataFrame, id_column: str) -> DataFrame:
    """Rows of ids with each rule whose pattern is found in them.

    The rules' columns go with their patterns, which have few rows; what is found is not shuffled here.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = F.col(id_column)
    ids = _many_tasks(ids.filter(value.isNotNull()))
    # a list of patterns has few bytes, its pieces have many: the tasks must not be merged before they are made
    patterns = _many_tasks(rules.select("pattern"), "pattern").distinct()
    keyed = stored(literal_pieces(patterns))
    # The pieces of a pattern that come before one: where an id holds several, the first counts.
    before = keyed.groupBy("pattern").agg(F.collect_set("_key").alias("_keys"))
    carried = keyed.join(before, "pattern").withColumn("_before", F.filter("_keys", lambda k: k < F.col("_key"))).drop("_keys")
    carried = stored(carried.join(rules, "pattern"))
    met = candidate_pairs(ids, carried, id_column).filter(~F.exists("_before", lambda k: F.contains(value, k)))
    columns = [*ids.columns, *rules.columns]
    found = met.filter(F.rlike(value, F.col("pattern"))).select(*columns)
    other = rules.join(keyed, "pattern", "left_anti").filter(F.col("pattern").isNotNull())
    blocks = -(-other.count() // _BLOCK)
    if blocks:
        blocked = other.withColumn("_block", F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int"))
        blocked = blocked.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        copied = ids.withColumn("_part", F.pmod(F.xxhash64(id_column), F.lit(parts)).cast("int"))
        copied = _many_tasks(copied.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), "_block", "_part")
        met = copied.join(blocked, ["_block", "_part"]).filter(F.rlike(value, F.col("pattern")))
        found = found.unionByName(met.select(*columns))
    return found
