"""Suffix arrays against sorting, and windows of contexts against brute force."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.repeats import repeated_starts
from tidemark.llm.suffixes import common_prefixes, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=40))
def test_suffix_array_and_common_prefixes(symbols):
    s = [*symbols, 0]
    order = suffix_array(s)
    assert order == sorted(range(len(s)), key=lambda i: s[i:])
    shared = common_prefixes(s, order)
    for k in range(1, len(s)):
        x, y = s[order[k] :], s[order[k - 1] :]
        h = 0
        while x[h] == y[h]:
            h += 1
        assert shared[k] == h


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.binary(max_size=6)), max_size=6))
def test_repeated_starts(ends):
    """Contexts share the anchor; a window counts if another context has it at the same place from the anchor."""
    anchor, length = b"ANCHOR", 9
    contexts = [(a.translate(bytes([97, 98] * 128)) + anchor + b.translate(bytes([97, 98] * 128)), len(a)) for a, b in ends]
    found = repeated_starts(contexts, length)
    for i, (raw, at) in enumerate(contexts):
        expected = []
        for x in range(max(0, at + len(anchor) - length), min(at, len(raw) - length) + 1):
            same = (r[p - at + x : p - at + x + length] for j, (r, p) in enumerate(contexts) if j != i and p - at + x >= 0)
            if any(w == raw[x : x + length] for w in same):
                expected.append(x)
        got = [x for a, b in found[i] for x in range(a, b + 1)]
        assert [x for x in got if at + len(anchor) - length <= x <= at] == expected
