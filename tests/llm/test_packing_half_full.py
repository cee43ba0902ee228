"""Patterns that are half full are used as far as the stream of cut remainders can fill them."""

from distillery.llm import packing


def test_half_full_patterns_are_used():
    each, n = 2056, 1000  # a little over half of a sequence: no two go together
    rows, sequences = packing.plan({129: n}, {129: n * each}, 16, 4096)
    placed = sum(last - first for _, first, last, *_ in rows)
    stream, room = (n - placed) * each, sequences * (4096 - each)
    assert placed == sequences and 0.45 * n < sequences < 0.5 * n
    assert room <= stream <= 1.15 * room
