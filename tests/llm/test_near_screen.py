"""What the signature screen and the bands lose of the pairs at exactly 0.8."""

from math import comb

from titlematch.llm.near_dedup import BANDS, BITS, HASHES, ROWS, SLACK


def test_a_pair_at_the_threshold_is_hardly_ever_lost():
    by_chance = 2.0**-BITS
    q = (1 - 0.8) * (1 - by_chance)
    lost = [d for d in range(HASHES + 1) if (1 - d / HASHES - by_chance) / (1 - by_chance) < 0.8 - SLACK]
    screen = sum(comb(HASHES, d) * q**d * (1 - q) ** (HASHES - d) for d in lost)
    assert screen + (1 - 0.8**ROWS) ** BANDS < 1e-6
