"""Edit distance for the few title checks made inside a block."""

from __future__ import annotations


def similarity(left: str, right: str) -> float:
    """One minus edit distance over the longer length; 1.0 for two empty texts."""
    longest = max(len(left), len(right))
    return (longest - distance(left, right)) / longest if longest else 1.0


def exceeds(left: str, right: str, limit: float) -> bool:
    """Whether the similarity is above ``limit``.

    Places with the same character in both texts bound it from below, which settles most long texts.
    """
    longest = max(len(left), len(right))
    if longest and sum(map(str.__eq__, left, right)) / longest > limit:
        return True
    return similarity(left, right) > limit


def distance(left: str, right: str) -> int:
    """Edit distance by the bit-vector method of Myers (1999), as Hyyro (2001) states it for whole texts.

    One step per character of the shorter text updates a whole column, one bit per character of the longer one.
    """
    if left == right:
        return 0
    longer, shorter = (left, right) if len(left) >= len(right) else (right, left)
    if not shorter:
        return len(longer)
    at: dict[str, int] = {}
    for i, char in enumerate(longer):
        at[char] = at.get(char, 0) | (1 << i)
    every, last = (1 << len(longer)) - 1, 1 << (len(longer) - 1)
    up, down, steps = every, 0, len(longer)
    for char in shorter:
        same = at.get(char, 0)
        vertical = same | down
        across = ((((same & up) + up) ^ up) | same) & every
        more, fewer = down | (every ^ (across | up)), up & across
        if more & last:
            steps += 1
        elif fewer & last:
            steps -= 1
        more, fewer = ((more << 1) | 1) & every, (fewer << 1) & every
        up, down = fewer | (every ^ (vertical | more) & every), more & vertical
    return steps
