"""The order of the rows in each epoch: a keyed permutation of their positions.

Positions 0 .. n - 1 are written as two digits, (left, right) in a grid of a x b places with
a = ceil(sqrt(n)) and b = ceil(n / a). Rounds add to one digit, modulo its range, a number made of
the other and of the round's keys; each round can be undone, so all of them are a bijection of the
grid. Fewer than a places of the grid are no positions. A position that lands on one goes on
through the rounds until it lands on a position; as a bijection runs in cycles, it does, and two
positions never meet. How often that takes at most is found beforehand on the few such places.

All of it is whole-number arithmetic on columns: no sort, no shuffle, no state, and a row's
place in any epoch is known from its position alone, and its position from its place.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunefeed.operators.batching import BatchPlan, assign_rank, assign_step

# Modulus of the round numbers: squares of what is below it fit in 64 bits.
MODULUS = 2**31 - 1
ROUNDS = 4
MAX_ROWS = 2**60


def round_keys(seed: int, epoch: int) -> list[tuple[int, int]]:
    """Two numbers below ``MODULUS`` per half round."""
    keys = []
    for i in range(2 * ROUNDS):
        digest = hashlib.sha256(f"{seed}/{epoch}/{i}".encode()).digest()
        keys.append(tuple(int.from_bytes(digest[j : j + 8], "big") % MODULUS for j in (0, 8)))
    return keys


def grid(n: int) -> tuple[int, int]:
    """Places along the two sides, enough for n positions."""
    if not 0 <= n <= MAX_ROWS:
        raise ValueError(f"{n} rows cannot be put in order")
    a = math.isqrt(n - 1) + 1 if n else 1
    return a, max(-(-n // a), 1)


def _mixed(digit, key: tuple[int, int]):
    """A number below MODULUS, of a digit (a number, an array or a column)."""
    u = (digit + key[0]) % MODULUS
    return (u * u + key[1] * u) % MODULUS


def permuted(at: np.ndarray, n: int, keys: list[tuple[int, int]], inverse: bool = False) -> np.ndarray:
    """Where the rounds, once through, take places of the grid."""
    a, b = grid(n)
    left, right = at // b, at % b
    pairs = list(zip(keys[::2], keys[1::2]))
    for first, second in reversed(pairs) if inverse else pairs:
        if inverse:
            right = (right - _mixed(left, second)) % b
            left = (left - _mixed(right, first)) % a
        else:
            left = (left + _mixed(right, first)) % a
            right = (right + _mixed(left, second)) % b
    return left * b + right


def longest_walk(n: int, keys: list[tuple[int, int]]) -> int:
    """How often, at most, a position has to go on through the rounds to land on a position."""
    a, b = grid(n)
    at = np.arange(n, a * b, dtype=np.int64)
    # Places that no position lands on lead nowhere, or come after those that one does.
    at, steps = at[permuted(at, n, keys, inverse=True) < n], 0
    while at.size:
        at = permuted(at, n, keys)
        at, steps = at[at >= n], steps + 1
    return steps


def epoch_order(
    df: DataFrame, n: int, epoch: int, seed: int = 0, position: str = "p", out: str = "p_epoch", inverse: bool = False
) -> DataFrame:
    """Add the place in an epoch's order of the row at ``position`` (0 .. n - 1, dense); with
    ``inverse``, the position of the row at that place. Equal seeds and epochs give equal orders.
    """
    a, b = grid(n)
    keys = round_keys(seed, epoch)

    def once(at: Column) -> Column:
        """The rounds, once through: each step changes one digit, and the two change places."""
        left, right = F.call_function("div", at, F.lit(b)), at % b
        digits = (right, left, b, a) if inverse else (left, right, a, b)
        halves = reversed(keys) if inverse else keys
        numbers = F.array(*[F.struct(*[F.lit(x).cast("bigint") for x in half]) for half in halves])

        def half_round(state: Column, key: Column) -> Column:
            number = _mixed(state["y"], (key["col1"], key["col2"]))
            changed = F.pmod(state["x"] - number if inverse else state["x"] + number, state["a"])
            return _state(state["y"], changed, state["b"], state["a"])

        done = F.aggregate(numbers, _state(*[F.lit(d) if isinstance(d, int) else d for d in digits]), half_round)
        # Variables of a lambda are bound, so no rule of the optimizer can repeat the rounds.
        return F.aggregate(
            F.array(done), F.lit(0).cast("bigint"), lambda _, d: d["y"] * b + d["x"] if inverse else d["x"] * b + d["y"]
        )

    place = once(F.col(position).cast("bigint"))
    walk = longest_walk(n, keys)
    if walk:
        again = F.array(*[F.lit(0)] * walk)
        place = F.aggregate(again, place, lambda at, _: F.when(at < n, at).otherwise(once(at)))
    return df.withColumn(out, place)


def _state(x: Column, y: Column, a: Column, b: Column) -> Column:
    return F.struct(*[c.cast("bigint").alias(name) for name, c in zip("xyab", (x, y, a, b))])


def plan_epoch(
    df: DataFrame, n: int, epoch: int, plan: BatchPlan, seed: int = 0, position: str = "p"
) -> DataFrame:
    """``rank``, ``step`` and ``micro`` of each row in an epoch's order; ``p_epoch`` is its place there.

    Steps go on counting from the epochs before (epoch 0 is the first), and a step cap holds
    over all epochs.
    """
    ordered = epoch_order(df, n, epoch, seed, position)
    planned = assign_step(assign_rank(ordered, plan.world_size, "p_epoch"), plan, "p_epoch")
    per_epoch = -(-n // plan.rows_per_step)
    planned = planned.withColumn("step", F.col("step") + epoch * per_epoch)
    return planned.filter(F.col("step") <= plan.max_steps) if plan.max_steps > 0 else planned
