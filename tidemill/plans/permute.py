"""Keyed permutations of 0..n-1 as column expressions.

A Feistel network over pairs (left, right) of a grid that just holds n cells:
in turn either half is moved, around its own axis, by a keyed function of the
other, which can be undone, so the cells are permuted.  A cell outside 0..n-1
is sent through again until it falls inside (cycle walking); how often that
happens at most is found beforehand by walking the few outside cells.  All
arithmetic stays below 2^62, so other engines can repeat it.
"""

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = 2147483647
ROUNDS = 4
#: Ranks that one permutation covers, at most: the halves stay below the prime.
MOST = 1 << 60


@dataclass(frozen=True)
class Permutation:
    """One order of n ranks, named by a key such as 'seed:epoch'."""

    n: int
    key: str

    def __post_init__(self):
        if not 0 <= self.n <= MOST:
            raise ValueError(f"a permutation of {self.n} ranks")

    @property
    def grid(self) -> tuple[int, int]:
        """Rows and columns of the grid; it has fewer than one row more cells than n."""
        rows = math.isqrt(max(self.n, 1) - 1) + 1
        return rows, -(-max(self.n, 1) // rows)

    def constants(self, turn: int) -> tuple[int, int, int, int]:
        """Two factors and two summands of a round, below the prime, from an md5 of the key and the round."""
        digits = hashlib.md5(f"{self.key}:{turn}".encode()).hexdigest()
        a, b, c, d = (int(digits[8 * i:8 * i + 8], 16) % (PRIME - 1) + 1 for i in range(4))
        return a, b, c, d

    @property
    def walks(self) -> int:
        """How often the network is applied to a rank at most."""
        rows, columns = self.grid
        outside = np.arange(self.n, rows * columns, dtype=np.int64)
        # Chains of outside cells that a rank leads into; cycles outside are never entered.
        chain = outside[self.once(outside, back=True) < self.n]
        most = 1
        while len(chain):
            chain = self.once(chain)
            chain = chain[chain >= self.n]
            most += 1
        return most

    def once(self, cells: np.ndarray, back: bool = False) -> np.ndarray:
        """The network on grid cells, as in ``apply``, or its inverse."""
        rows, columns = self.grid
        left, right = cells // columns, cells % columns
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            a, b, c, d = self.constants(turn)
            u = ((right if turn % 2 == 0 else left) * a + b) % PRIME
            u = ((u ^ (u >> 15)) * c + d) % PRIME
            u = u ^ (u >> 13)
            if turn % 2 == 0:
                left = (left - u if back else left + u) % rows
            else:
                right = (right - u if back else right + u) % columns
        return left * columns + right

    def positions(self, ranks: np.ndarray) -> np.ndarray:
        """The same as ``apply``, for an array."""
        out = self.once(np.asarray(ranks, dtype=np.int64))
        while (again := out >= self.n).any():
            out[again] = self.once(out[again])
        return out

    def apply(self, df: DataFrame, rank: str, out: str) -> DataFrame:
        """``df`` with the position of each rank (0..n-1): projections only, no shuffle.

        A NULL rank keeps a NULL position.  Halves are columns of their own, so
        that every round is computed once, in generated code.
        """
        rows, columns = self.grid
        kept, cell, current = [f"`{c}`" for c in df.columns], f"CAST(`{rank}` AS BIGINT)", df
        for walk in range(self.walks):
            # One selection in which every value is named and later ones refer to it.
            steps = [f"{cell} AS _cell", f"_cell DIV {columns}L AS _l0", f"_cell % {columns}L AS _r0"]
            left, right = "_l0", "_r0"
            for turn in range(ROUNDS):
                a, b, c, d = self.constants(turn)
                moved, by, size = (left, right, rows) if turn % 2 == 0 else (right, left, columns)
                there = f"{moved[:2]}{turn + 1}"
                steps += [
                    f"({by} * {a}L + {b}L) % {PRIME}L AS _u{turn}", f"((_u{turn} ^ shiftright(_u{turn}, 15)) * {c}L + {d}L) % {PRIME}L AS _v{turn}",
                    f"({moved} + (_v{turn} ^ shiftright(_v{turn}, 13))) % {size}L AS {there}",
                ]
                left, right = (there, right) if turn % 2 == 0 else (left, there)
            out_cell = f"{left} * {columns}L + {right}"
            steps.append(f"{out_cell if walk == 0 else f'CASE WHEN _cell < {self.n}L THEN _cell ELSE {out_cell} END'} AS _next")
            current = current.selectExpr(*kept, *steps).selectExpr(*kept, "_next AS _from")
            cell = "_from"
        # A value the optimizer must not compute elsewhere: else a filter on the
        # position would be pushed below the rounds, which means writing them
        # into one expression that doubles with each.
        fence = F.monotonically_increasing_id() >= 0
        return current.select(*[c for c in df.columns if c != out], F.when(fence, F.col("_from")).alias(out))
