"""Variance inflation and stepwise elimination with survivors (pass 3).

Spark adds up the cross products of all rows; what is left is a columns x columns matrix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.operators.gram import collect_blocks, correlation_of, cross_products

# Ridge on the diagonal, cap of R^2, and the correlation bounds of a survivor.
RIDGE = 1e-6
R2_CAP = 0.9999
MIN_CORRELATION = 0.7
PARTIAL_SHARE = 0.7


@dataclass
class Removal:
    column: str
    vif: float
    order: int
    survivor: str | None
    survivor_r2_drop: float = 0.0
    survivor_correlation: float = 0.0
    correlated: list[str] = field(default_factory=list)
    correlations: dict[str, float] = field(default_factory=dict)
    earlier_members: list[str] = field(default_factory=list)
    inherited_members: list[str] = field(default_factory=list)

    @property
    def members(self) -> list[str]:
        return sorted({self.column, *self.earlier_members, *self.inherited_members, *self.correlated})


def r_squared(corr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """R^2 of each column on the others, and the inverse it is read from.

    One inverse gives all of them: R^2_j = 1 + ridge - 1 / inv_jj.
    """
    p = len(corr)
    inverse = np.linalg.inv(corr + RIDGE * np.eye(p))
    if p == 1:
        return np.zeros(1), inverse
    return np.clip(1.0 + RIDGE - 1.0 / np.diag(inverse), 0.0, R2_CAP), inverse


def vif_from_correlation(corr: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 - r_squared(corr)[0])


def neighbour_score(corr: np.ndarray, inverse: np.ndarray, j: int) -> np.ndarray:
    """0.7 |partial| + 0.3 |marginal| correlation of column j with each other column."""
    diagonal = np.diag(inverse)
    partial = np.abs(inverse[j] / np.sqrt(diagonal[j] * diagonal))
    score = PARTIAL_SHARE * partial + (1 - PARTIAL_SHARE) * np.abs(corr[j])
    score[j] = 0.0
    return score


def eliminate_by_correlation(
    corr: np.ndarray, columns: list[str], threshold: float = 10.0,
    earlier: dict[str, list[str]] | None = None,
) -> tuple[list[str], list[Removal]]:
    """Drop the column with the largest VIF until all are below the threshold.

    What a dropped column stood for passes to the column whose R^2 falls most without it.
    """
    earlier = earlier or {}
    alive = list(range(len(columns)))
    inherited: dict[int, set[str]] = {}
    removals: list[Removal] = []
    while alive:
        g = corr[np.ix_(alive, alive)]
        before, inverse = r_squared(g)
        vif = 1.0 / (1.0 - before)
        worst = int(np.argmax(vif))
        if vif[worst] < threshold:
            break
        score = neighbour_score(g, inverse, worst)
        near = [a for a in np.flatnonzero(score >= MIN_CORRELATION)]
        gone = alive[worst]
        rest = alive[:worst] + alive[worst + 1 :]
        heir, drop = None, 0.0
        if rest:
            fall = np.delete(before, worst) - r_squared(corr[np.ix_(rest, rest)])[0]
            best = int(np.argmax(fall))
            if fall[best] > 0:
                heir, drop = rest[best], float(fall[best])
        name = columns[gone]
        correlations = {columns[alive[a]]: float(g[worst, a]) for a in near}
        record = Removal(
            column=name, vif=float(vif[worst]), order=len(removals) + 1,
            survivor=None if heir is None else columns[heir], survivor_r2_drop=drop,
            survivor_correlation=correlations.get(columns[heir], 0.0) if heir is not None else 0.0,
            correlated=list(correlations), correlations=correlations,
            earlier_members=sorted(set(earlier.get(name, [])) - {name}),
            inherited_members=sorted(inherited.pop(gone, set())),
        )
        if heir is not None:
            inherited.setdefault(heir, set()).update(
                [name, *record.earlier_members, *record.inherited_members]
            )
        removals.append(record)
        alive = rest
    return [columns[a] for a in alive], removals


def direct_vif(corr: np.ndarray) -> np.ndarray:
    """Least-squares VIF; columns that are exact combinations of others get infinity."""
    values, vectors = np.linalg.eigh(corr)
    null = values <= len(corr) * np.finfo(float).eps * max(values[-1], 1.0)
    tied = (vectors[:, null] ** 2).sum(axis=1) > 1e-10
    inverse = (vectors[:, ~null] ** 2 / values[~null]).sum(axis=1)
    return np.where(tied, np.inf, inverse)


def best_survivor(corr: np.ndarray, gone: int, alive: list[int]) -> tuple[int | None, float]:
    """Remaining column with the largest absolute correlation, if that is at least 0.7."""
    if not alive:
        return None, 0.0
    strength = np.abs(corr[gone, alive])
    best = int(np.argmax(strength))
    if strength[best] < MIN_CORRELATION:
        return None, 0.0
    return alive[best], float(strength[best])


class CompleteRows:
    """Cross products over the rows complete in a shrinking set of columns.

    Dropping a column adds exactly the rows in which only that column was missing, so each
    step scans those rows at most, and no row where the column has no missing value.
    """

    def __init__(self, df: DataFrame, columns: list[str], missing: dict[str, int],
                 shift: np.ndarray, scale: np.ndarray):
        self.df, self.columns, self.missing = df, list(columns), missing
        self.shift = dict(zip(columns, shift))
        self.scale = dict(zip(columns, scale))
        self.total = self._sum(df, self.columns)

    def _sum(self, df: DataFrame, columns: list[str]) -> np.ndarray:
        rows = cross_products(
            df, columns, np.array([self.shift[c] for c in columns]),
            np.array([self.scale[c] for c in columns]),
        )
        return collect_blocks(rows, 1, len(columns) + 1)[0]

    def drop(self, column: str) -> None:
        at = self.columns.index(column) + 1
        self.total = np.delete(np.delete(self.total, at, 0), at, 1)
        self.columns.remove(column)
        if self.missing.get(column, 0) and self.columns:
            newly_whole = self.df.filter(F.col(f"`{column}`").isNull())
            self.total = self.total + self._sum(newly_whole, self.columns)

    @property
    def count(self) -> int:
        return int(self.total[0, 0])

    def correlation(self) -> np.ndarray:
        return correlation_of(self.total)


def eliminate_directly(
    rows: CompleteRows, corr: np.ndarray, threshold: float = 10.0,
    earlier: dict[str, list[str]] | None = None,
) -> tuple[list[str], list[Removal]]:
    """Stepwise elimination on least-squares VIF over complete rows; survivors by ``corr``."""
    earlier = earlier or {}
    columns = list(rows.columns)
    alive = list(range(len(columns)))
    removals: list[Removal] = []
    while alive and rows.count >= len(alive) + 2:
        vif = direct_vif(rows.correlation())
        worst = int(np.argmax(vif))
        if vif[worst] < threshold:
            break
        gone = alive.pop(worst)
        heir, strength = best_survivor(corr, gone, alive)
        name = columns[gone]
        removals.append(
            Removal(
                column=name, vif=float(vif[worst]), order=len(removals) + 1,
                survivor=None if heir is None else columns[heir], survivor_correlation=strength,
                earlier_members=sorted(set(earlier.get(name, [])) - {name}),
            )
        )
        rows.drop(name)
    return [columns[a] for a in alive], removals


def use_direct(n_rows: int, n_columns: int) -> bool:
    return n_rows > 2 * n_columns
