"""Label permutations as matrix products: ranks of a panel are laid out once, and a task applies its draws to them.

A panel of statistics is a bounded side (CELLS); its matrices go to the tasks, and draws are what is distributed. On a date on
which every unit has a row, ranks only change places in a draw, so its correlations are products of standard scores. On other
dates ranks are taken anew among the pairs that remain.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most dates times units whose matrices are sent to tasks.
CELLS = 1_000_000
#: Draws that are applied at once.
BATCH = 32


def ranks(m: np.ndarray) -> np.ndarray:
    """1-based ranks along rows, equal values sharing the mean of their places; NaN has none."""
    order = np.argsort(m, 1, kind="stable")
    own = np.take_along_axis(m, order, 1)
    new = np.ones(m.shape, bool)
    new[:, 1:] = own[:, 1:] != own[:, :-1]
    end = np.ones(m.shape, bool)
    end[:, :-1] = new[:, 1:]
    place = np.arange(m.shape[1])
    first = np.maximum.accumulate(np.where(new, place, 0), 1)
    last = np.minimum.accumulate(np.where(end, place, m.shape[1])[:, ::-1], 1)[:, ::-1]
    out = np.empty(m.shape)
    np.put_along_axis(out, order, (first + last) / 2 + 1, 1)
    out[np.isnan(m)] = np.nan
    return out


def rounded(rho: np.ndarray) -> np.ndarray:
    """To six places, halves away from zero."""
    return np.sign(rho) * np.floor(np.abs(rho) * 1e6 + 0.5) / 1e6


@dataclass(frozen=True)
class Panel:
    """Matrices of dates by units; NaN where there is no row. groups: the units of each block (all units in one without)."""

    units: list[str]
    groups: list[np.ndarray]
    blocks: bool
    x: np.ndarray
    y: np.ndarray
    controls: tuple[np.ndarray, ...]

    @property
    def least(self) -> int:
        return 5 if self.blocks else 3

    def ranked(self, m: np.ndarray) -> np.ndarray:
        """Ranks in each row; with blocks within each, over their number plus one."""
        if not self.blocks:
            return ranks(m)
        out = np.empty(m.shape)
        for g in self.groups:
            out[:, g] = ranks(m[:, g]) / (1 + (~np.isnan(m[:, g])).sum(1, keepdims=True))
        return out

    def partners(self, draw: int, seed: int) -> np.ndarray:
        """Each unit's partner: the unit in its place when its group is ordered by md5("seed:draw:unit")."""
        out = np.empty(len(self.units), np.int64)
        for g in self.groups:
            key = [(hashlib.md5(f"{seed}:{draw}:{self.units[u]}".encode()).hexdigest(), self.units[u]) for u in g]
            out[g] = g[sorted(range(len(g)), key=key.__getitem__)]
        return out


def laid_out(panel: DataFrame, controls: list[str], block: str | None = None) -> Panel | None:
    """The matrices of a panel (date, unit, x, y, controls); None if they are too large, or a unit has several rows on a
    date or several blocks."""
    size = panel.agg(F.countDistinct("date").alias("d"), F.countDistinct("unit").alias("u")).first()
    if not 0 < size.d * size.u <= CELLS:
        return None
    rows = panel.select("date", F.col("unit").cast("string").alias("unit"), *([block] if block else []), *[F.col(c).cast("double").alias(c) for c in ("x", "y", *controls)]).dropna(subset=["date", "unit"]).toPandas()
    if rows.duplicated(["date", "unit"]).any() or (block and (rows[block].isna().any() or rows.drop_duplicates(["unit", block])["unit"].duplicated().any())):
        return None
    units = sorted(rows["unit"].unique(), key=str.encode)
    place = rows["unit"].map({u: i for i, u in enumerate(units)}).to_numpy()
    dates, found = pd.factorize(rows["date"], sort=True)
    matrix = lambda c: _filled((len(found), len(units)), dates, place, rows[c].to_numpy(float))
    of = rows.drop_duplicates("unit").set_index("unit")[block].reindex(units).to_numpy() if block else np.zeros(len(units))
    groups = [np.flatnonzero(of == b) for b in pd.unique(of)]
    return Panel(units, groups, block is not None, matrix("x"), matrix("y"), tuple(matrix(c) for c in controls))


def _filled(shape: tuple[int, int], i: np.ndarray, j: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.full(shape, np.nan)
    out[i, j] = values
    return out


def _scores(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ranks: deviations from the mean, and their population deviation."""
    apart = r - np.nanmean(r, 1, keepdims=True)
    return apart, np.sqrt(np.nanmean(apart * apart, 1))


def _held_fixed(xy: np.ndarray, xz: np.ndarray, yz: np.ndarray) -> np.ndarray:
    rest = (1 - xz * xz) * (1 - yz * yz)
    return np.where(rest > 1e-12, (xy - xz * yz) / np.sqrt(np.where(rest > 1e-12, rest, 1)), np.nan)


def _pearson(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; a and b lack the same values. NaN below three pairs or where a row is constant."""
    (a, sa), (b, sb) = _scores(a), _scores(b)
    ok = ((~np.isnan(a)).sum(1) >= 3) & (sa * sb > 1e-12)
    return np.where(ok, np.nanmean(a * b, 1) / np.where(ok, sa * sb, 1), np.nan)


def _free(of: np.ndarray, controls: list[np.ndarray]) -> np.ndarray:
    """of less its fit on an intercept and controls; NaN where those are singular."""
    m = np.stack([np.ones(len(of)), *controls], 1)
    scale = np.sqrt(np.maximum((m * m).sum(0), 1e-300))
    if len(of) == 0 or np.linalg.matrix_rank((m / scale).T @ (m / scale), tol=1e-9) < m.shape[1]:
        return np.full(len(of), np.nan)
    q, _ = np.linalg.qr(m)
    return of - q @ (q.T @ of)


def _anew(p: Panel, dates: np.ndarray, partner: np.ndarray) -> np.ndarray:
    """Correlations of one draw on dates, from ranks among the pairs that both have."""
    sides = [p.x[dates], p.y[dates][:, partner], *(c[dates] for c in p.controls)]
    lacks = np.isnan(sides).any(0)
    x, y, *z = (p.ranked(np.where(lacks, np.nan, m)) for m in sides)
    n = (~lacks).sum(1)
    if not z:
        rho = _pearson(x, y)
    elif len(z) == 1:
        rho = _held_fixed(_pearson(x, y), _pearson(x, z[0]), _pearson(y, z[0]))
    else:
        rho = np.full(len(dates), np.nan)
        for i, keep in enumerate(~lacks):
            free = [_free(m[i, keep], [c[i, keep] for c in z]) for m in (x, y)]
            rho[i] = _pearson(free[0][None], free[1][None])[0] if keep.any() and not np.isnan(free).any() else np.nan
    return rounded(np.where(n >= (p.least if z else 3), rho, np.nan))


def null_means(p: Panel, draws: np.ndarray, seed: int) -> np.ndarray:
    """The mean over dates of each draw's correlations; NaN where no date has one."""
    whole = ~np.isnan([p.x, p.y, *p.controls]).any((0, 2))
    fixed, other = np.flatnonzero(whole), np.flatnonzero(~whole)
    if len(p.controls) > 1 or len(p.units) < p.least:
        fixed, other = fixed[:0], np.arange(len(p.x))
    sides = [_scores(p.ranked(m[fixed])) for m in (p.x, p.y, *p.controls)] if len(fixed) else []
    out = np.full(len(draws), np.nan)
    for s in range(0, len(draws), BATCH):
        partner = np.stack([p.partners(int(d), seed) for d in draws[s : s + BATCH]])
        rho = np.full((len(partner), len(p.x)), np.nan)
        if len(fixed):
            (x, sx), (y, sy), *z = sides
            moved = y[:, partner]  # dates, draws, units
            product = lambda a, sa, m=moved, sy=sy: _over(np.einsum("du,dku->kd", a, m) / len(p.units), sa * sy)
            if z:
                xz = _over((x * z[0][0]).mean(1), sx * z[0][1])
                rho[:, fixed] = _held_fixed(product(x, sx), xz[None], product(*z[0]))
            else:
                rho[:, fixed] = product(x, sx)
            rho[:, fixed] = rounded(rho[:, fixed])
        if len(other):
            for k, own in enumerate(partner):
                rho[k, other] = _anew(p, other, own)
        some = ~np.isnan(rho).all(1)
        out[s : s + BATCH][some] = np.nanmean(rho[some], 1)
    return out


def _over(a: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-12, a / np.where(spread > 1e-12, spread, 1), np.nan)


def drawn_means(panel: DataFrame, draws: int, seed: int, controls: list[str], block: str | None = None) -> DataFrame | None:
    """(draw, null_rho) of the draws that have a value; None where the panel can't be laid out."""
    p = laid_out(panel, controls, block)
    if p is None:
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            means = null_means(p, frame["id"].to_numpy(), seed)
            yield pd.DataFrame({"draw": frame["id"], "null_rho": means}).dropna()

    spark = panel.sparkSession
    tasks = max(1, min(draws // BATCH, 4 * spark.sparkContext.defaultParallelism))
    return spark.range(0, draws, 1, tasks).mapInPandas(run, "draw long, null_rho double")
