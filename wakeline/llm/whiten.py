"""Whitening of vectors along their leading principal components.

The covariance is never formed. A block of directions is multiplied by it in passes over
the rows, each centred before it is multiplied. A Chebyshev polynomial, evaluated by its three-term
recurrence over such passes, damps what lies in the unwanted part of the spectrum; QR makes the
block orthonormal again and a Rayleigh-Ritz step turns it to the eigenvectors, until the residuals
of the wanted ones are at the level of rounding.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.ordered import written

COMPONENTS = 32
#: Directions beyond the wanted ones; the more, the wider the gap the polynomial can use.
GUARD = 16
#: Residuals up to this share of the largest eigenvalue are rounding.
TOLERANCE = 1e-13
#: Largest degree of a polynomial, and how much more it may raise the first direction than the last.
DEGREE, SPREAD = 16, 1e8
#: Filters without success after which the block is doubled.
PATIENCE = 12
LANCZOS = 8
SEED = 20_240_101
#: Partial results that meet in one task or, at the end, in the driver.
FAN_IN = 64

#: Fixed-point entries beyond this are held at it, so that they stay exact.
LARGEST = 1 << 52
NEW = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def fixed_point(vectors: DataFrame, column: str, scale: int, shift: int, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and ``x``: every entry times ``scale``, rounded down, plus ``shift``.

    Rows whose vector is null or holds null or a number that is not finite are left out, and
    so are vectors shorter than the longest one, the missing entries being null.
    """
    entry = F.col(column)
    finite = ~F.exists(entry, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = vectors.filter(entry.isNotNull() & finite)
    least, most = F.lit(float(-LARGEST)), F.lit(float(LARGEST))
    exact = F.transform(entry, lambda e: F.floor(F.greatest(least, F.least(most, e.cast("double") * scale))) + F.lit(shift))
    kept = [c for c in keep if c != "x"]
    made = written(whole.select(*kept, exact.alias("x")), "vectors")
    length = made.agg(F.max(F.size("x"))).first()[0] or 0
    return made.filter((F.size("x") == length) & (F.size("x") > 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("x")
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def total(rows: DataFrame, local: Callable[[Iterator[np.ndarray]], object], add: Callable[[object, object], object]) -> object:
    """One value from all vectors: ``local`` per task, ``add`` in a tree of tasks; always in one order.

    ``local`` gives None where there is nothing to say. No more than ``FAN_IN`` values go to the driver.
    """
    parts = rows.select("x")
    count = parts.rdd.getNumPartitions()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = local(_matrix(b) for b in batches if b.num_rows)
        if value is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "value": [pickle.dumps(value)]})

    def merged(values: pa.Table) -> object:
        whole = None
        for one in values.sort_by("part").column("value").to_pylist():
            whole = pickle.loads(one) if whole is None else add(whole, pickle.loads(one))
        return whole

    def meet(values: pa.Table) -> pa.Table:
        part = values.column("part")[0].as_py() // FAN_IN
        return pa.table({"part": pa.array([part], pa.int64()), "value": pa.array([pickle.dumps(merged(values))], pa.binary())})

    found = parts.mapInArrow(first, "part long, value binary")
    while count > FAN_IN:
        found = found.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(meet, "part long, value binary")
        count = math.ceil(count / FAN_IN)
    return merged(found.toArrow())


@dataclass
class Basis:
    """``n`` vectors with exact ``sums``; ``directions`` (as columns) of variance ``values``, falling,
    of ``spread`` in all. ``wide`` if whole numbers beyond 64 bits come up."""

    n: int
    sums: list[int]
    wide: bool
    directions: np.ndarray
    values: np.ndarray
    spread: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact."""
        kind = object if self.wide else np.int64
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.values))


def _counts(blocks: Iterator[np.ndarray]) -> tuple[int, list[int], int] | None:
    n, sums, most = 0, None, 0
    for x in blocks:
        top = int(np.abs(x).max())
        own = x.astype(object).sum(axis=0) if top * len(x) >= 1 << 62 else x.sum(axis=0)
        sums = [int(s) for s in own] if sums is None else [a + int(b) for a, b in zip(sums, own, strict=True)]
        n, most = n + len(x), max(most, top)
    return None if sums is None else (n, sums, most)


def _filtered(q: np.ndarray, times: Callable[[np.ndarray], np.ndarray], aq: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` that is small on [low, cut], scaled to 1 at ``top``, of the matrix times ``q``."""
    centre, half = (cut + low) / 2, (cut - low) / 2
    first = half / (top - centre)
    scale = first
    before, now = q, (aq - centre * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - before * (scale * following)
        scale = following
    return now


def _degree(low: float, cut: float, last: float, top: float) -> int:
    def growth(value: float) -> float:
        return math.acosh(max(1.0, (2 * value - cut - low) / (cut - low)))

    apart = growth(top) - growth(last)
    return max(2, min(DEGREE, int(math.log(SPREAD) / apart) if apart > 0 else DEGREE))


def _lower_bound(times: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator) -> float:
    """A number that hardly any eigenvalue lies below, from a few Lanczos steps."""
    v = np.linalg.qr(rng.standard_normal((d, 1)))[0]
    basis, a, b, w = v, [], [], None
    for _ in range(min(LANCZOS, d)):
        w = times(v)
        a.append(float(v[:, 0] @ w[:, 0]))
        w = w - basis @ (basis.T @ w)
        w = w - basis @ (basis.T @ w)
        b.append(float(np.linalg.norm(w)))
        if b[-1] <= 1e-12 * max(abs(a[0]), 1e-300):
            break
        v = w / b[-1]
        basis = np.hstack([basis, v])
    values, vectors = np.linalg.eigh(np.diag(a) + np.diag(b[: len(a) - 1], 1) + np.diag(b[: len(a) - 1], -1))
    return max(0.0, float(values[0]) - b[-1] * abs(float(vectors[-1, 0])))


def leading(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, guard: int = GUARD) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their eigenvectors of a symmetric, nonnegative
    d x d matrix that is known only by what it makes of blocks of columns.

    A block that has not met the tolerance after some filters is doubled; one of
    all d directions is exact by its Rayleigh-Ritz step alone.
    """
    rng = np.random.default_rng(SEED)
    width = min(d, k + guard)
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    low = _lower_bound(times, d, rng) if width < d else 0.0
    tried = 0
    while True:
        aq = times(q)
        values, turn = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, aq = q @ turn, aq @ turn
        residual = np.linalg.norm(aq - q * values, axis=0)[:k].max()
        if width == d or residual <= TOLERANCE * values[0]:
            return values[:k], q[:, :k]
        tried += 1
        if tried % PATIENCE == 0:
            width = min(d, 2 * width)
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((d, width - q.shape[1]))]))[0]
            continue
        cut, top = max(float(values[-1]), 1e-12 * float(values[0])), float(values[0])
        floor = min(low, 0.999 * cut)
        q = np.linalg.qr(_filtered(q, times, aq, floor, cut, top, _degree(floor, cut, float(values[k - 1]), top)))[0]


def fit(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Basis | None:
    """The leading components of the vectors ``x`` (whole numbers), or None where there are no rows.

    Directions without variance, up to rounding, are left out, so there are fewer
    components if the vectors lie in a smaller space.
    """
    counted = total(rows, _counts, lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)], max(a[2], b[2])))
    if counted is None:
        return None
    n, sums, most = counted
    d = len(sums)
    basis = Basis(n, sums, 2 * n * most >= 1 << 62, np.zeros((d, 0)), np.zeros(0), 0.0)

    def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a + b

    def passed(make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def local(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
            whole = None
            for x in blocks:
                own = make(basis.centred(x))
                whole = own if whole is None else whole + own
            return whole

        return total(rows, local, plus) / n

    basis.spread = float(passed(lambda c: np.array((c * c).sum())))
    if basis.spread == 0:
        return basis
    values, directions = leading(lambda q: passed(lambda c: c.T @ (c @ q)), d, min(components, d), guard)
    some = values > 1e-12 * values[0]
    basis.directions, basis.values = directions[:, some], values[some]
    return basis


def identity_error(rows: DataFrame, basis: Basis) -> float:
    """Largest entry of the covariance of the whitened vectors minus the identity."""

    def local(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        whole = None
        for x in blocks:
            w = basis.whitened(x)
            w = np.hstack([w, np.ones((len(w), 1))])
            whole = w.T @ w if whole is None else whole + w.T @ w
        return whole

    moments = total(rows, local, lambda a, b: a + b) / basis.n
    mean = moments[:-1, -1]
    return float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max(initial=0.0))


def transform(rows: DataFrame, basis: Basis | None, keep: Sequence[str], error: float) -> DataFrame:
    """Per row and component: the columns ``keep``, ``component`` (from 1), ``n``, ``deviation`` (sum of
    (n*x-S)^2; null beyond 64 bits), ``whitened``, ``explained`` and ``identity_error``.

    Kept columns named as the new ones are left out. Repeated rows stay as many as they are.
    """
    new = T.StructType.fromDDL(NEW)
    kept = [c for c in keep if c not in new.names and c != "x"]
    schema = T.StructType([rows.schema[c] for c in kept] + new.fields)
    if basis is None or not len(basis.values):
        return rows.sparkSession.createDataFrame([], schema)
    k = len(basis.values)
    share = basis.values / basis.spread

    def squares(x: np.ndarray) -> list[int | None]:
        apart = basis.deviations(x)
        if basis.wide or int(np.abs(apart).max()) ** 2 * apart.shape[1] >= 1 << 63:
            apart = apart.astype(object)
        found = (apart * apart).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _matrix(batch), batch.num_rows
            each = pa.array(np.repeat(np.arange(n), k))
            made = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, basis.n, np.int64)),
                pa.array(squares(x), pa.int64()).take(each),
                pa.array(basis.whitened(x).ravel()),
                pa.array(np.tile(share, n)),
                pa.array(np.full(n * k, error)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(each) for c in kept] + made, names=kept + new.names)

    return rows.select(*kept, "x").mapInArrow(run, schema)


def whiten(vectors: DataFrame, column: str, keep: Sequence[str], scale: int = 1, shift: int = 0, components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """Fixed-point vectors of ``column``, whitened; see ``fixed_point``, ``fit`` and ``transform``.

    A table without usable vectors, or of equal ones only, gives no rows.
    """
    rows = fixed_point(vectors, column, scale, shift, keep)
    basis = fit(rows, components, guard)
    error = identity_error(rows, basis) if basis is not None and len(basis.values) else 0.0
    return transform(rows, basis, keep, error)
