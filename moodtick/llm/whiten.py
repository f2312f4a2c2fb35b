"""Whitening of embeddings by the principal components of their covariance.

Vectors become whole numbers (``floor(scale * c)``), so count, sums and products of the
distinct vectors add up exactly, in any order, over any number of tasks. The driver sees
one sum per pair of dimensions; its float32 eigenvectors are corrected by Ogita-Aishima
steps (matrix products only) in extended precision, and clustered eigenvalues by solving
their own small, shifted problem.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import checkpoint, clean_name

SCALE = 256
HIGH = np.longdouble
_MOST = float(2**63 - 1024)  # the largest double below 2^63
_WIDTHS = (np.int16, np.int32, np.int64)
EXACT = 2**53

# ------------------------------------------------------------------ whole numbers


def whole(vectors: pa.ListArray, scale: float = SCALE) -> list[bytes | None]:
    """floor(scale * c) of every entry, little-endian, in the narrowest of three widths that
    holds a vector (its number is the first byte, so equal vectors have equal bytes). Null
    for a vector that is null, empty, or has an entry that is null or not finite. Beyond 64
    bits: the largest long."""
    v = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null -> nan
    ends = np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(v * scale)
        x = np.where(np.isnan(v), 0, np.clip(scaled, -_MOST, _MOST)).astype(np.int64)
    finite, out = np.isfinite(v), []
    for a, z in zip([0, *ends.tolist()], ends.tolist()):
        if a == z or not finite[a:z].all():
            out.append(None)
            continue
        top = max(int(x[a:z].max()), -int(x[a:z].min()) - 1)
        k = 0 if top < 2**15 else 1 if top < 2**31 else 2
        out.append(bytes([k]) + x[a:z].astype(_WIDTHS[k]).tobytes())
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows of int64."""
    out = np.empty((len(column), dim), np.int64)
    for i, b in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(b, _WIDTHS[b[0]], offset=1)
    return out


def dimension(b: bytes) -> int:
    return (len(b) - 1) // np.dtype(_WIDTHS[b[0]]).itemsize


def with_whole(df: DataFrame, vector: str, out: str, scale: float = SCALE) -> DataFrame:
    schema = StructType([*df.schema.fields, StructField(out, BinaryType())])
    at = df.columns.index(vector)

    def run(batches):
        for b in batches:
            coded = pa.array(whole(b.column(at), scale), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, coded], names=[*b.schema.names, out])

    return df.mapInArrow(run, schema)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b of integer matrices, exact: as doubles while no sum can round, else as long
    or Python integers."""
    bound = len(a) * int(max(abs(a.max(initial=0)), abs(a.min(initial=0)), 1)) * int(max(abs(b.max(initial=0)), abs(b.min(initial=0)), 1))
    if bound < EXACT:
        return (a.T.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if bound < 2**63:
        return a.T @ b
    return a.T.astype(object) @ b.astype(object)


_SUMS = "i int, place int, v array<long>"
_BITS = 30


def _limbs(rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows of integers of any size as (row, place, v): the sum of v * 2^(30 place) is the
    row, and 2^32 such v add up within a long."""
    for i, left in enumerate(rows):
        place = 0
        while np.any((left >= 2**_BITS) | (left < -(2**_BITS))):
            yield i, place, (left % 2**_BITS).astype(np.int64)
            left, place = left // 2**_BITS, place + 1
        yield i, place, left.astype(np.int64)


def _total(batches):
    """The sum of the rows of each (i, place)."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for i, place, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            v = v.values.to_numpy(zero_copy_only=False)
            held[i, place] = held[i, place] + v if (i, place) in held else v
    yield _sums([(i, place, v) for (i, place), v in held.items()])


def _sums(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
        names=["i", "place", "v"])


def exact_sums(fit: DataFrame, dim: int, rows: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of a ``rows`` x anything integer matrix: ``of`` gives it for
    the vectors of a batch. Tasks add up their batches, then one task each row of the matrix;
    the driver gets the matrix."""

    def run(batches):
        total = 0
        for b in batches:
            if len(x := _matrix(b.column(0), dim)):
                total = total + of(x).astype(object)
        if not isinstance(total, int):
            yield _sums(_limbs(total))

    parts = fit.mapInArrow(run, _SUMS).repartition("i").mapInArrow(_total, _SUMS)
    out = [0] * rows
    for i, place, v in parts.collect():
        out[i] = out[i] + np.array(v, object) * 2 ** (_BITS * place)
    return np.array(out, object)


# ------------------------------------------------------------------ eigenvectors


def _norm(a: np.ndarray) -> float:
    return float(np.abs(a).sum(axis=1).max(initial=0))  # bounds the spectral norm of a symmetric matrix


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenvectors(a: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, in the
    precision HIGH: a float32 solve, then Ogita-Aishima corrections. Where eigenvalues are
    too close for the correction to tell the vectors apart, the vectors of the cluster are
    turned by the solution of the small matrix left after its mean is taken off."""
    a = np.asarray(a, HIGH)
    d, size = len(a), _norm(a)
    if d < 2 or not size:
        return np.diag(a).copy(), np.eye(d, dtype=HIGH)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    eye, eps, solved = np.eye(d, dtype=HIGH), float(np.finfo(HIGH).eps), 0
    for _ in range(steps):
        r, s = eye - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        gap = 2 * (_norm(off) + _norm(r))
        far = np.abs(values[:, None] - values[None, :]) > gap
        with np.errstate(divide="ignore", invalid="ignore"):
            e = np.where(far, (s + values[None, :] * r) / (values[None, :] - values[:, None]), r / 2)
        x = x + x @ e
        close = _clusters(values, gap)
        if close and _norm(r) < 1e-6:
            for c in close:
                # the cluster's own problem: what its mean hides becomes large
                own = x[:, c]
                small = own.T @ (a @ own - own * values[c].mean())
                small = (small + small.T) / 2
                if len(c) < d or _norm(small) < 0.5:
                    if _norm(small) > 4 * d * eps:
                        x[:, c] = own @ eigenvectors(small)[1]
            solved += 1
        if _norm(e) <= 8 * d * eps or (solved > 2 and _norm(r) <= 8 * d * eps):
            break
    for _ in range(2):
        x = x + x @ ((eye - x.T @ x) / 2)
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt(np.einsum("ij,ij->j", x, x))[order]
    turn = np.sign(x[np.abs(x).argmax(axis=0), np.arange(d)])
    return values[order] * size, x * turn


# ------------------------------------------------------------------ the model


class Whitening:
    """What ``fit`` learned: ``n`` distinct vectors, their ``sums`` (exact), ``components``
    (rows), their eigenvalues ``values``, the ``trace``, and ``identity_error`` over the fit list."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace
        self.identity_error: float | None = None

    @property
    def used(self) -> np.ndarray:
        """Components that vary at all; the others cannot be scaled to one."""
        return self.values > self.trace * len(self.sums) * 1e-15

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off exactly, then its fraction."""
        floor = [s // self.n for s in self.sums]
        rest = np.array([(s - f * self.n) / self.n for s, f in zip(self.sums, floor)])
        if max(map(abs, floor), default=0) < 2**62 and (not x.size or max(int(x.max()), -int(x.min())) < 2**62):
            return (x - np.array(floor, np.int64)) - rest
        return (x.astype(object) - np.array(floor, object)).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return self.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """sum over dimensions of (n x - S)^2, exact; null where a long cannot hold it."""
        top = (self.n * max(int(abs(x.max(initial=0))), int(abs(x.min(initial=0)))) + max(map(abs, self.sums))) ** 2 * len(self.sums)
        if top < 2**63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        found = ((x.astype(object) * self.n - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [v if v < 2**63 else None for v in found]


def fit(vectors: DataFrame, components: int = 4) -> Whitening | None:
    """Learn from a column ``x`` of coded vectors (see ``whole``), each distinct one once.
    None without any. Copies of a vector, however many, are one row per task before they meet."""
    distinct = checkpoint(vectors.select("x").distinct())
    first = distinct.first()
    if first is None:
        return None
    dim = dimension(first["x"])

    def count_and_sums(x):
        small = len(x) * max(int(abs(x.max())), int(abs(x.min()))) < 2**62
        return np.concatenate([[len(x)], x.sum(axis=0) if small else x.astype(object).sum(axis=0)])[None, :]

    n, *sums = (int(v) for v in exact_sums(distinct, dim, 1, count_and_sums)[0])
    mean = [(2 * s + n) // (2 * n) for s in sums]  # S/n to the next whole number

    def moments(x):
        top = max(int(abs(x.max())), int(abs(x.min())), *map(abs, mean))
        y = x - np.array(mean, np.int64) if top < 2**62 else x.astype(object) - np.array(mean, object)
        return products(y, y)

    # centred on whole numbers; the fraction left of the mean comes off exactly: n sum(yy') - sum(y)sum(y)'
    about = exact_sums(distinct, dim, dim, moments)
    rest = np.array([s - m * n for s, m in zip(sums, mean)], object)
    scaled = n * about - rest[:, None] * rest[None, :]
    cov = _divided(scaled, n * n)
    values, vectors_ = eigenvectors(cov)
    k = min(components, dim)
    model = Whitening(n, sums, vectors_[:, :k].T.astype(np.float64), np.maximum(values[:k], 0).astype(np.float64), float(np.trace(cov)))
    model.identity_error = _identity_error(distinct, dim, model)
    return model


def _divided(a: np.ndarray, by: int) -> np.ndarray:
    """Whole numbers over one whole number, to 64 bits."""

    def one(v):
        q = (abs(int(v)) << 160) // by
        cut = max(0, q.bit_length() - 64)
        return np.ldexp(HIGH(q >> cut >> 32) * HIGH(2**32) + HIGH((q >> cut) & (2**32 - 1)), cut - 160) * (1 if v >= 0 else -1)

    return np.array([[one(v) for v in row] for row in a], HIGH)


def _identity_error(distinct: DataFrame, dim: int, model: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    use = model.used
    if not use.any():
        return None
    k = int(use.sum())

    def run(batches):
        total, rows = np.zeros((k + 1, k)), 0
        for b in batches:
            w = model.whitened(_matrix(b.column(0), dim))[:, use]
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
            rows += len(w)
        if rows:
            at = range(k + 1)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    parts = distinct.mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    total = np.zeros((k + 1, k))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        total[i, j] = v
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - mean[:, None] * mean[None, :] - np.eye(k)).max())


def whitened(df: DataFrame, vector: str = "embedding", components: int = 4, scale: float = SCALE) -> tuple[DataFrame, Whitening | None]:
    """All rows of ``df`` with a vector to whiten, and the model.

    Added are ``whitened`` (array<double>, one entry per component; null where the
    component does not vary) and ``deviation`` (long, null where it does not fit); their
    names get an underscore in front where ``df`` has such a column. Rows whose vector is
    null, empty, or holds a null, infinite or NaN entry are left out, as are vectors of
    another length than the commonest (the longest of equally common ones), which have no
    place in the same covariance. Repeated rows and ties stay. Fewer dimensions than
    ``components``: as many entries as dimensions. An empty table gives no rows."""
    x = clean_name(df, "x")
    coded = with_whole(df, vector, x, scale).where(F.col(x).isNotNull())
    coded = checkpoint(coded.withColumn(clean_name(df, "dim"), F.size(vector)))
    dim = clean_name(df, "dim")
    common = coded.groupBy(dim).count().orderBy(F.desc("count"), F.desc(dim)).first()
    if common is not None:
        coded = coded.where(F.col(dim) == common[0])
    model = fit(coded.select(F.col(x).alias("x")), components)
    names = [clean_name(df, "whitened"), clean_name(df, "deviation")]
    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{names[0]}` array<double>, `{names[1]}` long").fields])
    rows, width, length = coded.select(*df.columns, x), len(df.columns), common[0] if common else 0
    names = [*df.columns, *names]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column(width), length)
            scaled = np.where(model.used, model.whitened(v), np.nan)
            own = pa.array([[None if np.isnan(y) else y for y in r] for r in scaled.tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:width], own, pa.array(model.deviation(v), pa.int64())], names=names)

    return rows.mapInArrow(run, schema), model
