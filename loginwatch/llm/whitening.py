"""Whitening of embeddings: single-precision eigenvectors of the exact covariance, refined."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loginwatch.llm.common import stored

COMPONENTS = 16
#: Entries are scaled and floored to integers, then shifted.
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this are held at it, so that no integer overflows.
LIMIT = 1 << 60
#: Bytes of an integer sum: squares of 2^61, over 2^64 rows.
WIDTH = 24
#: Whole numbers up to this are exact as doubles.
EXACT = 1 << 53
#: Most rounds of refinement; a few suffice.
ROUNDS = 60
#: Eigenvalues below the largest one, times the dimension, times this are no variance.
NOISE = 2.0**-50

HIGH = np.longdouble


# ---------------------------------------------------------------- integers and their sums

def _kept(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` (array of longs) of the rows whose vector is whole."""
    whole = "embedding IS NOT NULL AND forall(embedding, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))"
    scaled = f"greatest(least({SCALE} * double(c), double({LIMIT})), double(-{LIMIT}))"
    return embeddings.where(whole).selectExpr(
        "vec_id", f"transform(embedding, c -> floor({scaled}) + {SHIFT}) AS x"
    )


def _rows(batch: pa.RecordBatch, d: int) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _pack(values: np.ndarray) -> bytes:
    return b"".join(int(v).to_bytes(WIDTH, "little", signed=True) for v in values.ravel())


def _unpack(data: bytes, *shape: int) -> np.ndarray:
    whole = [int.from_bytes(data[i: i + WIDTH], "little", signed=True) for i in range(0, len(data), WIDTH)]
    return np.array(whole, object).reshape(shape)


def _products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` as whole numbers: exact in doubles while sums stay below ``EXACT``."""
    top = int(np.abs(y).max(initial=0))
    step = EXACT // max(1, top * top)
    if not step:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), step):
        part = y[at: at + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


class Partial(NamedTuple):
    """How one partition sums up, how two sums merge, how a sum is written and read."""
    start: Callable
    add: Callable
    merge: Callable
    dump: Callable
    load: Callable


def _summed(frame: DataFrame, d: int, how: Partial):
    """One sum over all rows of ``x``: partitions first, then in two rounds of merging.

    Every partition gives one row of a size that depends on the dimension alone; a task
    merges such rows as it reads them.
    """
    def over_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = how.start(d)
        for batch in batches:
            if batch.num_rows:
                total = how.add(total, _rows(batch, d))
        yield pa.RecordBatch.from_arrays([pa.array([how.dump(total)], pa.binary())], ["total"])

    def over_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = how.start(d)
        for batch in batches:
            for data in batch.column(0):
                total = how.merge(total, how.load(data.as_py(), d))
        yield pa.RecordBatch.from_arrays([pa.array([how.dump(total)], pa.binary())], ["total"])

    first = frame.select("x").mapInArrow(over_rows, "total binary")
    some = first.repartition(16).mapInArrow(over_sums, "total binary")
    return how.load(some.repartition(1).mapInArrow(over_sums, "total binary").first()["total"], d)


def _sums() -> Partial:
    """Count and sums per dimension."""
    return Partial(
        lambda d: np.zeros(d + 1, object),
        lambda total, x: total + np.array([len(x), *(int(v) for v in _column_sums(x))], object),
        lambda a, b: a + b, _pack, lambda data, d: _unpack(data, d + 1),
    )


def _column_sums(x: np.ndarray) -> np.ndarray:
    top = int(np.abs(x).max(initial=0))
    return x.sum(axis=0) if top * len(x) < 1 << 62 else x.astype(object).sum(axis=0)


def _moments(centre: np.ndarray) -> Partial:
    """Products of the entries, taken from whole-numbered ``centre``, summed up exactly."""
    return Partial(
        lambda d: np.zeros((d, d), object),
        lambda total, x: total + _products(x - centre),
        lambda a, b: a + b, _pack, lambda data, d: _unpack(data, d, d),
    )


# -------------------------------------------------------------------------- eigenvectors

def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more neighbours (values fall) that are no more than ``gap`` apart."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > gap) + 1
    return [run for run in np.split(np.arange(len(values)), cuts) if len(run) > 1]


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better eigenvectors of ``a``, the eigenvalues that ``x``
    gives, the gap below which two of them cannot be told apart, and the correction's size.

    With R = I - X'X and S = X'AX, the correction E has (S + l_j R) / (l_j - l_i) at i, j;
    where the gap is too small for that, only the lengths and angles are mended, by R / 2.
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    gap = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    between = values[None, :] - values[:, None]
    near = np.abs(between) <= gap
    e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, between))
    return x + x @ e, values, float(gap), float(np.abs(e).max())


def _turned(a: np.ndarray, x: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned to the eigenvectors of ``a`` within their span.

    The matrix is shifted by the middle of the cluster, so that what is solved is as large
    as the differences inside it, however small these are beside the eigenvalues.
    """
    part = x[:, run]
    part = part + part @ (np.eye(len(run), dtype=a.dtype) - part.T @ part) / 2
    inner = part.T @ (a @ part)
    inner = (inner + inner.T) / 2
    inner -= np.eye(len(run), dtype=a.dtype) * (np.trace(inner) / len(run))
    size = np.abs(inner).max()
    if not size:
        return part
    _, turn = np.linalg.eigh((inner / size).astype(np.float64))
    return part @ turn[:, ::-1].astype(a.dtype)


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Starts from the eigenvectors in single precision; each round multiplies matrices in
    extended precision, which squares the error, and solves clusters of eigenvalues that
    cannot be told apart yet in the space they span. Stops when corrections are below the
    unit of the last place, or no longer fall. A zero matrix gives unit vectors.
    """
    a = matrix.astype(HIGH)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(HIGH)
    last = np.inf
    for done in range(ROUNDS):
        x, values, gap, change = _refined(a, x)
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        # A fresh look at the gap: the step has made it smaller.
        for run in _clusters(values, gap):
            x[:, run] = _turned(a, x, run)
        if change < 2.0**-58 or (done > 5 and change >= last):
            break
        last = change
    x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return (values[order] * size).astype(np.float64), x.astype(np.float64)


# ----------------------------------------------------------------------------- whitening

class Fit(NamedTuple):
    """What the rows need: its size depends on the dimension alone."""
    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    project: np.ndarray
    explained: np.ndarray
    error: float


def _whitened(fit: Fit, x: np.ndarray) -> np.ndarray:
    """Rows less their mean, in whole numbers as far as these go, on the components."""
    return ((x - fit.centre).astype(np.float64) - fit.rest) @ fit.project


def _spread(fit: Fit) -> Partial:
    """Count, mean and centred products of the whitened rows."""
    k = fit.project.shape[1]

    def of(rows: np.ndarray) -> tuple:
        mean = rows.mean(axis=0)
        return len(rows), mean, (rows - mean).T @ (rows - mean)

    def merge(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        if not n:
            return a
        apart = b[1] - a[1]
        return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)

    def load(data: bytes, d: int) -> tuple:
        flat = np.frombuffer(data, "<f8")
        return int(flat[0]), flat[1: k + 1], flat[k + 1:].reshape(k, k)

    return Partial(
        lambda d: (0, np.zeros(k), np.zeros((k, k))),
        lambda total, x: merge(total, of(_whitened(fit, x))),
        merge, lambda t: np.concatenate([[t[0]], t[1], t[2].ravel()]).astype("<f8").tobytes(), load,
    )


def fitted(kept: DataFrame, d: int, components: int = COMPONENTS) -> Fit | None:
    """The whitening of the distinct integer vectors of dimension ``d``; None without rows.

    Distinct rows are found by a hash aggregate that combines before the shuffle, so a
    vector that a third of all rows repeat is sent once per task. Sums are whole numbers
    of any size, taken from the whole number nearest to the mean: the covariance is exact
    and does not depend on the order of rows. The driver sees one matrix of the dimension.
    """
    fit_list = stored(kept.select("x").distinct(), "whitening_fit")
    n, *sums = _summed(fit_list, d, _sums())
    if not n or not d:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    products = _summed(fit_list, d, _moments(centre))
    exact = n * products - np.outer(np.array(rest, object), np.array(rest, object))
    # The quotient of whole numbers in two parts, so that extended precision is filled.
    high = np.array([[v / (n * n) for v in row] for row in exact], np.float64)
    low = np.array([[_left(v, n * n, h) for v, h in zip(row, line)] for row, line in zip(exact, high)])
    values, vectors = eigenpairs(high.astype(HIGH) + low)
    trace = float(sum(int(exact[i, i]) for i in range(d)) / (n * n))
    told = int((values[:components] > max(values[0], 0) * d * NOISE).sum())
    fit = Fit(
        int(n), [int(s) for s in sums], centre, np.array([r / n for r in rest]),
        vectors[:, :told] / np.sqrt(values[:told]), values[:told] / trace if told else values[:0], 0.0,
    )
    if not told:
        return fit
    count, _, products = _summed(fit_list, d, _spread(fit))
    return fit._replace(error=float(np.abs(products / count - np.eye(told)).max()))


def _left(value: int, by: int, quotient: float) -> float:
    """What ``quotient`` leaves of ``value / by``."""
    up, down = quotient.as_integer_ratio()
    return (value * down - up * by) / (by * down)


def _deviation(fit: Fit, x: np.ndarray) -> list[int | None]:
    """Squares of ``n * x - sums``, summed up per row; null where a long cannot hold it."""
    reach = float(np.abs(x).max(initial=0)) * fit.n + max(map(abs, fit.sums), default=0)
    apart = np.abs((x - fit.centre).astype(np.float64) - fit.rest).max(initial=0) * fit.n
    if reach < 2.0**62 and apart * apart * x.shape[1] < 2.0**62:
        y = x * fit.n - np.array(fit.sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    wide = x.astype(object) * fit.n - np.array(fit.sums, object)
    return [v if v < 1 << 63 else None for v in map(int, (wide * wide).sum(axis=1))]


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """The result of the query: a row for each remaining vector and component.

    ``embeddings`` has ``vec_id`` and ``embedding`` (array of floats or doubles); other
    columns are not looked at. Null vectors and those with null or non-finite entries are
    left out, and so are those whose length is not the most frequent one (of equally
    frequent ones, the longest). Repeated rows and null ids are kept. Components without
    variance are left out: vectors that are all alike, and an empty table, give no rows.
    A deviation beyond a long is null. Neither rows nor ids are shuffled.
    """
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = _kept(embeddings)
    size = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return embeddings.sparkSession.createDataFrame([], out)
    d = size["d"]
    kept = kept.where(F.size("x") == d)
    fit = fitted(kept, d, components)
    if fit is None or not len(fit.explained):
        return embeddings.sparkSession.createDataFrame([], out)
    shared = embeddings.sparkSession.sparkContext.broadcast(fit)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        k = len(fit.explained)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = _rows(batch, d)
            each = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, fit.n, np.int64)),
                pa.array(_deviation(fit, x), pa.int64()).take(each),
                pa.array(_whitened(fit, x).ravel()), pa.array(np.tile(fit.explained, rows)),
                pa.array(np.full(rows * k, fit.error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.selectExpr("bigint(vec_id) AS vec_id", "x").mapInArrow(over, out)
