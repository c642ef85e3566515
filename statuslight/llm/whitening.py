"""Whitened embeddings from an eigendecomposition that is updated row by row and refined once."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: rows that are reduced to one orthogonal-triangular factor before they update the spectrum
BLOCK_ROWS = 1_024
#: spectra that one task combines
FAN_IN = 16
#: largest magnitude of a scaled component: beyond it doubles do not hold every integer
LARGEST = 1 << 53
EPS = float(np.finfo(float).eps)


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of ``basis diag(values) basis' + vector vector'``.

    Deflation: where eigenvalues are equal, a reflection turns their eigenvectors so that
    the vector meets only the last of them; eigenpairs that the vector does not meet stay
    as they are. The others are the roots of the secular equation.
    """
    z = basis.T @ vector
    norm = math.sqrt(float(z @ z))
    scale = max(abs(values[0]), abs(values[-1]), norm * norm)
    if norm == 0.0:
        return values, basis
    near = 8 * EPS * scale
    basis = basis.copy()
    first = 0
    for end in [*(np.flatnonzero(np.diff(values) > near) + 1).tolist(), len(values)]:
        if end - first > 1:
            part = z[first:end]
            size = math.sqrt(float(part @ part))
            if size > 0:
                size = math.copysign(size, part[-1])
                mirror = part.copy()
                mirror[-1] += size
                mirror /= math.sqrt(float(mirror @ mirror))
                block = basis[:, first:end]
                basis[:, first:end] = block - 2 * np.outer(block @ mirror, mirror)
                z[first:end] = 0.0
                z[end - 1] = -size
        first = end
    met = np.flatnonzero(np.abs(z) * norm > near)
    if not len(met):
        return values, basis
    roots, mixed = _secular(values[met], z[met])
    out, columns = values.copy(), basis
    out[met], columns[:, met] = roots, basis[:, met] @ mixed
    order = np.argsort(out, kind="stable")
    return out[order], columns[:, order]


def _secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum z_i^2 / (d_i - t) = 0`` and the eigenvectors of ``diag(d) + z z'``; d ascending, z without zeros.

    Root k lies between d_k and d_k+1 (the last one below d_m + |z|^2) and is kept as its
    distance from the nearer pole, so that differences to poles lose no digits. Each step
    replaces the poles on either side of a root by one that has the same value and slope,
    and solves the quadratic equation that remains; steps that leave the bracket halve it.
    """
    m, weight = len(d), z * z
    upper = np.append(d[1:], d[-1] + weight.sum())
    width = upper - d
    middle = 1 + (weight[:, None] / ((d[:, None] - d[None, :]) - width[None, :] / 2)).sum(axis=0)
    from_left = middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, upper)
    gaps = d[:, None] - origin[None, :]
    low = np.where(from_left, 0.0, -width / 2)
    high = np.where(from_left, np.where(middle >= 0, width / 2, width), 0.0)
    low[-1] = 0.0 if middle[-1] >= 0 else width[-1] / 2
    t = (low + high) / 2
    left = np.arange(m)[:, None] <= np.arange(m)[None, :]
    near_left, near_right = gaps.diagonal(), np.append(gaps.diagonal(-1), 0.0)
    last = np.arange(m) == m - 1
    for _ in range(60):
        far = gaps - t[None, :]
        far[far == 0] = EPS * EPS
        term = weight[:, None] / far
        slope = term / far
        psi, phi = np.where(left, term, 0).sum(axis=0), np.where(left, 0, term).sum(axis=0)
        psi_slope, phi_slope = np.where(left, slope, 0).sum(axis=0), np.where(left, 0, slope).sum(axis=0)
        value = 1 + psi + phi
        low, high = np.where(value < 0, t, low), np.where(value > 0, t, high)
        done = np.abs(value) <= 4 * m * EPS * (1 + np.abs(psi) + np.abs(phi))
        if done.all():
            break
        a, b = near_left - t, near_right - t  # distances to the poles beside the root
        big_s, big_r = psi_slope * a * a, phi_slope * b * b
        constant = 1 + (psi - psi_slope * a) + (phi - phi_slope * b)
        # constant + big_s / (a - h) + big_r / (b - h) = 0 for the step h
        quad = np.where(last, 0.0, constant)
        line = np.where(last, -constant, -(constant * (a + b) + big_s + big_r))
        free = np.where(last, constant * a + big_s, constant * a * b + big_s * b + big_r * a)
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(line * line - 4 * quad * free, 0.0))
            q = -0.5 * (line + np.copysign(root, line))
            h1, h2 = q / quad, free / q
            inside1 = (t + h1 > low) & (t + h1 < high)
            inside2 = (t + h2 > low) & (t + h2 < high)
            step = np.where(inside2, t + h2, np.where(inside1, t + h1, (low + high) / 2))
        new = np.where(done, t, step)
        if (new == t).all():
            break
        t = new
    far = gaps - t[None, :]  # d_i - root_j, negative up to the diagonal
    far[far == 0] = -EPS * EPS
    # weights for which the computed roots are exact: products over interlacing pairs
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    exact = np.sqrt(np.maximum(-np.prod(far / np.where(np.eye(m, dtype=bool), 1.0, -apart), axis=1), 0.0))
    vectors = np.copysign(exact, z)[:, None] / far
    return origin + t, vectors / np.sqrt((vectors * vectors).sum(axis=0))


@dataclass
class Spectrum:
    """Number, mean, and eigenpairs of the scatter matrix of some rows."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, d: int) -> Spectrum:
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def take(self, vector: np.ndarray) -> None:
        self.values, self.basis = rank_one(self.values, self.basis, vector)
        self.values = np.maximum(self.values, 0.0)

    def shift(self, n: int, mean: np.ndarray) -> None:
        """Count ``n`` more rows with another mean: the distance of the means is one more update."""
        whole, gap = self.n + n, mean - self.mean
        if self.n and n:
            self.take(math.sqrt(self.n * n / whole) * gap)
        self.mean = self.mean + gap * (n / whole) if whole else self.mean
        self.n = whole

    def add(self, rows: np.ndarray) -> None:
        """Update by rows centred at their own mean.

        More rows than dimensions are first turned by an orthogonal matrix into as many
        rows as there are dimensions, which have the same scatter.
        """
        if not len(rows):
            return
        mean = rows.mean(axis=0)
        centred = rows - mean
        for vector in np.linalg.qr(centred, mode="r") if len(rows) > rows.shape[1] else centred:
            self.take(vector)
        self.shift(len(rows), mean)

    def merge(self, other: Spectrum) -> None:
        """Update by each eigenpair of another spectrum, then by the distance of the means."""
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.take(math.sqrt(value) * vector)
        self.shift(other.n, other.mean)

    def dump(self) -> bytes:
        return struct.pack("<qi", self.n, len(self.mean)) + np.concatenate([self.mean, self.values, self.basis.ravel()]).astype("<f8").tobytes()

    @classmethod
    def load(cls, payload: bytes) -> Spectrum:
        n, d = struct.unpack_from("<qi", payload)
        whole = np.frombuffer(payload, "<f8", offset=12)
        return cls(n, whole[:d].copy(), whole[d : 2 * d].copy(), whole[2 * d :].reshape(d, d).copy())


def shifted(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the floors of ``scale`` times the components plus ``shift``, little-endian 64-bit integers in one value.

    Null vectors, vectors with null or non-finite components and empty ones are left out,
    as are vectors of another length than most (of equally frequent lengths the longer
    counts). A component beyond ``LARGEST`` after scaling raises an error.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(F.col("v").isNotNull() & fine & (F.size("v") > 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.floor(scale * batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d))
            if np.abs(found).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            x = [row.tobytes() for row in found.astype("<i8") + shift]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(x, pa.binary())], ["vec_id", "x"])

    return rows.where(F.size("v") == d).mapInArrow(pack, "vec_id bigint, x binary")


def _unpacked(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i8").reshape(batch.num_rows, -1)


def incremental_spectrum(rows: DataFrame, scratch: Scratch) -> Spectrum | None:
    """The spectrum of all rows: one per task, then ``FAN_IN`` at a time combined until one is left.

    A spectrum has (dimensions + 2) x dimensions numbers; the driver gets the last one.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = _unpacked(batch.slice(at, BLOCK_ROWS)).astype(float)
                found = found or Spectrum.empty(x.shape[1])
                found.add(x)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([found.dump()], pa.binary())], ["node", "spectrum"]
            )

    def combine(key, table):
        order = np.argsort(table.column("node").to_numpy(), kind="stable").tolist()
        payloads = table.column("spectrum").to_pylist()
        found = Spectrum.load(payloads[order[0]])
        for k in order[1:]:
            found.merge(Spectrum.load(payloads[k]))
        return pa.table({"node": pa.array([key[0].as_py()], pa.int64()), "spectrum": pa.array([found.dump()], pa.binary())})

    nodes = scratch.write(rows.mapInArrow(own, "node bigint, spectrum binary"), "spectra")
    highest = nodes.agg(F.max("node")).first()[0]
    if highest is None:
        return None
    while highest:
        up = F.floor(F.col("node") / FAN_IN).alias("up")
        nodes = nodes.groupBy(up).applyInArrow(combine, "node bigint, spectrum binary")
        highest //= FAN_IN
    return Spectrum.load(nodes.first()["spectrum"])


def _totals(rows: DataFrame, cells: int, of) -> np.ndarray:
    """``cells`` numbers that ``of`` gives for each batch of integer rows, added over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                total += of(_unpacked(batch.slice(at, BLOCK_ROWS)))
        yield pa.RecordBatch.from_arrays([pa.array(range(cells), pa.int32()), pa.array(total)], ["k", "v"])

    found = np.zeros(cells)
    for r in rows.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        found[r["k"]] = r["v"]
    return found


@dataclass
class Whitening:
    """Count, exact sums, eigenvalues (falling) and eigenvectors (columns) of the covariance, its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows minus the mean, the whole part of which is taken off as an integer."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole) - np.array([(s % self.n) / self.n for s in self.sums])

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return (self.centred(x) @ self.basis[:, :components]) / np.sqrt(self.values[:components])


def _exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension; a task adds up its rows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _unpacked(batch)
                # halves of 32 bits, so that no sum of a task leaves 64 bits
                part = np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                n, total = n + len(x), part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["k", "v"])

    added = rows.mapInArrow(run, "k int, v bigint").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r["k"]: int(r["v"]) for r in added.collect()}
    n, d = found.pop(-1, 0), len(found) // 2
    return n, [(found[j] << 32) + found[d + j] for j in range(d)]


def fit(rows: DataFrame, scratch: Scratch) -> Whitening | None:
    """Eigenpairs of the covariance of all rows.

    The incremental spectrum gives the basis; a pass over all rows projects them on it and
    adds up the products, centred at the exact mean; the eigenvectors of that small matrix
    turn the basis into the final one (Rayleigh-Ritz), in double precision.
    """
    spectrum = incremental_spectrum(rows, scratch)
    if spectrum is None:
        return None
    n, sums = _exact_sums(rows)
    d = len(sums)
    basis, _ = np.linalg.qr(spectrum.basis[:, ::-1])
    found = Whitening(n, sums, np.ones(d), basis, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = found.centred(x) @ basis
        return (y.T @ y).ravel()

    ritz = _totals(rows, d * d, products).reshape(d, d) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(np.trace(ritz))
    # directions without variance cannot be whitened
    values = np.where(values > max(trace, 0.0) * d * EPS * 8, values, 0.0)
    return Whitening(n, sums, values, basis @ turn, trace)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error`` of every remaining row.

    ``whitened`` and ``explained`` are arrays over the components, by falling eigenvalue;
    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions as decimal(38,0).
    ``identity_error`` is measured on the whitened rows in one more pass. A component
    without variance (fewer rows than dimensions, equal rows) has null in ``whitened``,
    0 in ``explained`` and takes no part in ``identity_error``; if there is none with
    variance, the error is 0. See ``shifted`` for what is left out. Repeated rows and null
    ids are rows like others, other columns are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    schema = "vec_id bigint, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    rows = scratch.write(shifted(vectors, scale, shift, id_col, vector_col), "rows")
    model = fit(rows, scratch)
    if model is None:
        return spark.createDataFrame([], schema)
    k = min(components, len(model.values))
    used = int((model.values[:k] > 0).sum())

    def products(x: np.ndarray) -> np.ndarray:
        w = model.whitened(x, used)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    error = 0.0
    if used:
        total = _totals(rows, used + used * used, products) / model.n
        covariance = total[used:].reshape(used, used) - np.outer(total[:used], total[:used])
        error = float(np.abs(covariance - np.eye(used)).max())
    explained = (model.values[:k] / model.trace if model.trace > 0 else np.zeros(k)).tolist()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = _unpacked(part)
                w = model.whitened(x, used)
                padded = [row + [None] * (k - used) for row in w.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(_deviations(x, model.n, sums), pa.string()), pa.array(padded, pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "whitened"],
                )

    found = rows.mapInArrow(finish, "vec_id bigint, deviation string, whitened array<double>")
    return found.select(
        "vec_id", F.lit(model.n).cast("bigint").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened",
        F.lit(explained).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"),
    )


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[str]:
    """The exact deviations as decimal texts: in 64 bits where they surely fit, in Python's integers otherwise."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n for s in sums], np.int64)
    near = x - whole  # n x - S = n (x - whole) - rest
    most = (int(np.abs(near).max(initial=0)) + 1) * n
    if most * most * len(sums) < 1 << 62:
        gap = n * near - rest
        return list(map(str, np.einsum("ij,ij->i", gap, gap).tolist()))
    return [str(sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True))) for row in near.tolist()]


def per_component(found: DataFrame) -> DataFrame:
    """A row per vector and component (from 1); ``deviation`` as a long, null where it does not fit into one."""
    both = F.arrays_zip("whitened", "explained")
    rows = found.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode(both).alias("at", "c"), "identity_error")
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
