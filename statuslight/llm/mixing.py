"""Mix documents to target weights with soft membership in domains."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuslight.llm.common import Scratch, id_and_text, utf8

#: labelled documents that the posteriors are fitted on, at most
LABELLED_ROWS = 20_000
#: hashed byte trigrams
BUCKETS = 4096
#: trigrams whose evidence a posterior adds up: the mean over the text times this number
EVIDENCE = 4.0
PENALTY = 1e-3
STEPS = 80
#: change of the domain shares in a step that ends the search
TOLERANCE = 1e-5


def trigram_counts(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8).astype(np.int32)
    if len(b) < 3:
        return np.zeros(BUCKETS, np.int64)
    return np.bincount((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) % BUCKETS, minlength=BUCKETS)


def token_count(text: bytes) -> int:
    """Runs of bytes other than ASCII white space."""
    return len(text.split())


@dataclass
class Domains:
    """Log-likelihoods of trigrams per domain, and the domains' shares of the labelled documents."""

    names: list[str]
    likelihood: np.ndarray
    prior: np.ndarray

    def posterior(self, text: bytes) -> np.ndarray:
        if not self.names:
            return np.zeros(0)
        counts = trigram_counts(text)
        total = counts.sum()
        evidence = self.likelihood @ counts * (min(EVIDENCE, total) / total) if total else 0.0
        margin = self.prior + evidence
        p = np.exp(margin - margin.max())
        return p / p.sum()


def fit_domains(labelled: DataFrame) -> Domains:
    """Count trigrams of all rows of ``labelled`` (text, domain) per domain.

    Each task adds up its own rows, so at most domains x 4,096 counts per task are
    shuffled. Domains are few (a parameter of the mixture). Rows without a domain are
    no training rows; a null text has no trigrams.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, domain in zip(utf8(batch.column("text")), batch.column("domain").to_pylist(), strict=True):
                held = sums.setdefault(domain, np.zeros(BUCKETS + 1, np.int64))
                held[:BUCKETS] += trigram_counts(text)
                held[BUCKETS] += 1
        for domain, held in sums.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([domain] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(held[at])],
                ["domain", "cell", "n"],
            )

    rows = labelled.select(F.coalesce("text", F.lit("")).alias("text"), F.col("domain").cast("string").alias("domain"))
    counted = rows.where(F.col("domain").isNotNull()).mapInArrow(count, "domain string, cell int, n bigint")
    cells = counted.groupBy("domain", "cell").agg(F.sum("n").alias("n")).collect()
    names = sorted({c["domain"] for c in cells})
    sums = np.zeros((len(names), BUCKETS + 1))
    for c in cells:
        sums[names.index(c["domain"]), c["cell"]] = c["n"]
    smooth = sums[:, :BUCKETS] + 0.1
    share = sums[:, BUCKETS] / max(1.0, sums[:, BUCKETS].sum())
    return Domains(names, np.log(smooth / smooth.sum(axis=1, keepdims=True)), np.log(share))


def posteriors(documents: DataFrame, domains: Domains) -> DataFrame:
    """``doc_id, n_tokens, posterior`` of every row with an id, one probability per domain name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([token_count(t) for t in texts], pa.int64()),
                    pa.array([domains.posterior(t) for t in texts], pa.list_(pa.float64())),
                ],
                ["doc_id", "n_tokens", "posterior"],
            )

    return id_and_text(documents).mapInArrow(run, "doc_id bigint, n_tokens bigint, posterior array<double>")


def rates(posterior: np.ndarray, history: np.ndarray, step: float, penalty: float) -> np.ndarray:
    """The rates after the accelerated projected steps that ``history`` (residuals per step) describes."""
    rate = ahead = np.ones(len(posterior))
    weight = 1.0
    for residual in history:
        new = np.maximum(0.0, ahead - step * (posterior @ residual + penalty * (ahead - 1.0)))
        grown = (1 + np.sqrt(1 + 4 * weight * weight)) / 2
        ahead = new + (weight - 1) / grown * (new - rate)
        rate, weight = new, grown
    return np.stack([rate, ahead], axis=1)


def _matrix(batch: pa.RecordBatch, domains: int) -> np.ndarray:
    column = batch.column("posterior")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), domains)


@dataclass
class Mixture:
    """Steps that turn a posterior into a rate, with the domain shares before and after."""

    names: list[str]
    history: np.ndarray
    step: float
    penalty: float
    target: np.ndarray
    reached: np.ndarray


def fit_mixture(
    members: DataFrame, names: list[str], targets: dict[str, float],
    penalty: float = PENALTY, steps: int = STEPS, tolerance: float = TOLERANCE,
) -> Mixture:
    """Nonnegative document rates whose expected token total per domain meets the targets.

    Minimises half the squared gap between the expected domain shares and ``targets``
    (scaled to sum to 1; a domain not named has target 0) plus ``penalty`` / 2 times the
    token-weighted squared distance of the rates from 1, over rates >= 0, by accelerated
    projected gradient. A rate depends on the document's posterior and on the residuals
    of the steps so far, so a step sends one vector of residuals to the tasks, which
    recompute rates and return their sums: no state is kept between steps.
    """
    d = len(names)

    def sums(history: np.ndarray, step: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + 2 * d + d * d)
            for batch in batches:
                p, t = _matrix(batch, d), batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
                both = rates(p, history, step, penalty)
                weighted = p * t[:, None]
                total += np.r_[t.sum(), weighted.T @ both[:, 0], weighted.T @ both[:, 1], (weighted.T @ p).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["k", "v"])

        added = members.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        found = np.zeros(1 + 2 * d + d * d)
        for row in added:
            found[row["k"]] = row["v"]
        return found

    goal = np.array([max(0.0, targets.get(n, 0.0)) for n in names], float)
    goal = goal / goal.sum() if goal.sum() > 0 else goal
    history, step, reached = np.zeros((0, d)), 1.0, goal
    before = np.full(d, np.inf)
    for _ in range(steps + 1):
        found = sums(history, step)
        total = found[0]
        if total == 0:
            break
        reached, ahead = found[1 : 1 + d] / total, found[1 + d : 1 + 2 * d] / total
        if len(history) == 0:
            step = 1.0 / (np.linalg.eigvalsh(found[1 + 2 * d :].reshape(d, d) / total).max() + penalty)
        if max(np.abs(reached - before).max(), np.abs(ahead - reached).max()) < tolerance or len(history) == steps:
            break
        before = reached
        history = np.vstack([history, np.round(ahead - goal, 9)])  # rounded: independent of the order of addition
    return Mixture(names, history, step, penalty, goal, reached)


def mix(
    documents: DataFrame, labelled: DataFrame, targets: dict[str, float], steps: int = STEPS
) -> DataFrame:
    """``doc_id, n_tokens, posterior, rate, copies, shares`` of every row with an id.

    ``labelled`` (text, domain) trains the posteriors, ``targets`` gives the wanted token
    share of each domain. ``copies`` is the rate rounded up or down by a hash of the id,
    so that its expectation is the rate. An empty or null text has no tokens and the
    prior as posterior. Without labelled rows every rate is 1. ``shares`` says, the same
    on every row, what share of the tokens each domain was meant to have and has; a target
    without labelled rows cannot be met and shows there with 0 reached. Repeated rows get equal
    rates, other columns are ignored, an empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    domains = fit_domains(labelled)
    without = sorted(name for name, share in targets.items() if share > 0 and name not in domains.names)
    if not domains.names:
        rows = posteriors(documents, domains).withColumns({"rate": F.lit(1.0), "copies": F.lit(1).cast("bigint")})
        return rows.withColumn("shares", _shares([], [], [], without, targets))
    members = scratch.write(posteriors(documents, domains), "members")
    mixture = fit_mixture(members, domains.names, targets, steps=steps)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate = rates(_matrix(batch, len(mixture.names)), mixture.history, mixture.step, mixture.penalty)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [*batch.schema.names, "rate"])

    found = members.mapInArrow(rated, "doc_id bigint, n_tokens bigint, posterior array<double>, rate double")
    uniform = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    shares = _shares(mixture.names, mixture.target.tolist(), mixture.reached.tolist(), without, targets)
    return found.withColumns({"copies": F.floor(F.col("rate") + uniform).cast("bigint"), "shares": shares})


def _shares(names: list[str], wanted: list[float], reached: list[float], without: list[str], targets: dict[str, float]) -> F.Column:
    """Wanted and reached share of every domain, those that no labelled row knows with none reached."""
    known = zip([*names, *without], [*wanted, *(targets[n] for n in without)], [*reached, *(0.0 for _ in without)], strict=True)
    rows = [F.struct(F.lit(n).alias("domain"), F.lit(float(w)).alias("target"), F.lit(float(r)).alias("reached")) for n, w, r in known]
    return F.array(*rows) if rows else F.array().cast("array<struct<domain:string,target:double,reached:double>>")


def repeated(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``documents`` as often as ``mixed`` says, with all their columns.

    Rows are joined by doc_id; an id that repeats takes its copies once per row.
    """
    copies = mixed.groupBy("doc_id").agg(F.max("copies").alias("copies"))
    held = documents.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = held.join(copies.where(F.col("copies") > 0), "doc_id")
    taken = joined.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return taken.select("row.*")
