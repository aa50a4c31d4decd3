"""Stochastic gradient descent for L1 logistic regression, over shards that are fixed by a hash.

Rows are dealt to shards by a hash of their id, about ``SHARD_ROWS`` each, and every
shard is packed once, in hash order, into one row of a written table.  An epoch is one
pass without a shuffle: each shard runs through its rows from the current weights, and
the results are averaged by rows.  Shards and their order follow from ids alone, so the
result does not depend on how the input is partitioned.

The penalty is the cumulative one: each weight knows how much penalty it should have
had so far and how much it has had, and is cut by the difference, but never through
zero.  So weights of features that do not help are exactly zero, as in a full solver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scalar import hash_order, quoted
from riskloom.operators.joint import sigmoid, summed
from riskloom.operators.sampling import with_class_weight
from riskloom.operators.transforms import fit_scaler, scale_expr
from riskloom.sources.scratch import materialise, small_table

SHARD_ROWS = 20_000
MINI_BATCH = 16
SIDE_BY_SIDE = 32  # shards a task runs at once


def packed_shards(df: DataFrame, features: Sequence[str], target: str, ident: str, seed: int = 42) -> tuple[DataFrame, int]:
    """A written table with one row per shard (shard, rows: doubles of weight, label and scaled features), and the number of rows.

    NULL counts as 0; rows are weighted so that both classes weigh the same.
    """
    filled = df.select(
        hash_order(quoted(ident), seed).alias("place"),
        quoted(ident).cast("string").alias("tie"),
        F.coalesce(quoted(target).cast("double"), F.lit(0.0)).alias("label"),
        *[F.coalesce(quoted(f).cast("double"), F.lit(0.0)).alias(f"x{k}") for k, f in enumerate(features)],
    )
    filled = materialise(filled, "sgd-input")
    names = [f"x{k}" for k in range(len(features))]
    params = fit_scaler(filled, names)
    n = filled.count()
    shards = max(1, -(-n // SHARD_ROWS))
    rows = with_class_weight(filled, "label").select(
        F.pmod("place", F.lit(shards)).alias("shard"), "place", "tie",
        F.array(F.col("weight").cast("double"), "label", *[scale_expr(c, params[c]) for c in names]).alias("cells"),
    )

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("tie", "ascending")])
        cells = group["cells"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({"shard": group["shard"][:1], "rows": pa.array([cells.astype(float).tobytes()], pa.binary())})

    return materialise(rows.groupBy("shard").applyInArrow(pack, "shard bigint, rows binary"), "shards"), n


def run_epochs(shards: Sequence[np.ndarray], beta: np.ndarray, rate: float, lam: float) -> np.ndarray:
    """One pass over the rows (weight, label, features) of each shard from ``beta`` (intercept first): a row of weights per shard.

    Shards know nothing of each other; step t takes the t-th mini-batch of every shard
    that still has one, so a step is a few array operations for all of them.
    """
    order = sorted(range(len(shards)), key=lambda s: -len(shards[s]))
    sizes = np.array([len(shards[s]) for s in order])
    steps = -(-int(sizes[0]) // MINI_BATCH)
    # (step, row, cell, shard), so that neighbours in memory are different shards; missing rows weigh 0
    cells = np.zeros((steps * MINI_BATCH, shards[0].shape[1], len(shards)))
    for k, s in enumerate(order):
        cells[: sizes[k], :, k] = shards[s]
        cells[: sizes[k], 0, k] /= shards[s][:, 0].mean()
    cells = cells.reshape(steps, MINI_BATCH, -1, len(shards))
    now = np.repeat(beta[:, None], len(shards), axis=1)
    had = np.zeros((len(beta) - 1, len(shards)))  # penalty each weight has had
    due = 0.0
    for t in range(steps):
        left = sizes - t * MINI_BATCH
        m = int((left > 0).sum())
        part, n = cells[t, :, :, :m], np.minimum(left[:m], MINI_BATCH)
        x = part[:, 2:]
        miss = part[:, 0] * (sigmoid(now[0, :m] + (x * now[1:, :m]).sum(axis=1)) - part[:, 1])
        now[0, :m] -= rate * miss.sum(axis=0) / n
        before = now[1:, :m] - rate * (x * miss[:, None]).sum(axis=0) / n
        due += rate * lam
        after = np.where(before > 0, np.maximum(0.0, before - (due + had[:, :m])), np.minimum(0.0, before + (due - had[:, :m])))
        had[:, :m] += after - before
        now[1:, :m] = after
    out = np.empty((len(shards), len(beta)))
    out[order] = now.T
    return out


def fit_sgd_l1(shards: DataFrame, width: int, lam: float, epochs: int = 40, rate: float = 0.3) -> np.ndarray:
    """Intercept and weights; ``lam`` stands beside the mean weighted loss."""
    beta = np.zeros(width + 1)
    for t in range(epochs):
        now, step = beta, rate / (1.0 + t)

        def partial(batch: pa.RecordBatch, now=now, step=step):
            cells = [np.frombuffer(c.as_py()).reshape(-1, width + 2) for c in batch.column(batch.schema.get_field_index("rows"))]
            for own, after in zip(cells, run_epochs(cells, now, step, lam)):
                yield 0, len(own) * np.append(after, 1.0)

        found = summed(shards, partial, rows=SIDE_BY_SIDE)
        if not found:
            break
        beta = found[0][:-1] / found[0][-1]
    return beta


def fs_lr_sgd(df: DataFrame, features: Sequence[str], target: str, ident: str, c: float = 0.1, epochs: int = 40, seed: int = 42) -> DataFrame:
    """|weight| of a balanced L1 logistic model on standardised features, fitted by stochastic gradient descent."""
    shards, n = packed_shards(df, features, target, ident, seed)
    beta = fit_sgd_l1(shards, len(features), 1.0 / (c * max(n, 1)), epochs)
    rows = [(f, abs(float(b))) for f, b in zip(features, beta[1:])]
    return small_table(df.sparkSession, rows, "feature string, score double")
