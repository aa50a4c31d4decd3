"""Learning curves: nested samples of the training rows, all fitted in the same passes.

A row is in the sample of a share if its hash lies below the share, so samples are
nested and a row's place does not depend on the others.  Every size is one more fit of
``joint.fit_linear`` over the same written table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scalar import hash_order, quoted
from riskloom.operators import joint
from riskloom.operators.rankings import Scores, ranking_metrics
from riskloom.operators.transforms import fit_scaler
from riskloom.sources.scratch import materialise, small_table

SHARES = (0.1, 0.2, 0.35, 0.5, 0.7, 1.0)


def learning_curve(
    df: DataFrame, features: Sequence[str], target: str, group: str, ident: str,
    shares: Sequence[float] = SHARES, c: float = 1.0, l1: float = 0.0, seed: int = 42, train: str = "Train",
) -> DataFrame:
    """share, n, split, roc_auc, pr_auc, ks: a logistic model fitted on each share of the ``train`` rows.

    ``split`` is ``train`` for the rows a model was fitted on, else the row's group.  The
    scaler is fitted on all training rows; NULL features count as 0, and so does a NULL
    target.  A share without a row of both classes still has a (constant) model.
    """
    names = [f"x{k}" for k in range(len(features))]
    limit = F.conv(F.lit("f" * 15), 16, 10).cast("double")
    place = hash_order(quoted(ident), seed).cast("double") / limit
    rows = df.where(quoted(group).isNotNull()).select(
        quoted(group).cast("string").alias("split"),
        F.coalesce(quoted(target).cast("double"), F.lit(0.0)).alias("label"),
        *[F.when((quoted(group) == train) & ((place < share) | F.lit(share >= 1.0)), 0).alias(f"s{k}") for k, share in enumerate(shares)],
        *[F.coalesce(quoted(f).cast("double"), F.lit(0.0)).alias(n) for f, n in zip(features, names)],
    )
    table = materialise(rows, "curve")
    params = fit_scaler(table.where(F.col("s" + str(len(shares) - 1)).isNotNull() if 1.0 in shares else F.col("split") == train), names)
    sizes = table.agg(*[F.count(f"s{k}").alias(f"s{k}") for k in range(len(shares))]).first()
    centre, width = tuple(params[n][0] for n in names), tuple(params[n][1] for n in names)
    columns = tuple(range(len(features)))
    fits = [joint.Linear(columns, centre, width, joint.Rows(f"s{k}"), 1.0 / (c * max(sizes[f"s{k}"], 1)), l1) for k in range(len(shares))]
    betas = joint.fit_linear(table, fits)

    held = table.groupBy("split").agg(F.count("*").alias("n")).collect()  # a row per split
    splits = ["train", *sorted({r["split"] for r in held} - {train})]

    def scores(batch: pa.RecordBatch) -> Scores:
        x, label = joint.features_of(batch, columns), joint.numbers(batch, "label")
        positive, known = label == 1, (label == 0) | (label == 1)
        split = batch.column(batch.schema.get_field_index("split"))
        others = [pc.equal(split, name).to_numpy(zero_copy_only=False) for name in splits[1:]]
        for k, (fit, beta) in enumerate(zip(fits, betas)):
            found = joint.linear_scores(x, fit, beta)
            for j, own in enumerate([~np.isnan(joint.numbers(batch, f"s{k}")), *others]):
                own = own & known
                yield k * len(splits) + j, found[own], positive[own]

    measured = ranking_metrics(table, scores, sum(r["n"] for r in held))
    points = [(k * len(splits) + j, float(share), int(sizes[f"s{k}"]), name) for k, share in enumerate(shares) for j, name in enumerate(splits)]
    points = small_table(df.sparkSession, points, "at bigint, share double, n bigint, split string")
    return points.join(measured, "at").select("share", "n", "split", "roc_auc", "pr_auc", "ks")
