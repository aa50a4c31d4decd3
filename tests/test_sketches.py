"""The profile of merged parts against all rows."""

import numpy as np
import pytest

from riskloom.operators import sketches
from riskloom.sources.scratch import scratch_path


def test_parts_merge_to_the_whole(spark):
    draw = np.random.default_rng(4)
    n = 12_000
    x = np.round(draw.exponential(size=n) * 1000) / 8
    rows = [(k, None if k % 11 == 0 else float(x[k]), f"t{int(x[k]) % 700}", None) for k in range(n)]
    schema = "id bigint, x double, t string, nothing double"
    path = scratch_path(spark, "parts")
    cuts = [0, 100, 5_000, 5_001, n]
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        sketches.add_part(spark.createDataFrame(rows[a:b], schema), path, f"p{k}")
    sketches.add_part(spark.createDataFrame(rows[: cuts[1]], schema), path, "p0")  # came again
    got = {r["column"]: r for r in sketches.merged_profile(sketches.read_parts(spark, path)).collect()}
    assert set(got) == {"id", "x", "t", "nothing"} and all(r["n_rows"] == n for r in got.values())
    known = np.sort([r[1] for r in rows if r[1] is not None])
    r = got["x"]
    assert (r["n_missing"], r["min"], r["max"]) == (n - len(known), known[0], known[-1])
    assert r["mean"] == pytest.approx(known.mean(), abs=1e-6) and r["std"] == pytest.approx(known.std(), rel=1e-6)
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        low, high = np.searchsorted(known, r[name], "left"), np.searchsorted(known, r[name], "right")
        assert low / len(known) - 0.03 <= q <= high / len(known) + 0.03
    for c, values in (("id", range(n)), ("x", known), ("t", [r[2] for r in rows])):
        assert got[c]["n_unique"] == pytest.approx(len(set(values)), rel=0.07)
    assert got["t"]["mean"] is None and got["t"]["q50"] is None
    assert (got["nothing"]["n_missing"], got["nothing"]["n_unique"], got["nothing"]["min"], got["nothing"]["q50"]) == (n, 0, None, None)
    whole = sketches.part_sketches(spark.createDataFrame(rows, schema))
    alone = {r["column"]: r for r in sketches.merged_profile(whole).collect()}
    assert all(alone[c][k] == got[c][k] for c in got for k in ("n_rows", "n_missing", "min", "max"))


def test_empty_part(spark):
    empty = spark.createDataFrame([], "x double, t string")
    rows = {r["column"]: r for r in sketches.merged_profile(sketches.part_sketches(empty)).collect()}
    assert rows["x"]["n_rows"] == 0 and rows["x"]["n_unique"] == 0 and rows["x"]["mean"] is None
