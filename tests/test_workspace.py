"""A run that ends early goes on after its last whole stage and leaves nothing but its results."""

import json
import os

import pytest

from quarry.plans import run as R
from quarry.workspace import Workspace

LIGHT = R.RunParams(target="kind", n_init=1, k_max=3, num_trees=3, forest_depth=4, sample=50, micro=20, key_cols=["id"])


def test_stage_is_built_once_and_only_when_whole(spark, tmp_path):
    folder = str(tmp_path / "work")
    calls = []

    def build(fail=False):
        calls.append(fail)
        return {"a": spark.range(3), "b": spark.range(5).selectExpr("id", "raise_error('lost') x" if fail else "1 x")}
    work = Workspace(spark, folder, {"k": 1})
    with pytest.raises(Exception, match="lost"):
        work.stage("one", lambda: build(True))
    assert Workspace(spark, folder, {"k": 1}).stages == []
    assert {t: d.count() for t, d in work.stage("one", build).items()} == {"a": 3, "b": 5}
    again = Workspace(spark, folder, {"k": 1})
    assert again.stages == ["one"] and again.stage("one", build)["b"].count() == 5 and calls == [True, False]
    with pytest.raises(ValueError):
        Workspace(spark, folder, {"k": 2})
    again.remove()
    assert not os.path.exists(folder)


def test_killed_run_goes_on(spark, tmp_path, monkeypatch):
    rows = [(i, float(i % 7), f"c{i % 3}", "yes" if (i % 7 > 3) != (i % 11 == 0) else "no") for i in range(160)]
    df = spark.createDataFrame(rows, "id long, x double, c string, kind string")
    work, out = str(tmp_path / "work"), str(tmp_path / "out")

    def lost(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(R.C, "train_tree", lost)
        with pytest.raises(RuntimeError, match="lost"):
            R.run_and_write([("t", df)], out, LIGHT, work=work)
    assert list(json.load(open(f"{work}/dataset_1/manifest.json"))["stages"]) == ["clean", "features", "clustering"]
    with monkeypatch.context() as m:  # what is whole is not done again
        for module, name in ((R, "clean_table"), (R.X, "fit_features"), (R.K, "kmeans_sweep"), (R.K, "ward_clusters")):
            m.setattr(module, name, lost)
        listing = {r["table"]: r["rows"] for r in R.run_and_write([("t", df)], out, LIGHT, work=work).collect()}
    assert not os.path.exists(work) and os.path.exists(out)
    whole = R.run_analysis(df, "t", LIGHT)
    assert set(listing) == set(whole.tables)
    for name in ("comparison_table", "kmeans_sweep", "cluster_sizes", "feature_importance", "split_sizes", "cleaning_audit"):
        got = sorted(map(str, spark.read.parquet(f"{out}/dataset_1/{name}").collect()))
        assert got == sorted(map(str, whole.tables[name].collect())), name
