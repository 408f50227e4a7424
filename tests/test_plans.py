"""Physical-plan guards for every SQL-checked query: no cartesian products or
nested-loop joins, no Python in the plan except the declared kernel operator,
and column pruning reaches the scans of the wide text table."""
import pytest

from paths import SF0001
from screenlake.plans.catalog import ORACLE, QUERIES

PYTHON_OK = {"distinct_featurize"}   # FP3: the mapInPandas kernel contract


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_plan_shape(spark, name):
    plan = _plan(QUERIES[name](spark, SF0001))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_OK:
        assert "Python" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    from screenlake.operators import metrics as M
    from screenlake.plans import views as V
    plan = _plan(M.threshold_metrics(V.assay_balanced(spark, SF0001)))
    # events has 6 columns; the metric reads 3 of them
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan


def test_filter_pushdown(spark):
    from pyspark.sql import functions as F
    from screenlake.sources.parquet import load_labelled
    df = load_labelled(spark, f"{SF0001}/orders.parquet", ["o_orderkey", "o_orderstatus"]) \
        .where(F.col("o_orderstatus") == "F")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in _plan(df)


def test_cluster_needs_a_shared_folder():
    """A machine-local folder is made for local masters only."""
    from types import SimpleNamespace

    import pytest

    from screenlake.session import ensure_checkpoint_dir
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="shared storage"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf={}))
