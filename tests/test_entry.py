"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry
from tillcast.config import HORIZONS, V1
from tillcast.plans import catalog


def test_entry_runs_flagship_on_smallest_scale(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", *V1.features, *[t for _, t, _ in HORIZONS]]
    assert df.count() > 0


def test_model_queries_train_all_rounds():
    assert catalog.MODEL_CFG.max_iter == 400


def test_queries_and_oracles_line_up():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert all(callable(f) for f in qs.values())
    assert all(isinstance(v, str) and v.strip() for v in orc.values())
