from types import SimpleNamespace

import pytest

from fixtrail import session


def fake(master, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, other: folder or other))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(fake(master))


def test_scratch_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    table = session.materialise(spark.range(3))
    assert table.count() == 3
    path = session._SCRATCH[0]
    assert session.drop_scratch(spark) == 1 and session.drop_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
