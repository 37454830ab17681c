"""Staged tables and the folder they lie in."""

from pathlib import Path

import pytest

from railmart import session


def test_staged_tables_can_be_cleared(spark):
    kept = session.cut_lineage(spark.range(5))
    assert kept.count() == 5
    folder = Path(session.staging_folder(spark).removeprefix("file:"))
    assert any(folder.iterdir())
    session.clear_staged(spark)
    assert not folder.exists()
    session.clear_staged(spark)


class Cluster:
    """A session of several processes without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "local-cluster[2,1,1024]"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(Cluster)
