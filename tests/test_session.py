import os

import pytest

from partflow import session


class _Cluster:
    """What ``shared_dir`` looks at, of a session on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster)


def test_scratch_goes_with_the_run(spark):
    table = session.materialize(spark.range(5), "numbers")
    assert table.count() == 5
    root = session._scratch_root(spark)
    assert os.listdir(root)
    session.clear_scratch(spark)
    assert not os.path.exists(root)
