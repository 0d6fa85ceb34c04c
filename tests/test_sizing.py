import pytest

from monthcast import session


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Session())
