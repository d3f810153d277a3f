import types

import pytest

from tidewater import session


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


def fake(master, folder=None):
    made = []
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    conf = _Conf({"spark.checkpoint.dir": folder} if folder else {})
    return types.SimpleNamespace(sparkContext=sc, conf=conf, made=made)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(fake(master))


@pytest.mark.parametrize("folder", ["file:///shared/x", "hdfs://nn/x", "/plain/x"])
def test_named_folder_is_used_as_it_is(folder):
    assert session.checkpoint_root(fake("yarn", folder)) == folder
    assert session.scratch_path(fake("yarn", folder), "job").startswith(folder + "/job-")


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_local_master_makes_a_folder(master):
    assert session.checkpoint_root(fake(master)).startswith("file:///")
