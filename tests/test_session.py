"""The shared folder of sessions on a cluster, stood in for by a local session under another master's name."""

from types import SimpleNamespace

import pytest

from ferrytally import session


@pytest.fixture
def cluster(spark):
    """A session whose master is that of a cluster."""
    def with_folder(folder, warehouse="", read=spark.read):
        settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
        chosen = []
        sc = SimpleNamespace(
            master="spark://head:7077", applicationId="app-1", defaultParallelism=3, getCheckpointDir=lambda: folder,
            setCheckpointDir=chosen.append, chosen=chosen,
        )
        conf = SimpleNamespace(get=lambda name, default=None: settings.get(name) or default)
        return SimpleNamespace(sparkContext=sc, conf=conf, range=spark.range, read=read)

    return with_folder


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_mounted_folder(cluster, tmp_path, scheme):
    """A path that every machine has is a shared folder, too."""
    folder = f"{scheme}{tmp_path}"
    assert session.scratch_path(cluster(folder), "x").startswith(f"{folder}/x-")


def test_warehouse_without_a_checkpoint_folder(cluster, tmp_path):
    at = cluster(None, f"file:{tmp_path}/tables")
    folder = session.shared_dir(at)
    assert folder.startswith(f"file:{tmp_path}/tables/ferrytally-")
    assert at.sparkContext.chosen == [folder]


def test_folder_of_one_machine(cluster, spark, tmp_path):
    """What tasks wrote is not there when it is read."""
    empty = SimpleNamespace(schema=lambda kind: SimpleNamespace(parquet=lambda path: spark.createDataFrame([], kind)))
    with pytest.raises(RuntimeError, match="folder of one machine"):
        session.shared_dir(cluster(str(tmp_path / "own"), read=empty))


def test_warehouse_of_executors_on_one_machine(cluster, tmp_path):
    """Executors of a local cluster have temp folders of their own, so the driver's is none for them."""
    at = cluster(None, f"file:{tmp_path}/tables")
    at.sparkContext.master = "local-cluster[3,2,3000]"
    assert session.shared_dir(at).startswith(f"file:{tmp_path}/tables/ferrytally-")
