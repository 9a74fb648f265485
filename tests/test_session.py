"""Where scratch data may go."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from merchlake import session
from merchlake.session import scratch_root


def cluster(setting, current=None):
    conf = SimpleNamespace(get=lambda key, default: setting)
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: current, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        scratch_root(cluster(None))
    assert scratch_root(cluster("hdfs://x/y")) == "hdfs://x/y"
    assert scratch_root(cluster(None, "hdfs://x/z")) == "hdfs://x/z"


def test_scratch_is_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "_HANDED_OUT", [])
    table = session.stored(spark.range(5).toDF("n"), "gone")
    assert table.count() == 5
    (path,) = [p for *_, p in session._HANDED_OUT]
    folder = Path(path.removeprefix("file:"))
    assert folder.is_dir()
    session.remove_scratch()
    assert not folder.exists() and not session._HANDED_OUT
