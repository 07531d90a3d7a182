from pathlib import Path
from types import SimpleNamespace

import pytest

from corpusloom import session


def fake(master, configured=None):
    """As much of a session as ``shared_dir`` asks for."""
    no_folder = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: configured or d), sparkContext=SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: no_folder)))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError):
        session.shared_dir(fake(master))
    assert session.shared_dir(fake(master, "hdfs://shared/x")) == "hdfs://shared/x"


def test_release_deletes_what_was_staged(spark):
    kept = list(session._staged)
    session._staged.clear()
    try:
        df = session.stage(spark.range(5), "release-test")
        path = Path(session._staged[0][1].removeprefix("file:"))
        assert df.count() == 5 and path.exists()
        session.release()
        assert not path.exists() and session._staged == []
    finally:
        session._staged.extend(kept)
