from types import SimpleNamespace

import pytest

from quillstack.llm.common import LOCAL_CHECKPOINTS, shared_dir


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None))


def test_shared_folder():
    """The named folder; without one, a folder of this machine for a local master only."""
    assert shared_dir(session("spark://host:7077", "hdfs://store/work/")) == "hdfs://store/work"
    assert shared_dir(session("local[2]", "/shared")) == "/shared"
    assert shared_dir(session("local")) == shared_dir(session("local[8]")) == LOCAL_CHECKPOINTS
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
