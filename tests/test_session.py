from pathlib import Path
from types import SimpleNamespace

import pytest

from siltbed.session import drop_scratch, make_folder, scratch_folder, scratch_home, scratch_root


def session(shared=None, master="local[2]", checkpoint=None):
    state = {"dir": checkpoint}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: state["dir"], setCheckpointDir=lambda path: state.update(dir=path)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared or default), sparkContext=context)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(session("s3a://x/y/")) == "s3a://x/y"
    assert scratch_root(session(checkpoint="hdfs:/c", master="yarn")) == "hdfs:/c"


def test_a_cluster_needs_one():
    with pytest.raises(ValueError):
        scratch_root(session(master="yarn"))


def test_a_local_session_keeps_its_own():
    local = session()
    assert scratch_root(local) == scratch_root(local)


def test_folders_differ(spark):
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")


def test_drop_scratch_leaves_the_shared_folder(spark):
    shared = Path(scratch_root(spark))
    make_folder(spark, scratch_folder(spark, "a"))
    make_folder(spark, str(shared / "other"))
    assert Path(scratch_home(spark)).exists()
    drop_scratch(spark)
    assert not Path(scratch_home(spark)).exists() and (shared / "other").exists()
