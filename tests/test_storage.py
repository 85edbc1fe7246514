import os
from types import SimpleNamespace

import pytest

from arenalake.storage import fresh_path, remove_app_files, shared_folder


def session(folder, master):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(session("hdfs://shared/checkpoints/", "yarn")) == "hdfs://shared/checkpoints"


def test_a_cluster_needs_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("", "yarn"))


def test_local_mode_falls_back_to_a_temporary_folder():
    first, second = (fresh_path(session("", "local[2]"), "x") for _ in range(2))
    assert first != second
    assert os.path.isdir(first.split("/arenalake/")[0])


def test_app_files_are_removed(spark):
    """A second landing works after the files are gone."""
    from arenalake.registry.queries import all_queries
    from tests.conftest import SMALL

    query = all_queries()["explode_pages"]
    before = query(spark, SMALL).count()
    remove_app_files(spark)
    assert query(spark, SMALL).count() == before
