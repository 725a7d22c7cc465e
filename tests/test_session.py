"""Where written tables go."""

from types import SimpleNamespace

import pytest

from tidegauge.session import shared_folder


def session(master, folder):
    context = SimpleNamespace(applicationId=f"app-{master}", master=master)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))


def test_the_cluster_names_the_folder():
    assert shared_folder(session("yarn", "hdfs://shared/x/"), "t") == "hdfs://shared/x/app-yarn/t"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn", None), "t")


def test_a_local_session_gets_its_own():
    one = shared_folder(session("local[2]", None), "t")
    assert one.endswith("/t") and one == shared_folder(session("local[2]", None), "t")
