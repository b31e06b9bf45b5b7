"""The folder for tables in between."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from folia import session


def fake(setting, master, app="app-1"):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default), sparkContext=SimpleNamespace(master=master, applicationId=app))


def test_scratch_folder():
    assert session.scratch(fake("hdfs://x/y/", "yarn")) == "hdfs://x/y"
    own = session.scratch(fake(None, "local"))
    assert own.startswith("file://") and os.path.isdir(own.removeprefix("file://"))
    assert session.scratch(fake(None, "local[4]")) == own and session.scratch(fake("", "local[*]", "app-2")) != own
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            session.scratch(fake(None, master))
