"""The submitter's settings stand; no machine-local folder on a cluster."""

import os
import subprocess
import sys

import pytest

from tillcast import session

CODE = """
from tillcast.session import build_session
s = build_session()
print("GOT", s.conf.get("spark.sql.shuffle.partitions"), s.sparkContext.getConf().get("spark.driver.memory"),
      s.conf.get("spark.sql.adaptive.enabled"), s.conf.get("spark.sql.session.timeZone"))
"""


def test_submitted_settings_survive():
    args = ("--master local[1] --driver-memory 900m --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2000 "
            "--conf spark.sql.adaptive.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-c", CODE], env=os.environ | {"PYSPARK_SUBMIT_ARGS": args}, capture_output=True, text=True, timeout=300)
    assert "GOT 2000 900m false UTC" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("master,local", [("local", True), ("local[8]", True), ("local-cluster[2,1,1024]", False), ("yarn", False), ("spark://h:7077", False)])
def test_local_masters(master, local):
    assert session.is_local(master) == local


def test_cluster_without_shared_folder_is_an_error():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
