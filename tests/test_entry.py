"""The entry file without its optional part, and the shared folder without outside configuration."""

import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from caudal import session
from workload.queries import CATALOG

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("away", ["caudal.llm", "caudal.llm.queries"])
def test_queries_without_the_optional_subpackage(away):
    code = f"import sys; sys.modules['{away}'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(CATALOG)), str(sum(q.sql is not None for q in CATALOG.values()))], said.stderr


class Settings(dict):
    """As on Spark 4.1, where a running session does not take this one."""

    def set(self, key, value):
        raise RuntimeError(f"CANNOT_MODIFY_CONFIG {key}")


def test_shared_folder_without_a_setting():
    application = lambda master: SimpleNamespace(conf=Settings(), sparkContext=SimpleNamespace(master=master, applicationId="app-without-setting"))
    folder = session.shared_folder(application("local[2]"))
    assert Path(folder).is_dir() and session.shared_folder(application("local[2]")) == folder
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(application("spark://host:7077"))
    named = SimpleNamespace(conf=Settings({"spark.checkpoint.dir": "hdfs://n/c/"}), sparkContext=None)
    assert session.shared_folder(named) == "hdfs://n/c"
