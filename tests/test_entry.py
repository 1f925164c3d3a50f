import builtins
import sys

import __spark_entry__ as entry
from tidelog.plans.jobs import JOBS
from tidelog.plans.sql import ORACLE


def test_jobs_work_without_the_training_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("tidelog.llm")]:
        monkeypatch.delitem(sys.modules, name)
    real = builtins.__import__

    def broken(name, *args, **kwargs):
        if name == "corpus_pipeline" or name.startswith("tidelog.llm"):
            raise ImportError("a library is missing")
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", broken)
    assert entry.queries() == JOBS and entry.oracle_sql() == ORACLE


def test_jobs_have_unique_names_and_sql():
    assert set(ORACLE) <= set(JOBS)
