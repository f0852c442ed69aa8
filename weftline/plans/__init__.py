"""Complete jobs over the given tables, and the SQL that checks them."""

from __future__ import annotations

from importlib import import_module

_TOPICS = ("reports", "files", "conformed", "text", "profiles", "imputation", "messages")


def all_jobs() -> dict[str, tuple]:
    """``name -> (callable(spark, folder), oracle SQL or None)``."""
    jobs: dict[str, tuple] = {}
    for topic in _TOPICS:
        for name, job in import_module(f"weftline.plans.{topic}").JOBS.items():
            if name in jobs:
                raise ValueError(f"job {name} is defined twice")
            jobs[name] = job
    return jobs
