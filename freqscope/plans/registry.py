"""Query registry: name -> Spark job and name -> DuckDB oracle statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..streaming import jobs as stream_jobs
from ..streaming import online
from . import events, events_sql, membership, membership_sql, requests, tokens, tokens_sql, urls, urls_sql

Job = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Job]:
    return {**events.JOBS, **tokens.JOBS, **urls.JOBS, **membership.JOBS, **stream_jobs.JOBS,
            **online.JOBS, **requests.JOBS}


def oracle_sql() -> dict[str, str]:
    return {**events_sql.oracle(), **tokens_sql.oracle(), **urls_sql.oracle(), **membership_sql.oracle(),
            **stream_jobs.oracle(), **online.oracle(),
            **requests.oracle()}
