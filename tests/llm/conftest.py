"""A session for the operators, with the folder for intermediate tables that a cluster would name."""

from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("llm-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes documents from ``(doc_id, text)`` pairs; further columns may be given by name."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t) if t is not None else None) for i, t in pairs]
        return spark.createDataFrame(rows, DOC_SCHEMA)

    return make
