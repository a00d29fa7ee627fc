"""The driver contract, the stream, and agreement of queries with their SQL on the smallest tables."""

from __future__ import annotations

import importlib.util
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from graphloom import queries
from graphloom.config import Settings
from graphloom.streaming.folders import extract_stream

DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).parent.parent


def _value(x):
    return round(x, 9) if isinstance(x, float) else x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_value(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DIR).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    found = queries.QUERIES[name](spark, DIR)
    rows = found.collect()
    assert rows
    if name in queries.ORACLE_SQL:
        theirs = duck.sql(queries.ORACLE_SQL[name])
        assert _rows(found.columns, rows) == _rows(theirs.columns, theirs.fetchall())


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    there = importlib.util.find_spec("graphloom.llm.queries") if importlib.util.find_spec("graphloom.llm") else None
    assert any(n.startswith("op1_") for n in entry.queries()) == (there is not None)


def test_stands_without_the_corpus_operators(tmp_path):
    """A copy without their two folders, with and without the pipeline, still lists its queries."""
    for name in ("graphloom", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    check = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(sorted(q))"
    for _ in range(2):
        out = subprocess.run([sys.executable, "-c", check], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        assert "'chunk_scan'" in out.stdout and "op1_" not in out.stdout and "pipeline" not in out.stdout
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


def test_library_stands_alone():
    for path in (ROOT / "graphloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "graphloom").parts:
            assert not re.search(r"(from|import) [\w.]*\bllm\b", path.read_text()), path


def test_plans_are_lean(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<(text|source|doc_id)[^>]*>", plan(queries.QUERIES["chunk_scan"](spark, DIR)))
    assert "n_chars" not in plan(queries.QUERIES["regex_entities"](spark, DIR)).split("ReadSchema")[1]
    assert "BatchEvalPython" not in "".join(plan(queries.QUERIES[n](spark, DIR)) for n in ("edge_merge", "self_consistency_vote"))


def test_stream(spark, tmp_path):
    chunks = spark.createDataFrame([("f", "c0", 0, 0, "mail a@b.co"), ("g", "c1", 1, 0, "mail b@c.de and 12345")], "folder_id string, chunk_id string, doc_id long, line_no int, text string")
    for folder in ("f", "g"):
        chunks.where(f"folder_id = '{folder}'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        extract_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), Settings(engine="rules", pack="commerce")).awaitTermination()
    assert sorted(r.surface_form for r in spark.read.parquet(str(tmp_path / "out/entities")).collect()) == ["12345", "a@b.co", "b@c.de"]
    quiet = spark.createDataFrame([("f", "c0", 0, 0, "no mail any more")], chunks.schema)
    quiet.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(chunks.schema).parquet(str(tmp_path / "in"))
    extract_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), Settings(engine="rules", pack="commerce")).awaitTermination()
    assert {r.folder_id for r in spark.read.parquet(str(tmp_path / "out/entities")).collect()} == {"g"}
