"""A store that changes as a whole: commits, killed runs, added columns, conflicts."""

import os
import signal
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import types as T

from siltstone.sources import files
from siltstone.sources.snapshots import Conflict, SnapshotStore, merged_schema

ROOT = Path(__file__).resolve().parent.parent


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_killed_run_shows_the_old_filing(spark, tmp_path):
    """A process that dies after it has written some tables of a filing, before the commit."""
    unit = lambda v: spark.createDataFrame([("f1", "u1", v)], "filing_id string, unit_id string, measures string")
    label = lambda v: spark.createDataFrame([("f1", "q", v)], "filing_id string, qname string, text string")
    files.save_store({"units": unit("old"), "labels": label("old")}, str(tmp_path / "s"))
    script = tmp_path / "killed.py"
    script.write_text(textwrap.dedent(f"""
        import os, signal, sys
        sys.path.insert(0, {str(ROOT)!r})
        from siltstone.session import session
        from siltstone.sources import files, snapshots
        spark = session("local[1]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1"}})
        done = []
        replace = snapshots.Transaction.replace
        def dies(self, table, *a, **b):
            if done:
                os.kill(os.getpid(), signal.SIGKILL)
            done.append(table)
            return replace(self, table, *a, **b)
        snapshots.Transaction.replace = dies
        unit = spark.createDataFrame([("f1", "u1", "new")], "filing_id string, unit_id string, measures string")
        label = spark.createDataFrame([("f1", "q", "new")], "filing_id string, qname string, text string")
        files.save_store({{"units": unit, "labels": label}}, {str(tmp_path / "s")!r})
    """))
    done = subprocess.run([sys.executable, str(script)], env=os.environ | {"PYTHONPATH": str(ROOT)}, capture_output=True, timeout=120)
    assert done.returncode == -signal.SIGKILL
    folders = lambda: len(list((tmp_path / "s/data/units").iterdir()))
    assert folders() == 2  # it had written units
    store = files.load_store(spark, str(tmp_path / "s"))
    assert rows(store["units"].select("measures")) == rows(store["labels"].select("text")) == [("old",)]
    assert SnapshotStore(spark, str(tmp_path / "s")).vacuum() == 1 and folders() == 1
    files.save_store({"units": unit("new"), "labels": label("new")}, str(tmp_path / "s"))
    store = files.load_store(spark, str(tmp_path / "s"))
    assert rows(store["units"].select("measures")) == rows(store["labels"].select("text")) == [("new",)]
    assert rows(files.load_store(spark, str(tmp_path / "s"), version=1)["units"].select("measures")) == [("old",)]


def test_added_columns_and_wider_types(spark, tmp_path):
    path = str(tmp_path / "s")
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    files.save_store({"facts": make([("f1", "a", 1)], "filing_id string, qname string, doc_order int")}, path)
    files.save_store({"facts": make([("f2", "b", 2, 7, [1, 2])], "filing_id string, qname string, doc_order long, page int, boxes array<int>")}, path)
    files.save_store({"facts": make([("f3", "c", 3, 2**40)], "filing_id string, qname string, doc_order long, page long")}, path)
    got = files.load_store(spark, path)["facts"]
    assert rows(got.select("filing_id", "doc_order", "page", "boxes")) == [("f1", 1, None, None), ("f2", 2, 7, "[1,2]"), ("f3", 3, 2**40, None)]
    with pytest.raises(ValueError, match="page"):
        files.save_store({"facts": make([("f4", "x")], "filing_id string, page string")}, path)
    assert files.load_store(spark, path, ["f2", "no such"])["facts"].count() == 1


def test_what_a_filing_no_longer_has_goes(spark, tmp_path):
    path = str(tmp_path / "s")
    unit = lambda f: spark.createDataFrame([(f, "u1")], "filing_id string, unit_id string")
    files.save_store({"units": unit("f1").union(unit("a/b c")), "labels": spark.createDataFrame([("f1", "q")], "filing_id string, qname string")}, path)
    files.save_store({"units": unit("f1"), "labels": spark.createDataFrame([], "filing_id string, qname string")}, path)
    store = files.load_store(spark, path)
    assert store["labels"].count() == 0 and rows(store["units"].select("filing_id")) == [("a/b c",), ("f1",)]
    assert store["calc_edges"].count() == 0
    assert rows(files.load_store(spark, path, ["a/b c"])["units"].select("filing_id")) == [("a/b c",)]


def test_conflict_and_failure(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    one = spark.createDataFrame([(1, None), (2, "x")], "a int, p string")
    with store.transaction() as tx:
        tx.replace("t", one, "p")
    with pytest.raises(Conflict), store.transaction() as tx:
        tx.append("t", one, "p")
        with store.transaction() as other:
            other.properties["n"] = 3
    assert store.properties() == {"n": 3} and store.read("t").count() == 2
    with pytest.raises(ZeroDivisionError), store.transaction() as tx:
        tx.append("t", one, "p")
        1 / 0
    with store.transaction() as tx:
        tx.append("t", one, "p")
    assert store.version() == 3 and rows(store.read("t")) == rows(one.union(one)) and rows(store.read("t", ["x"]).select("a")) == [(2,), (2,)]
    with pytest.raises(ValueError, match="partitioned"), store.transaction() as tx:
        tx.replace("t", one)
    with pytest.raises(KeyError):
        store.read("u")
    assert not [n for n in os.listdir(tmp_path / "s/_manifests") if n.startswith("draft")]


def test_merged_schema():
    a = T.StructType.fromDDL("x int, s struct<p: float, q: int>, y string")
    b = T.StructType.fromDDL("s struct<p: double, r: string>, x long, z array<int>")
    assert merged_schema(a, b) == T.StructType.fromDDL("x long, s struct<p: double, q: int, r: string>, y string, z array<int>")
