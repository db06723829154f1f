import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from logquarry.session import Scratch, gathered, scratch_root


def test_a_run_removes_its_folder_also_after_an_error(spark):
    with pytest.raises(RuntimeError):
        with Scratch(spark) as area:
            stored = area.store(spark.range(10).withColumn("k", F.col("id") % 2), "rows", partition_by=["k"])
            assert stored.where("k = 1").count() == 5 and os.path.isdir(area.folder.removeprefix("file:"))
            raise RuntimeError
    assert not os.path.isdir(area.folder.removeprefix("file:"))


def test_gathered_rows_need_no_files(spark):
    with Scratch(spark) as area:
        kept = gathered(area.store(spark.range(3), "rows"))
    assert sorted(r["id"] for r in kept.collect()) == [0, 1, 2]


def test_scratch_root_is_the_sessions(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_queries_run_from_another_folder_and_without_settings(tmp_path):
    """Executors get the package from the session; a plain local session gets a scratch root."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
        import sys
        sys.path.insert(0, {root!r})
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        import __spark_entry__ as entry
        print("ROWS", entry.queries()["isolation_forest_scores"](spark, "/root/testdata/sf0.001").count())
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000" in out.stdout, out.stderr[-2000:]
