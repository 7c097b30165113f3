"""Queries on workers that cannot import the package: only the driver knows where it lies."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from tidegauge.session import local_session
spark = local_session("4", "workers", **{{
    "spark.checkpoint.dir": {folder!r}, "spark.sql.warehouse.dir": {folder!r} + "/warehouse"}})

def found(_):
    try:
        import tidegauge
    except ModuleNotFoundError:
        return ["no"]
    return ["yes"]

assert spark.sparkContext.parallelize([1], 1).mapPartitions(found).collect() == ["no"]
import corpus_pipeline
from tidegauge.llm.queries import QUERIES
sf = "/root/testdata/sf0.001"
for name in {names!r}:
    if name == "pipeline":
        docs = spark.read.parquet(sf + "/documents.parquet")
        rows = corpus_pipeline.identify_language(spark, docs, sf).collect()
    else:
        rows = QUERIES[name](spark, sf).collect()
    assert rows, name
    print(name, len(rows))
spark.stop()
"""


@pytest.mark.parametrize("names", [
    ("op5_language_crf", "pipeline"),
    ("op2_pack_sequences", "op4_line_dedup", "op7_warc_pages", "op9_hash_forest", "op11_spectrum_whitening",
     "op12_conversation_repair"),
])
def test_workers_without_the_package(tmp_path, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=str(ROOT), folder=str(tmp_path), names=names)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines()] == list(names)
