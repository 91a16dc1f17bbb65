from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from digestry.llm.near_dups import near_duplicates
from digestry.llm.ppm import lm_scores
from digestry.llm.quality import quality_scores
from tests.llm.fixtures import documents

# What a worker holds after a task over 20 MB of text, in MB.
HELD = """
import re, sys
import pyarrow as pa
from digestry.llm.lean import lean
from digestry.llm.near_dups import NearSettings, keyed_sets

def held():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def batches(n, seed):
    for k in range(n):
        yield pa.RecordBatch.from_pydict({"text": [" ".join(f"w{(seed + k + i) * j % 9973}" for j in range(7000)) for i in range(100)]})

run = keyed_sets(NearSettings().width)
run = lean(run) if sys.argv[1] == "lean" else run
list(map(len, run(batches(1, 1))))
for out in run(batches(8, 5)):
    pass
del out
print(held())
"""


def after_a_task(kind: str) -> float:
    root = Path(__file__).resolve().parents[2]
    return float(subprocess.run([sys.executable, "-c", HELD, kind], cwd=root, capture_output=True, text=True, check=True).stdout)


def test_a_worker_gives_back_what_its_task_freed():
    assert after_a_task("lean") + 30 < after_a_task("plain")


def test_operators_of_the_pipeline_send_lean_functions(spark, monkeypatch):
    kind, sent = type(spark.range(1)), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, func, *a, **b: sent.append(func) or plain(self, func, *a, **b))
    docs = documents(spark, [(i, f"the quick brown fox jumps over {i % 3}", "s") for i in range(12)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    assert quality_scores(docs, labels).count() == 12
    assert near_duplicates(docs).where("kept").count() == 3
    assert len(sent) >= 6 and {f.__module__ for f in sent} == {"digestry.llm.lean"}


def test_the_language_model_sends_lean_functions(spark, monkeypatch):
    kind, sent = type(spark.range(1)), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, func, *a, **b: sent.append(func) or plain(self, func, *a, **b))
    assert lm_scores(documents(spark, [(i, f"the quick brown fox {i}", "s") for i in range(12)])).count() == 12
    assert len(sent) == 2 and {f.__module__ for f in sent} == {"digestry.llm.lean"}
