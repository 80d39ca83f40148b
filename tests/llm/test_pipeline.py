"""The pipeline: stages against their operators' brute-force versions, whole run, odd rows, and the entry's guard."""

import collections
import os
import shutil
import subprocess
import sys

import corpus_pipeline as P
from test_exact import encoder, lines_by_force, shingle_groups

from pathlattice.llm.common import stage

TINY = "/root/testdata/sf0.001"


def test_stages_on_a_small_table(llm_spark):
    assert [n for n, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "decontaminate", "packing"]
    docs = llm_spark.read.parquet(f"{TINY}/documents.parquet")
    for name, fn in P.STAGES:
        before = docs.collect()
        docs = stage(llm_spark, fn(llm_spark, docs, TINY), name)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
            assert 0.5 * len(before) < len(after) <= len(before)
        if name == "lines":
            want = lines_by_force([(r.doc_id, r.text) for r in before])
            assert {r.doc_id: r.text for r in after} == {r.doc_id: want[r.doc_id, r.text] for r in before
                                                         if want[r.doc_id, r.text].strip() or want[r.doc_id, r.text] == r.text}
        if name == "near_duplicates":
            groups = shingle_groups([(r.doc_id, r.text) for r in before])
            assert {r.doc_id for r in after} == {c if n else i for i, n, c in groups}
        if name == "packing":
            tk = encoder()
            assert sum(r.length for r in after) == sum(len(tk.encode(r.text, add_special_tokens=False).ids) + 1 for r in before)
    again = P.run(llm_spark, TINY).collect()
    by_doc = collections.Counter(r.doc_id for r in after)
    assert collections.Counter(r.doc_id for r in again) and set(by_doc) == {r.doc_id for r in again}


def test_stages_on_odd_rows(llm_spark, odd, none):
    for name, fn in P.STAGES:
        out = fn(llm_spark, odd, TINY)
        if name != "packing":
            assert out.columns == odd.columns
        assert out.count() > 0 and fn(llm_spark, none, TINY).count() == 0


def test_entry_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(P.__file__))
    for name in ("__spark_entry__.py", "pathlattice"):
        src = os.path.join(root, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert len(q) >= 70 and not any(k.startswith('op1') or k == 'pipeline' for k in q) and set(o) <= set(q)")
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len([k for k in q if k.startswith('op')]) >= 10 and 'pipeline' in q"
    subprocess.run([sys.executable, "-c", code], cwd=root, env={**os.environ, "PYTHONPATH": root}, check=True)
