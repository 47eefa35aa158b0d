import importlib
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from odometrix.llm.common import materialize
from odometrix.llm.quality import clean_lines
from tests.llm.helpers import LOW, components, documents, hard_rows, words
from tests.llm.test_mixing import iterated_targets
from tests.llm.test_packing import direct
from tests.llm.test_simhash import fingerprint


def run_stages(spark, docs):
    """(input, output) rows of every stage."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = materialize(stage(spark, docs, ""), f"test-{name}")
        out.append((docs, result))
        docs = result
    return out


def pairs(df):
    return sorted((str(r.doc_id), r.text) for r in df.select("doc_id", "text").collect())


def check_stages(spark, docs):
    (a, quality), (_, exact), (_, near), (_, mixed), (_, packed) = run_stages(spark, docs)
    for df in (quality, exact, near, mixed):
        assert df.columns == docs.columns

    # Quality: what the rules keep, with failing lines removed.
    kept = clean_lines(a).filter("quality.kept").select("doc_id", "text", "quality.clean_text", "quality.lost_words")
    assert pairs(quality) == sorted((str(r.doc_id), r.clean_text if r.lost_words else r.text) for r in kept.collect())

    # Exact: the largest id of every normalised text, once.
    best: dict = {}
    for i, t in ((r.doc_id, r.text) for r in quality.collect()):
        key = (t or "").translate(LOW)
        best[key] = max(best.get(key, -1), -1 if i is None else i)
    assert sorted((t or "").translate(LOW) for _, t in pairs(exact)) == sorted(best)
    assert sorted(i for i, _ in pairs(exact)) == sorted(str(None if i == -1 else i) for i in best.values())

    # Near: the smallest id of every component.
    rows = sorted(((r.doc_id, r.text) for r in exact.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    fps = np.array([fingerprint(t) for _, t in rows], "u8")
    group = components(len(rows), lambda i: np.nonzero(np.bitwise_count(fps[i] ^ fps) <= 2)[0])
    assert pairs(near) == sorted((str(rows[k][0]), rows[k][1]) for k in set(group))

    # Mix: each source's words come to its target; documents whole but for the last.
    sizes: dict = defaultdict(int)
    text_of = {}
    for r in near.collect():
        sizes[r.source] += len(words(r.text))
        text_of[r.doc_id] = r.text
    want = iterated_targets(sizes)
    taken, cut, uses = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
        uses[r.doc_id] += 1
        if r.text != text_of[r.doc_id]:
            cut[r.source] += 1
            assert words(text_of[r.doc_id])[: len(words(r.text))] == words(r.text)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want) and all(n <= 3 for n in uses.values())
    assert all(n <= 1 for n in cut.values())

    # Pack: every row's ids, cut at 2048, gapless in sequences.
    expected = []
    for r in mixed.collect():
        ids = direct(r.text or "") + b"\0\0\0\0"
        expected += [
            (str(r.doc_id), k, at // 4, zlib.crc32(ids[at : at + 8192])) for k, at in enumerate(range(0, len(ids), 8192))
        ]
    got = packed.collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.ids_crc32) for r in got) == sorted(expected)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048


def test_stages_on_the_tables(spark):
    check_stages(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_stages_on_hard_rows(spark):
    long_lines = [(i, "\n".join(f"Line {k} of text number {i // 2} has words enough." for k in range(12)), "ab"[i % 2]) for i in range(500, 540)]
    check_stages(spark, documents(spark, hard_rows() + long_lines))


def test_empty_table(spark):
    for _, result in run_stages(spark, documents(spark, hard_rows()).limit(0)):
        assert result.count() == 0


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"
    ]


def test_registered_queries():
    entry = importlib.import_module("__spark_entry__")
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_workers_need_no_package_on_their_path(tmp_path):
    import os

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from odometrix.llm.packing import op1_best_fit_packing
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
print("ROWS", op1_best_fit_packing(s, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]
