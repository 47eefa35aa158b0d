from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odometrix.llm.exact_dedup import exact_dedup, exact_dedup_rows
from tests.llm.helpers import LOW, documents, hard_rows


def expected(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[(t or "").translate(LOW)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        kept_left = 1
        for i in ids:
            kept = i == keep and kept_left == 1
            kept_left -= kept
            out.append((str(i), str(keep), len(ids), kept))
    return sorted(out)


@pytest.mark.parametrize("collide", [False, True])
def test_matches_brute_force(spark, collide):
    rows = hard_rows()
    options = {"digest": lambda t: F.pmod(F.length(t), F.lit(5)).cast("string")} if collide else {}
    got = exact_dedup(documents(spark, rows), salts=4, **options).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == expected(rows)


def test_rows_keep_their_columns(spark):
    docs = documents(spark, hard_rows())
    got = exact_dedup_rows(docs)
    assert got.columns == docs.columns
    assert got.count() == sum(k for *_, k in expected(hard_rows()))


def test_empty_table(spark):
    assert exact_dedup(documents(spark, hard_rows()).limit(0)).count() == 0


def test_a_file_listed_twice_is_read_twice(spark, tmp_dir):
    path = f"{tmp_dir}/docs.parquet"
    documents(spark, hard_rows()).write.parquet(path)
    twice = spark.read.parquet(path, path)
    assert twice.count() == 2 * len(hard_rows())
    once = exact_dedup_rows(spark.read.parquet(path)).count()
    assert exact_dedup_rows(twice).count() == once == sum(k for *_, k in expected(hard_rows()))
