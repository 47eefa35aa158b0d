from itertools import combinations

import numpy as np
import pytest
import xxhash

from odometrix.llm import golay
from odometrix.llm.simhash import components, links, near_distinct, simhash_components
from tests.llm.helpers import LOW, components as brute_components, documents, hard_rows, words


def test_golay_code():
    rest = golay._tables()[0]
    codewords = np.array([(m << 11) | int(rest[m]) for m in range(4096)])
    distances = {bin(int(a ^ b)).count("1") for a, b in zip(codewords, np.roll(codewords, 1), strict=True)}
    assert min(distances) >= 7
    w = np.random.default_rng(1).integers(0, 1 << 23, 200)
    d = np.bitwise_count(w[:, None] ^ codewords[None, :])
    assert (d.min(axis=1) <= 3).all() and (d.argmin(axis=1) == golay.nearest(w)).all()
    which, index = golay.within4(w)
    for k in range(len(w)):
        assert set(index[which == k]) == set(np.nonzero(d[k] <= 4)[0])


@pytest.mark.parametrize("max_bucket", [256, 3, 0])
@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_components_of_all_links(spark, max_bits, max_bucket):
    r = np.random.default_rng(max_bits)
    values = {int(x) for x in r.integers(0, 1 << 63, 60, dtype="u8")}
    for b in list(values)[:40]:
        for _ in range(5):
            x = b
            for _ in range(r.integers(1, 4)):
                x ^= 1 << int(r.integers(0, 64))
            values.add(x)
    values |= {0} | {(1 << i) | (1 << j) for i, j in combinations(range(0, 64, 9), 2)}
    fps = np.array(sorted(values), "u8")
    want = brute_components(len(fps), lambda i: np.nonzero(np.bitwise_count(fps[i] ^ fps) <= max_bits)[0])
    nodes = spark.createDataFrame([(int(x),) for x in fps.view("i8")], "fp long")
    root = {r.node: r.root for r in components(links(nodes, max_bits, max_bucket)).collect()}
    names = [root.get(int(x), int(x)) for x in fps.view("i8")]
    assert len(set(zip(names, want, strict=True))) == len(set(names)) == len(set(want))


def test_links_outside_crowded_buckets_are_all_links(spark):
    fps = np.array([0, 1, 3, 7, 1 << 40, (1 << 40) | (1 << 41) | (1 << 63)], "u8")
    want = {
        tuple(sorted((int(a), int(b))))
        for a, b in combinations(fps.view("i8"), 2)
        if np.bitwise_count(np.int64(a).astype("u8") ^ np.int64(b).astype("u8")) <= 2
    }
    nodes = spark.createDataFrame([(int(x),) for x in fps.view("i8")], "fp long")
    assert {tuple(r) for r in links(nodes).collect()} == want


def fingerprint(text):
    w = words((text or "").translate(LOW))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_documents_match_brute_force(spark):
    rows = [r for r in hard_rows() if r[0] is not None]
    fps = np.array([fingerprint(t) for _, t, _ in rows], "u8")
    group = brute_components(len(rows), lambda i: np.nonzero(np.bitwise_count(fps[i] ^ fps) <= 2)[0])
    least: dict = {}
    for k, (i, _, _) in enumerate(rows):
        least[group[k]] = min(least.get(group[k], i), i)
    docs = documents(spark, rows)
    got = simhash_components(docs).collect()
    assert sorted((r.id, r.fp & (2**64 - 1), r.component_id) for r in got) == sorted(
        (i, int(fps[k]), least[group[k]]) for k, (i, _, _) in enumerate(rows)
    )
    assert sum(r.stays for r in got) == len(least)
    kept = near_distinct(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_null_ids_and_empty_table(spark):
    docs = documents(spark, hard_rows())
    got = simhash_components(docs)
    assert got.count() == len(hard_rows())
    assert got.filter("component_id is null and id is not null").count() == 0
    assert simhash_components(docs.limit(0)).count() == 0
