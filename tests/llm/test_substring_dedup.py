import hashlib
import random

import pytest
from pyspark.sql import functions as F

import odometrix.llm.substring_dedup as sub
from odometrix.llm.deep_shallow import BlindTrie, common_prefix, deep_shallow_order, neighbour_prefixes
from tests.llm.helpers import as_table, documents, hard_rows


def test_deep_shallow_order():
    r = random.Random(5)
    for _ in range(150):
        texts = [bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 40))) for _ in range(r.randint(1, 80))]
        if r.random() < 0.5:
            texts = [b"long common prefix x" + t for t in texts]
        order = deep_shallow_order(texts)
        assert sorted(order) == list(range(len(texts))) and [texts[i] for i in order] == sorted(texts)
        for k, n in enumerate(neighbour_prefixes(texts, order).tolist()):
            assert k == 0 or n == common_prefix(texts[order[k - 1]], texts[order[k]])


def test_blind_trie_holds_equal_strings():
    texts = [b"abc", b"ab", b"abc", b"", b"abd", b"ab"]
    trie = BlindTrie(texts)
    for i in range(len(texts)):
        trie.insert(i)
    assert [texts[i] for i in trie.ordered()] == sorted(texts)
    assert common_prefix(b"\0\0a", b"\0\0b") == 2 and common_prefix(b"", b"x") == 0


def brute(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (t or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - 99):
            w = raw[k : k + 100]
            if w in seen:
                covered[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, m in zip(raw, covered, strict=True) if not m)
        runs = sum(1 for k in range(len(raw)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((str(i), len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows_with_passages():
    r = random.Random(9)
    passages = ["".join(r.choice("abcdef é\n") for _ in range(r.randint(90, 400))) for _ in range(10)]
    rows = [(5000, "a" * 1000), (5001, "a" * 99), (5002, "a" * 100), (5003, "ab" * 300), (5006, "é" * 400)]
    for i in range(200):
        parts = []
        for _ in range(r.randint(0, 5)):
            p = r.choice(passages)
            parts.append(r.choice([p, p[r.randint(0, 50) : r.randint(60, 400)], "".join(r.choice("abc ") for _ in range(r.randint(0, 60)))]))
        rows.append((6000 + i, "".join(parts)))
    return rows


@pytest.mark.parametrize("max_regions, chunk", [(50_000, 1 << 21), (2, 3000)])
def test_matches_brute_force(spark, tmp_path, monkeypatch, max_regions, chunk):
    monkeypatch.setattr(sub, "CHUNK", chunk)
    rows = rows_with_passages() + [(i, t) for i, t, _ in hard_rows() if t is None or len(t) < 100_000]
    # Fully repeated rows and rows of one id tie; any order of them removes as much.
    docs = as_table(spark, documents(spark, [(i, t, "s") for i, t in rows]), str(tmp_path))
    got = sub.remove_repeats(docs, max_regions=max_regions).select(
        "id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("sha")
    )
    got = sorted((str(r.id), r.n_bytes, r.n_removed, r.n, r.sha) for r in got.collect())
    want = brute(rows)
    single = [r for r in want if sum(x[0] == r[0] for x in want) == 1]
    assert [r for r in got if r[0] in {x[0] for x in single}] == single
    assert sum(r[2] for r in got) == sum(r[2] for r in want)


def test_long_text_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sub, "CHUNK", 5000)
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh") for _ in range(12_000))
    rows = [(1, text + text[3000:9000]), (2, text[100:11_900])]
    docs = as_table(spark, documents(spark, [(i, t, "s") for i, t in rows]), str(tmp_path))
    got = sub.remove_repeats(docs).select("id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("sha"))
    assert sorted((str(x.id), *x[1:]) for x in got.collect()) == brute(rows)


def test_empty_table(spark, tmp_path):
    docs = as_table(spark, documents(spark, hard_rows()).limit(0), str(tmp_path))
    assert sub.remove_repeats(docs).count() == 0


def test_merge_spans():
    assert sub.merge_spans([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
