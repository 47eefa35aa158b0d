import random
import re
import zlib
from collections import Counter

import pytest

from odometrix.llm import spelling
from odometrix.llm.spelling import sorted_scan, spelling_variants
from tests.llm.helpers import LOW, documents, hard_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows, one_in):
    counts = Counter()
    for i, text, _ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % one_in == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    found = {w: [v for v in counts if near(w, v)] for w in counts}
    forms = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(found[w]), counts.get(forms[w])))
    return sorted(out, key=str)


def rows_of():
    rng = random.Random(5)
    words = ["".join(rng.choice("abéÿ") for _ in range(rng.randint(4, 7))) for _ in range(260)]
    rows = [(20_000 + i, " ".join(rng.choices(words, k=40)).title(), "s") for i in range(60)]
    chain = "spelling spellings spellinqs spellinqz"  # each form twice as common as the next
    rows += [(30_000 + i, " ".join(w for k, w in enumerate(chain.split()) if i % (3**k) == 0), "s") for i in range(160)]
    return hard_rows() + rows + [(40_000 + i, "z" * 3000 + " " + "z" * (3000 + i % 2), "t") for i in range(8)]


@pytest.mark.parametrize("cell_chars, one_in", [(1 << 17, 97), (120, 5)])
def test_matches_brute_force(spark, monkeypatch, cell_chars, one_in):
    monkeypatch.setattr(spelling, "CELL_CHARS", cell_chars)
    rows = rows_of()
    got = [tuple(r) for r in spelling_variants(documents(spark, rows), typo_one_in=one_in).collect()]
    want = expected(rows, one_in)
    assert sorted(got, key=str) == want
    assert any(r[1] not in (None, r[2]) for r in want)  # a form that has a form


def test_empty_table(spark):
    assert spelling_variants(documents(spark, hard_rows()).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_scan_matches_all_pairs(seed):
    rng = random.Random(seed)
    size = rng.randint(1, 7)
    cells = []
    for _ in range(rng.randint(1, 5)):
        pool = {"".join(rng.choice("ab🙂") for _ in range(rng.choice((size, size + 1)))) for _ in range(rng.randint(0, 60))}
        words = sorted(pool)
        cells.append(([w for w in words if len(w) == size], words))
    q, v = sorted_scan(size, cells)
    queries = [(k, w) for k, (qs, _) in enumerate(cells) for w in qs]
    listed = [(k, w) for k, (_, ws) in enumerate(cells) for w in ws]
    want = [(i, j) for i, a in enumerate(queries) for j, b in enumerate(listed) if a[0] == b[0] and near(a[1], b[1])]
    assert sorted(zip(q.tolist(), v.tolist())) == want
