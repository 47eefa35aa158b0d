import hashlib
import re

import pytest

from odometrix.llm.phrase_index import decontaminate
from tests.llm.helpers import LOW, documents, hard_rows

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog while Édouard counts sheep in SÃO"),
    (2, "over the LAZY dog"),
    (3, "one"),
    (4, None),
    (5, "  ... "),
    (6, "words that no document has at all, none of them, never ever"),
    (7, "ab " * 25),
    (10, "sheep in São Paulo again. The quick brown fox jumps; ending number 7"),
    (None, "many times over the quick"),
    (2, "counts sheep"),
    (2, "over the LAZY dog"),
]


def tokens(text):
    return TOKEN.findall((text or "").translate(LOW))


def expected(rows, items, window=10, slop=2):
    docs = [(i, tokens(t)) for i, t, _ in rows]
    wanted = {w for _, t in items for w in tokens(t)}
    counts = {w: sum(ws.count(w) for _, ws in docs) for w in wanted}
    windows = set()
    for item, text in items:
        ws = tokens(text)
        size = min(window, len(ws))
        for s in range(len(ws) - size + 1) if ws else ():
            windows.add(("" if item is None else str(item), tuple(ws[s : s + size])))
    out = []
    for i, ws in docs:
        hit, exact, near = set(), set(), set()
        for item, win in windows:
            anchor = min(range(len(win)), key=lambda k: (counts[win[k]], k))
            for pos in (p for p, w in enumerate(ws) if w == win[anchor]):
                start = pos - anchor

                def within(k, d, start=start, win=win, ws=ws):
                    return any(0 <= start + k + e < len(ws) and ws[start + k + e] == win[k] for e in range(-d, d + 1))

                others = [k for k in range(len(win)) if k != anchor]
                if all(within(k, slop) for k in others):
                    near.add(item)
                    if all(within(k, 0) for k in others):
                        exact.add(item)
                        hit.update(range(start, start + len(win)))
        names = ",".join(sorted(exact))
        digest = hashlib.sha256(names.encode()).hexdigest()
        out.append((str(i), len(ws), len(hit), len(exact), digest, bool(hit), len(near)))
    return sorted(out)


def items_table(spark, items):
    rows = [(i, t, 7, "x", 1) for i, t in items]
    return spark.createDataFrame(rows, "item_id long, text string, row long, word string, term int")


@pytest.mark.parametrize("window, slop", [(10, 2), (4, 0), (1, 1)])
def test_matches_brute_force(spark, window, slop):
    rows = hard_rows()
    rows.append((400, "the brown quick fox jumps over lazy the dog while counts Édouard sheep in são Paulo", "z"))
    rows.append((401, "Ab AB ab\x00aB " * 6, "z"))
    got = decontaminate(documents(spark, rows), items_table(spark, ITEMS), window=window, slop=slop).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == expected(rows, ITEMS, window, slop)


def test_empty_tables(spark):
    docs, items = documents(spark, hard_rows()), items_table(spark, ITEMS)
    assert decontaminate(docs.limit(0), items).count() == 0
    clean = decontaminate(docs, items.limit(0))
    assert clean.count() == len(hard_rows()) and clean.filter("contaminated or n_near > 0").isEmpty()


def test_large_benchmark_joins_without_broadcast(spark, monkeypatch):
    from odometrix.llm import phrase_index

    monkeypatch.setattr(phrase_index, "BROADCAST_ROWS", 0)
    rows = hard_rows()
    got = decontaminate(documents(spark, rows), items_table(spark, ITEMS)).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == expected(rows, ITEMS)
