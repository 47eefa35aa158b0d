"""Brute-force counterparts and hard small inputs for the operator tests."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Columns named like the operators' own, beside the ones they read.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, id long, digest string, "
    "size long, place int, quality string, fp long, shard int, word string"
)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def hard_rows() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): nulls, empty and very long texts, ties, repeats."""
    prose = "The quick brown fox jumps over the lazy dog while Édouard counts sheep in São Paulo again. "
    rows: list[tuple] = [
        (1, None, "a"), (2, "", "b"), (3, None, None), (4, "   \n\t ", "a"), (5, "one", "a"), (6, "one two", None),
        (7, prose * 3, "b"), (8, (prose * 3).upper().replace("É", "é"), "b"), (9, prose * 3, "c"),
        (10, prose * 2000, "a"), (11, prose * 2000, "a"), (11, prose * 2000, "a"), (12, prose, "b"), (12, prose, "b"),
        (None, prose, "a"), (None, None, "c"), (13, "ab " * 700, "c"), (14, "x" * 5000, "a"),
        (15, "zero\0byte and   separators   and emoji 🙂 " * 8, ""), (16, "E" + prose, "d"),
    ]
    rows += [(100 + i, f"copy of one text, many times over {prose}", "hot") for i in range(120)]
    rows += [(300 + i, f"{prose * 2} ending number {i} of them", "hot") for i in range(40)]
    return rows


def documents(spark, rows):
    full = [
        (i, t, "en", s, None if t is None else len(t), 1, 2, "d", 3, 4, "q", 5, 6, "w") for i, t, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def as_table(spark, df, folder: str):
    """As a table of files, which the operators that read twice ask for."""
    path = f"{folder}/documents.parquet"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def components(n: int, linked) -> list[int]:
    """Smallest member reachable from each of n items; ``linked(i)``: its neighbours."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(n):
        for j in linked(i):
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
