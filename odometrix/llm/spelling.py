"""Spelling variants by dynamic programming over sorted word lists.

Two words are near if one inserted, deleted or replaced code point tells them
apart. A query word is held against a sorted list with a banded edit matrix
(three cells a row) whose rows are kept: the next word starts at the row of its
common prefix (LCP) with the one before, and when a row has no cell below two,
the whole range of words that share this prefix is skipped.

The sorted vocabulary is not scanned by one task. For a pair whose shorter word
has L code points, an edit behind the first h = L // 2 of them leaves these as
common prefix; any other leaves the last L - h as common suffix. So the pair
meets in a range of the list of words sorted forwards (words of L or L + 1 with
one prefix of h) or in one of the words sorted backwards (one suffix of L - h),
and each range is scanned by itself. A range of more than ``CELL_CHARS`` code
points is cut into k query parts by k list parts of that size. Tasks scan all
queries of many ranges at once, one row step of each at a time, in numpy.

A word's form is its near word of most occurrences if that has twice its own;
counts double along forms, so following them to the root takes a few rounds of
pointer jumping.

Defined results: a null or empty text has no words; a null id counts as an empty
one; repeated rows count each; a table without words gives no rows; columns other
than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import ascii_lower, materialize, read_table, ship_package

LETTERS = r"[A-Za-zÀ-ÿ]"
OTHERS = r"[^A-Za-zÀ-ÿ]+"
MIN_CHARS = 5
MIN_COUNT = 3
TYPO_ONE_IN = 97
CELL_CHARS = 1 << 17
CHUNK_CHARS = 1 << 19  # of ranges scanned together


def with_typos(run: Column, doc_id: Column, one_in: int) -> Column:
    """The run less one code point where the hash of id and run says so."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(F.encode(seed, "UTF-8"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(h % one_in == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_count: int, one_in: int) -> DataFrame:
    """(word, n): words of at least so many code points and occurrences, written
    once. Counts are combined in each task, so a common word costs it one row."""
    runs = docs.select(
        F.col(id_col).alias("id"), F.explode(F.split(F.coalesce(text_col, F.lit("")), OTHERS)).alias("run")
    ).filter(F.length("run") >= min_chars)
    words = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    words = words.select(with_typos(F.col("run"), F.col("id"), one_in).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count)), "spelling-words")


def ranges(words: DataFrame, min_chars: int) -> DataFrame:
    """(size, cell, s, n, query, listed): every word in the ranges it is part of.

    ``size`` is the length L of the shorter word of the pairs looked for there;
    ``s`` the word as the range sorts it; queries are the words of L."""
    length = F.length("word")
    h = F.floor(F.col("size") / 2).cast("int")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size")).filter(
        F.col("size") >= min_chars
    )
    back = F.reverse("word")
    rows = rows.select(
        "n",
        "size",
        (F.length("word") == F.col("size")).alias("short"),
        F.inline(
            F.array(
                F.struct(F.lit("f").alias("way"), F.col("word").alias("s"), F.substring("word", F.lit(1), h).alias("key")),
                F.struct(F.lit("b").alias("way"), back.alias("s"), F.substring(back, F.lit(1), F.col("size") - h).alias("key")),
            )
        ),
    )
    by = ["way", "size", "key"]
    parts = F.ceil(F.count(F.lit(1)) * F.col("size") / CELL_CHARS).cast("int")
    large = materialize(rows.groupBy(*by).agg(parts.alias("parts")).filter("parts > 1"), "spelling-large-ranges")
    rows = rows.join(large, by, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("s"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)

    def cell(i: Column, j: Column, query: Column, listed: bool) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), query.alias("query"), F.lit(listed).alias("listed"))

    own = F.col("own")
    as_list = F.transform(every, lambda i: cell(i, own, F.col("short") & (i == own), True))
    as_query = F.transform(F.filter(every, lambda j: F.col("short") & (j != own)), lambda j: cell(own, j, F.lit(True), False))
    rows = rows.select("way", "size", "key", "s", "n", F.inline(F.concat(as_list, as_query)))
    name = F.concat_ws(":", "way", "i", "j", "key")
    return rows.select("size", name.alias("cell"), "s", "n", "query", "listed")


def _code_points(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), "u4")
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    return out


def sorted_scan(size: int, cells: list[tuple[list[str], list[str]]]) -> tuple[np.ndarray, np.ndarray]:
    """(query, listed): indices into the concatenated queries and lists of all
    pairs at edit distance one. ``cells`` are (queries of ``size`` code points,
    sorted list of words of ``size`` or one more); a query meets its own list."""
    queries = [q for qs, _ in cells for q in qs]
    listed = [w for _, ws in cells for w in ws]
    ends = np.cumsum([len(ws) for _, ws in cells])
    lanes = np.repeat(np.arange(len(cells)), [len(qs) for qs, _ in cells])
    end = ends[lanes]
    pos = end - np.array([len(ws) for _, ws in cells])[lanes]
    if not queries or not listed:
        return np.zeros(0, "i8"), np.zeros(0, "i8")

    q = np.pad(_code_points(queries, size), ((0, 0), (1, 2)))  # q[:, j]: the j-th code point, from 1
    v = _code_points(listed, size + 1)
    n = len(listed)
    v_len = np.array([len(w) for w in listed])
    # Common prefix with the word before, and the next word that leaves a prefix.
    lcp = np.zeros(n + 1, "i8")
    if n > 1:
        same = v[1:] == v[:-1]
        lcp[1:n] = np.minimum(np.where(same.all(1), size + 1, same.argmin(1)), np.minimum(v_len[1:], v_len[:-1]))
    after = np.full((size + 2, n + 1), n, "i8")
    place = np.arange(n + 1)
    for d in range(1, size + 2):
        leaves = np.where(lcp[1:] < d, place[1:], n)
        after[d, :n] = np.minimum.accumulate(leaves[::-1])[::-1]

    rows = np.full((len(queries), size + 2, 3), 2, "i1")  # cells j = d - 1, d, d + 1 of row d
    rows[:, 0, 1], rows[:, 0, 2] = 0, 1
    lane = np.flatnonzero(pos < end)
    pos, end = pos[lane], end[lane]
    d = np.zeros(len(lane), "i8")
    found_q, found_v = [], []
    while len(lane):
        old = rows[lane, d]
        c = v[pos, d]
        # D[d+1][j] for j = d, d+1, d+2; a cell outside the band or the query is 2.
        a = np.minimum(old[:, 0] + (q[lane, d] != c), old[:, 1] + 1)
        b = np.minimum(np.minimum(old[:, 1] + (q[lane, np.minimum(d + 1, size + 2)] != c), old[:, 2] + 1), a + 1)
        b[d + 1 > size] = 2
        e = np.minimum(old[:, 2] + (q[lane, np.minimum(d + 2, size + 2)] != c), b + 1)
        e[d + 2 > size] = 2
        d = d + 1
        new = np.minimum(np.stack([a, b, e], axis=1), 2)
        rows[lane, d] = new
        over = new.min(axis=1) > 1
        at_end = ~over & (d == v_len[pos])
        hit = at_end & (np.where(d == size, new[:, 1], new[:, 0]) == 1)
        if hit.any():
            found_q.append(lane[hit])
            found_v.append(pos[hit])
        move = over | at_end
        pos = np.where(over, after[d, pos], pos + at_end)
        d = np.where(move, lcp[pos], d)
        go = pos < end
        if not go.all():
            lane, pos, end, d = lane[go], pos[go], end[go], d[go]
    if not found_q:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    return np.concatenate(found_q), np.concatenate(found_v)


PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _pairs(size: int, cells: list[tuple[str, list[tuple[str, int]], list[tuple[str, int]]]]) -> pa.RecordBatch:
    """Near pairs of ranges of one size, each pair once in either direction."""
    found = sorted_scan(size, [([w for w, _ in qs], [w for w, _ in ws]) for _, qs, ws in cells])
    queries = [(way, *q) for way, qs, _ in cells for q in qs]
    listed = [w for _, _, ws in cells for w in ws]
    h = size // 2
    out: list[tuple[str, str, int]] = []
    for i, j in zip(*(x.tolist() for x in found)):
        way, a, n_a = queries[i]
        b, n_b = listed[j]
        if way == "b":
            a, b = a[::-1], b[::-1]
            if a[:h] == b[:h]:  # met forwards too
                continue
        out.append((a, b, n_b))
        if len(b) > size:  # only the shorter word of two is a query
            out.append((b, a, n_a))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PAIRS)], schema=PAIRS)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in (size, cell, s) order: ranges of one size are scanned in chunks."""
    chunk: list = []
    size, name, chars = 0, None, 0
    queries: list[tuple[str, int]] = []
    words: list[tuple[str, int]] = []

    def close() -> int:
        if queries and len(words) + len(queries) > 1 and words:
            chunk.append((name[0], queries, words))
            return size * (len(words) + len(queries))
        return 0

    for batch in batches:
        for at, cell, s, n, query, listed in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if cell != name or at != size:
                chars += close()
                if chunk and (at != size or chars >= CHUNK_CHARS):
                    yield _pairs(size, chunk)
                    chunk, chars = [], 0
                size, name, queries, words = at, cell, [], []
            if query:
                queries.append((s, n))
            if listed:
                words.append((s, n))
    close()
    if chunk:
        yield _pairs(size, chunk)


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, near, near_n): every ordered pair of near words of ``words``."""
    ship_package(words.sparkSession)
    cells = ranges(words, min_chars)
    ordered = cells.repartition("size", "cell").sortWithinPartitions("size", "cell", "s")
    return ordered.mapInArrow(_scan, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): pointer jumping, a written table a round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = materialize(now.join(step, "root", "left"), "spelling-roots")
        now = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further is not null").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    typo_one_in: int = TYPO_ONE_IN,
) -> DataFrame:
    """One row per word of ``vocabulary``: ``form``, ``root``, ``n``, ``n_near``
    and ``form_n``."""
    words = vocabulary(docs, id_col, text_col, min_chars, min_count, typo_one_in)
    near = near_pairs(words, min_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    twice = F.col("best.minus") * -1 >= 2 * F.col("n")
    known = materialize(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(twice, F.col("best.near")).alias("form"),
            F.when(twice, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-near",
    )
    last = roots(known.filter("form is not null"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP13_SQL = f"""
WITH RECURSIVE step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8
), runs AS (
  SELECT doc_id, w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_AZ}), '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= {MIN_CHARS} GROUP BY doc_id, w
), hashed AS (
  SELECT w, k, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc
), words AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT k, CASE WHEN h % {TYPO_ONE_IN} = 0
                  THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(k) >= {MIN_COUNT}
), less AS (
  SELECT word, n, length(word) AS size, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b
  ON a.rest = b.rest AND a.i = b.i AND a.size = b.size AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS best_n, arg_min(near, (-near_n, near)) AS best
  FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * w.n THEN b.best END AS form,
         CASE WHEN b.best_n >= 2 * w.n THEN b.best_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, last_word, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.form
)
SELECT f.word, f.form, c.last_word AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.form IS NULL
"""
