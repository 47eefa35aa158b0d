"""Benchmark decontamination with a distributed positional inverted index.

The training documents' tokens that are words of the benchmark at all (no other
token can take part in a match) are stored once as postings (term, document
row, position), sorted by term within each file: every file is the index of its
own documents. No posting is shuffled to build it.

A benchmark item is cut into windows of ten consecutive words; equal windows
of all items are one window. Its terms are ranked by their number of postings.
The list of the rarest term, less its offset in the window, gives candidate
places (document, start). They are intersected with the offset-adjusted list of
the second rarest term, and the few that are left with the lists of all other
terms. A list is met on (term, document, position), so a word or a passage that
is in a third of all documents is spread by document. A term may lie up to
``slop`` words from its place: with all terms at their places the match is an
exact phrase, otherwise a proximity match. A place whose rarest term is missing
is none of either.

Only tables about the benchmark (its terms, windows and their ranks) are ever
broadcast, after their rows are counted; beyond ``BROADCAST_ROWS`` the join is
left to Spark.

Defined results: a null or empty text has no words; a null item id makes an
item whose name is empty; rows of one item id are one item; repeated document
rows are separate rows; an empty benchmark finds nothing; no documents, no
rows; columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odometrix.llm.common import ascii_lower, materialize, read_table

WINDOW = 10
SLOP = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 200_000  # of at most about 60 bytes each
END = -1  # the "term" of the posting at a document's end: its position is the word count


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z: an array, empty for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.array_remove(parts, "")


def _small(table: DataFrame) -> DataFrame:
    """``table``, marked for broadcast if counting finds it small."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, place, word): the words of every item, written once."""
    rows = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.monotonically_increasing_id().alias("item_row"),
        words_of(F.col(text_col)).alias("words"),
    )
    return materialize(rows.select("item", "item_row", F.posexplode("words").alias("place", "word")), "phrase-items")


def term_numbers(words: DataFrame) -> DataFrame:
    """(word, term): a number for each different word, and END for the empty one."""
    spark = words.sparkSession
    numbers = words.select("word").distinct().withColumn("term", F.monotonically_increasing_id())
    end = spark.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term"))
    return materialize(numbers.unionByName(end), "phrase-terms")


def build_postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The index: (term, row, pos, id). One pass over all whole texts, sorted by
    term within each file. A document's END posting has its word count as
    ``pos`` and carries its id, which is null in all others."""
    # The row's number first, by itself: beside a generator it would number tokens.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.array_append(words_of(F.col(text_col)), F.lit("")).alias("words"),
    )
    tokens = rows.select("row", "id", F.posexplode("words").alias("pos", "word"))
    found = tokens.join(_small(terms), "word").select(
        "term", "row", "pos", F.when(F.col("term") == END, F.col("id")).alias("id")
    )
    return materialize(found.sortWithinPartitions("term", "row", "pos"), "phrase-postings")


def ranked_windows(words: DataFrame, terms: DataFrame, postings: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Windows that can occur, and the items they are of.

    (win, size, ranks): ranks are (n, off, term) from the rarest term to the
    commonest, n its postings; (win, item): one row per window and item."""
    counts = materialize(
        postings.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "phrase-counts"
    )
    known = words.join(terms, "word").join(counts, "term", "left")
    items = known.groupBy("item", "item_row").agg(
        F.sort_array(F.collect_list(F.struct("place", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("seq")
    )
    size = F.least(F.size("seq"), F.lit(window))
    cut = items.select(
        "item",
        "seq",
        size.alias("size"),
        F.explode(F.sequence(F.lit(1), F.size("seq") - size + 1)).alias("first"),
    ).select("item", "size", F.slice("seq", F.col("first"), F.col("size")).alias("part"))
    possible = cut.filter(~F.exists("part", lambda t: t["n"] == 0)).withColumn("key", F.col("part.term"))
    ranks = F.sort_array(
        F.transform("part", lambda t, i: F.struct(t["n"].alias("n"), i.alias("off"), t["term"].alias("term")))
    )
    of_items = materialize(
        possible.select("item", "size", "key", ranks.alias("ranks")).distinct(), "phrase-item-windows"
    )
    windows = materialize(
        of_items.groupBy("key")
        .agg(F.first("size").alias("size"), F.first("ranks").alias("ranks"))
        .withColumn("win", F.monotonically_increasing_id()),
        "phrase-windows",
    )
    return windows.drop("key"), of_items.join(windows.select("key", "win"), "key").select("win", "item")


def _near(place: Column, slop: int) -> Column:
    """(pos, at): the positions that a term whose place is ``place`` may have."""
    steps = sorted(range(-slop, slop + 1), key=abs)
    return F.inline(F.array(*[F.struct((place + s).alias("pos"), F.lit(s == 0).alias("at")) for s in steps]))


def phrase_matches(windows: DataFrame, postings: DataFrame, slop: int = SLOP) -> DataFrame:
    """(win, size, row, start, exact): every place of every window, written once."""
    lists = postings.filter(F.col("term") != END).select("term", "row", "pos")

    first = windows.select("win", "size", F.col("ranks")[0]["term"].alias("term"), F.col("ranks")[0]["off"].alias("off"))
    starts = (
        lists.join(_small(first), "term")
        .select("win", "row", (F.col("pos") - F.col("off")).alias("start"))
        .filter(F.col("start") >= -slop)
    )
    ranked = windows.select("win", "size", "ranks")
    single = ranked.filter("size = 1").select("win")
    more = ranked.filter("size > 1")

    # The second rarest list, cut to the terms that are second to any window.
    second = more.select("win", F.col("ranks")[1]["term"].alias("term"), F.col("ranks")[1]["off"].alias("off"))
    probes = starts.join(_small(second), "win").select(
        "win", "row", "start", "term", _near(F.col("start") + F.col("off"), slop)
    )
    short = lists.join(_small(second.select("term").distinct()), "term", "left_semi")
    pairs = materialize(
        probes.join(short, ["term", "row", "pos"]).groupBy("win", "row", "start").agg(F.max("at").alias("exact")),
        "phrase-pairs",
    )

    # All other lists, for the few places left.
    rest = more.select("win", "size", F.explode(F.slice("ranks", 3, 1 << 30)).alias("r")).select(
        "win", "size", F.col("r.off").alias("off"), F.col("r.term").alias("term")
    )
    probes = pairs.join(_small(rest), "win").select(
        "win", "row", "start", "size", "off", "term", _near(F.col("start") + F.col("off"), slop)
    )
    rows = pairs.select("row").distinct()
    tail = lists.join(_small(rest.select("term").distinct()), "term", "left_semi")
    tail = tail.join(_small(materialize(rows, "phrase-rows")), "row", "left_semi")
    at_place = (
        probes.join(tail, ["term", "row", "pos"])
        .groupBy("win", "row", "start", "size", "off")
        .agg(F.max("at").alias("at"))
        .groupBy("win", "row", "start", "size")
        .agg(F.count(F.lit(1)).alias("found"), F.min("at").alias("at"))
        .filter(F.col("found") == F.col("size") - 2)
    )
    long_ones = pairs.join(at_place, ["win", "row", "start"]).select(
        "win", "size", "row", "start", (F.col("exact") & F.col("at")).alias("exact")
    )
    two = pairs.join(_small(more.filter("size = 2").select("win", "size")), "win").select(
        "win", "size", "row", "start", "exact"
    )
    one = starts.join(_small(single), "win").select("win", F.lit(1).alias("size"), "row", "start", F.lit(True).alias("exact"))
    return materialize(long_ones.unionByName(two).unionByName(one), "phrase-matches")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    *,
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit`` (words inside an exact
    occurrence of a window), ``n_items`` and ``items_sha256`` (items with exact
    occurrences), ``contaminated``, and ``n_near``: items with exact or
    proximity matches."""
    words = item_words(items, item_col, item_text)
    terms = term_numbers(words)
    postings = build_postings(docs, terms, id_col, text_col)
    windows, of_items = ranked_windows(words, terms, postings, window)
    matches = phrase_matches(windows, postings, slop)

    # Words covered by the union of a document's exact occurrences.
    spans = (
        matches.filter("exact").groupBy("row", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    )
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = (
        spans.select("row", F.greatest(fresh, F.lit(0)).alias("n"))
        .groupBy("row")
        .agg(F.sum("n").cast("long").alias("n_hit"))
    )
    found = (
        matches.groupBy("row", "win").agg(F.max("exact").alias("exact"))
        .join(of_items, "win").groupBy("row", "item").agg(F.max("exact").alias("exact"))
        .groupBy("row").agg(
            F.count_if("exact").alias("n_items"),
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))), ",").alias("names"),
            F.count(F.lit(1)).alias("n_near"),
        )
    )
    rows = postings.filter(F.col("term") == END).select("row", "id", F.col("pos").cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return (
        rows.join(found, "row", "left")
        .join(hits, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce("n_hit", zero).alias("n_hit"),
            F.coalesce("n_items", zero).alias("n_items"),
            F.sha2(F.encode(F.coalesce("names", F.lit("")), "UTF-8"), 256).alias("items_sha256"),
            (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
            F.coalesce("n_near", zero).alias("n_near"),
        )
    )


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), b AS (
  SELECT row_number() OVER () AS br, coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS ws FROM benchmark
), bw AS (
  SELECT br, item, least(len(ws), {WINDOW}) AS size, len(ws) AS n_ws,
         unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM b
), tok AS (
  SELECT r, w, pos FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d)
  WHERE w IN (SELECT w FROM bw)
), freq AS (
  SELECT w, count(*) AS n FROM tok GROUP BY w
), cells AS (
  SELECT f.br, f.item, f.i AS win, f.size, t.i - f.i AS off, t.w, coalesce(q.n, 0) AS n
  FROM bw f JOIN bw t ON t.br = f.br AND t.i BETWEEN f.i AND f.i + f.size - 1 LEFT JOIN freq q ON q.w = t.w
  WHERE f.i <= f.n_ws - f.size + 1
), good AS (
  SELECT *, row_number() OVER (PARTITION BY br, win ORDER BY n, off) AS rank,
         min(n) OVER (PARTITION BY br, win) AS least FROM cells
), cand AS (
  SELECT g.br, g.item, g.win, g.size, t.r, t.pos - g.off AS start
  FROM good g JOIN tok t ON t.w = g.w WHERE g.rank = 1 AND g.least > 0
), near AS (
  SELECT c.br, c.item, c.win, c.size, c.r, c.start, g.off, max(t.pos = c.start + g.off) AS at_place
  FROM cand c JOIN good g ON g.br = c.br AND g.win = c.win
  JOIN tok t ON t.r = c.r AND t.w = g.w
   AND abs(t.pos - c.start - g.off) <= CASE WHEN g.rank = 1 THEN 0 ELSE {SLOP} END
  GROUP BY ALL
), hit AS (
  SELECT br, item, win, size, r, start, min(at_place) AS exact FROM near GROUP BY ALL HAVING count(*) = size
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(start, start + size)) AS p FROM hit WHERE exact) GROUP BY r
), per_item AS (
  SELECT r, item, max(exact) AS exact FROM hit GROUP BY r, item
), named AS (
  SELECT r, count(*) FILTER (exact) AS n_items, count(*) AS n_near,
         string_agg(item, ',' ORDER BY item) FILTER (exact) AS names FROM per_item GROUP BY r
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(m.n_items, 0)::BIGINT AS n_items, sha256(coalesce(m.names, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated, coalesce(m.n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN covered c ON c.r = d.r LEFT JOIN named m ON m.r = d.r
"""
