"""Secret scan: named patterns plus sliding-window entropy.

``assign``, ``access`` and ``hex`` spans come from patterns. ``entropy`` spans
come from candidate strings (runs of ``A-Za-z0-9+/_=-`` of at least one
window): a window of ``WINDOW`` characters slides over the candidate; the
counts of each symbol are updated by the character that enters and the one
that leaves, and with them S = sum of c * log2(c), so the window's Shannon
entropy is log2(WINDOW) - S / WINDOW. The candidate's character class sets the
threshold. The span runs from the first window at or above it to the end of
the last one. The allow-list suppresses candidates that only look random, and
windows with a phrase that marks an example: beside the phrase a key still counts.

Everything is one projection of built-in expressions over the whole text; the
costly parts run only on texts that hold a match.

Defined results: a null text counts as empty and has no spans; positions are
code points, end exclusive; rows are independent, so repeated rows give
repeated results, null ids as any others; an empty table gives no rows; other
columns are ignored or passed through unread, but for one named as the column that
``scan_secrets`` adds, which it replaces.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import array_prefix_sums, let, read_table

KINDS = ("assign", "access", "hex", "entropy")

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
# A whole run of 24 or more: the same spans as [0-9a-f]+ with short ones dropped.
HEX = r"[0-9a-f]{24,}"

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

# Character class -> (pattern of the whole candidate, entropy in bits from which
# a window is suspicious). The first class that fits holds.
CLASSES = {
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    "letters": (r"^[A-Za-z]+$", 3.9),  # compound names reach 3.8
    "base32": (r"^(?:[A-Z2-7]+|[a-z2-7]+)$", 3.3),
    "alnum": (r"^[A-Za-z0-9]+$", 3.6),
    "base64": (r"^[A-Za-z0-9+/_=-]+$", 3.65),
}

# Allow-list: candidates that are not secrets however mixed they look.
ALLOWED = (
    r"^(?:[^0-9A-Z]+|[^0-9a-z]+|[^0-9]*[+/_=-][^0-9]*)$",  # no digit, and one case or marks: words, paths, rules
    r"^[^A-Za-z]+$",  # no letter: numbers, dates, phone and card numbers
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"^(?:[A-Za-z]+[/_=-]+|[0-9]+[/_=-]+)+(?:[A-Za-z]+|[0-9]+)?$",  # words and numbers joined by marks
)
# Windows that hold one of these are not suspicious; what stands beside them may be.
PHRASES = r"(?i)(?:example|sample|dummy|placeholder|changeme|redacted|xxxx|0123456789|abcdefghij)"


def _spans(text: Column, pattern: str, wanted) -> Column:
    """array<struct<start, end, match>> of the leftmost non-overlapping matches
    of ``pattern`` for which ``wanted(match)`` holds. The text between matches
    (split on the same pattern) gives the positions."""
    kind = "array<struct<start:bigint,end:bigint,match:string>>"

    def place(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)

        def with_gaps(g: Column) -> Column:
            steps = F.transform(matches, lambda m, i: (F.length(F.get(g, i)) + F.length(m)).cast("long"))
            return let(
                array_prefix_sums(steps),
                lambda ends: F.transform(
                    matches,
                    lambda m, i: F.struct(
                        (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("match")
                    ),
                ),
            )

        return F.filter(let(gaps, with_gaps), lambda s: wanted(s["match"]))

    some = F.when(
        text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    )
    return F.coalesce(some, F.array().cast(kind))


def _allowed(candidate: Column) -> Column:
    hit = F.lit(False)
    for pattern in ALLOWED:
        hit = hit | candidate.rlike(pattern)
    return hit


def _threshold(candidate: Column) -> Column:
    out = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES.values()):
        out = F.when(candidate.rlike(pattern), F.lit(bits)).otherwise(out)
    return out


def hot_range(candidate: Column, window: int = WINDOW) -> Column:
    """struct<first, last>: starts of the first and last window of
    ``candidate`` whose entropy reaches its class's threshold and that hold no
    allowed phrase; nulls if none."""
    g = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    table = F.array(*[F.lit(x) for x in g])

    def code(at: Column) -> Column:  # place of the character in the alphabet, from 0
        return F.instr(F.lit(ALPHABET), F.substring(candidate, at + 1, F.lit(1))) - 1

    zero = F.transform(F.sequence(F.lit(0), F.lit(len(ALPHABET) - 1)), lambda _: F.lit(0))
    start = F.struct(
        zero.alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(limit: Column, gs: Column):
        def slide(acc: Column, i: Column) -> Column:
            full = i >= window
            moved = F.struct(code(i).alias("in"), F.when(full, code(i - window)).alias("out"))

            def count(m: Column) -> Column:
                c = acc["counts"]
                leaves = F.coalesce(F.get(c, m["out"]), F.lit(0))
                # What the entering symbol counts once the leaving one is gone.
                enters = F.get(c, m["in"]) - F.when(m["out"] == m["in"], 1).otherwise(0)
                s = (
                    acc["s"]
                    + F.when(full, F.get(gs, leaves - 1) - F.get(gs, leaves)).otherwise(0.0)
                    + F.get(gs, enters + 1)
                    - F.get(gs, enters)
                )
                counts = F.transform(
                    c,
                    lambda n, k: n
                    + F.when(k == m["in"], 1).otherwise(0)
                    - F.when(k == m["out"], 1).otherwise(0),
                )

                def judge(s: Column) -> Column:
                    hot = (i >= window - 1) & (F.lit(math.log2(window)) - s / window >= limit - 1e-9)
                    at = i - (window - 1)
                    hot = hot & ~F.substring(candidate, at + 1, F.lit(window)).rlike(PHRASES)
                    return F.struct(
                        counts.alias("counts"),
                        s.alias("s"),
                        F.when(hot & acc["first"].isNull(), at).otherwise(acc["first"]).alias("first"),
                        F.when(hot, at).otherwise(acc["last"]).alias("last"),
                    )

                return let(s, judge)

            return let(moved, count)

        return slide

    n = F.length(candidate)
    return let(
        F.struct(_threshold(candidate).alias("limit"), table.alias("g")),
        lambda p: F.aggregate(
            F.sequence(F.lit(0), n - 1),
            start,
            step(p["limit"], p["g"]),
            lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")),
        ),
    )


def secret_spans(text: Column) -> Column:
    """array<struct<start, place, end>> over a non-null text, sorted by start,
    then kind (``place`` in ``KINDS``), then end."""

    def tagged(spans: Column, kind: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), s["end"].alias("end")
            ),
        )

    assign = _spans(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)
    access = _spans(text, ACCESS, lambda m: F.length(m) >= 20)
    hexes = _spans(text, HEX, lambda m: F.length(m) >= 24)
    candidates = _spans(text, CANDIDATE, lambda m: ~_allowed(m))
    hot = F.filter(
        F.transform(candidates, lambda c: F.struct(c["start"].alias("start"), hot_range(c["match"]).alias("hot"))),
        lambda c: c["hot"]["first"].isNotNull(),
    )
    entropy = F.transform(
        hot,
        lambda c: F.struct(
            (c["start"] + c["hot"]["first"]).alias("start"),
            F.lit(KINDS.index("entropy")).alias("place"),
            (c["start"] + c["hot"]["last"] + WINDOW).alias("end"),
        ),
    )
    return F.sort_array(
        F.concat(tagged(assign, "assign"), tagged(access, "access"), tagged(hexes, "hex"), entropy)
    )


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """``docs`` with ``out_col``: array<struct<start, place, end>> of all spans."""
    return docs.withColumn(out_col, let(F.coalesce(F.col(text_col), F.lit("")), secret_spans))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"], s["end"])), ","
    )


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def digest(spans: Column) -> Column:
        def count(kind: str) -> Column:
            return F.size(F.filter(spans, lambda s: s["place"] == KINDS.index(kind))).cast("long")

        base = F.filter(spans, lambda s: s["place"] < KINDS.index("entropy"))
        return F.struct(
            *[count(k).alias(f"n_{k}") for k in KINDS],
            F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"),
            _joined(spans).alias("spans"),
        )

    return docs.select("doc_id", let(F.col("secrets"), digest).alias("found")).select("doc_id", "found.*")
