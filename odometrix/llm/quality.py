"""Quality rules: line-first cleaning, then a verdict on the document.

Every line of a text is judged by itself; failing lines are removed; a document
is rejected when its base statistics fail or when cleaning removed more than
``max_lost`` of its words. A line with words fails when it is

* ``punctuation``: less than ``min_letters`` of its characters (spaces apart)
  are letters or digits, or more than ``max_symbol_words`` of its words carry
  one of the symbols ``# * $ % & | < >``;
* ``navigation``: at least three of the separators ``| > / - * «»`` and bullets
  stand alone between its words, and they make up a quarter of its words;
* ``boilerplate``: it has at most ``max_boilerplate_words`` words and holds a
  licence, rights or cookie notice, a link to terms, or other page furniture, in
  English, German, French or Spanish (the patterns in ``BOILERPLATE``).

Lines without a word are neither judged nor removed. All of it is one
projection of built-in expressions: no shuffle, no Python.

Defined results: a null text has no words, fails the base rules and cleans to
the empty text; texts of any length are read whole; rows are independent, so
repeated rows give repeated results; other columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm.common import SPACES, WORD, let, read_table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5
MIN_LETTERS = 0.6
MAX_SYMBOL_WORDS = 0.5
MAX_BOILERPLATE_WORDS = 40

SYMBOLS = r"#*$%&|<>"
SEPARATORS = ("|", ">", "/", "*", "-", "«", "»", "•", "·", "::", ">>")

# Notices and page furniture in the languages of the texts, as patterns that start
# where no letter A-Z stands before. A space stands for any white space; letters
# outside A-Z are given in both cases, since only A-Z is matched in either.
BOILERPLATE = {
    "licences": (
        r"licen[cs]ed (?:to you )?under", r"under (?:[^ ]+ ){0,8}licen[cs]e", r"general public licen[cs]e",
        r"(?:mit|bsd|isc|apache|mozilla|eclipse)(?: [^ ]+){0,2} licen[cs]e", r"(?:mit|bsd|gpl|apache)-lizenz",
        r"creative commons", r"cc(?: |-)by(?:-[a-z]{2})* [1-4]\.0", r"spdx-license-identifier",
        r"lizenziert unter", r"unter (?:[^ ]+ ){1,6}[^ ]*lizenz", r"sous (?:la |une )?licence",
        r"bajo (?:la |una )?licencia", r"licenciado bajo",
    ),
    "rights": (
        r"all rights reserved", r"alle rechte vorbehalten", r"tous (?:les )?droits r[eéÉ]serv[eéÉ]s",
        r"todos los derechos reservados", r"(?:copyright|©|\(c\))(?: |,|©|\(c\)){0,3}(?:19|20)[0-9]{2}",
    ),
    "terms": (
        r"(?:cookie|privacy) (?:policy|notice|settings|preferences)", r"terms (?:of use|of service|and conditions)",
        r"datenschutz(?:erkl|richtl|hinw|bestimm|einst)", r"nutzungsbedingungen", r"impressum",
        r"cookie-(?:richtlinie|einstellungen)", r"politique (?:de confidentialit|des? cookies)",
        r"mentions l[eéÉ]gales", r"conditions (?:d['’]utilisation|g[eéÉ]n[eéÉ]rales)",
        r"pol[iíÍ]tica de (?:privacidad|cookies)", r"aviso legal", r"(?:t[eéÉ]rminos|condiciones) (?:de uso|del? servicio)",
    ),
    "cookies": (
        r"(?:we|this (?:web)?site) uses? cookies", r"accept (?:all )?cookies",
        r"(?:wir|diese (?:web)?(?:seite|site)) (?:verwende[tn]|nutz(?:t|en)) cookies", r"cookies (?:akzeptieren|zulassen)",
        r"(?:nous utilisons|ce site utilise) des cookies", r"accepter (?:tous )?les cookies",
        r"(?:utilizamos|usamos|este sitio (?:web )?(?:utiliza|usa)) cookies", r"aceptar (?:todas las )?cookies",
    ),
    "furniture": (
        r"powered by", r"click here", r"sign up", r"subscribe to", r"log in to", r"skip to (?:main )?content",
        r"back to top", r"share this", r"lorem ipsum", r"enable javascript",
        r"zum (?:haupt)?inhalt springen", r"klicken sie hier", r"newsletter (?:abonnieren|anmelden)",
        r"aller au contenu", r"retour en haut", r"cliquez ici", r"(?:inscrivez|abonnez)-vous",
        r"(?:ir|saltar) al contenido", r"volver arriba", r"(?:haga|haz) clic aqu", r"suscr[iíÍ]bete",
    ),
}
_NOTICES = "(?i)(?:^|[^A-Za-z])(?:{})".format(
    "|".join(
        p.replace("[^ ]", r"[^\x20\x09-\x0D]").replace(" ", r"[\x20\x09-\x0D]+")
        for patterns in BOILERPLATE.values()
        for p in patterns
    )
)


def base_statistics(text: Column, words: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a
    non-null text and its array of words."""
    with_word = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    dup_lines = let(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": dup_lines.cast("long"),
        "n_repeat_words": _repeat_words(words).cast("long"),
    }


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES, -1), "")


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Windows are
    compared whole (joined by a space, which no word holds): sorted, so equal
    ones are neighbours, then the starts of the repeated ones are unrolled."""
    zero, space = F.lit(0), F.lit(" ")
    grams = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, zero)),
        lambda w, i: F.concat(w, space, F.get(words, i + 1), space, F.get(words, i + 2)),
    )

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - x, F.lit(3))))
        return F.aggregate(reach, zero, lambda s, x: s + x)

    def repeated(ordered: Column) -> Column:
        marked = F.transform(
            ordered,
            lambda e, k: F.when(
                (e["gram"] == F.get(ordered, k - 1)["gram"]) | (e["gram"] == F.get(ordered, k + 1)["gram"]), e["at"]
            ),
        )
        return let(F.sort_array(F.array_compact(marked)), covered)

    def count(g: Column) -> Column:
        at = F.transform(g, lambda x, i: F.struct(x.alias("gram"), i.alias("at")))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), zero).otherwise(let(F.sort_array(at), repeated))

    return let(grams, count)


def failing_rule(
    line: Column,
    words: Column,
    *,
    min_letters: float = MIN_LETTERS,
    max_symbol_words: float = MAX_SYMBOL_WORDS,
    max_boilerplate_words: int = MAX_BOILERPLATE_WORDS,
) -> Column:
    """Name of the first rule that ``line`` (of these ``words``) fails, or null."""
    chars = F.length(line)
    marks = F.length(F.regexp_replace(line, r"[a-z\x20\x09-\x0DA-Z0-9\p{L}\p{M}\p{N}]+", ""))
    spaces = chars - F.length(F.array_join(words, ""))
    symbol_words = F.size(F.filter(words, lambda w: w.rlike(f"[{SYMBOLS}]")))
    separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
    # Each costlier test runs only on lines that can fail it.
    odd = line.rlike(f"[{SYMBOLS}/«»•·:-]")
    return (
        F.when(F.size(words) == 0, None)
        .when(odd & (separators >= 3) & (separators * 4 >= F.size(words)), "navigation")
        .when(odd & (symbol_words > F.size(words) * max_symbol_words), "punctuation")
        .when((chars - spaces) * (1 - min_letters) < marks, "punctuation")
        .when((F.size(words) <= max_boilerplate_words) & line.rlike(_NOTICES), "boilerplate")
    )


def clean_lines(
    docs: DataFrame,
    text_col: str = "text",
    *,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost: float = MAX_LOST,
    out_col: str = "quality",
) -> DataFrame:
    """``docs`` with one struct column ``out_col`` added (an existing column of
    that name is replaced): the base statistics, ``base_failed``,
    ``clean_text``, ``lost_words``, ``lost_lines`` by rule, ``kept``.

    The struct passes through an exploded one-element array: a filter on it is
    then not moved below it, where it would be computed a second time."""
    judged = judge_text(
        F.col(text_col), min_words=min_words, max_repeat_percent=max_repeat_percent, max_lost=max_lost
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    return docs.select(*others, F.explode(F.array(judged)).alias(out_col))


def judge_text(
    text: Column,
    *,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost: float = MAX_LOST,
) -> Column:
    """The struct of ``clean_lines`` for one text."""
    text = F.coalesce(text, F.lit(""))

    def judged(t: Column) -> Column:
        lines = F.transform(
            F.split(t, "\n", -1),
            lambda x: let(
                _words(x),
                lambda w: F.struct(x.alias("line"), failing_rule(x, w).alias("rule"), F.size(w).alias("words")),
            ),
        )
        return let(
            F.struct(lines.alias("lines"), _words(t).alias("words")),
            lambda a: F.struct(
                *[c.alias(n) for n, c in base_statistics(t, a["words"]).items()], *_cleaned(a["lines"])
            ),
        )

    both = let(text, judged)

    def verdict(s: Column) -> Column:
        failed = (s["n_words"] < min_words) | (s["n_repeat_words"] * 100 > s["n_words"] * max_repeat_percent)
        kept = ~failed & (s["lost_words"] <= s["n_words"] * max_lost)
        return F.struct(
            *[s[n].alias(n) for n in (*_STATS, "clean_text", "lost_words", "lost_lines")],
            failed.alias("base_failed"),
            kept.alias("kept"),
        )

    return let(both, verdict)


_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RULES = ("navigation", "punctuation", "boilerplate")


def _cleaned(lines: Column) -> list[Column]:
    kept = F.filter(lines, lambda x: x["rule"].isNull())
    lost = F.filter(lines, lambda x: x["rule"].isNotNull())

    def failed(rule: str) -> Column:
        return F.size(F.filter(lost, lambda x: x["rule"] == rule)).alias(rule)

    return [
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("clean_text"),
        F.aggregate(lost, F.lit(0), lambda s, x: s + x["words"]).cast("long").alias("lost_words"),
        F.struct(*[failed(r) for r in _RULES]).alias("lost_lines"),
    ]


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).select(
        "doc_id", *[F.col(f"quality.{c}") for c in (*_STATS, "base_failed", "kept", "lost_words")]
    )


_SEPARATOR_LIST = ", ".join(f"'{x}'" for x in SEPARATORS)
_NOTICES_SQL = _NOTICES.replace("'", "''")

OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d
), place AS (
  SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), grams AS (
  SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p AS gram
  FROM place WINDOW p AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams WHERE gram IS NOT NULL) x
  WHERE n > 1
), covered AS (
  SELECT r, count(*) AS n_repeat_words
  FROM (SELECT r, i FROM again UNION SELECT r, i + 1 FROM again UNION SELECT r, i + 2 FROM again) x GROUP BY r
), lines AS (
  SELECT r, line, regexp_extract_all(line, '{WORD}') AS ws
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) x
), judged AS (
  SELECT r, line, len(ws) AS n,
    len(list_filter(ws, lambda x: x IN ({_SEPARATOR_LIST}))) AS seps,
    len(list_filter(ws, lambda x: regexp_matches(x, '[{SYMBOLS}]'))) AS syms,
    length(regexp_replace(line, '[a-z\\x20\\x09-\\x0DA-Z0-9\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')) AS marks,
    length(array_to_string(ws, '')) AS chars
  FROM lines WHERE len(ws) > 0
), by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines,
    sum(CASE WHEN (seps >= 3 AND seps * 4 >= n) OR syms > n * CAST({MAX_SYMBOL_WORDS} AS DOUBLE)
               OR chars * CAST({1 - MIN_LETTERS} AS DOUBLE) < marks
               OR (n <= {MAX_BOILERPLATE_WORDS} AND regexp_matches(line, '{_NOTICES_SQL}'))
             THEN n ELSE 0 END) AS lost
  FROM judged GROUP BY r
), s AS (
  SELECT w.doc_id, len(w.ws) AS n_words, length(array_to_string(w.ws, '')) AS word_chars,
    length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
    coalesce(b.n_dup_lines, 0) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words,
    coalesce(b.lost, 0) AS lost
  FROM w LEFT JOIN by_line b ON w.r = b.r LEFT JOIN covered c ON w.r = c.r
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND lost <= n_words * CAST({MAX_LOST} AS DOUBLE) AS kept, CAST(lost AS BIGINT) AS lost_words
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s) z
"""
