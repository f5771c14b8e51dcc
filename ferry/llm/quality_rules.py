"""Quality rules by line-first cleaning, in DataFrame functions only.

Every line with a word is judged by punctuation, navigation, shouting and
boilerplate rules; failing lines are removed, and a document is rejected when
too much of its text went with them or when its base measures fail.

Defined cases: a null or blank text has no words, all measures 0, and fails
(fewer than MIN_WORDS words). Lines without a word are never judged, removed
or counted. Repeated rows are judged one by one, alike. Extra columns pass
through ``clean_documents``; its own column names win over clashing ones.
An empty table gives an empty result. There is no shuffle: one scan, row by
row, so no key can be hot and any text length is one row's work.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import BREAK, WORD, let, quoted, table, words_of

# Fixed values of the query's contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

# Line rules. A line fails if any holds.
MAX_SYMBOL_PERCENT = 5  # symbols among its characters
SHOUT_PERCENT = 30  # "!!" marks against its words
LONG_LINE = 5  # words from which a line must hold some punctuation
PUNCTUATION = "[.,;:!?\\u2026\\u3002\\u060c\\u061f\\u0964\\uff0c]"
NAVIGATION = "[|\\u00bb\\u203a\\u2022\\u00b7]"
NAV_MARKS = 3  # navigation marks, with at most NAV_WORDS words for each
NAV_WORDS = 4
# Lower-case phrases in the corpus's languages. A line of at most
# BOILERPLATE_WORDS words that holds one fails; a longer one is a paragraph that
# mentions it.
BOILERPLATE = (
    "accept cookies", "cookie policy", "privacy policy", "terms of use", "all rights reserved",
    "click here", "read more", "subscribe to", "enable javascript", "lorem ipsum",
    "cookies akzeptieren", "datenschutzerklärung", "alle rechte vorbehalten", "hier klicken", "weiterlesen",
    "accepter les cookies", "politique de confidentialité", "tous droits réservés", "cliquez ici", "lire la suite",
    "aceptar cookies", "política de privacidad", "todos los derechos reservados", "haga clic aquí", "leer más",
)
BOILERPLATE_WORDS = 20
# Share of the characters of lines with words that may go before the document does.
MAX_LOSS_PERCENT = 50


def has_boilerplate(text: Column) -> Column:
    return let(
        F.lower(text), lambda t: functools.reduce(lambda x, y: x | y, [t.contains(F.lit(b)) for b in BOILERPLATE])
    )


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[" + SYMBOLS + "]")).cast("long")


def line_fails(line: Column, symbols: Column, boilerplate: Column) -> Column:
    """The rules on one line; lines without a word never fail.

    ``symbols`` and ``boilerplate`` tell whether the whole text has any, so
    most texts skip these two. In each rule the cheap test stands first and
    decides alone on most lines; words are counted only where it holds.
    """
    words = F.regexp_count(line, F.lit(WORD))
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    marks = F.regexp_count(line, F.lit(NAVIGATION))
    return (
        (symbols & (100 * n_symbols(line) > MAX_SYMBOL_PERCENT * F.length(line)))
        | (line.contains("!!") & (100 * shouts >= SHOUT_PERCENT * words))
        | (~line.rlike(PUNCTUATION) & (words >= LONG_LINE))
        | (line.rlike(NAVIGATION) & (marks >= NAV_MARKS) & (words <= NAV_WORDS * marks))
        | (boilerplate & (words <= BOILERPLATE_WORDS) & has_boilerplate(line))
    )


def repeated_words(words: Column) -> Column:
    """Words covered by WINDOW-word windows found twice or more, first included.

    Windows are compared by their 64-bit hash. Only texts with a repeated
    window sort theirs; the rest stop at one hash set.
    """
    zero = F.lit(0).cast("long")

    def covered(wins: Column) -> Column:
        pairs = F.array_sort(F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twice = F.filter(
                s,
                lambda x, k: (x["h"] == F.get(s, k - 1)["h"]).eqNullSafe(True)
                | (x["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def union(p: Column) -> Column:
            steps = F.transform(
                p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
            )
            return F.aggregate(steps, zero, lambda acc, x: acc + x)

        return let(let(pairs, positions), union)

    def check(wins: Column) -> Column:
        return F.when(F.size(F.array_distinct(wins)) < F.size(wins), covered(wins)).otherwise(zero)

    def from_words(w: Column) -> Column:
        # hashes of 2, 4, then 8 words, each from two halves; the padded tail goes
        wins = let(paired(paired(w, 1), 2), lambda h: F.slice(paired(h, 4), 1, F.size(w) - (WINDOW - 1)))
        return F.when(F.size(w) > WINDOW, let(wins, check)).otherwise(zero)

    def paired(array: Column, shift: int) -> Column:
        """Hash of each element with the one ``shift`` further on."""
        rest = F.lit(1 << 30)
        return let(array, lambda x: F.zip_with(x, F.slice(x, shift + 1, rest), lambda a, b: F.xxhash64(a, b)))

    return let(words, from_words)


def quality_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures, the line measures, ``cleaned`` (the text
    without failing lines; null stays null), ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # the input in one column, so that no name of its columns meets one of these
    passed = [c for c in docs.columns if c.lower() not in _ADDED]
    kept_columns = [F.col(f"_in.{quoted(c)}").alias(c) for c in passed]

    def verdicts(lines: Column, symbols: Column, boilerplate: Column) -> Column:
        with_words = F.filter(lines, lambda x: x.rlike(WORD))
        return let(
            with_words,
            lambda w: F.struct(
                F.size(w).alias("n_lines"),
                (F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
                _chars(w).alias("chars"),
                F.filter(lines, lambda x: ~line_fails(x, symbols, boilerplate)).alias("rest"),
            ),
        )

    def finish(v: Column) -> Column:
        left = F.filter(v["rest"], lambda x: x.rlike(WORD))
        return F.struct(
            v["n_dup_lines"].alias("n_dup_lines"),
            (v["n_lines"] - F.size(left)).cast("long").alias("n_lines_removed"),
            (v["chars"] - _chars(left)).alias("n_chars_removed"),
            v["chars"].alias("n_line_chars"),
            F.array_join(v["rest"], "\n").alias("cleaned"),
        )

    def judged(t: Column) -> Column:
        lines = let(F.split(text, "\n", -1), lambda x: verdicts(x, t["symbols"] > 0, t["boilerplate"]))
        return let(lines, lambda v: F.struct(t["symbols"].alias("n_symbols"), let(v, finish).alias("l")))

    whole = F.struct(n_symbols(text).alias("symbols"), has_boilerplate(text).alias("boilerplate"))
    words = let(
        words_of(F.col("text")),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("rep")),
    )
    wide = docs.select(
        F.struct(*[F.col(quoted(c)) for c in passed]).alias("_in"),
        words.alias("_w"),
        let(whole, judged).alias("_t"),
        (F.length(text) - F.regexp_count(text, F.lit(BREAK))).cast("long").alias("word_chars"),
    ).select("*", "_t.n_symbols", F.col("_t.l").alias("_l"))
    base_failed = (F.col("_w.n") < MIN_WORDS) | (100 * F.col("_w.rep") > MAX_REPEAT_PERCENT * F.col("_w.n"))
    kept = ~base_failed & (100 * F.col("_l.n_chars_removed") <= MAX_LOSS_PERCENT * F.col("_l.n_line_chars"))
    return wide.select(
        *kept_columns,
        F.col("_w.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_l.n_dup_lines").alias("n_dup_lines"),
        F.col("_w.rep").alias("n_repeat_words"),
        F.col("_l.n_lines_removed").alias("n_lines_removed"),
        F.col("_l.n_chars_removed").alias("n_chars_removed"),
        F.when(F.col("_in.text").isNotNull(), F.col("_l.cleaned")).alias("cleaned"),
        base_failed.alias("base_failed"),
        kept.alias("kept"),
    )


_ADDED = {
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed",
    "n_chars_removed", "cleaned", "base_failed", "kept",
}


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of
    ``docs``; ``n_chars`` follows the text where the column exists."""
    out = quality_rules(docs.select("text", F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_doc")))
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return out.where("kept").select(
        *[new[c].alias(c) if c in new else F.col(f"_doc.{quoted(c)}").alias(c) for c in docs.columns]
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).drop("text", "cleaned")


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda s: s <> '') AS ws, x FROM t),
p AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
r AS (SELECT doc_id, i FROM p QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
c AS (SELECT doc_id, count(DISTINCT k) AS rep FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM r) GROUP BY 1),
l AS (SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS nw,
             length(l) - length(translate(l, '#*$%&|<>', '')) AS sy,
             (length(l) - length(replace(l, '!!', ''))) / 2.0 AS sh,
             len(regexp_extract_all(l, '[|\x{00bb}\x{203a}\x{2022}\x{00b7}]')) AS mk
      FROM (SELECT doc_id, unnest(string_split(x, chr(10))) AS l FROM t)),
f AS (SELECT doc_id, l, (100 * sy > 5 * length(l)) OR (sh > 0 AND 100 * sh >= 30 * nw)
        OR (nw >= 5 AND NOT regexp_matches(l, '[.,;:!?\x{2026}\x{3002}\x{060c}\x{061f}\x{0964}\x{ff0c}]'))
        OR (mk >= 3 AND nw <= 4 * mk)
        OR (nw <= $WORDS AND list_bool_or([contains(lower(l), b) FOR b IN [$PHRASES]])) AS bad
      FROM l WHERE nw > 0),
g AS (SELECT doc_id, count(*) - count(DISTINCT l) AS dup, sum(bad::INT) AS nbad,
             sum(CASE WHEN bad THEN length(l) ELSE 0 END) AS cbad, sum(length(l)) AS call FROM f GROUP BY 1),
b AS (SELECT w.doc_id, len(ws) AS n_words, length(translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
             length(x) - length(translate(x, '#*$%&|<>', '')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
             coalesce(rep, 0) AS n_repeat_words, coalesce(nbad, 0) AS n_lines_removed,
             coalesce(cbad, 0) AS n_chars_removed, coalesce(call, 0) AS call
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_lines_removed::BIGINT AS n_lines_removed, n_chars_removed::BIGINT AS n_chars_removed,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_chars_removed <= 50 * call AS kept
FROM b
""".replace("$WORDS", str(BOILERPLATE_WORDS)).replace("$PHRASES", ", ".join(f"'{b}'" for b in BOILERPLATE))
