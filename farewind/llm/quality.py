"""Line-first quality rules, as column expressions only.

Words are runs of characters other than blank and U+0009 to U+000D. Lines are split at ``\\n``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 20
MAX_REPEATED_PCT = 30
MIN_KEPT_PCT = 40
WINDOW = 8
#: Words from which on a line that holds a boilerplate phrase is prose, not a notice.
NOTICE_WORDS = 30

# What the line rules look for.
SENTENCE_ENDS = ".!?…\"'”’»)]。！？"
SEPARATORS = "|»›→•·>"
#: Three separators with one run of characters between them, and something behind. No group is
#: repeated, so the match takes neither stack nor, in a long run, more than its length.
SEPARATED = r"[|»›→•·>]\s*\S+\s*[|»›→•·>]\s*\S+\s*[|»›→•·>]\s*\S"
MENU_WORDS = [
    "home", "menu", "login", "log in", "sign in", "sign up", "next", "previous", "back to top",
    "read more", "share",
]
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use cookies", "uses cookies", "enable javascript", "lorem ipsum", "click here",
    "subscribe to our", "©", "licensed under", "released under",
]


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def lines_of(text: Column) -> Column:
    """The lines of a text, each with its words' hashes, their number and their characters.

    No word crosses a line, so this is the one pass of a pattern over the text.
    """
    found = F.transform(
        F.split(text, "\n"),
        lambda line: F.struct(
            line.alias("line"), F.regexp_extract_all(line, F.lit(WORD), F.lit(0)).alias("words")
        ),
    )
    return F.transform(
        found,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.size(x["words"]).alias("n"),
            F.length(F.array_join(x["words"], "")).alias("chars"),
            F.transform(x["words"], lambda w: F.xxhash64(w)).alias("hashes"),
        ),
    )


def _measured(docs: DataFrame, text: str, window: int) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (null text: all 0).

    Windows of words are compared by 64-bit hashes. Only a text that holds a window twice is
    sorted: equal hashes are then neighbours, and the gaps between the places found give the
    words covered. Names of the added columns win over columns of the same name in ``docs``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_lines", lines_of(body))
    docs = docs.withColumn("_hashes", F.flatten(F.transform("_lines", lambda x: x["hashes"])))
    worded = F.transform(F.filter("_lines", lambda x: x["n"] > 0), lambda x: x["line"])
    docs = docs.withColumns({
        "n_words": F.size("_hashes").cast("long"),
        "word_chars": F.aggregate("_lines", F.lit(0).cast("long"), lambda n, x: n + x["chars"]),
        "n_symbols": _count_of(body, SYMBOLS).cast("long"),
        "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
        "_windows": F.when(
            F.size("_hashes") > window,
            F.transform(
                F.slice("_hashes", F.lit(1), F.size("_hashes") - (window - 1)),
                lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + k) for k in range(1, window)]),
            ),
        ),
    })
    docs = docs.withColumn(
        "_placed",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    placed, last = F.col("_placed"), F.size("_placed") - 1
    docs = docs.withColumn(
        "_starts",
        F.sort_array(
            F.transform(
                F.filter(
                    placed,
                    lambda x, i: F.coalesce(F.get(placed, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(placed, i + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    starts = F.col("_starts")
    covered = F.aggregate(
        F.transform(
            starts,
            lambda at, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - at, F.lit(window))),
        ),
        F.lit(0),
        lambda total, step: total + step,
    )
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_hashes", "_windows", "_placed", "_starts"
    )


def measure(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to ``docs``."""
    return _measured(docs, text, window).drop("_lines")


def line_passes(line: Column, n_words: Column) -> Column:
    """A line stays if it ends like a sentence or is long, and is neither navigation nor boilerplate.

    Separators are counted before the pattern that needs three of them in a row is tried.
    """
    bare = F.trim(line, F.lit(BLANKS))
    ends = (n_words >= 12) | (F.instr(F.lit(SENTENCE_ENDS), F.right(bare, F.lit(1))) > 0)
    low = F.lower(line)
    separated = (_count_of(line, SEPARATORS) >= 3) & low.rlike(SEPARATED)
    menu = F.lower(bare).isin(MENU_WORDS)
    told = functools.reduce(lambda a, b: a | b, [low.contains(phrase) for phrase in BOILERPLATE])
    return ends & ~separated & ~menu & ~((n_words < NOTICE_WORDS) & told)


def judge_documents(docs: DataFrame, text: str = "text", min_kept_pct: int = MIN_KEPT_PCT) -> DataFrame:
    """Adds the measures of ``measure``, clean_text, base_failed and kept.

    Each line is judged on its own by the punctuation, navigation and boilerplate rules and
    removed if it fails; a document that keeps less than ``min_kept_pct`` percent of its words
    is rejected. ``base_failed`` (under 20 words, or over 30 percent of them in repeated
    8-word windows) rejects beforehand. A null text has no words and fails; repeated rows are
    judged alike; columns of ``docs`` with the names of added ones are replaced. A line is read
    whole, however long or full of separators.
    """
    docs = _measured(docs, text, WINDOW)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words")
    )
    docs = docs.withColumn(
        "_passed", F.filter("_lines", lambda x: (x["n"] == 0) | line_passes(x["line"], x["n"]))
    )
    passed = F.col("_passed")
    n_left = F.aggregate(passed, F.lit(0), lambda n, x: n + x["n"])
    return docs.withColumns({
        "base_failed": failed,
        "clean_text": F.array_join(F.transform(passed, lambda x: x["line"]), "\n"),
        "kept": ~failed & (100 * n_left >= min_kept_pct * F.col("n_words")),
    }).drop("_lines", "_passed")


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept documents with their texts cleaned; the columns of ``docs``, n_chars made right."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    # the number of the row keeps Spark from moving the filter below the measures, where they
    # would be worked out anew for every use of one in another
    judged = judge_documents(whole).withColumn("_row", F.monotonically_increasing_id())
    judged = judged.filter("kept and _row >= 0")
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text")}
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    return judged.select(*[
        changed[c].cast(kinds[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ])
