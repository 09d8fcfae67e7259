"""Quality rules: a threshold table compiled into one Spark projection.

All measures of a text (words, symbols, letters, lines, stop words, repeats)
are built-in expressions, and every rule of ``RULES`` is an integer comparison
of two of them, so the whole verdict is a projection of the scan: no shuffle,
no user function. Repeated three-word windows are found by sorting a text's
windows with their places and comparing neighbours (n log n in its words).

Defined results: null text counts as empty; an empty text has all counts 0 and
fails the base rule on the number of words; ties and repeated rows do not
matter, every row is judged on its own; other columns pass through, but
columns named as a measure are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: frequent function words of the four languages of the corpus
STOP_WORDS = (
    "a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "not", "of", "on", "or", "that",
    "the", "this", "to", "was", "with",
    "als", "auch", "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich",
    "und", "von", "zu",
    "au", "avec", "ce", "dans", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "par", "pas",
    "pour", "que", "qui", "sur", "un", "une",
    "con", "de", "del", "el", "es", "las", "lo", "los", "no", "para", "por", "se", "su", "y",
)
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``least`` <= 100 * part / whole <= ``most`` (percent; None: no bound); ``whole`` None: part itself."""

    name: str
    part: str
    whole: str | None
    least: int | None
    most: int | None

    def holds(self, measure: dict[str, Column]) -> Column:
        part = measure[self.part] * (100 if self.whole else 1)
        whole = measure[self.whole] if self.whole else F.lit(1)
        bounds = [F.lit(True)]
        if self.least is not None:
            bounds.append(part >= whole * self.least)
        if self.most is not None:
            bounds.append(part <= whole * self.most)
        return bounds[0] if len(bounds) == 1 else bounds[1] & bounds[-1]


# the threshold table
RULES = (
    Rule("word_count", "n_words", None, 50, 100_000),
    Rule("word_length", "word_chars", "n_words", 250, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("letters", "n_letters", "word_chars", 60, None),
    Rule("capitals", "n_capitals", "n_letters", None, 30),
    Rule("stop_words", "n_stop_words", None, 2, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 50),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more among ``words``.

    Windows are compared by 64-bit hashes of their words.
    """
    def keys(w):
        pairs = F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b))
        return F.zip_with(F.slice(pairs, 1, F.size(w) - 2), F.slice(w, 3, F.size(w)), lambda a, b: F.xxhash64(a, b))

    def sorted_windows(k):
        return F.sort_array(F.transform(k, lambda key, i: F.struct(key.alias("key"), i.alias("at"))))

    def places(s):
        twice = F.zip_with(s, F.slice(s, 2, F.size(s)),
                           lambda a, b: F.when(a["key"] == b["key"], F.array(a["at"], b["at"])))
        starts = F.array_distinct(F.flatten(F.array_compact(twice)))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

    def count(k):  # most texts repeat no window
        return F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(let(sorted_windows(k), places))

    return F.when(F.size(words) < 4, 0).otherwise(let(keys(words), count))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals",
            "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``MEASURES`` (long) of a text column (null counts as empty)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # words and lines are columns of their own, so that each text is split once for all measures
    parts = df.withColumns({
        "__words": F.array_remove(F.split(whole, SPACE), ""),
        "__lines": F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines = F.col("__words"), F.col("__lines")

    def characters(pattern: str) -> Column:
        return F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))

    values = (
        F.size(words),
        F.length(F.array_join(words, "")),
        characters(SYMBOLS),
        F.size(lines) - F.size(F.array_distinct(lines)),
        _repeat_words(words),
        characters(r"\p{L}+"),
        characters(r"\p{Lu}+"),
        F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_WORDS)))),
        F.size(lines),
        F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\t]*[•*-]"))),
        F.size(F.filter(lines, lambda x: F.rtrim(F.translate(x, "\t\r", "  ")).rlike(r"(?:\.\.\.|…)\z"))),
    )
    measured = parts.withColumns({name: v.cast("long") for name, v in zip(MEASURES, values)})
    return measured.drop("__words", "__lines")


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add all measures, ``base_failed``, ``failed_rules`` (names, comma-separated) and ``kept``."""
    measured = measure(df, text)
    m = {name: F.col(name) for name in MEASURES}
    base = (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)
    failed = F.concat_ws(",", *(F.when(~r.holds(m), F.lit(r.name)) for r in rules))
    judged = measured.withColumns({"base_failed": base, "failed_rules": failed})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
