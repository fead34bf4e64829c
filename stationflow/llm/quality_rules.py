"""Quality rules: one projection of text measures and a threshold table compiled over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stationflow.llm.common import SPACES, let, words

# The symbols of the contract.
SYMBOLS = "#*$%&|<>"

# Frequent short words of the languages in the corpus.
STOP_WORDS = (
    "the of and to in is that for it on with as was be by are this from or at "
    "le la les de des et un une que qui dans en du pour par est sur au pas avec "
    "der die das und ein eine ist von zu den mit sich auf für nicht im dem als auch "
    "el los las que y del se por con una para no su lo al es"
).split()


@dataclass(frozen=True)
class Rule:
    """Keeps a document whose ``measure`` (a SQL expression of the measures) lies in [low, high]."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, checks = F.expr(self.measure), []
        checks += [value >= self.low] if self.low is not None else []
        checks += [value <= self.high] if self.high is not None else []
        out = checks[0]
        for c in checks[1:]:
            out = out & c
        return F.coalesce(out, F.lit(True))


#: The threshold table. A ratio without a base (no word, no line) is null and never rejects.
RULES = (
    Rule("word_length", "try_divide(word_chars, n_words)", 2.5, 12.0),
    Rule("symbol_ratio", "try_divide(n_symbols, n_words)", None, 0.1),
    Rule("exclamation_ratio", "try_divide(n_exclamations, n_words)", None, 0.2),
    Rule("stop_words", "try_divide(n_stop_words, n_words)", 0.02, None),
    Rule("duplicate_lines", "try_divide(n_dup_lines, n_lines)", None, 0.3),
    Rule("bullet_lines", "try_divide(n_bullet_lines, n_lines)", None, 0.9),
    Rule("ellipsis_lines", "try_divide(n_ellipsis_lines, n_lines)", None, 0.3),
)


def repeat_words(found: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that the text holds twice or more.

    Window hashes are sorted with their places, neighbours with equal hashes are repeats, and the
    stretches that the repeats cover are added up, so a text costs n log n however repetitive."""

    def covered(hashes: Column) -> Column:
        last = F.size(hashes) - width
        spots = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        window = lambda i: F.struct(F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]).alias("h"), i.alias("i"))
        return let(F.sort_array(F.transform(spots, window)), repeats)

    def repeats(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
        twice = F.transform(ordered, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        return let(F.sort_array(F.filter(twice, F.isnotnull)), spread)

    def spread(places: Column) -> Column:
        step = F.transform(places, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - p, F.lit(width))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.transform(found, lambda w: F.xxhash64(w)), covered)


def measures(text: Column) -> Column:
    """All measures of one text as a struct; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    count = lambda kept: F.size(kept).cast("long")
    without = lambda t, chars: F.length(F.translate(t, chars, ""))
    plain = lambda w: w.isin(*sorted(set(STOP_WORDS)))

    def of(found: Column, lines: Column) -> Column:
        return F.struct(
            count(found).alias("n_words"),
            without(text, SPACES).cast("long").alias("word_chars"),
            (F.length(text) - without(text, SYMBOLS)).cast("long").alias("n_symbols"),
            (F.length(text) - without(text, "!")).cast("long").alias("n_exclamations"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(found).alias("n_repeat_words"),
            count(F.filter(found, lambda w: plain(F.lower(w)))).alias("n_stop_words"),
            count(lines).alias("n_lines"),
            count(F.filter(lines, lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•", "·"))).alias("n_bullet_lines"),
            count(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_ellipsis_lines"),
        )

    wordy = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return let(words(text), lambda found: let(wordy, lambda lines: of(found, lines)))


def quality_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, out: str = "quality") -> DataFrame:
    """Add a struct ``out``: the measures, ``base_failed``, ``failed`` (names of the broken rules)
    and ``kept``. One projection, no shuffle, no user function; whole texts.

    Null and empty texts have no word and fail the base. All other columns stay as they are; a
    column that is already called ``out`` is replaced."""
    measured = docs.withColumn(out, measures(F.col(text)))
    names = ["n_words", "word_chars", "n_symbols", "n_exclamations", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines"]
    broken = F.filter(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]), F.isnotnull)
    # The rules read the measures by their plain names, so they are judged in a row of their own.
    judged = measured.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != out]).alias("_row"), F.col(out).alias("_m"))
    judged = judged.select("_row", "_m", "_m.*").withColumn("failed", broken)
    at = lambda name: F.col("_m")[name]
    base = (at("n_words") < 50) | (100 * at("n_repeat_words") > 50 * at("n_words"))
    verdict = F.struct(*[at(n).alias(n) for n in names], base.alias("base_failed"), F.col("failed"), (~base & (F.size("failed") == 0)).alias("kept"))
    return judged.select("_row.*", verdict.alias(out))
