"""Quality rules: a threshold table compiled into one projection of built-in functions.

A rule bounds one measure of a text from below, above or both; a document is kept when no rule is broken.
Null and empty texts have no words, so they break ``n_words``. Ratios of nothing are 0. Rows are judged one by
one: repeated rows get the same verdict and columns that are already there are never read, save the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.text import BLANKS, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages, lower case only: shouted text has none of them.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are an from have or not which "
    "de la le et des les en un une est que pour dans sur par qui au du avec il "
    "der die das und den von zu mit ist im dem nicht ein eine auf für sich des als auch "
    "el los las del por con una su para se al lo como más no y o es"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a missing bound does not bind."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Bounds of length, symbols, stop words and lines. Prose has about a quarter of stop words and few symbols.
RULES = (
    Rule("n_words", low=10),
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("symbols_per_word", high=0.15),
    Rule("shouts_per_word", high=0.15),
    Rule("stop_word_ratio", low=0.06),
    Rule("dup_line_ratio", high=0.35),
    Rule("doubled_word_ratio", high=0.15),
    Rule("repeat_word_percent", high=20.0),
)


def _repeated_window_words(tokens: Column) -> Column:
    """Words inside windows of five that occur at least twice in the text.

    Only texts in which a window's hash occurs twice are looked at again: there the windows themselves are
    sorted, and the words that the repeated ones cover are summed from one start to the next.
    """
    window = lambda i: F.concat_ws(" ", F.slice(tokens, i + 1, WINDOW))
    hashed = lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(WINDOW)))
    starts = F.sequence(F.lit(0), F.size(tokens) - WINDOW)
    hashes = F.transform(starts, hashed)
    ordered = F.array_sort(F.transform(starts, lambda i: F.struct(window(i).alias("text"), i.alias("at"))))

    def repeated(rows: Column) -> Column:
        same = lambda i, j: F.get(rows, i)["text"] == F.get(rows, j)["text"]
        kept = F.filter(rows, lambda _, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        return F.sort_array(F.transform(kept, lambda row: row["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    bind = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  evaluates value once
    in_text = bind(bind(ordered, repeated), covered)
    return F.when(F.size(tokens) < WINDOW, 0).when(
        bind(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), 0
    ).otherwise(in_text).cast("long")


def _count_of(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def measures(text: Column) -> dict[str, Column]:
    """Counts of one text, as columns over its words ``_words`` and itself."""
    text = F.coalesce(text, F.lit(""))
    tokens = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda line: F.char_length(F.translate(line, BLANKS, "")) > 0)
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": (F.char_length(text) - _count_of(text, BLANKS)).cast("long"),
        "n_symbols": _count_of(text, SYMBOLS),
        "n_shouts": _count_of(text, "!"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_doubled_words": F.size(F.filter(tokens, lambda w, i: w.eqNullSafe(F.get(tokens, i - 1)))).cast("long"),
        "n_stop_words": F.size(F.filter(tokens, lambda w: w.isin(STOP_WORDS))).cast("long"),
        "n_repeat_words": _repeated_window_words(tokens),
    }


def _ratios() -> dict[str, Column]:
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "shouts_per_word": share("n_shouts", "n_words"),
        # One word more than found: a text of a dozen words may do without any.
        "stop_word_ratio": (F.col("n_stop_words") + 1) / (F.col("n_words") + 1),
        "doubled_word_ratio": share("n_doubled_words", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "repeat_word_percent": 100 * F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
    }


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the broken rules, as one expression over the counts."""
    ratios = _ratios()

    def broken(rule: Rule) -> Column:
        value, bad = ratios[rule.measure], F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        return F.when(bad, F.lit(rule.measure))

    return F.array_compact(F.array(*(broken(rule) for rule in rules)))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: the key, all counts, ``base_failed``, ``broken`` (names of broken rules) and ``kept``."""
    rows = docs.select(F.col(key), F.col(text).alias("_text"), words(F.col(text)).alias("_words"))
    counted = rows.select(F.col(key), *(column.alias(name) for name, column in measures(F.col("_text")).items()))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.withColumns({"base_failed": base_failed, "broken": compile_rules(rules)}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with their columns as they were."""
    own = docs.columns
    boxed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("_row"), F.col(text).alias("_doc_text"))
    # A filter is pushed below deterministic projections and would repeat every count there for each of its uses.
    verdict = judge(boxed, key="_row", text="_doc_text", rules=rules).withColumn("_at", F.monotonically_increasing_id())
    return verdict.where("kept AND _at >= 0").select(*(F.col("_row").getField(c).alias(c) for c in own))
