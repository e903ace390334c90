"""Quality rules as data: a table of thresholds on length, symbol, stop-word
and line ratios, compiled into one Spark projection without user functions.

Counts per text: ``n_words`` (words are runs of anything but space and
\\t..\\r), ``word_chars`` (their code points), ``n_symbols`` (characters of
``SYMBOLS``), ``n_lines`` (lines with a word), ``n_dup_lines`` (such lines
equal to an earlier one), ``n_repeat_words`` (words inside a window of
``REPEAT_WINDOW`` words that occurs twice or more in the text, the first time
included) and ``n_stop_words``. A rule bounds ``100 * numerator / denominator``
by integers, so its verdict never depends on rounding.

Windows are compared by 64-bit hashes of their words; only texts in which a
hash repeats pay for sorting (hash, position) pairs.

Cases: null and blank texts have no words and fail the base rule; a very long
text is one row, whose words and windows are arrays within it; repeated rows, and
those that share or lack a doc_id, are judged each; ``verdicts`` returns doc_id
and the verdict alone, ``keep_good`` every column; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STOP_PUNCTUATION = ".,;:!?"

# Common function words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in a is that it was for on are as with be at by this from or an he "
          "have not which you had but what all were when we there been their has if more",
    "fr": "le la les de des du et en un une que qui dans est pour au aux par sur ne pas plus "
          "avec son sa ses ce cette se il elle on mais ou leur sont",
    "de": "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als "
          "auch es an er aus bei nach wie um am sind einer so zum war oder",
    "es": "el la los las de y en que un una por con no su para es al lo como más o pero sus "
          "le se del ha me si sin sobre este ya entre cuando todo",
}


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * numerator / denominator <= high``; a null bound is open.
    A text with a zero denominator meets the rule."""
    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 200, 1200),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 10),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 1, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 50),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_stop_words")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs at least twice. With the positions of
    such windows in order, each adds its width or the step to the next one."""
    def marked(pairs: Column) -> Column:
        n = F.size(pairs)
        same = F.filter(F.sequence(F.lit(0), n - 1), lambda k: (
            (k > 0) & (pairs[F.greatest(k - 1, F.lit(0))]["h"] == pairs[k]["h"]))
            | ((k < n - 1) & (pairs[F.least(k + 1, n - 1)]["h"] == pairs[k]["h"])))
        return F.array_sort(F.transform(same, lambda k: pairs[k]["i"]))

    def width(at: Column) -> Column:
        n = F.size(at)
        steps = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.least(
            at[k] - at[k - 1], F.lit(REPEAT_WINDOW)))
        return F.aggregate(F.when(n > 1, steps).otherwise(F.array().cast("array<int>")),
                           F.lit(REPEAT_WINDOW).cast("long"), lambda a, x: a + x)

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(pairs, marked), width)


def _repeat_words(words: Column) -> Column:
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - REPEAT_WINDOW + 1),
                         lambda i: F.xxhash64(F.slice(words, i, REPEAT_WINDOW)))
    zero = F.lit(0).cast("long")
    return F.when(n <= REPEAT_WINDOW, zero).otherwise(_let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(_covered(h))))


def text_counts(text: Column) -> Column:
    """A struct of ``COUNTS`` for a text column."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    in_class = "[" + "".join("\\" + c for c in SYMBOLS) + "]"

    def of_words(words: Column) -> list[Column]:
        return [
            _count(words).alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"),
                        lambda a, w: a + F.char_length(w)).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
            _count(F.filter(words, lambda w: F.btrim(F.lower(w), F.lit(STOP_PUNCTUATION))
                            .isin(stop))).alias("n_stop_words")]

    def of_lines(lines: Column) -> list[Column]:
        return [(_count(lines) - _count(F.array_distinct(lines))).alias("n_dup_lines"),
                _count(lines).alias("n_lines")]

    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    symbols = (F.char_length(text) - F.char_length(F.regexp_replace(text, in_class, ""))
               ).cast("long")
    parts = F.struct(_let(words, lambda w: F.struct(*of_words(w))).alias("w"),
                     _let(lines, lambda x: F.struct(*of_lines(x))).alias("x"),
                     symbols.alias("n_symbols"))
    return _let(parts, lambda p: F.struct(
        p["w"]["n_words"].alias("n_words"), p["w"]["word_chars"].alias("word_chars"),
        p["n_symbols"].alias("n_symbols"), p["x"]["n_dup_lines"].alias("n_dup_lines"),
        p["w"]["n_repeat_words"].alias("n_repeat_words"), p["x"]["n_lines"].alias("n_lines"),
        p["w"]["n_stop_words"].alias("n_stop_words")))


def compile_rules(rules: tuple[Rule, ...], counts) -> Column:
    """True where every rule of the table holds; ``counts`` gives a column for
    the name of a count."""
    ok = F.lit(True)
    for r in rules:
        share, base = counts(r.numerator) * 100, counts(r.denominator)
        if r.low is not None:
            ok = ok & (share >= F.lit(r.low) * base)
        if r.high is not None:
            ok = ok & (share <= F.lit(r.high) * base)
    return ok


def base_failed(counts) -> Column:
    return ((counts("n_words") < MIN_WORDS)
            | (counts("n_repeat_words") * 100 > counts("n_words") * MAX_REPEAT_PERCENT))


def verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    out = _let(text_counts(F.col("text")), lambda c: F.struct(
        *[c[name].alias(name) for name in COUNTS],
        base_failed(c.getField).alias("base_failed"),
        (~base_failed(c.getField) & compile_rules(rules, c.getField)).alias("kept")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       out.alias("verdict")).select("doc_id", "verdict.*")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that the rules keep, columns unchanged."""
    kept = _let(text_counts(F.col("text")), lambda c: (
        ~base_failed(c.getField) & compile_rules(rules, c.getField)))
    return docs.filter(kept)
