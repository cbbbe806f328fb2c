"""Quality rules: a threshold table compiled into Spark column expressions, without user functions.

Words are runs of anything but ASCII white space, lines are split at line feeds, and a symbol is one
of #*$%&|<>. A rule compares one count with a multiple of another one, in whole percents, so no
rounding takes part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.store import settled

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for was with on as by this from or an be at it are not "
    "der die das und den von zu mit auf für im des ein eine ist nicht sich dem "
    "le la les des et en que une un pour dans qui sur par est du au "
    "el los las del y con por para se una como lo es su"
).split()


@dataclass(frozen=True)
class Rule:
    """low * base <= 100 * count <= high * base; a bound that is None does not bind."""

    name: str
    count: str
    base: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        count = 100 * F.col(self.count)
        above = F.lit(True) if self.low is None else count >= self.low * F.col(self.base)
        below = F.lit(True) if self.high is None else count <= self.high * F.col(self.base)
        return above & below


# Bounds in percent of the base.
THRESHOLDS = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("exclamations", "n_exclamations", "n_words", high=20),
    Rule("stop_words", "n_stop_words", "n_words", low=3),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=30),
)


def metrics(docs: DataFrame) -> DataFrame:
    """`docs` (text) with one column per count. Null text has no words, lines or symbols.

    The three steps are one chain of projections: arrays are named once so that no expression is
    evaluated twice. Word windows are compared by their 64-bit hash inside one document, and sorted
    only in documents where a hash comes twice.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    split = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, GAP), ""),
            "_lines": F.filter(F.split(text, "\n"), has_word),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("bigint"),
            "n_exclamations": (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("!"), F.lit("")))).cast("bigint"),
        }
    )
    counted = split.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("bigint"),
            "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_bullet_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).cast("bigint"),
            "n_ellipsis_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("bigint"),
            "_grams": F.when(
                F.size("_words") >= 3,
                F.transform(F.sequence(F.lit(1), F.size("_words") - 2), lambda i: F.xxhash64(*[F.element_at("_words", i + k) for k in range(3)])),
            ),
        }
    )
    # Half of each hash with its place below it in one number: sorted, equal halves stand side by side.
    high = F.lit(-1 << 32)
    packed = counted.withColumn(
        "_packed",
        F.when(
            F.size(F.array_distinct("_grams")) < F.size("_grams"),
            F.sort_array(F.transform("_grams", lambda g, i: g.bitwiseAND(high).bitwiseOR(i.cast("bigint")))),
        ),
    )
    # Only what may be equal is compared by the whole hash.
    same_half = lambda x, k: (x.bitwiseXOR(F.get("_packed", k + 1)).bitwiseAND(high) == 0) | (x.bitwiseXOR(F.get("_packed", k - 1)).bitwiseAND(high) == 0)
    near = F.filter("_packed", lambda x, k: F.coalesce(same_half(x, k), F.lit(False)))
    place = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    placed = packed.withColumn("_placed", F.sort_array(F.transform(near, lambda x: F.struct(F.get("_grams", place(x)).alias("g"), place(x).alias("i")))))
    twice = lambda x, k: (x["g"] == F.get("_placed", k - 1)["g"]) | (x["g"] == F.get("_placed", k + 1)["g"])
    starts = placed.withColumn(
        "_starts", F.sort_array(F.transform(F.filter("_placed", lambda x, k: F.coalesce(twice(x, k), F.lit(False))), lambda x: x["i"]))
    )
    # A start covers three words, fewer where the next start comes sooner.
    covers = lambda i, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - i, F.lit(3)))
    repeated = F.aggregate(F.transform("_starts", covers), F.lit(0), lambda a, x: a + x)
    # A filter on a count must not be pushed below this point: it would repeat the arrays inside itself.
    out = starts.withColumn("n_repeat_words", settled(F.coalesce(repeated, F.lit(0)).cast("bigint")))
    return out.drop("_words", "_lines", "_grams", "_packed", "_placed", "_starts")


def judged(docs: DataFrame, thresholds: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """`docs` with all counts, `failed_rules` (names), `base_failed` and `kept`.

    Null and empty texts have no words and fail. Rows are judged one by one, so repeated rows and ids
    get the same verdict; an empty table gives no rows. A column of `docs` that carries the name of a
    count is replaced.
    """
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in thresholds]))
    found = metrics(docs).withColumns({"base_failed": base, "failed_rules": failed})
    return found.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that pass, with their own columns."""
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.col("text"))
    return judged(own).filter("kept").select("_row.*")
