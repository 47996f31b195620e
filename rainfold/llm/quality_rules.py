"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every text is measured; each measure's distribution is summarised per language
and source in mergeable quantile sketches (``percentile_approx``, built per
task and merged after the shuffle), and a document is rejected where a measure
lies beyond its group's fence: ``FENCE`` spreads above the median (or
below, for words' length), where a spread is the distance from the median to the
upper (lower) quartile.  Measures that are zero in most clean documents
(``SPARSE``) take both from the group's non-zero values.  Medians and spreads are
shrunk by row count: a group's count as much as its rows against ``PRIOR`` rows of
its language's, and those against ``PRIOR`` rows of the whole table's.  ``LEAST``
guards against spreads of (nearly) zero only.

The two base rules (too few words, too much repetition) always hold.

Edge cases: a null or empty text has no words and fails the base rules; null
languages and sources are groups of their own; repeated rows count as often as
they occur; a table with extra columns of any name keeps them apart; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
FENCE = 10.0
PRIOR = 50
ACCURACY = 10_000
#: Measures and the smallest spread that counts, per side (None: no fence there).
MEASURES = {
    "symbol_share": (0.005, None),
    "dup_line_share": (0.005, None),
    "repeat_share": (0.005, None),
    "upper_share": (0.0005, None),
    "mean_word": (0.02, 0.02),
}
#: Measures whose non-zero values make the fence.
SPARSE = ("dup_line_share", "repeat_share")


def _windows(words: Column, n: Column) -> Column:
    """64-bit hashes of the WINDOW_WORDS-word windows, by the word hashes."""
    at = [F.expr(f"_wh[i + {k}]") for k in range(WINDOW_WORDS)]
    args = ", ".join(f"_wh[i + {k}]" for k in range(len(at)))
    return F.expr(f"transform(sequence(0, size(_wh) - {WINDOW_WORDS}), i -> xxhash64({args}))")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words
    and upper_chars; the text column is only read."""
    body = F.coalesce(F.col(text), F.lit(""))
    k = WINDOW_WORDS
    out = (
        df.withColumn("_words", F.regexp_extract_all(body, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.translate(body, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
        .withColumn("upper_chars", F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long"))
        .withColumn("_lines", F.filter(F.split(body, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("_wh", F.expr("transform(_words, w -> xxhash64(w))"))
        .withColumn("_h", F.when(F.size("_wh") >= k, _windows(F.col("_wh"), F.col("n_words"))).otherwise(F.expr("cast(array() as array<bigint>)")))
    )
    # Places of the windows that occur again: sorted by (hash, place), a window has an equal neighbour.
    out = out.withColumn("_sorted", F.expr(
        "case when size(_h) > size(array_distinct(_h)) then array_sort(transform(_h, (h, i) -> struct(h, i))) "
        "else cast(array() as array<struct<h: bigint, i: int>>) end"))
    out = out.withColumn("_places", F.expr(
        "array_sort(transform(filter(_sorted, (x, j) -> (j > 0 and _sorted[j - 1].h = x.h) or (j + 1 < size(_sorted) and _sorted[j + 1].h = x.h)), x -> x.i))"))
    # Their union covers, from each place to the next, at most k words.
    covered = f"aggregate(transform(_places, (p, j) -> if(j + 1 < size(_places), least({k}, _places[j + 1] - p), {k})), 0L, (a, x) -> a + x)"
    out = out.withColumn("n_repeat_words", F.expr(covered))
    return out.drop("_words", "_lines", "_wh", "_h", "_sorted", "_places")


def shares(df: DataFrame) -> DataFrame:
    """Add the measures that have fences."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return df.withColumns({
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("upper_chars") / chars,
        "mean_word": F.col("word_chars") / words,
    })


def summaries(measured: DataFrame, groups: list[str], prefix: str) -> DataFrame:
    """One row per group: each measure's median, spreads to the upper and lower
    quartile, and the number of values that they come from."""
    aggs = []
    for m in MEASURES:
        value = F.when(F.col(m) > 0, F.col(m)) if m in SPARSE else F.col(m)
        aggs += [F.percentile_approx(value, [0.25, 0.5, 0.75], ACCURACY).alias(m), F.count(value).alias(f"{m}_n")]
    rows = measured.groupBy(*groups).agg(*aggs) if groups else measured.agg(*aggs)
    out = [F.col(g).alias(f"{prefix}_{g}") for g in groups]
    for m in MEASURES:
        q = [F.col(m)[i] for i in range(3)]
        out.append(F.struct(F.col(f"{m}_n").alias("n"), q[1].alias("mid"), (q[2] - q[1]).alias("up"), (q[1] - q[0]).alias("down")).alias(f"{prefix}_{m}"))
    return rows.select(*out)


def shrunk(level: Column, part: str, parent: Column) -> Column:
    """A level's value, weighed by its rows against PRIOR rows of its parent's."""
    return F.coalesce((level["n"] * level[part] + PRIOR * parent) / (level["n"] + PRIOR), parent)


def fences(measured: DataFrame) -> DataFrame:
    """One row per language and source (g_lang, g_source): every measure's fences."""
    by_group, by_lang, overall = summaries(measured, ["lang", "source"], "g"), summaries(measured, ["lang"], "l"), summaries(measured, [], "a")
    levels = by_group.join(by_lang, F.col("g_lang").eqNullSafe(F.col("l_lang")))
    levels = levels.withColumn("_all", overall.select(F.struct(*overall.columns).alias("all")).scalar())
    out = [F.col("g_lang"), F.col("g_source")]
    for m, (high, low) in MEASURES.items():
        mid, up, down = (shrunk(F.col(f"g_{m}"), x, shrunk(F.col(f"l_{m}"), x, F.col("_all")[f"a_{m}"][x])) for x in ("mid", "up", "down"))
        out.append((mid + FENCE * F.greatest(up, F.lit(high))).alias(f"{m}_high"))
        if low is not None:
            out.append((mid - FENCE * F.greatest(down, F.lit(low))).alias(f"{m}_low"))
    return levels.select(*out)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per document: doc_id, the measures, base_failed, failed (the measures
    beyond their fences, comma-joined), kept."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    measured = materialize(shares(measure(rows)).drop("text"), "measures")
    limits, beyond = fences(measured), []
    for m, (_, low) in MEASURES.items():
        beyond.append(F.when(F.col(m) > F.col(f"{m}_high"), F.lit(f"{m}_high")))
        if low is not None:
            beyond.append(F.when(F.col(m) < F.col(f"{m}_low"), F.lit(f"{m}_low")))
    judged = measured.join(limits, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = judged.withColumns({"base_failed": base_failed, "failed": F.concat_ws(",", *beyond)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed") == "")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")
