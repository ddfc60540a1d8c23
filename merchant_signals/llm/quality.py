"""Quality rules with adaptive thresholds from mergeable quantile sketches.

DataFrame functions only.  Each text's base counts give four ratios; a KLL sketch of each ratio is kept for each
(language, source).  A group of fewer than ``MIN_GROUP`` texts that pass the base rules takes the merged sketch of its
language, or of all languages.  A text is kept if the base rules pass and each ratio lies within the quartiles of its
group widened by ``SPREAD`` quartile distances, or by the ratio's least margin where that is more: the thresholds
follow the group, and up to a quarter of junk in a group doesn't move them.  The margin of the mean word length
grows for short texts, whose mean scatters more.

Cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of their
own; repeated rows are judged each; an empty table gives no rows; an input column named like one of the result's is
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import staged

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Texts that a group's own sketch needs; accuracy parameter of the sketches.
MIN_GROUP, SKETCH_K = 100, 400
#: Quartile distances beyond the quartiles, and the least margin of each ratio: what a text of few words or lines reaches by
#: chance (a repeated line among five).  That of repeat_ratio is below the base rule, which else decides alone.
SPREAD = 3.0
MARGINS = {"word_length": 1.0, "symbol_ratio": 0.05, "dup_line_ratio": 0.2, "repeat_ratio": 0.1}
#: Added to the margin of the mean word length, divided by the root of the number of words.
WORD_LENGTH_SCATTER = 8.0

_SEPARATORS = r"[\x20\x09-\x0D]+"


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words in place of the text."""
    added = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    others = [c for c in docs.columns if c != text_col and c.lower() not in added]
    text = F.coalesce(F.col("__text"), F.lit(""))
    df = docs.select(*others, F.col(text_col).cast("string").alias("__text"))
    df = df.select(
        *others,
        F.filter(F.split(text, _SEPARATORS), lambda w: w != "").alias("__w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__l"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    n = F.size("__w")
    window = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(5)]))
    df = df.select(
        *others, n.cast("long").alias("n_words"), F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        "n_symbols", F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 5, window).otherwise(F.array().cast("array<bigint>")).alias("__h"))
    # most texts repeat nothing: only the others sort their windows
    ordered = F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.select(*others, *[c for c in added if c != "n_repeat_words"],
                   F.when(F.size(F.array_distinct("__h")) < F.size("__h"), ordered).otherwise(none).alias("__s"))
    same = F.filter("__s", lambda x, k: (F.get("__s", k - 1)["h"] == x["h"]) | (F.get("__s", k + 1)["h"] == x["h"]))
    df = df.select(*others, *[c for c in added if c != "n_repeat_words"],
                   F.sort_array(F.transform(same, lambda x: x["i"])).alias("__p"))
    covered = F.aggregate(F.transform("__p", lambda x, k: F.least(F.lit(5), F.coalesce(F.get("__p", k + 1) - x, F.lit(5)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(*others, *[c for c in added if c != "n_repeat_words"], covered.alias("n_repeat_words"))


def _ratios(df: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return (df.withColumn("word_length", F.col("word_chars") / words)
            .withColumn("symbol_ratio", F.col("n_symbols") / words)
            .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double"))
            .withColumn("repeat_ratio", F.col("n_repeat_words") / words))


def _bounds(sketches: DataFrame, prefix: str) -> list[Column]:
    out = []
    for c, margin in MARGINS.items():
        low, high = (F.kll_sketch_get_quantile_double(F.col(f"s_{c}"), F.lit(q)) for q in (0.25, 0.75))
        margin = F.greatest(F.lit(margin), F.lit(SPREAD) * (high - low))
        out.append(F.struct((low - margin).alias("lo"), (high + margin).alias("hi")).alias(f"{prefix}{c}"))
    return out


def thresholds(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """t_lang, t_source and bounds of each ratio, from the texts that pass the base rules."""
    clean = measured.where(~F.col("base_failed")).select(
        F.col(lang_col).alias("t_lang"), F.col(source_col).alias("t_source"), *MARGINS)
    group = clean.groupBy("t_lang", "t_source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(f"s_{c}") for c in MARGINS])
    group = staged(group, "quality-sketches")  # a row for each group, read three times
    merged = [F.kll_merge_agg_double(f"s_{c}", F.lit(SKETCH_K)).alias(f"s_{c}") for c in MARGINS]
    of_lang = group.groupBy(F.col("t_lang").alias("l_lang")).agg(F.sum("n").alias("n"), *merged)
    of_all = group.agg(F.sum("n").alias("n"), *merged).where(F.col("n") > 0)
    lang = of_lang.select("l_lang", F.col("n").alias("n_lang"), *_bounds(of_lang, "l_"))
    every = of_all.select(*_bounds(of_all, "a_"))
    own = group.select("t_lang", "t_source", "n", *_bounds(group, "g_"))
    # one row of bounds for all
    joined = own.join(lang, F.col("t_lang").eqNullSafe(F.col("l_lang"))).join(F.broadcast(every))
    return joined.select("t_lang", "t_source", *[
        F.when(F.col("n") >= MIN_GROUP, F.col(f"g_{c}")).when(F.col("n_lang") >= MIN_GROUP, F.col(f"l_{c}"))
        .otherwise(F.col(f"a_{c}")).alias(f"t_{c}") for c in MARGINS])


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          id_col: str = "doc_id") -> DataFrame:
    """The id, the base counts and ratios, base_failed and kept of each text."""
    failed = ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"),
                      F.col(text_col).alias("__in"))
    measured = staged(_ratios(base_counts(own, "__in")).withColumn("base_failed", failed), "quality-counts")
    bounds = thresholds(measured, "__lang", "__source")
    fits = F.lit(True)
    for c in MARGINS:
        more = F.lit(WORD_LENGTH_SCATTER) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1))) if c == "word_length" else F.lit(0.0)
        fits = fits & (F.col(c) >= F.col(f"t_{c}.lo") - more) & (F.col(c) <= F.col(f"t_{c}.hi") + more)
    joined = measured.join(bounds, F.col("__lang").eqNullSafe(F.col("t_lang"))
                           & F.col("__source").eqNullSafe(F.col("t_source")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(fits, F.lit(False))).alias("kept"), *MARGINS)
