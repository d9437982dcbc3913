"""Whole-text statistics as Spark SQL expressions; used by the quality rules and the quality classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CLASS

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once although body names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{WHITE_CLASS}+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found at least twice in the text, the first find included.

    Most texts repeat no window, which a hash set over the windows' hashes
    shows. For the others the hashes are sorted with their positions, so that
    equal windows are neighbours: n log n work, whatever a text repeats.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
        )

    def positions(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        again = lambda s: F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return let(placed, lambda s: F.sort_array(F.transform(again(s), lambda x: x["p"])))

    def covered(p: Column) -> Column:
        new = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(new, F.lit(0), lambda s, x: s + x)

    def count(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(positions(h), covered))

    return let(let(words, hashes), count)


def text_stats(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each row of df: the columns of keep, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Null and empty texts have zero of everything. Texts are read whole. Columns
    of df that aren't in keep are dropped, so clashing names can't arise.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(*keep, t.alias("__t"), split_words(F.col(text)).alias("__w"))
    return rows.select(
        *keep,
        F.size("__w").cast("bigint").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__t", F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
        let(F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("__w")).cast("bigint").alias("n_repeat_words"),
    )
