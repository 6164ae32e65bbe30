"""Quality rules: word and line counts, and distribution divergence from a language reference.

Per language the reference holds two histograms over all of its documents:

* character classes (lower-case letters and all others, upper-case letters,
  digits, white space, punctuation, symbols);
* common words: words are known by a 64-bit hash and fall into ``WORD_BINS``
  hash bins; every bin that holds at least ``MIN_SHARE`` of the language's
  words is a bin of the histogram (one common word, and about 1 / WORD_BINS
  of the others), all other words share one more bin.

A document is compared with the reference of its own language through the
Jensen-Shannon distance (base 2, 0 to 1) of either histogram; it is rejected
if a distance exceeds its limit. Documents shorter than the guards are not
judged by a histogram that they are too short for.

Two passes read the texts: one counts words per language and bin (state bounded
by the bins), one counts everything per document. Sums of the per-document
counts give the references. Everything is a DataFrame expression over one row:
arrays of words stay inside their row; only counts are shuffled.

Null text: no words, all counts 0, rejected by the base rule. Null language,
or one without words: no reference, so the base rule alone decides. Repeated
rows: judged one by one, each counts in the reference. Very long texts: counted whole, a row at a time.
A distance equal to its threshold passes. Empty table: no rows.
Extra columns: ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import broadcast_small, stored, words


@dataclass(frozen=True)
class Limits:
    min_words: int = 50  # base rule
    max_repeat_percent: int = 50  # base rule
    word_distance: float = 0.35
    char_distance: float = 0.28
    word_guard: int = 50  # fewest words judged by the word histogram
    char_guard: int = 200  # fewest characters judged by the character histogram


#: Least share of a language's words that makes a bin common; at most 1 / MIN_SHARE bins are.
MIN_SHARE = 0.01
WORD_BINS = 1 << 14
#: Languages up to which reference tables are broadcast (1 / MIN_SHARE bins each).
BROADCAST_LANGUAGES = 4096
#: Repeated windows of a text up to which they are looked up one by one, beyond which by sorting.
LOOKED_UP = 64

#: Character classes after the first (everything else), as sets for a regular expression.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "punct": r".,;:!?'\"()\-", "symbol": r"#*$%&|<>@=+/\\_\[\]{}~^"}
SYMBOLS = r"#*$%&|<>"


def count_in(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def word_bin(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(WORD_BINS)).cast("int")


def repeated_windows(h: Column, n: Column) -> Column:
    """Hashes of the three-word windows of a text, given its words' hashes; null below three words."""
    def at(k: int) -> Column:
        return F.slice(h, F.lit(k), n - 2)

    pair = F.zip_with(at(1), at(2), lambda a, b: F.xxhash64(a, b))
    return F.when(n >= 3, F.zip_with(pair, at(3), lambda a, b: F.xxhash64(a, b)))


def base_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    """Per row: id, ``keep`` columns, ``__t`` (text), ``__h`` (hashes of its words) and the base counts.

    Windows found again are those equal to a neighbour once sorted; a word
    counts if such a window covers it. Each array that a lambda reads is a
    column of an earlier projection, so it is computed once per row.
    """
    t = df.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    names = [c for c in t.columns if c != "__t"]
    n = F.size("__h")
    t = t.withColumn("__w", words(F.col("__t")))
    t = t.select(*names, "__t", F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
                 F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"))
    t = t.withColumn("__g", repeated_windows(F.col("__h"), n))
    t = t.withColumn("__s", F.sort_array("__g"))
    t = t.withColumn("__d", F.array_distinct(F.filter(
        "__s", lambda x, k: F.coalesce(F.get("__s", k + 1) == x, F.lit(False)))))
    few = F.filter(F.sequence(F.lit(0), n - 3), lambda i: F.array_contains("__d", F.get("__g", i)))
    t = t.withColumn("__z", F.when(F.size("__d") > LOOKED_UP, F.sort_array(
        F.transform("__g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    many = F.sort_array(F.transform(
        F.filter("__z", lambda x, k: F.coalesce(F.get("__z", k - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get("__z", k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    t = t.withColumn("__p", F.when(F.size("__d") > LOOKED_UP, many).when(F.size("__d") > 0, few))
    covered = F.aggregate(
        F.transform("__p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("__p", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return t.select(
        *names, "__t", "__h", n.cast("long").alias("n_words"), "word_chars",
        count_in(F.col("__t"), SYMBOLS).alias("n_symbols"),
        duplicate_lines(F.col("__t")).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def common_bins(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Per non-null language with words: ``__bins`` (sorted common bins), ``__word_ref`` (their shares, the rest's)."""
    tokens = df.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("__lang"), F.explode(words(F.col(text_col))).alias("__word"))
    per_bin = (tokens.groupBy("__lang", word_bin(F.xxhash64("__word")).alias("bin"))
               .agg(F.count(F.lit(1)).alias("n")))
    total = per_bin.groupBy("__lang").agg(F.sum("n").alias("__total"))
    share = F.col("n") / F.col("__total")
    common = per_bin.join(total, "__lang").where(share >= MIN_SHARE)
    found = common.groupBy("__lang").agg(F.sort_array(F.collect_list(F.struct("bin", share.alias("p")))).alias("b"))
    shares = F.transform("b", lambda x: x["p"])
    return (total.join(found, "__lang", "left").withColumn("b", F.coalesce("b", F.expr("filter(array(struct(0 AS bin, 0D AS p)), x -> false)")))
            .select("__lang", F.transform("b", lambda x: x["bin"]).alias("__bins"),
                    F.concat(shares, F.array(1 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)))
                    .alias("__word_ref")))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    def half(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / total)


def quality_rules(df: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``df``: id, base counts, ``word_distance``, ``char_distance``, ``base_failed``, ``kept``.

    A distance is null where there is no reference or a guard applies.
    """
    bins = stored(common_bins(df, text_col, lang_col), "common-words")
    rows = base_counts(df, id_col, text_col, F.col(lang_col).alias("__lang"))
    rows = rows.join(broadcast_small(bins, BROADCAST_LANGUAGES), "__lang", "left")
    rows = rows.withColumns({
        "__m": F.when(F.size("__bins") > 0, F.transform("__h", word_bin)),
        "__r": F.regexp_replace("__t", r"[a-z\x20]+", "")})  # most of a text is in no class that is counted here
    counts = F.transform("__bins", lambda b: F.size("__m") - F.size(F.array_remove("__m", b)))
    n, chars = F.col("n_words").cast("double"), F.length("__t")
    classes = [count_in(F.col("__r"), c) for c in CLASSES.values()] + [chars - F.col("word_chars")]
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    counted = stored(rows.select(
        "doc_id", "__lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        chars.cast("long").alias("__chars"),
        F.array(*[c.cast("long") for c in classes]).alias("__classes"),
        F.when(F.col("n_words") >= limits.word_guard, js_distance(
            F.concat(_shares(counts, n), F.array((n - total(counts)) / n)), F.col("__word_ref")))
        .alias("word_distance")), "quality-counts")
    refs = class_references(counted)
    scored = counted.join(broadcast_small(refs, BROADCAST_LANGUAGES), "__lang", "left")
    chars = F.col("__chars").cast("double")
    rest = chars - F.aggregate("__classes", F.lit(0).cast("long"), lambda a, x: a + x)
    char_d = F.when(F.col("__chars") >= limits.char_guard, js_distance(
        F.concat(_shares(F.col("__classes"), chars), F.array(rest / chars)), F.col("__char_ref")))
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
    return (scored.withColumns({"char_distance": char_d, "base_failed": failed})
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "word_distance", "char_distance", "base_failed",
                    (~F.col("base_failed")
                     & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= limits.word_distance)
                     & (F.coalesce(F.col("char_distance"), F.lit(0.0)) <= limits.char_distance)
                     ).alias("kept")))


def class_references(counted: DataFrame) -> DataFrame:
    """Per language with text: ``__char_ref``, the shares of the character classes over all its documents."""
    k = len(CLASSES) + 1
    total = (counted.where(F.col("__lang").isNotNull()).groupBy("__lang")
             .agg(F.sum("__chars").alias("__c"),
                  *[F.sum(F.get("__classes", F.lit(i))).alias(f"__k{i}") for i in range(k)])
             .where(F.col("__c") > 0))
    ref = F.array(*[F.col(f"__k{i}") / F.col("__c") for i in range(k)])
    return total.select("__lang", F.concat(ref, F.array(1 - F.aggregate(ref, F.lit(0.0), lambda a, x: a + x)))
                        .alias("__char_ref"))
