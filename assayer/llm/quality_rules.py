"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, white space collapsed, digits set to 0) and hashed. For each host the distinct
documents holding a line are counted; exact copies of a text count once there, as they are the business of
deduplication. Lines above the host's limit are removed: ``without_frequent_lines`` gives the texts that are left. Documents
that lose too much with them are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import WORD, let, text_or_empty, words_of

#: The symbols counted by ``n_symbols`` (fixed value).
SYMBOLS = r"[^#*$%&|<>]+"
SPACE = r"[\x20\x09-\x0D]+"


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that the array holds twice or more, the first included.

    Windows are compared by 64-bit hash and sorted with their places, so the time is n log n for any text.
    """

    def covered(places: Column) -> Column:
        """Words under windows at sorted places: each covers up to the next place, at most ``width``."""
        steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda here, after: F.coalesce(F.least(after - here, F.lit(width)), F.lit(width)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeats(windows: Column) -> Column:
        def twice(entry: Column, i: Column) -> Column:
            before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
            return (entry["h"].eqNullSafe(before)) | (entry["h"].eqNullSafe(after))

        return let(F.sort_array(F.transform(F.filter(windows, twice), lambda entry: entry["i"])), covered)

    def windows_of(array: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(array) - width)
        hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(array, i + k) for k in range(width)]))

        def sorted_windows(hashes: Column) -> Column:
            entries = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(F.sort_array(entries), repeats))

        return F.when(F.size(array) < width + 1, F.lit(0)).otherwise(let(hashed, sorted_windows))

    return let(words, windows_of).cast("bigint")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (bigint) of each whole text."""
    content = text_or_empty(text)

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            repeated_window_words(words).alias("n_repeat_words"),
        )

    def duplicates(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")

    with_word = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(WORD))
    return docs.withColumns(
        {
            "_of_words": let(words_of(content), of_words),
            "n_symbols": F.length(F.regexp_replace(content, SYMBOLS, "")).cast("bigint"),
            "n_dup_lines": let(with_word, duplicates),
        }
    ).withColumns({name: F.col(f"_of_words.{name}") for name in ("n_words", "word_chars", "n_repeat_words")}).drop("_of_words")


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")), "[0-9]", "0")


def numbered_lines(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """``_id, _host, _text, line, words, at``: each line of a document that has a word, by hash, with its words and its place."""

    def entry(line: Column, i: Column) -> Column:
        def hashed(norm: Column) -> Column:
            blanks = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit("")))
            return F.struct(F.xxhash64(norm).alias("line"), (blanks + 1).alias("words"), i.alias("at"))

        return F.when(line.rlike(WORD), let(normalised(line), hashed))

    entries = F.filter(F.transform(F.split(text_or_empty(text), "\n", -1), entry), lambda e: e.isNotNull())
    return docs.select(F.col(key).alias("_id"), F.col(host).cast("string").alias("_host"), F.xxhash64(text_or_empty(text)).alias("_text"), F.inline(entries))


@dataclass(frozen=True)
class LineLimit:
    """How many distinct texts of a host may hold a line.

    More than ``share`` of the host's texts and more than ``least`` are too many. For a line of at least
    ``whole_words`` words, which does not come up by chance, so are more than ``most``, however large the host is.
    """

    share: float = 0.1
    least: int = 10
    most: int = 1_000
    whole_words: int = 8

    def of(self, host_texts: Column, words: Column) -> Column:
        share = host_texts * F.lit(self.share)
        held = F.when(words >= self.whole_words, F.least(share, F.lit(float(self.most)))).otherwise(share)
        return F.greatest(F.lit(float(self.least)), held)


def frequent_lines(lines: DataFrame, hosts: DataFrame, limit: LineLimit) -> DataFrame:
    """``_of, _hash``: host and hash of the lines above their host's limit."""
    # One row per text and line first, then their number: both steps combine before the shuffle.
    texts = lines.groupBy("_host", "line", "words", "_text").agg(F.lit(1).alias("_one"))
    counts = texts.groupBy("_host", "line", "words").agg(F.count(F.lit(1)).alias("_texts")).filter(F.col("_texts") > limit.least)
    same = F.col("_host").eqNullSafe(F.col("_of"))
    above = counts.join(hosts.withColumnRenamed("_host", "_of"), same).filter(F.col("_texts") > limit.of(F.col("_host_texts"), F.col("words")))
    return above.select("_of", F.col("line").alias("_hash"))


def _hits(docs: DataFrame, key: str, text: str, host: str, limit: LineLimit) -> DataFrame:
    """The numbered lines of ``docs`` that are above their host's limit. Lines are shuffled by hash, texts are not."""
    lines = numbered_lines(docs, key, text, host)
    hosts = (
        docs.select(F.col(host).cast("string").alias("_host"), F.xxhash64(text_or_empty(text)).alias("_text"))
        .distinct()
        .groupBy("_host")
        .agg(F.count(F.lit(1)).alias("_host_texts"))
    )
    frequent = frequent_lines(lines, hosts, limit)
    hit = (F.col("line") == F.col("_hash")) & F.col("_host").eqNullSafe(F.col("_of"))
    # Every line that is hit is a hot key; a merge join's skewed partitions are split, whatever their number.
    return lines.join(frequent.hint("merge"), hit)


def without_frequent_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: LineLimit = LineLimit(), into: str = "text_left"
) -> DataFrame:
    """The rows of ``docs`` with ``into``, the text without its host's frequent lines.

    The other lines stay as they are and in their order. A text without frequent lines is left alone, a null one too.
    A column named like ``into`` is replaced.
    """
    # Rows repeated with key, text and host have the same places.
    gone = _hits(docs, key, text, host, limit).groupBy("_id", "_text", "_host").agg(F.collect_set("at").alias("_gone"))
    # Rows travel once, as one struct, so that their column names clash with nothing.
    rows = docs.drop(into).select(F.struct("*").alias("row"), F.xxhash64(text_or_empty(text)).alias("_rtext"))
    own_key, own_host, content = F.col(f"row.`{key}`"), F.col(f"row.`{host}`").cast("string"), F.col(f"row.`{text}`").cast("string")
    same = own_key.eqNullSafe(F.col("_id")) & (F.col("_rtext") == F.col("_text")) & own_host.eqNullSafe(F.col("_host"))

    def rest(array: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(array) - 1), F.col("_gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(array, i)), "\n")

    left = F.when(F.col("_gone").isNull(), content).otherwise(let(F.split(content, "\n", -1), rest))
    return rows.join(gone.hint("merge"), same, "left").select("row.*", left.alias(into))


def judge_quality(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limit: LineLimit = LineLimit(),
    least_left: float = 0.5,
    least_words: int = 50,
    most_repeated: float = 0.5,
) -> DataFrame:
    """One row per document with its statistics, ``n_removed_words``, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` of them in repeated 3-word
    windows. A line is removed when more distinct texts of its host hold it than ``limit`` allows. ``kept`` is false when
    the base rules fail or when the removal leaves less than ``least_left`` of the words.

    Only statistics and line hashes are shuffled. A null text has no words. Null hosts are one host. Repeated rows are
    judged alike and counted as one text. Columns other than the three named are ignored. An empty table gives an empty
    result.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("_content"), F.col(host).cast("string").alias("_source"))
    # Rows repeated with key, text and host have one sum for all: its lines come up once for each of them.
    hits = _hits(rows, "doc_id", "_content", "_source", limit).groupBy("_id", "_text", "_host", "at", "words").agg(F.lit(1).alias("_one"))
    removed = hits.groupBy("_id", "_text", "_host").agg(F.sum("words").alias("_removed"))
    stated = text_statistics(rows, "_content").withColumn("_rtext", F.xxhash64(text_or_empty("_content"))).drop("_content")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_rtext") == F.col("_text")) & F.col("_source").eqNullSafe(F.col("_host"))
    counted = stated.join(removed.hint("merge"), same, "left").withColumn("n_removed_words", F.coalesce("_removed", F.lit(0)).cast("bigint"))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > F.col("n_words") * F.lit(most_repeated))
    left = F.col("n_words") - F.col("n_removed_words")
    return counted.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_removed_words",
        "base_failed",
        (~F.col("base_failed") & (left >= F.col("n_words") * F.lit(least_left))).alias("kept"),
    )
