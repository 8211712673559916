"""Quality rules: line frequency across documents, and counts over each whole text.

Built-in Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.llm.common import SPACE, free_name, let, stored, words_of
from tradebinder.operators.lookup import spread_join

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BLANKS = " \t\n\x0b\x0c\r"
# Lists of frequent lines of all hosts that may be broadcast, in lines.
BROADCAST_LINES = 200_000


def normalized_line(line: Column) -> Column:
    """Lower case, words separated by one space."""
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def line_hashes(text: Column) -> Column:
    """Per line of the text the hash of its normalised form, null for a line without a word."""

    def one(line: Column) -> Column:
        return let(normalized_line(line), lambda x: F.when(x != "", F.xxhash64(x)))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), one)


def window_hashes(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, in order; none if there are fewer words."""

    def at(word: Column, i: Column) -> Column:
        rest = [F.get(words, i + k) for k in range(1, size)]
        return F.xxhash64(word, *rest)

    n = F.greatest(F.size(words) - (size - 1), F.lit(0))
    return F.slice(F.transform(words, at), F.lit(1), n)


def covered_words(words: Column, size: int) -> Column:
    """Number of words inside a run of ``size`` words that occurs twice or more in the text.

    Runs are told apart by 64-bit hashes.  Most short texts have no repeated run, which a
    count of distinct hashes shows; only the others sort their runs by hash.
    """

    def repeated(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            last = F.size(p) - 1
            twin = lambda x, k: F.get(p, k)["h"] == x["h"]
            again = F.filter(p, lambda x, k: F.coalesce(twin(x, k - 1), F.lit(False)) | ((k < last) & F.coalesce(twin(x, k + 1), F.lit(False))))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        def spanned(s: Column) -> Column:
            # Each run adds the words up to the next run, at most its own length.
            gap = F.transform(s, lambda x, k: F.least(F.coalesce(F.get(s, k + 1) - x, F.lit(size)), F.lit(size)))
            return F.aggregate(gap, F.lit(0), lambda a, x: a + x)

        return let(let(pairs, starts), spanned)

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(repeated(hashes))

    return let(window_hashes(words, size), count)


def document_counts(text: Column) -> Column:
    """Struct of the counts every rule starts from; null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    repeated_lines = let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    from_words = let(
        words_of(text), lambda w: F.struct(F.size(w).alias("n"), covered_words(w, 3).alias("repeated"))
    )
    return let(
        from_words,
        lambda w: F.struct(
            w["n"].cast("long").alias("n_words"),
            F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            repeated_lines.cast("long").alias("n_dup_lines"),
            w["repeated"].cast("long").alias("n_repeat_words"),
        ),
    )


def frequent_lines(documents: DataFrame, share: float, least_docs: int) -> DataFrame:
    """source and lines (hashes): the lines in more than max(least_docs, share x documents).

    Documents are counted per source by their text, so copies of one text count once.  A line
    above the limit is in more than ``share`` of its source's documents, so a source has at
    most (distinct lines per document) / ``share`` of them, however large it is.
    """
    each = documents.select("source", F.xxhash64("text").alias("body"), F.array_distinct(F.array_compact(line_hashes(F.col("text")))).alias("lines"))
    each = stored(each)
    sizes = each.groupBy("source").agg(F.count_distinct("body").alias("documents"))
    lines = each.select("source", "body", F.explode("lines").alias("line"))
    counts = lines.groupBy("source", "line").agg(F.count_distinct("body").alias("n")).where(F.col("n") > least_docs)
    known = counts.join(sizes, counts["source"].eqNullSafe(sizes["source"])).where(F.col("n") > F.col("documents") * share)
    return known.groupBy(counts["source"]).agg(F.collect_list("line").alias("lines"))


def judge_documents(
    documents: DataFrame,
    share: float = 0.1,
    least_docs: int = 20,
    least_left: float = 0.3,
    least_words: int = 50,
    most_repeated: float = 0.5,
) -> DataFrame:
    """Every row and column of ``documents`` (doc_id, text, source) with its counts and verdict.

    Adds, under names that do not clash, the text without its frequent lines and a struct
    ``verdict``: the counts (see ``document_counts``), ``base_failed`` (fewer than ``least_words`` words, or more than
    ``most_repeated`` of them in repeated three-word runs) and ``kept``: not base_failed, and
    at least ``least_left`` of the characters of its words stay when the lines that are
    frequent in its source go.  Returned with the names as a tuple.

    Null or empty text has zero words and fails.  A null source is a source.  A null doc_id
    and repeated rows are judged each by their own text.  Empty input gives no rows.
    """
    names = {n: free_name(documents, n) for n in ("verdict", "cleaned", "host", "lines")}
    # A short hash stands for the source, null included.
    host = F.xxhash64(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))
    light = documents.select(host.alias("source"), "text")
    frequent = stored(frequent_lines(light, share, least_docs).toDF(names["host"], names["lines"]))
    total = frequent.agg(F.sum(F.size(names["lines"]))).first()[0] or 0
    keyed = documents.withColumn(names["host"], host)
    if total <= BROADCAST_LINES:
        met = keyed.join(F.broadcast(frequent), names["host"], "left")
    else:
        met = spread_join(keyed, frequent, [names["host"]], "left", ["doc_id", "text"])
    # Most sources have no frequent line; their texts are not looked at again.
    text, bad = F.coalesce(F.col("text"), F.lit("")), F.col(names["lines"])

    def stays(hashes: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda x, i: ~F.coalesce(F.array_contains(bad, F.get(hashes, i)), F.lit(False)))

    cleaned = F.when(bad.isNull(), F.col("text")).otherwise(F.array_join(let(line_hashes(text), stays), "\n"))
    left = F.length(F.translate(F.coalesce(cleaned, F.lit("")), BLANKS, ""))

    def judge(c: Column) -> Column:
        failed = (c["n_words"] < least_words) | (c["n_repeat_words"] > most_repeated * c["n_words"])
        kept = ~failed & (left >= c["word_chars"] * least_left)
        return F.struct(*[c[n].alias(n) for n in COUNTS], failed.alias("base_failed"), kept.alias("kept"))

    # One expression, so that a filter on the verdict does not count twice.
    met = met.withColumn(names["cleaned"], cleaned).withColumn(names["verdict"], let(document_counts(F.col("text")), judge))
    return met.drop(names["host"], names["lines"]), names


def quality_report(documents: DataFrame, **rules) -> DataFrame:
    """doc_id, the five counts, base_failed and kept of every row (see ``judge_documents``)."""
    judged, names = judge_documents(documents.select("doc_id", "text", "source"), **rules)
    verdict = F.col(names["verdict"])
    return judged.select("doc_id", *[verdict[n].alias(n) for n in (*COUNTS, "base_failed", "kept")])


def keep_good(documents: DataFrame, **rules) -> DataFrame:
    """The documents the rules keep, without their frequent lines, in their own columns.

    An ``n_chars`` column follows the text where lines were removed.
    """
    judged, names = judge_documents(documents, **rules)
    text = F.col(names["cleaned"])
    new = {"text": text}
    if "n_chars" in documents.columns:
        changed = ~text.eqNullSafe(F.col("text"))
        new["n_chars"] = F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast(documents.schema["n_chars"].dataType)
    return judged.where(F.col(names["verdict"])["kept"]).select(*[new[c].alias(c) if c in new else F.col(c) for c in documents.columns])
