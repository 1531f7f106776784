"""Quality rules for documents and their hosts, in Spark's own functions only.

A document fails by rules on its own text. Failures are counted by host. A host's rate is
shrunk towards all hosts by a beta prior whose mean and strength come from the hosts
themselves (moments), so a host with few documents is not condemned by one of them.
Documents of a host whose shrunk rate is too high are rejected as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import WORD_SPLIT, fresh_name, stored

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
# A document counts against its host by the base rules, or by these.
SYMBOL_PERCENT = 10
DUPLICATE_LINE_PERCENT = 30
# A host is rejected above this shrunk rate.
HOST_LIMIT = 0.5
# Bounds of the prior's strength, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0

_SYMBOLS = r"[#*$%&|<>]"
_IN_WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(grams: Column) -> Column:
    """Words in windows whose gram occurs twice or more; only for arrays with such."""

    def positions(ordered: Column) -> Column:
        def same(one: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(ordered, k - 1)["gram"] == one["gram"])
            after = F.get(ordered, k + 1)["gram"] == one["gram"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, same), lambda one: one["at"]))

    def covered(places: Column) -> Column:
        rest = F.size(places) - 1
        gaps = F.zip_with(
            F.slice(places, 1, rest), F.slice(places, 2, rest), lambda a, b: F.least(F.lit(WINDOW), b - a)
        )
        return F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)

    placed = F.transform(grams, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at")))
    return _let(_let(F.array_sort(placed), positions), covered)


def _repeat_words(words: Column) -> Column:
    """Grams are 64-bit hashes of five words; within one text two do not meet by chance."""
    last = F.size(words) - WINDOW
    grams = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )

    def count(found: Column) -> Column:
        unique = F.size(F.array_distinct(found)) == F.size(found)
        return F.when(unique, F.lit(0)).otherwise(_repeated(found))

    return F.when(last < 1, F.lit(0)).otherwise(_let(grams, count))


def measures(text: Column) -> Column:
    """A struct of the base measures of a whole text; a null text has no words."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def measured(words: Column) -> Column:
        chars = F.aggregate(words, F.lit(0).cast("bigint"), lambda n, word: n + F.length(word))
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_IN_WORD))
        found = _let(lines, lambda kept: F.struct(F.size(kept).alias("n"), F.size(F.array_distinct(kept)).alias("d")))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            chars.alias("word_chars"),
            F.regexp_count(text, F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
            found["n"].cast("bigint").alias("n_lines"),
            (found["n"] - found["d"]).cast("bigint").alias("n_dup_lines"),
            _repeat_words(words).cast("bigint").alias("n_repeat_words"),
        )

    return _let(F.filter(F.split(text, WORD_SPLIT), lambda word: word != ""), measured)


def base_failed(found: Column) -> Column:
    return (found["n_words"] < MIN_WORDS) | (
        100 * found["n_repeat_words"] > REPEAT_PERCENT * found["n_words"]
    )


def counts_against_host(found: Column) -> Column:
    return (
        base_failed(found)
        | (100 * found["n_symbols"] > SYMBOL_PERCENT * found["n_words"])
        | (100 * found["n_dup_lines"] > DUPLICATE_LINE_PERCENT * found["n_lines"])
    )


def host_verdicts(rated: DataFrame) -> DataFrame:
    """``(host, n_docs, n_failed, shrunk_rate, rejected)`` from rows ``(host, failed)``.

    Rows without host are no host. The counts are made map-side first, so a host with a
    third of all rows costs one row per task.
    """
    hosts = (
        rated.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("failed").alias("n_failed"))
        .withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    )
    # Stored, since both the prior and the verdicts read it and it comes from all texts.
    hosts = stored(hosts, "host-counts")
    mean, spread = F.avg("rate"), F.var_pop("rate")
    strength = F.when(spread > 0, mean * (1 - mean) / spread - 1).otherwise(MOST_STRENGTH)
    strength = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    prior = hosts.agg(mean.alias("mean"), strength.alias("strength")).first()
    failures, documents = (prior["mean"] or 0.0) * prior["strength"], prior["strength"]
    shrunk = (F.col("n_failed") + failures) / (F.col("n_docs") + documents)
    return hosts.select(
        "host",
        "n_docs",
        "n_failed",
        shrunk.alias("shrunk_rate"),
        (shrunk > HOST_LIMIT).alias("rejected"),
    )


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """Every row as ``(doc_id, host, measures..., base_failed, shrunk_rate, kept)``.

    A row is kept unless its own text fails or its host is rejected; a row without host is
    judged by its text alone. Null and empty texts have no words and fail. Repeated rows
    are judged and counted each; an empty table gives no rows.
    """
    found = F.col("found")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        measures(F.col("text")).alias("found"),
    ).select(
        "doc_id",
        "host",
        "found.*",
        base_failed(found).alias("base_failed"),
        counts_against_host(found).alias("failed"),
    )
    rows = stored(rows, "measures")
    # Stored, so that its size is known: broadcast if small, else a join that may split a host.
    verdicts = stored(host_verdicts(rows), "hosts").select("host", "shrunk_rate", "rejected")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return rows.join(verdicts, "host", "left").withColumn("kept", kept).drop("rejected", "failed")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns as they are.

    Null, empty and blank texts fail and go; rows without host are judged by their text
    alone; repeated rows are judged and counted each; an empty table gives no rows. Texts
    are measured once: their two verdicts are stored beside the rows.
    """
    mark, own, name = (fresh_name(docs, n) for n in ("_found", "_own_verdicts", "_host"))
    verdicts = F.struct(
        base_failed(F.col(mark)).alias("failed"), counts_against_host(F.col(mark)).alias("counts")
    )
    measured = docs.withColumn(mark, measures(F.col("text"))).withColumn(own, verdicts).drop(mark)
    measured = stored(measured, "judged")
    rated = measured.select(F.col(host).cast("string").alias("host"), F.col(own)["counts"].alias("failed"))
    rejected = stored(host_verdicts(rated).filter("rejected").select(F.col("host").alias(name)), "bad-hosts")
    good = measured.filter(~F.col(own)["failed"]).drop(own)
    return good.join(rejected, good[host].cast("string") == rejected[name], "left_anti")
