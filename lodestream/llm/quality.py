"""Quality rules with host-level verdicts, in DataFrame functions only.

Every document is measured in one pass over its own text (no shuffle).  Rule
failures are then summed by host; each host's failure rate is shrunk by a beta
prior whose mean and strength are fitted to the hosts (method of moments), and
documents of hosts whose shrunk rate exceeds ``reject_rate`` are rejected.
Only the small measurements take part in the aggregation and the join back,
never the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import WORD_BREAK, as_table, cut_lineage, text_of

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once for a row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    The windows are sorted with their positions, so equal ones are neighbours;
    the cost is n log n in a text's words.
    """

    def covered(s: Column) -> Column:
        n = F.size(s)
        last = n - 1
        twin = lambda k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["w"] == s[k]["w"])) | ((k < last) & (s[F.least(k + 1, last)]["w"] == s[k]["w"]))
        at = F.transform(F.filter(F.sequence(F.lit(0), last), twin), lambda k: s[k]["p"])
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(p, p + 1, p + 2)))))

    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, p: F.struct(F.concat_ws(" ", w, F.get(words, p + 1), F.get(words, p + 2)).alias("w"), p.alias("p")),
    )
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(F.sort_array(windows), covered))


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the five counts and ``base_failed`` to every row; a null text has no words."""
    text = text_of(text_col)
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, " \t\n\x0b\x0c\r", "")) > 0)
    counts = {
        "n_words": _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).cast("long").alias("r"))),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }
    out = df.withColumns(counts)
    out = out.withColumns({"n_repeat_words": F.col("n_words.r"), "n_words": F.col("n_words.n")})
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def host_verdicts(measured: DataFrame, host: str, reject_rate: float) -> DataFrame:
    """One row per host (null is a host of its own): documents, failures, shrunk rate, ``host_rejected``.

    The prior is a beta distribution with the hosts' mean rate m and strength
    m(1-m)/v - 1 for their variance v (at least 1, and 1 where v is 0), so a
    host of few documents stays near the mean.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    # One row of two numbers comes to the driver, whatever the number of hosts.
    rate = F.col("n_failed") / F.col("n_docs")
    mean, spread = hosts.agg(F.avg(rate), F.coalesce(F.var_pop(rate), F.lit(0.0))).first()
    mean = mean or 0.0
    strength = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else 1.0
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > reject_rate)


def judge_documents(df: DataFrame, reject_rate: float = 0.8, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the five counts, base_failed, host_rate, kept.

    Null and empty texts have no words and fail; repeated rows are judged
    alike and each counts for its host; an empty table gives no rows; other
    columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    measured = cut_lineage(measure(rows).select("doc_id", "host", *MEASURES, "base_failed"))
    verdicts = host_verdicts(measured, "host", reject_rate).select(F.col("host").alias("h"), "host_rate", "host_rejected")
    judged = measured.join(verdicts, measured["host"].eqNullSafe(verdicts["h"]), "left")
    return judged.select("doc_id", *MEASURES, "base_failed", "host_rate", (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"))


def keep_good(df: DataFrame, reject_rate: float = 0.8, broadcast_hosts: int = 100_000, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``df`` that the rules and their host's verdict keep, with its columns.

    Each text is measured once: its host and verdict are written beside the row, if that
    passed, and the hosts' verdicts are worked out from the two narrow columns of that
    table.  Up to ``broadcast_hosts`` rejected hosts (counted first) are broadcast, so the
    rows stay where they are; more are joined by a shuffle.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    measured = as_table(measure(rows).select("host", "base_failed", F.when(~F.col("base_failed"), F.col("_row")).alias("_row")))
    bad = cut_lineage(host_verdicts(measured.select("host", "base_failed"), "host", reject_rate).filter("host_rejected").select(F.col("host").alias("_bad_host")))
    kept = measured.filter(~F.col("base_failed")).select("host", "_row")
    bad = F.broadcast(bad) if bad.limit(broadcast_hosts + 1).count() <= broadcast_hosts else bad
    return kept.join(bad, F.col("host").eqNullSafe(F.col("_bad_host")), "left_anti").select("_row.*")
