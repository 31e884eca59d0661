"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured and checked against rules of its own. Rule failures are counted per host (here the
``source``), the hosts' failure rates are shrunk towards an empirical beta prior, and each host's verdict is joined
back: a *blocked* host loses all documents, a *watched* host those that fail any rule, a *trusted* host only those
that fail a base rule.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; repeated rows are
measured alike and each counts for its host; an empty table gives no rows. Other input columns are not read by
``measure`` and are kept by ``keep_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import BLANKS, Scratch, cut, let, packed, small, unpacked, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: Symbols per hundred word characters, and repeated lines per hundred lines, that a document may have.
    max_symbol_percent: int = 10
    max_dup_line_percent: int = 30
    #: Shrunk failure rates from which a host is watched or blocked.
    watch_rate: float = 0.02
    block_rate: float = 0.6


def repeat_words(ws: Column, window: int) -> Column:
    """Words that lie in a ``window``-word window found twice or more in the array, the first occurrence included.

    Windows are compared by 64-bit hash. Only documents with a repeated window pay for locating it: the starts of
    repeated windows are sorted, and each covers ``window`` words less its overlap with the next.
    """

    def located(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            hit = F.filter(
                p,
                lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | ((k < F.size(p) - 1) & (F.get(p, k + 1)["h"] == x["h"])),
            )
            return F.sort_array(F.transform(hit, lambda x: x["i"]))

        def covered(s: Column) -> Column:
            return F.aggregate(
                F.transform(s, lambda x, k: F.when(k < F.size(s) - 1, F.least(F.lit(window), F.get(s, k + 1) - x)).otherwise(F.lit(window))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            )

        return let(pairs, lambda p: let(starts(p), covered))

    hashes = F.transform(F.sequence(F.lit(1), F.size(ws) - (window - 1)), lambda i: F.xxhash64(F.slice(ws, i, window)))
    return F.when(F.size(ws) < window, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(located(h))))


def measure(docs: DataFrame, text: str = "text", config: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` plus one struct column ``_m`` of measurements and rule outcomes."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    base = F.struct(
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"), F.size(x).cast("long").alias("lines"))).alias("l"),
        let(words(F.col(text)), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w, config.window).alias("n_repeat_words"))).alias("w"),
    )

    def outcome(m: Column) -> Column:
        n, rep = m["w"]["n_words"], m["w"]["n_repeat_words"]
        base_failed = (n < config.min_words) | (100 * rep > config.max_repeat_percent * n)
        return F.struct(
            n.alias("n_words"),
            m["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            m["l"]["dup"].alias("n_dup_lines"),
            rep.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            (base_failed | (100 * m["n_symbols"] > config.max_symbol_percent * m["word_chars"]) | (100 * m["l"]["dup"] > config.max_dup_line_percent * m["l"]["lines"])).alias("any_failed"),
        )

    return docs.withColumn("_m", let(base, outcome))


def host_verdicts(measured: DataFrame, host: str = "source", config: QualityConfig = QualityConfig()) -> DataFrame:
    """``_host, _verdict`` per host from a frame that has ``_m``.

    The beta prior has the mean and, by the method of moments, the spread of the hosts' failure rates; with one host,
    or rates more alike than chance makes them, the prior outweighs every host and all share the mean rate.
    """
    hosts = cut(measured.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_m.any_failed").cast("long")).alias("bad")))
    rate = F.col("bad") / F.col("n")
    # One row of sums over the hosts.
    total = hosts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.var_samp(rate).alias("spread"), F.avg(1 / F.col("n")).alias("noise")).first()
    mean = (total["bad"] or 0) / total["n"] if total["n"] else 0.0
    binomial = mean * (1 - mean)
    between = (total["spread"] or 0.0) - binomial * (total["noise"] or 0.0)
    weight = max(binomial / between - 1, 0.0) if between > 0 else 1e12
    shrunk = (F.col("bad") + weight * mean) / (F.col("n") + weight)
    verdict = F.when(shrunk >= config.block_rate, "blocked").when(shrunk >= config.watch_rate, "watched").otherwise("trusted")
    return hosts.select("_host", verdict.alias("_verdict"))


def judge(measured: DataFrame, host: str = "source", config: QualityConfig = QualityConfig(), verdicts: DataFrame | None = None) -> DataFrame:
    """``measured`` plus ``_verdict`` and ``_kept``; the host table is one narrow row per host."""
    verdicts = small(cut(verdicts if verdicts is not None else host_verdicts(measured, host, config)))
    joined = measured.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
    kept = ~F.col("_m.base_failed") & (F.col("_verdict") != "blocked") & ~((F.col("_verdict") == "watched") & F.col("_m.any_failed"))
    return joined.withColumn("_kept", kept).drop("_host")


def score_documents(docs: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The digest of every document: measurements, host verdict, decision."""
    narrow = cut(measure(docs.select("doc_id", "source", "text"), "text", config).select("doc_id", "source", "_m"))
    out = judge(narrow, "source", config)
    return out.select("doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words", "_m.base_failed", F.col("_kept").alias("kept"), F.col("_verdict").alias("host_verdict"))


def keep_documents(docs: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    # Verdicts need all measurements first; they are written beside the rows, so that each text is measured once.
    measured = Scratch(docs.sparkSession).keep(measure(packed(docs), "__row__.text", config), "measured")
    return unpacked(judge(measured, "__row__.source", config).where("_kept"))
