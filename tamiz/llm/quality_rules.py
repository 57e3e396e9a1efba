"""Quality rules whose cutoffs come with a bound on wrongly rejected documents.

Each rule rejects a document whose statistic exceeds a cutoff. Candidate
cutoffs are fixed beforehand; good documents that were labelled and play no
other part are the holdout. Within every stratum of text length and for every
candidate, an exact binomial test asks whether the rule would reject more than
its share of good documents. A candidate counts only if its p-value passes a
Bonferroni bound over all strata, rules and candidates, and the lowest such
cutoff is taken. With probability ``1 - delta`` all chosen cutoffs together
then reject at most ``alpha`` of the good documents of each stratum. A stratum
with too few labels gets no cutoff and rejects nothing.

DataFrame functions only; repeated windows are compared by 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import SPACES, free_name, frozen, windows, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lower bounds, in words, of the strata after the first.
STRATA = (64, 128, 256, 512, 1024)
RULES = ("symbols", "capitals", "dup_lines", "repeats")
CUTOFFS = (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.7)
ALPHA = 0.05
DELTA = 0.05


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs at least twice, from the array of window hashes."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def repeated(ordered: Column) -> Column:
        def twin(i: Column, step: int, h: Column) -> Column:
            return F.coalesce(F.get(ordered, i + step)["h"] == h, F.lit(False))

        return F.filter(ordered, lambda e, i: twin(i, -1, e["h"]) | twin(i, 1, e["h"]))

    # the sorted array is bound to a lambda variable, so it is made once
    found = F.transform(F.array(F.array_sort(placed)), repeated)[0]
    starts = F.array_sort(F.transform(found, lambda e: e["i"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        starts,
        zero,
        lambda a, s: F.struct(
            (a["n"] + s + WINDOW - F.greatest(a["end"], s)).alias("n"), (s + WINDOW).alias("end")
        ),
        lambda a: a["n"],
    )
    distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(distinct, F.lit(0).cast("long")).otherwise(covered)


def _removed(text: Column, characters: str) -> Column:
    """How many characters of a set ``text`` has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """``docs`` with a struct of counts per text; ``name`` must be new.

    n_words, word_chars (code points in words), n_symbols, n_capitals, n_lines
    (lines with a word), n_dup_lines (of these, equal to an earlier one),
    n_repeat_words (words in windows of eight found twice or more, the first
    included). Words are runs of characters other than ASCII white space. Null
    and empty texts count 0 everywhere.
    """
    value, word, line, window = (free_name(docs, x) for x in ("text_value", "word_list", "line_list", "window_list"))
    lines = F.filter(F.split(F.col(value), "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    counted = (
        docs.withColumn(value, F.coalesce(F.col(f"`{text}`"), F.lit("")))
        .withColumns({word: words(F.col(value)), line: lines})
        .withColumn(window, windows(F.col(word), WINDOW))
    )
    statistics = F.struct(
        F.size(word).cast("long").alias("n_words"),
        F.length(F.translate(F.col(value), SPACES, "")).cast("long").alias("word_chars"),
        _removed(F.col(value), SYMBOLS).alias("n_symbols"),
        _removed(F.col(value), CAPITALS).alias("n_capitals"),
        F.size(line).cast("long").alias("n_lines"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col(window)).alias("n_repeat_words"),
    )
    return counted.withColumn(name, statistics).drop(value, word, line, window)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def _rule_values(s: Column) -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(s[whole] > 0, s[part] / s[whole]).otherwise(F.lit(0.0))

    return {
        "symbols": share("n_symbols", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }


def stratum(s: Column) -> Column:
    """0 to ``len(STRATA)`` by number of words."""
    return sum((F.when(s["n_words"] >= low, 1).otherwise(0) for low in STRATA), F.lit(0))


def _log_factorial(n: Column) -> Column:
    """ln n!: exact products up to 20, Stirling's series above (error below 1e-15 relative)."""
    x = n.cast("double")
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5))
    above = x * F.log(x) - x + 0.5 * F.log(2 * F.lit(3.141592653589793) * x) + series
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(above)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X binomial with ``n`` trials of probability ``risk``; 1 where k is no lower than expected.

    Terms are summed downwards from k; those more than 40 standard deviations
    away are below any double and are left out.
    """
    odds = (1 - risk) / risk
    log_first = (
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
        + k * F.log(F.lit(risk)) + (n - k) * F.log(F.lit(1 - risk))
    )
    last = F.least(k, F.ceil(40 * F.sqrt(n * risk * (1 - risk))) + 100)
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), last),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (k - j) * odds / (n - k + j + 1)).alias("term"), (a["sum"] + a["term"]).alias("sum")
        ),
        lambda a: a["sum"],
    )
    return F.when(k < n * risk, F.exp(log_first) * terms).otherwise(F.lit(1.0))


def cutoffs(
    counted: DataFrame,
    labels: DataFrame,
    alpha: float = ALPHA,
    delta: float = DELTA,
    doc_id: str = "doc_id",
    statistics: str = "statistics",
) -> DataFrame:
    """One row per stratum that has good documents: stratum, n, and a cutoff for each rule (null: none holds).

    ``labels`` (doc_id, quality): a document is good if all its labels are 1;
    rows with a null id or label are passed over. ``counted`` needs doc_id and
    the statistics, no text. At most ``len(STRATA) + 1`` rows, always.
    """
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    good = good.agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    held = counted.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(statistics).alias("s")).join(good, "doc_id")
    value = _rule_values(F.col("s"))
    over = [
        F.count(F.when(value[rule] > cut, 1)).alias(f"over_{rule}_{i}")
        for rule in RULES
        for i, cut in enumerate(CUTOFFS)
    ]
    tests = (len(STRATA) + 1) * len(RULES) * len(CUTOFFS)
    table = held.groupBy(stratum(F.col("s")).alias("stratum")).agg(F.count("*").alias("n"), *over)

    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cut"), F.col(f"over_{rule}_{i}").alias("k"))
                for rule in RULES
                for i, cut in enumerate(CUTOFFS)
            ]
        )
    )
    tested = table.select("stratum", "n", each.alias("test")).select("stratum", "n", "test.*")
    holds = binomial_tail(F.col("n"), F.col("k"), alpha / len(RULES)) <= delta / tests
    lowest = [F.min(F.when((F.col("rule") == rule) & F.col("holds"), F.col("cut"))).alias(rule) for rule in RULES]
    return tested.withColumn("holds", holds).groupBy("stratum").agg(F.first("n").alias("n"), *lowest)


def with_verdict(counted: DataFrame, table: DataFrame, statistics: str = "statistics", name: str = "kept") -> DataFrame:
    """``counted`` with a boolean: neither the base rules nor any cutoff of its stratum rejects the row.

    ``table`` comes from ``cutoffs`` and has a few rows by construction, so it is broadcast.
    """
    s = F.col(statistics)
    own = [free_name(counted, x) for x in ("cut_stratum", *[f"cut_{rule}" for rule in RULES])]
    small = F.broadcast(table.select("stratum", *RULES).toDF(*own))
    joined = counted.join(small, stratum(s) == F.col(own[0]), "left")
    value = _rule_values(s)
    rejected = [F.coalesce(value[rule] > F.col(c), F.lit(False)) for rule, c in zip(RULES, own[1:])]
    verdict = ~base_failed(s)
    for r in rejected:
        verdict &= ~r
    return joined.withColumn(name, verdict).drop(*own)


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **levels: float
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns.

    Every row is judged by its own text, so repeated rows share a verdict and
    rows with null ids are judged like any other; null and empty texts fail
    the base rules. Empty tables stay empty.
    """
    name, kept = free_name(docs, "statistics"), free_name(docs, "kept_by_rules")
    counted = frozen(with_statistics(docs, text, name), "quality-counted")  # counted once, read twice
    table = cutoffs(counted, labels, doc_id=doc_id, statistics=name, **levels)
    return with_verdict(counted, table, name, kept).where(F.col(kept)).drop(name, kept)
