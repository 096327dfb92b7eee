"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Native: DataFrame functions only.  All text statistics come from one pass over each text, with arrays inside
the row.  Every document that passes the base rules is turned into a vector of transformed statistics.  Per
cell (language and source; the language alone, or all documents, where a cell has fewer than ``min_rows``
such rows) a minimum-covariance-determinant estimate of centre and scatter is found: start from medians and
quartiles, then repeat concentration steps, each of which takes the ``share`` of rows nearest to the present
centre and computes their mean and covariance, until the steps are done.  A document is rejected if its squared Mahalanobis
distance is above ``cutoff``.

Design notes.  Vectors are whole numbers of 1/1024, so every sum is exact and the verdict does not depend on
the order of rows, tasks or retries.  The nearest rows are found with a histogram of the logarithm of the
distance per cell (no sort, no unbounded group): all rows up to the bin that reaches the share are taken.
Counts, sums and histograms combine on the map side, so a source with a third of all rows is no hot key.
Statistics that hardly vary in clean text get a least deviation (``floors``), else a cell of equal rows would
reject every newcomer.  The scatter is widened to the chi-square quantile of the share, never narrowed.

Edge cases: null text counts as empty, and an empty text fails the base rules; null language or source is a value
of its own; repeated rows count each; an empty table gives an empty result; other columns are passed
through, and a column named like a result column is replaced; names that begin with "_" are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.runtime import materialise

SEPARATORS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UNIT = 1024  # vectors are counted in 1/UNIT
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_other", "n_lines"]  # only the vector uses them
#: 75 % quantile of the chi-square law, by degrees of freedom
CHI2_75 = {1: 1.323, 2: 2.773, 3: 4.108, 4: 5.385, 5: 6.626, 6: 7.841, 7: 9.037, 8: 10.219}


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    share: float = 0.75
    steps: int = 4
    min_rows: int = 200
    cutoff: float = 40.0  # about one in a million clean vectors lies beyond it


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (an expression inside a lambda would be computed per element)."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that is found at least twice in ``words``."""
    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, j: F.coalesce(x.h == F.get(ordered, j - 1).h, F.lit(False))
                         | F.coalesce(x.h == F.get(ordered, j + 1).h, F.lit(False)))
        begins = F.sort_array(F.transform(again, lambda x: x.i))
        return F.aggregate(
            begins, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda s, p: F.struct((s.n + p + width - F.greatest(p, s.end)).alias("n"), (p + width).alias("end")),
            lambda s: s.n)

    def windows(w: Column) -> Column:
        last = F.size(w) - width
        found = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + k) for k in range(width)]).alias("h"), i.alias("i")))
        return F.when(last >= 0, _let(F.sort_array(found), covered)).otherwise(F.lit(0))

    return _let(words, windows)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics and those that only the vector uses."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda letters: F.length(F.translate(t, letters, ""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = _let(F.regexp_extract_all(t, F.lit(WORD), 0), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("again")))
    split_lines = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")))
    return docs.withColumns({
        "_words": counted, "_lines": split_lines, "word_chars": without(SEPARATORS).cast("long"),
        "n_symbols": (F.length(t) - without(SYMBOLS)).cast("long"),
        "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long"),
        "n_other": F.length(F.regexp_replace(t, r"[\p{L}\p{M}\s]+", "")).cast("long"),
    }).withColumns({
        "n_words": F.col("_words.n"), "n_repeat_words": F.col("_words.again"),
        "n_lines": F.col("_lines.n"), "n_dup_lines": F.col("_lines.again"),
    }).drop("_words", "_lines")


#: name, value of the statistic, least deviation
VECTOR = [
    ("word_length", lambda: F.log(F.try_divide("word_chars", F.col("n_words"))), 0.08),
    ("symbols", lambda: F.sqrt(F.try_divide("n_symbols", F.col("word_chars"))), 0.035),
    ("upper", lambda: F.sqrt(F.try_divide("n_upper", F.col("word_chars"))), 0.06),
    ("other", lambda: F.sqrt(F.try_divide("n_other", F.col("word_chars"))), 0.06),
    ("dup_lines", lambda: F.sqrt(F.try_divide("n_dup_lines", F.greatest("n_lines", F.lit(1)))), 0.15),
    ("repeats", lambda: F.sqrt(F.try_divide("n_repeat_words", F.col("n_words"))), 0.12),
]
NAMES = [f"v_{name}" for name, _, _ in VECTOR]
FLOORS = [floor for _, _, floor in VECTOR]
D = len(VECTOR)


def vectors(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        n: F.coalesce(F.round(value() * UNIT), F.lit(0)).cast("long") for n, (_, value, _) in zip(NAMES, VECTOR)})


def cells_of(rows: DataFrame, min_rows: int) -> DataFrame:
    """(_fine, _cell): the cell of each language and source - itself, its language, or all."""
    fine, coarse = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    n_fine = rows.groupBy(fine.alias("_fine"), coarse.alias("_coarse")).agg(F.count("*").alias("_n"))
    n_coarse = n_fine.groupBy("_coarse").agg(F.sum("_n").alias("_m"))
    return materialise(n_fine.join(n_coarse, "_coarse").select(
        "_fine", F.when(F.col("_n") >= min_rows, F.col("_fine"))
        .when(F.col("_m") >= min_rows, F.col("_coarse")).otherwise("*").alias("_cell")), "cells")


def _in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    return rows.withColumn("_fine", F.to_json(F.struct("lang", "source"))).join(cells, "_fine").drop("_fine")


def with_cells(rows: DataFrame, min_rows: int) -> DataFrame:
    """``rows`` with the cell each belongs to: language and source, language, or all."""
    return _in_cells(rows, cells_of(rows, min_rows))


def _quartiles(rows: DataFrame) -> DataFrame:
    """Per cell: arrays of the three quartiles of each statistic, exact to 1/UNIT."""
    long = rows.select("_cell", F.posexplode(F.array(*NAMES)).alias("k", "x"))
    counts = long.groupBy("_cell", "k", "x").agg(F.count("*").alias("n"))
    w = Window.partitionBy("_cell", "k")
    counts = counts.withColumns({"cum": F.sum("n").over(w.orderBy("x")), "all": F.sum("n").over(w)})
    at = lambda q: F.min(F.when(F.col("cum") >= F.col("all") * q, F.col("x")))
    per = counts.groupBy("_cell", "k").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    pick = lambda c: F.transform(F.col("q"), lambda s: s[c].cast("double"))
    return per.groupBy("_cell").agg(F.sort_array(F.collect_list(F.struct("k", "q1", "q2", "q3"))).alias("q")).select(
        "_cell", *[pick(c).alias(c) for c in ("q1", "q2", "q3")])


def _start(rows: DataFrame) -> DataFrame:
    """Per cell: centre and inverse scatter from medians and quartile distances."""
    floors = F.array(*[F.lit(f * UNIT) for f in FLOORS])
    spread = F.zip_with(F.zip_with("q3", "q1", lambda a, b: (a - b) / 1.349), floors, lambda s, f: F.greatest(s, f))
    return _quartiles(rows).withColumn("s", spread).select("_cell", F.col("q2").alias("_centre"), F.flatten(
        F.transform("s", lambda s, i: F.transform(F.sequence(F.lit(0), F.lit(D - 1)), lambda j: F.when(
            i == j, 1.0 / (s * s)).otherwise(0.0)))).alias("_inverse"))


def _distance() -> Column:
    """Squared Mahalanobis distance of the row's vector from its cell's centre."""
    gap = [F.col(n) - F.col("_centre")[i] for i, n in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(D):
        inner = F.lit(0.0)
        for j in range(D):
            inner = inner + F.col("_inverse")[i * D + j] * gap[j]
        total = total + inner * gap[i]
    return F.greatest(total, F.lit(0.0))


def _inverse(matrix: Column) -> Column:
    """Inverse of a positive definite matrix, by sweeping each pivot in turn."""
    def sweep(m: Column, k: Column) -> Column:
        pivot = F.get(m, k * D + k)

        def cell(x: Column, at: Column) -> Column:
            i, j = F.floor(at / D).cast("int"), (at % D).cast("int")
            row, col = F.get(m, k * D + j), F.get(m, i * D + k)
            return (F.when((i == k) & (j == k), 1.0 / pivot).when(i == k, row / pivot)
                    .when(j == k, -col / pivot).otherwise(x - col * row / pivot))
        return F.transform(m, cell)
    return F.aggregate(F.sequence(F.lit(0), F.lit(D - 1)), matrix, sweep)


def _bin() -> Column:
    return F.floor(F.log2(F.col("d2") + 1e-6) * 64).cast("int")


def _reach(placed: DataFrame, share: float) -> DataFrame:
    """Per cell: the bin up to which at least ``share`` of the rows lie."""
    w = Window.partitionBy("_cell")
    counts = placed.groupBy("_cell", "bin").agg(F.count("*").alias("n")).withColumns({
        "cum": F.sum("n").over(w.orderBy("bin")), "all": F.sum("n").over(w)})
    return counts.filter(F.col("cum") >= F.col("all") * share).groupBy("_cell").agg(F.min("bin").alias("reach"))


def _place(rows: DataFrame, state: DataFrame) -> DataFrame:
    return rows.join(state, "_cell").withColumn("d2", _distance()).withColumn("bin", _bin())


def _concentrate(rows: DataFrame, state: DataFrame, share: float) -> DataFrame:
    """One step: mean and covariance of the rows nearest to the present centre."""
    placed = _place(rows, state)
    near = placed.join(materialise(_reach(placed, share), "reach"), "_cell").filter("bin <= reach")
    whole = "decimal(38,0)"
    sums = near.groupBy("_cell").agg(
        F.count("*").alias("n"), *[F.sum(F.col(a).cast(whole)).alias(f"s{i}") for i, a in enumerate(NAMES)],
        *[F.sum((F.col(NAMES[i]) * F.col(NAMES[j])).cast(whole)).alias(f"p{i}_{j}")
          for i in range(D) for j in range(i, D)])
    mean = [F.col(f"s{i}").cast("double") / F.col("n") for i in range(D)]
    entry = lambda i, j: (F.col(f"p{min(i, j)}_{max(i, j)}").cast("double") / F.col("n") - mean[i] * mean[j]
                          + (F.lit((FLOORS[i] * UNIT) ** 2) if i == j else F.lit(0.0)))
    matrix = F.array(*[entry(i, j) for i in range(D) for j in range(D)])
    return sums.select("_cell", F.array(*mean).alias("_centre"), _inverse(matrix).alias("_inverse"))


def fit_mcd(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per cell: centre, inverse scatter and ``widen``, the factor by which distances are too large."""
    state = materialise(_start(rows), "mcd")
    for _ in range(rules.steps):
        state = materialise(_concentrate(rows, state, rules.share), "mcd")
    reach = _reach(_place(rows, state), rules.share)
    top = F.pow(F.lit(2.0), (F.col("reach") + 1) / 64.0)
    return materialise(state.join(reach, "_cell").select(
        "_cell", "_centre", "_inverse", F.greatest(F.lit(1.0), top / CHI2_75[D]).alias("_widen")), "mcd")


def quality_rules(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``distance2`` (null where the base rules failed), ``kept``.

    The estimate is made from statistics without their texts; then the texts are read once more and judged as they
    pass, so no text is written or shuffled on the way.
    """
    docs = docs.drop(*[c for c in [*BASE, *MORE, *NAMES, "base_failed", "distance2", "kept"] if c in docs.columns])
    # stored before it is filtered: a filter would be pushed below and compute the statistics a second time
    passed = materialise(base_verdict(vectors(text_statistics(docs.select("lang", "source", text), text)), rules).select(
        "lang", "source", "base_failed", *NAMES), "stats").filter(~F.col("base_failed"))
    cells = cells_of(passed, rules.min_rows)
    model = fit_mcd(materialise(_in_cells(passed, cells).select("_cell", *NAMES), "vectors"), rules)
    by_source = materialise(cells.join(model, "_cell").drop("_cell"), "rules")
    stats = base_verdict(vectors(text_statistics(docs, text)), rules)
    known = stats.withColumn("_fine", F.to_json(F.struct("lang", "source"))).join(by_source, "_fine", "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.col("_widen"))
    # one condition over both sides of the join, so that a filter on it stays above the join
    return known.withColumn("distance2", distance).withColumn(
        "kept", F.coalesce(F.col("distance2") <= rules.cutoff, F.lit(False))).select(*stats.columns, "distance2", "kept")


def base_verdict(stats: DataFrame, rules: Rules) -> DataFrame:
    return stats.withColumn("base_failed", (F.col("n_words") < rules.min_words)
                            | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))


def judge(stats: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Verdicts from statistics; they are stored once, so a caller who needs no texts drops these before."""
    stats = materialise(base_verdict(vectors(stats), rules), "stats")
    passed = stats.filter(~F.col("base_failed")).select("lang", "source", *NAMES)
    cells = materialise(with_cells(passed, rules.min_rows).select("_cell", *NAMES), "vectors")
    model = fit_mcd(cells, rules)
    good = with_cells(stats.filter(~F.col("base_failed")), rules.min_rows)
    judged = good.join(model, "_cell").withColumn("distance2", _distance() / F.col("_widen"))
    keep = [*stats.columns, "distance2"]
    return judged.select(*keep).unionByName(
        stats.filter("base_failed").withColumn("distance2", F.lit(None).cast("double")).select(*keep)
    ).withColumn("kept", ~F.col("base_failed") & (F.col("distance2") <= rules.cutoff))
