"""Quality rules: fixed ones per document, and robust multivariate outliers per language and source.

Every document's statistics are computed in one row-wise pass. For each language and source the
centre and scatter of four transformed statistics are estimated by the minimum covariance
determinant: from two deterministic starts (quartiles; all rows), concentration steps take the
nearest half of the rows, ``(n + p + 1) / 2``, by Mahalanobis distance and estimate again from them;
the start with the smaller determinant stands, and the rows within the 97.5 % quantile of it give
the final estimate. So nearly half of a source may be junk. A step is one histogram of distances
per group and one table of moment sums, both pre-aggregated. A group's one row of estimates meets its
rows again in ``SALTS`` parts, so a source with a third of all rows is spread over that many tasks.

Statistics that most documents share exactly (no symbols, no repeats) have no variance among the
central rows, so each scatter gets a floor. Small groups lean on their language: the language's
central rows count as ``PRIOR`` rows of every group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import BLANK_RUN, let, stored, text_or_empty

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
REWEIGHT = 0.975  # part of the rows that the final estimates are made from, were all of them normal
STEPS = 3
SALTS = 64  # parts in which a group's rows meet its estimates
PRIOR = 20
CUTOFF = 33.4  # chi-square with four degrees of freedom: one in a million is larger
STEADY = 50  # words added below a share of repeats: one repeated line says little in a short text
FLOORS = (0.05, 0.1, 0.25, 0.12)  # standard deviations added to the four statistics
P = len(FLOORS)
X = [f"x{i}" for i in range(P)]
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]
GROUP = ["_loom_lang", "_loom_source"]


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows found twice or more in ``words``.

    Windows are compared by 64-bit hashes. A text without equal hashes, the usual case, is done
    after one set; else the windows are sorted by hash and neighbours compared.
    """
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def among(rows: Column) -> Column:
            def twin(k: Column, other: Column) -> Column:
                return F.coalesce(F.get(rows, k)["h"] == F.get(rows, other)["h"], F.lit(False))

            again = F.filter(F.sequence(F.lit(0), F.size(rows) - 1), lambda k: twin(k, k - 1) | twin(k, k + 1))
            spread = F.transform(again, lambda k: let(F.get(rows, k)["i"], lambda i: F.array(i, i + 1, i + 2)))
            return F.size(F.array_distinct(F.flatten(spread)))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, among))

    return F.when(n < 3, 0).otherwise(let(windows, covered))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the base statistics of the whole text, all long."""
    text = text_or_empty()
    words = F.array_remove(F.split(text, BLANK_RUN), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated_words(w).cast("long").alias("n_repeat_words"),
    ))
    return docs.select(
        "doc_id", "lang", "source", counts.alias("c"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def _vector(rows: DataFrame) -> DataFrame:
    """The transformed statistics: log word length; roots of symbols, repeated lines and words per word."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return rows.withColumns({
        "x0": F.log((F.col("word_chars") + 1) / (n + 1)),
        "x1": F.sqrt(F.col("n_symbols") / n),
        "x2": F.sqrt(F.col("n_dup_lines") * 10 / (n + STEADY)),
        "x3": F.sqrt(F.col("n_repeat_words") / (n + STEADY)),
        "_loom_salt": F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"),
        "_loom_lang": F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")),
        "_loom_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
    })


def _chi_square(x: float, terms: int) -> float:
    """The part below ``x`` under chi-square with 2 * ``terms`` degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(terms))


def _quantile(part: float) -> float:
    low, high = 0.0, 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi_square(mid, P // 2) < part else (low, mid)
    return low


def _consistency(part: float) -> float:
    """How much the covariance of the nearest ``part`` of all rows falls short under the normal law."""
    return part / _chi_square(_quantile(part), P // 2 + 1) if part < 1 else 1.0


def _whitened(estimates: DataFrame) -> DataFrame:
    """Adds ``w_i_j``, the inverse Cholesky factor of covariance ``c_i_j``, and its ``logdet``."""
    out = estimates
    for i, j in LOWER:
        rest = F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    for j in range(P):
        for i in range(j, P):
            if i == j:
                value = 1 / F.col(f"l_{i}_{i}")
            else:
                value = -sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l_{i}_{i}")
            out = out.withColumn(f"w_{i}_{j}", value)
    logdet = sum((F.log(f"l_{i}_{i}") for i in range(P)), F.lit(0.0)) * 2
    kept = [f"m{i}" for i in range(P)] + [f"w_{i}_{j}" for i, j in LOWER]
    return out.withColumn("logdet", logdet).select(*GROUP, "start", *kept, "logdet")


def _estimates(rows: DataFrame, factor: Column, central: Column | None = None) -> DataFrame:
    """Centre and scatter per group and start from the rows given, or the ``central`` ones of them.

    ``factor`` makes up for what the central rows' scatter falls short, one value for a group and
    start. A group without central rows has its language's estimates.
    """
    def total(value: Column) -> Column:
        return F.sum(value if central is None else F.when(central, value).otherwise(0.0))

    sums = {"n": total(F.lit(1.0))}
    sums |= {f"s{i}": total(F.col(X[i])) for i in range(P)}
    sums |= {f"s_{i}_{j}": total(F.col(X[i]) * F.col(X[j])) for i, j in LOWER}
    moments = rows.groupBy(*GROUP, "start").agg(F.max(factor).alias("factor"), *[c.alias(name) for name, c in sums.items()])
    language = W.partitionBy("_loom_lang", "start")
    lean = PRIOR / F.sum("n").over(language)
    moments = moments.select(*GROUP, "start", "factor", *[(F.col(c) + F.sum(c).over(language) * lean).alias(c) for c in sums])
    means = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(P)})
    covariance = {
        f"c_{i}_{j}": (F.col(f"s_{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * F.col("factor")
        + (FLOORS[i] ** 2 if i == j else 0.0)
        for i, j in LOWER
    }
    return _whitened(means.withColumns(covariance))


def _dealt(per_group: DataFrame) -> DataFrame:
    """A row per group and start once for each salt, to meet a group's rows in all their parts."""
    return per_group.withColumn("_loom_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with the squared Mahalanobis distance ``d2`` from their group's estimates."""
    near = rows.join(_dealt(estimates), [*GROUP, "_loom_salt"])
    steps = [
        sum((F.col(f"w_{i}_{j}") * (F.col(X[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(P)
    ]
    used = [f"m{i}" for i in range(P)] + [f"w_{i}_{j}" for i, j in LOWER] + ["logdet"]
    return near.withColumn("d2", sum((s * s for s in steps), F.lit(0.0))).drop(*used)


def _central(distances: DataFrame) -> DataFrame:
    """The nearest (n + p + 1) / 2 rows of each group and start, to a thirtieth of the distance, with
    the ``part`` of the group that they are."""
    binned = distances.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * 16).cast("int"))
    group = [*GROUP, "start"]
    counts = binned.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("k"))
    so_far = F.sum("k").over(W.partitionBy(*group).orderBy("bin"))
    all_rows = F.sum("k").over(W.partitionBy(*group))
    half = F.least(all_rows, F.floor((all_rows + P + 1) / 2))
    edge = (
        counts.withColumns({"so_far": so_far, "n": all_rows, "enough": so_far >= half}).filter("enough")
        .groupBy(*group).agg(F.min("bin").alias("edge"), (F.min("so_far") / F.max("n")).alias("part"))
    )
    return binned.join(_dealt(edge), [*group, "_loom_salt"]).filter("bin <= edge")


def scatter(rows: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimates of each group of ``_vector`` rows."""
    quartiles = rows.groupBy(*GROUP).agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(x) for x in X]
    ).withColumn("start", F.lit(0))
    start0 = _whitened(quartiles.select(
        *GROUP, "start", *[F.col(X[i])[1].alias(f"m{i}") for i in range(P)],
        *[
            (F.pow((F.col(X[i])[2] - F.col(X[i])[0]) / 1.349, 2) + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}")
            for i, j in LOWER
        ],
    ))
    start1 = _estimates(rows.withColumn("start", F.lit(1)), F.lit(1.0))
    estimates = stored(start0.unionByName(start1), "scatter")
    factors = F.array(*[F.lit(_consistency(k / 100)) for k in range(50, 101)])
    factor = F.get(factors, F.greatest(F.round(F.col("part") * 100).cast("int") - 50, F.lit(0)))
    for _ in range(STEPS):
        estimates = stored(_estimates(_central(_distance(rows, estimates)), factor), "scatter")
    first = W.partitionBy(*GROUP).orderBy(F.round("logdet", 9), "start")
    best = estimates.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth")
    best = best.withColumn("start", F.lit(0))  # the groups of a language lean on each other whatever their starts
    near = F.col("d2") <= _quantile(REWEIGHT)
    return _estimates(_distance(rows, best), F.lit(_consistency(REWEIGHT)), near)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the statistics, ``base_failed``, ``distance`` and ``kept`` for every row.

    A null text has no words and fails. Null languages and sources are groups of their own. Rows
    that fail the base rules neither shape the estimates nor get a distance. Repeated rows
    count as often as they stand. An empty table gives an empty result.
    """
    rows = stored(_vector(statistics(docs)).withColumn("base_failed", base_failed()), "statistics")
    sound = rows.filter("NOT base_failed")
    estimates = stored(scatter(sound).withColumn("base_failed", F.lit(False)), "scatter")
    # Failed rows keep their place without a distance: the join on the flag leaves them unmatched.
    near = rows.join(_dealt(estimates.drop("start")), [*GROUP, "base_failed", "_loom_salt"], "left")
    steps = [
        sum((F.col(f"w_{i}_{j}") * (F.col(X[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(P)
    ]
    distance = sum((s * s for s in steps), F.lit(0.0))
    return near.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        distance.alias("distance"), F.coalesce(~F.col("base_failed") & (distance <= CUTOFF), F.lit(False)).alias("kept"),
    )
