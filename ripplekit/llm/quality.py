"""Texts rejected by fixed rules, or as outliers of their language and source.

Each text becomes a vector of transformed statistics. For every language and
source the minimum covariance determinant is approached by concentration steps:
from medians and quartile ranges, the three quarters of the rows that are nearest
by Mahalanobis distance give the next centre and covariance, whose determinant is
never larger. A step is two aggregations over all rows (a quantile and moments),
so a group of any size is summed where its rows lie. Groups of fewer than
``LEAST`` rows use the estimate of their language, or else that of all rows. An estimate of
five dimensions needs ``FEWEST`` rows: with fewer altogether nothing is an outlier.

A floor is added to each variance: statistics that are zero in nearly all texts
would otherwise reject any other value.

Defined results: a null or empty text has no words, fails the base rules and is
not kept. Null languages and sources form groups of their own. Repeated rows get
equal verdicts, whole texts are read, other columns are ignored, an empty table
gives an empty one.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.session import settle

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Rows a language, or a language and source, needs for an estimate of its own; and the table, for any.
LEAST, FEWEST = 200, 25
PART = 0.75
STEPS = 4
#: Squared distance beyond which a text is an outlier: the 0.999 quantile of a chi-square of five dimensions.
CUTOFF = 20.515
#: chi-square of five dimensions: its median.
MEDIAN = 4.3515
#: Statistics and the deviation added to each, in their units.
FLOORS = {"log_words": 0.6, "word_length": 0.5, "symbols": 0.06, "repeated_lines": 0.12, "repeated_words": 0.12}
NAMES = tuple(FLOORS)
P = len(NAMES)


def statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes: ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    doubled = len(lines) - len(set(lines))
    repeated = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            often = {w for w, n in Counter(windows).items() if n > 1}
            covered = -1  # the last word counted
            for i, window in enumerate(windows):
                if window in often:
                    repeated += i + 2 - max(covered, i - 1)
                    covered = i + 2
    return len(words), chars, symbols, doubled, repeated, len(lines)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measure(rows: DataFrame, text: str) -> DataFrame:
    """The rows' other columns, the counts of their texts, ``failed`` (by the base rules) and the vector."""
    place = rows.columns.index(text)
    others = [c for c in rows.columns if c != text]

    def run(batches):
        for batch in batches:
            found = list(zip(*map(statistics, batch.column(place).to_pylist()))) or [()] * len(COUNTS)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != place]
            columns += [pa.array(f, pa.int64()) for f in found]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *COUNTS])

    schema = T.StructType([rows.schema[c] for c in others] + [T.StructField(c, T.LongType()) for c in COUNTS])
    return rows.mapInArrow(run, schema).select("*", base_failed().alias("failed"), *vector())


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def vector() -> list[Column]:
    """The statistics, transformed to be roughly symmetric, named as in NAMES."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return [
        F.log1p("n_words").alias("log_words"),
        F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(0.0).alias("word_length"),
        share("n_symbols", "word_chars").alias("symbols"),
        share("n_dup_lines", "n_lines").alias("repeated_lines"),
        share("n_repeat_words", "n_words").alias("repeated_words"),
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance to ``centre`` by ``inverse`` (rows one after the other)."""
    off = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
    return sum(
        (off[i] * off[j] * F.col("inverse")[i * P + j] * (1 if i == j else 2) for i in range(P) for j in range(i, P)),
        F.lit(0.0),
    )


def _inverted(moments: DataFrame) -> DataFrame:
    """(pool, centre, inverse) from rows (pool, centre, covariance)."""
    floor = np.diag(np.square(list(FLOORS.values())))

    def run(batches):
        for batch in batches:
            covariances = [np.array(c, dtype=float).reshape(P, P) for c in batch.column(2).to_pylist()]
            inverses = [np.linalg.inv(c + floor).ravel().tolist() for c in covariances]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(inverses, pa.list_(pa.float64()))],
                names=["pool", "centre", "inverse"],
            )

    return moments.mapInArrow(run, "pool string, centre array<double>, inverse array<double>")


def _pool_names(by: tuple[str, ...]) -> list[Column]:
    """Names of a row's pools, coarsest first: all, its language, its language and source."""
    mark = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by]
    return [F.to_json(F.array(*mark[:i])) if i else F.lit("[]") for i in range(len(by) + 1)]


def large_pools(rows: DataFrame, by: tuple[str, ...], least: int = LEAST) -> DataFrame:
    """(pool): those with enough rows that passed the base rules."""
    finest = rows.where("NOT failed").groupBy(*by).agg(F.count("*").alias("n"))
    named = finest.select("n", F.explode(F.array(*_pool_names(by))).alias("pool"))
    enough = F.when(F.col("pool") == _pool_names(by)[0], min(least, FEWEST)).otherwise(least)
    return settle(named.groupBy("pool").agg(F.sum("n").alias("n")).where(F.col("n") >= enough).select("pool"), "pools")


def with_pool(rows: DataFrame, large: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The rows with ``pool``: the finest of theirs that is large; else null."""
    everything, *finer = _pool_names(by)
    levels = [f"fit_pool_{i}" for i in range(len(finer))]
    for level, name in zip(levels, finer):
        known = large.select(F.col("pool").alias(level))
        rows = rows.withColumn("fit_name", name).join(known, F.col("fit_name") == F.col(level), "left")
    last = large.where(F.col("pool") == everything).agg(F.max("pool")).scalar()
    return rows.withColumn("pool", F.coalesce(*reversed(levels), last)).drop("fit_name", *levels)


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(pool, centre, inverse): centre and scaled inverse covariance of each pool's concentrated part."""
    fit = rows.where("pool IS NOT NULL AND NOT failed")
    quartiles = [F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias(n) for n in NAMES]
    spread = [((F.col(n)[2] - F.col(n)[0]) / 1.349) for n in NAMES]
    diagonal = [spread[i] * spread[i] if i == j else F.lit(0.0) for i in range(P) for j in range(P)]
    at = fit.groupBy("pool").agg(*quartiles).select(
        "pool", F.array(*[F.col(n)[1].cast("double") for n in NAMES]).alias("centre"), F.array(*diagonal).alias("covariance")
    )
    at = settle(_inverted(at), "estimates")
    for _ in range(steps):
        measured = fit.join(at, "pool").withColumn("distance", _distance())
        cut = measured.groupBy("pool").agg(F.percentile_approx("distance", PART, 1000).alias("cut"))
        bounds = settle(at.join(cut, "pool"), "bounds")  # a small table: no row moves to meet it
        near = fit.join(bounds, "pool").where(_distance() <= F.col("cut"))
        off = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
        sums = [F.avg(o).alias(f"m{i}") for i, o in enumerate(off)]
        sums += [F.avg(off[i] * off[j]).alias(f"m{i}_{j}") for i in range(P) for j in range(i, P)]
        moments = near.groupBy("pool").agg(F.first("centre").alias("centre"), *sums)
        centre = F.array(*[F.col("centre")[i] + F.col(f"m{i}") for i in range(P)])
        covariance = F.array(
            *[F.col(f"m{min(i, j)}_{max(i, j)}") - F.col(f"m{i}") * F.col(f"m{j}") for i in range(P) for j in range(P)]
        )
        at = settle(_inverted(moments.select("pool", centre.alias("centre"), covariance.alias("covariance"))), "estimates")
    middle = (
        fit.join(at, "pool").withColumn("distance", _distance()).groupBy("pool")
        .agg(F.greatest(F.percentile_approx("distance", 0.5, 1000) / MEDIAN, F.lit(1.0)).alias("scale"))
    )  # fmt: skip  # the concentrated part is narrower than its group
    scaled = at.join(middle, "pool").withColumn("inverse", F.transform("inverse", lambda x: x / F.col("scale")))
    return settle(scaled.select("pool", "centre", "inverse"), "estimates")


def fit(measured: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The large pools and their estimates."""
    large = large_pools(measured, by)
    return large, estimates(settle(with_pool(measured, large, by), "pooled"))


def verdicts(measured: DataFrame, large: DataFrame, found: DataFrame, by: tuple[str, ...], cutoff: float) -> DataFrame:
    """The measured rows with ``distance`` and ``kept``; small tables are joined, no row moves."""
    judged = with_pool(measured, large, by).join(found, "pool", "left").withColumn("distance", _distance())
    return judged.withColumn("kept", ~F.col("failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


def judge_quality(
    docs: DataFrame, cutoff: float = CUTOFF, key: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")
) -> DataFrame:
    """(key, by, statistics, base_failed, distance, kept); distance is null for texts of no large pool."""
    measured = settle(measure(docs.select(key, *by, text), text), "measured")
    return verdicts(measured, *fit(measured, by), by, cutoff).select(
        key, *by, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("failed").alias("base_failed"), "distance", "kept",
    )


def keep_quality(
    docs: DataFrame, cutoff: float = CUTOFF, text: str = "text", by: tuple[str, ...] = ("lang", "source")
) -> DataFrame:
    """The rows that are kept, with all their columns. Texts are measured twice and never shuffled."""
    measured = settle(measure(docs.select(*by, text), text), "measured")
    plain = docs.select(*[F.col(c).alias(f"doc_{i}") for i, c in enumerate(docs.columns)])
    named = tuple(f"doc_{docs.columns.index(c)}" for c in by)
    again = measure(plain.withColumn("body", F.col(f"doc_{docs.columns.index(text)}")), "body")
    large, found = fit(measured, by)
    kept = verdicts(again, large, found, named, cutoff).where("kept")
    return kept.select(*[F.col(f"doc_{i}").alias(c) for i, c in enumerate(docs.columns)])
