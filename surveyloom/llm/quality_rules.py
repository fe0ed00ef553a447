"""Quality rules: plain base counts, then robust multivariate outliers by language and source.

The base rules count words and repetition. What passes them is turned into a vector of transformed
statistics, and a minimum-covariance-determinant estimate for each language and source tells which
vectors lie too far out, by their Mahalanobis distance.

**Statistics.** Word length, marks (punctuation and symbols), short words and ends of sentences: four
shares that vary in every clean text. Each is smoothed as if the text had ``PRIOR_WORDS`` more words
with the median shares of its group, so that short texts do not spread more widely than long ones.

**Estimation.** Vectors are kept in fixed point, so every sum is exact and independent of the order
of tasks. From several starts (the mean, the median, and small subsets drawn by hash), concentration
steps repeat: distances under the present centre and covariance; of each group the ``SUBSET`` share
with the least distances, found on a histogram of their logarithms; centre and covariance of these.
The start with the least determinant wins. Rows never leave their tasks: a step ships one row of
counts or sums for each task, group and start. A group with a third of all rows is pre-aggregated
like any other. The steps go through small tables in the shared folder, so a lost executor costs one
step.

**Limit.** Squared distances of clean text follow the law of ``DIM`` times an F-ratio of ``DIM`` and as
many degrees as the estimate has rows; a text goes beyond what a share of ``BEYOND`` of such texts
exceeds. That is 23.5 for many rows, as by the chi-square law, and more for few.

**Small groups.** A language and source with fewer than ``MIN_ROWS`` rows is estimated with the
other small ones of its language; if these are still too few, with those of all languages. Every
estimate leans on that of all central rows together as if it had ``PRIOR_ROWS`` rows more, and that
one on ``PRIOR_SPREAD`` in the same way, so each row is judged however few there are.

Null text counts as no words and fails the base rules. Null language or source is a value of its
own. Repeated rows count as often as they occur. An empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from surveyloom.llm.batches import map_batches, texts_of
from surveyloom.sources.workspace import written

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
SUBSET = 0.75
MIN_ROWS = 60
STEPS = 4
#: Words with the group's median shares that every text is given on top of its own.
PRIOR_WORDS = 200
#: Longest short word, in code points.
SHORT = 3
DIM = 4
#: Covariance of all rows over that of the central ``SUBSET`` share, for normal rows of ``DIM``
#: coordinates.
CONSISTENCY = 1.4864
#: Share of clean texts that the law of the distances leaves beyond the limit.
BEYOND = 1e-4
#: Random starts of the search beside the mean and the median, and the rows expected in each.
RANDOM_STARTS = 3
START_ROWS = 12
#: Rows by which an estimate leans on that of all groups, and that one on ``PRIOR_SPREAD``.
PRIOR_ROWS = 10
PRIOR_SPREAD = 0.5
#: Least variance of a coordinate, against singular matrices only.
RIDGE = 1e-5
#: Steps of the fixed-point vectors, for one unit.
SCALE = 1024
BINS_PER_OCTAVE = 16
#: Most rows of a table of groups, of some hundred bytes each, that are sent to every task; the
#: rows of a group are spread over so many tasks beyond.
BROADCAST_ROWS = 100_000
SALTS = 64

NULLS = {"ignoreNullFields": "false"}
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SHAPE = "n_marks long, n_short long, n_ends long"
#: Share of each statistic, as numerator and denominator.
SHARES = (("word_chars", "n_words"), ("n_marks", "word_chars"), ("n_short", "n_words"),
          ("n_ends", "n_words"))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_MARK = re.compile(r"[^\w\s]")
_END = re.compile(r"[.!?。！？।؟]")
_UNIT = re.compile(r"\x1c|\x1d|\x1e|\x1f|[\x85\xa0  -     　]")


def words_of(text: str) -> list[str]:
    """Words of a text: runs of anything but blank, tab, line feed, VT, FF and CR."""
    return WORD.findall(text) if _UNIT.search(text) else text.split()


def repeated_words(words: list[str]) -> int:
    """Words inside a window of eight that occurs at least twice in the text.

    Word numbers are combined to numbers of windows of two, four and eight, so equal numbers mean
    equal windows and no hash can collide.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    for width in (1, 2, 4):
        pairs = ids[:-width] * (int(ids.max()) + 1) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1]
    repeated = np.bincount(ids)[ids] > 1
    if not repeated.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += repeated
    edges[WINDOW : WINDOW + n] -= repeated
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = words_of(text)
    spaces = sum([text.count(c) for c in _SPACES])
    symbols = sum([text.count(c) for c in _SYMBOLS])
    lines = [line for line in text.split("\n") if line and not line.strip(_SPACES) == ""]
    repeated = len(lines) - len(set(lines))
    return len(words), len(text) - spaces, symbols, repeated, repeated_words(words)


def shape_counts(text: str) -> tuple[int, int, int]:
    """``n_marks, n_short, n_ends``: what the statistics need beside the base counts."""
    short = sum([len(w) <= SHORT for w in words_of(text)])
    return len(_MARK.findall(text)), short, len(_END.findall(text))


def document_counts(docs: DataFrame, carried: Column) -> DataFrame:
    """``carried, lang, source``, the base counts, those of ``SHAPE`` and ``base_failed``.

    ``carried`` is what a caller wants to find again beside the verdict of a row: its id, or all of
    its columns as one struct, which no name can clash with.
    """

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            columns = [batch.column(c) for c in ("carried", "lang", "source")]
            table = np.array([[*base_counts(t), *shape_counts(t)] for t in texts], np.int64)
            columns += [pa.array(table[:, i]) for i in range(table.shape[1])]
            names = [part.split()[0] for part in f"{BASE}, {SHAPE}".split(", ")]
            return pa.RecordBatch.from_arrays(columns, names=["carried", "lang", "source", *names])

        return run

    typed = docs.select(
        carried.alias("carried"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    schema = StructType(
        [*typed.schema.fields[:3],
         *[StructField(part.split()[0], LongType()) for part in f"{BASE}, {SHAPE}".split(", ")]]
    )
    counted = map_batches(typed, make, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def apply_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is the squared robust distance; null where the base rules fail.
    """
    counted = written(document_counts(docs, F.col("doc_id").cast("long")), "quality-counts")
    judged = _judged(counted, *_estimates(counted))
    names = [part.split()[0] for part in BASE.split(", ")]
    return judged.select(
        F.col("carried").alias("doc_id"), *names, "base_failed", "kept", "distance"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Verdicts are made on each row itself, so neither ids nor texts are joined or shuffled; in
    exchange the counts of a text are taken twice, for the estimates and for its verdict.
    """
    counted = written(document_counts(docs, F.lit(None).cast("long")), "quality-counts")
    rows = document_counts(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return _judged(rows, *_estimates(counted)).where("kept").select("carried.*")


def _estimates(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The group of each language and source, and the estimate of each group."""
    groups = with_medians(counted, group_names(counted))
    estimates = estimate(with_group(counted, groups).where(~F.col("base_failed")))
    return groups, written(estimates, "quality-estimates")


def _judged(rows: DataFrame, groups: DataFrame, estimates: DataFrame) -> DataFrame:
    judged = meet(with_group(rows, groups), estimates, {"grp": "grp"}, "left").withColumn(
        "distance", F.when(~F.col("base_failed"), squared_distance())
    )
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("limit"), F.lit(True))
    return judged.withColumn("kept", kept)


def group_names(counted: DataFrame) -> DataFrame:
    """``g_lang, g_source, grp``: the group that a language and source is estimated with."""
    passed = counted.where(~F.col("base_failed"))
    sizes = passed.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_lang = (
        sizes.where(F.col("n") < MIN_ROWS)
        .groupBy(F.col("g_lang").alias("small_lang"))
        .agg(F.sum("n").alias("n_lang"))
    )
    named = sizes.join(by_lang, F.col("g_lang").eqNullSafe(F.col("small_lang")), "left").select(
        "g_lang", "g_source",
        # With nulls written out, so that a null source is no pool of small ones.
        F.when(F.col("n") >= MIN_ROWS, F.to_json(F.struct("g_lang", "g_source"), NULLS))
        .when(F.col("n_lang") >= MIN_ROWS, F.to_json(F.struct("g_lang"), NULLS))
        .otherwise("rest")
        .alias("grp"),
    )
    return written(named, "quality-groups")


def meet(rows: DataFrame, small: DataFrame, keys: dict[str, str], how: str = "inner") -> DataFrame:
    """Joins rows with a written table of groups; ``keys`` gives its column for each of the rows.

    Up to ``BROADCAST_ROWS`` groups, rows stay where they are. Beyond, they are dealt by group and
    a number of the task they come from, so that a group with a third of all rows is many tasks.
    """
    small = small.withColumnsRenamed({right: f"met_{right}" for right in keys.values()})
    same = F.lit(True)
    for left, right in keys.items():
        same = same & F.col(left).eqNullSafe(F.col(f"met_{right}"))
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(small), same, how)
    else:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        small = small.withColumn("met_salt", F.explode(salts))
        rows = rows.withColumn("met_deal", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        joined = rows.join(small, same & (F.col("met_deal") == F.col("met_salt")), how)
    return joined.drop(*[f"met_{right}" for right in keys.values()], "met_deal", "met_salt")


def with_medians(counted: DataFrame, named: DataFrame) -> DataFrame:
    """Adds ``share0..``, the medians of each group, to the names of groups."""
    passed = counted.where(~F.col("base_failed"))
    medians = meet(passed, named, {"lang": "g_lang", "source": "g_source"}).groupBy("grp").agg(
        *[F.percentile_approx(F.col(a) / F.col(b), 0.5, 1000).alias(f"share{i}")
          for i, (a, b) in enumerate(SHARES)]
    )
    return written(named.join(medians, "grp"), "quality-shares")


def with_group(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds ``grp`` and the vector ``x0..`` in fixed point.

    Both are null where no row of the language and source passed the base rules. The vector holds
    the logarithms of the mean word length and of three shares in hundredths, one added: marks,
    short words, ends of sentences.
    """
    joined = meet(counted, groups, {"lang": "g_lang", "source": "g_source"}, "left")
    x = {}
    for i, (a, b) in enumerate(SHARES):
        # Characters come by the word, so their weight is that of as many words.
        weight = PRIOR_WORDS * (F.col("share0") if b == "word_chars" else F.lit(1.0))
        share = (F.col(a) + weight * F.col(f"share{i}")) / (F.col(b) + weight)
        value = F.log(share) if i == 0 else F.log(1 + 100 * share)
        x[f"x{i}"] = F.round(value * SCALE).cast("long")
    kept = [c for c in joined.columns if c not in groups.columns or c == "grp"]
    return joined.withColumns(x).select(*kept, *x)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of ``x0..`` from ``centre`` under ``precision`` (row by row)."""
    d = [F.col(f"x{i}") / SCALE - F.col("centre")[i] for i in range(DIM)]
    terms = []
    for i in range(DIM):
        row = sum(((2 if j > i else 1) * F.col("precision")[i * DIM + j] * d[j]
                   for j in range(i, DIM)), F.lit(0.0))
        terms.append(d[i] * row)
    return sum(terms[1:], terms[0])


def _sums() -> list[Column]:
    """Exact sums of the vectors and their products."""
    out = [F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"x{i}") for i in range(DIM)]).alias("s")]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(DIM) for j in range(i, DIM)]
    return [*out, F.array(*products).alias("p")]


ESTIMATE = (
    "grp string, start int, n long, centre array<double>, cov array<double>, "
    "precision array<double>, logdet double"
)


def _fit(sums: DataFrame) -> DataFrame:
    """Centre, covariance and determinant of every row of sums; a handful of small matrices."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(DIM)
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                centre = np.asarray(r.s, float) / r.n / SCALE
                cov = np.zeros((DIM, DIM))
                cov[upper] = np.asarray(r.p, float) / r.n / SCALE**2
                cov = (cov + np.triu(cov, 1).T - np.outer(centre, centre)) * r.factor
                cov += RIDGE * np.eye(DIM)
                sign, logdet = np.linalg.slogdet(cov)
                precision = np.linalg.inv(cov).ravel()
                rows.append((r.grp, r.start, r.n, centre, cov.ravel(), precision, logdet))
            names = ["grp", "start", "n", "centre", "cov", "precision", "logdet"]
            yield pd.DataFrame(rows, columns=names)

    return sums.mapInPandas(run, ESTIMATE)


def estimate(rows: DataFrame) -> DataFrame:
    """``grp, centre, precision, limit`` of each group, by concentration steps from several starts.

    Start 0 is the mean and covariance of all rows, start 1 the coordinate-wise median with the
    spread of the rows between the outer eighths, the others some ``START_ROWS`` rows each, drawn
    by a hash of the vector and the number of the start.
    """
    rows = rows.where(F.col("grp").isNotNull()).select("grp", *[f"x{i}" for i in range(DIM)])
    middle = written(
        rows.groupBy("grp").agg(
            F.count(F.lit(1)).alias("total"),
            *[
                F.percentile_approx(f"x{i}", [0.125, 0.5, 0.875], 1000).alias(f"q{i}")
                for i in range(DIM)
            ],
        ),
        "quality-middle",
    )
    spread = [((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / (2.3 * SCALE)) for i in range(DIM)]
    diagonal = [
        (1 / (spread[i] * spread[i] + RIDGE) if i == j else F.lit(0.0))
        for i in range(DIM) for j in range(DIM)
    ]
    none = F.array(*[F.lit(0.0)] * DIM * DIM)
    robust = middle.select(
        "grp", F.lit(1).alias("start"), F.col("total").alias("n"),
        F.array(*[F.col(f"q{i}")[1] / SCALE for i in range(DIM)]).alias("centre"),
        none.alias("cov"), F.array(*diagonal).alias("precision"), F.lit(0.0).alias("logdet"),
    )
    numbers = F.array(F.lit(0), *[F.lit(2 + i) for i in range(RANDOM_STARTS)])
    # Between 0 and 1, the same for equal vectors.
    drawn = F.pmod(F.xxhash64("start", *[f"x{i}" for i in range(DIM)]), F.lit(1 << 52)) / 2.0**52
    sums = (
        meet(rows, middle.select("grp", "total"), {"grp": "grp"})
        .withColumn("start", F.explode(numbers))
        .where((F.col("start") == 0) | (drawn * F.col("total") < START_ROWS))
        .groupBy("grp", "start").agg(*_sums())
    )
    now = _fit(sums.withColumn("factor", F.lit(1.0))).unionByName(robust)
    now = written(now, "quality-starts")
    for step in range(STEPS):
        now = written(_concentrate(rows, now, last=step == STEPS - 1), f"quality-step{step}")
    best = now.groupBy("grp").agg(
        F.min_by(F.struct("n", "centre", "cov"), F.struct("logdet", "start")).alias("b")
    )
    return _shrunk(written(best.select("grp", "b.*"), "quality-best"))


def limit_of(degrees: float) -> float:
    """Squared distance that a share of ``BEYOND`` exceeds, for so many degrees of the estimate.

    For four statistics the tail of the F-ratio is ``w**a * (1 + a * (1 - w))`` with half the
    degrees as ``a`` and ``w = degrees / (degrees + squared distance)``.
    """
    low, high, a = 0.0, 1.0, degrees / 2
    for _ in range(60):
        w = (low + high) / 2
        low, high = (low, w) if w**a * (1 + a * (1 - w)) > BEYOND else (w, high)
    return degrees * (1 - low) / low


def _shrunk(best: DataFrame) -> DataFrame:
    """``grp, centre, precision, limit``, each leaning on the estimate of all groups together.

    The driver sees one row of sums, however many groups there are.
    """
    pairs = [(i, j) for i in range(DIM) for j in range(DIM)]
    n, c, v = F.col("n"), F.col("centre"), F.col("cov")
    total = best.agg(
        F.sum("n"), *[F.sum(n * c[i]) for i in range(DIM)],
        *[F.sum(n * (v[i * DIM + j] + c[i] * c[j])) for i, j in pairs],
    ).first()
    rows = float(total[0] or 1)
    values = np.array([x or 0.0 for x in total[1:]]) / rows
    mean, square = values[:DIM], values[DIM:].reshape(DIM, DIM)
    wide = np.eye(DIM) * PRIOR_SPREAD**2
    common = (rows * (square - np.outer(mean, mean)) + PRIOR_ROWS * wide) / (rows + PRIOR_ROWS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                own = r.n / (r.n + PRIOR_ROWS)
                centre = own * np.asarray(r.centre) + (1 - own) * mean
                cov = own * np.asarray(r.cov).reshape(DIM, DIM) + (1 - own) * common
                limit = limit_of(r.n + PRIOR_ROWS)
                out.append((r.grp, centre, np.linalg.inv(cov).ravel(), limit))
            yield pd.DataFrame(out, columns=["grp", "centre", "precision", "limit"])

    return best.mapInPandas(
        run, "grp string, centre array<double>, precision array<double>, limit double"
    )


def _concentrate(rows: DataFrame, now: DataFrame, last: bool) -> DataFrame:
    """One concentration step; the last one scales the covariance to that of all rows."""
    octave = F.log2(F.greatest(F.col("d"), F.lit(2.0**-20)))
    binned = (
        meet(rows, now.select("grp", "start", "centre", "precision"), {"grp": "grp"})
        .withColumn("d", squared_distance())
        .select("grp", "start", F.floor(octave * BINS_PER_OCTAVE).cast("int").alias("bin"),
                *[f"x{i}" for i in range(DIM)])
    )
    # One row for each group, start and bin, however many rows of text lie behind them.
    counts = binned.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
    cut = counts.groupBy("grp", "start").agg(
        F.sum("n").alias("total"),
        F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins"),
    ).select(
        "grp", "start",
        F.expr(
            "aggregate(bins, named_struct('seen', 0L, 'cut', cast(null as int)), (a, b) -> "
            f"named_struct('seen', a.seen + b.n, 'cut', coalesce(a.cut, "
            f"if(a.seen + b.n >= {SUBSET} * total, b.bin, null)))).cut"
        ).alias("cut"),
    )
    # Written, so that its size is known and rows are not shuffled to meet a few numbers.
    cut = written(cut, "quality-cut")
    central = meet(binned, cut, {"grp": "grp", "start": "start"}).where(F.col("bin") <= F.col("cut"))
    # Rows inside the ellipsoid spread less than all rows do.
    factor = F.lit(CONSISTENCY if last else 1.0)
    sums = central.groupBy("grp", "start").agg(*_sums())
    return _fit(sums.withColumn("factor", factor))
