"""Robust multivariate outliers: minimum-covariance-determinant estimates per language and source.

Every text gets whole-text counts and a vector of transformed statistics
(variance-stabilised shares, a log word length, each shrunk towards the value
of ordinary prose by a few pseudo-counts, so that short texts are not outliers
by chance): symbols, capitals, punctuation, word length, repeated passages and
lines, words equal to the one before. Per (language, source) the location and scatter of the vectors come
from the ``SHARE`` of rows whose Mahalanobis distances are smallest: two
deterministic starts (median and MAD; mean and covariance) are improved by
concentration steps, the smaller determinant wins and is reweighted. Rows whose
squared distance exceeds a far chi-square quantile are rejected.

Each step is a pair of Spark aggregates over the light statistics table
(a distance quantile, then moments of the rows within it), so a group with a
third of all rows only ever meets partial aggregates; nothing is sampled.
Quantiles are read off counts of fixed bins, which add up across tasks: a map
task ships at most a few thousand counts per model, whatever its rows.

Every group is fitted, and so are every language and the whole table. A group of n
rows is judged by its own estimate with weight n / (n + ``PRIOR_ROWS``) and its
language's with the rest; the language's is drawn towards the whole table's in the
same way. The floors of the scatter keep the estimate regular in a table of any size.

Edge cases. Null, empty and white-space texts have zero counts and fail the
base rules. Null languages or sources are groups of their own. Equal rows get
equal verdicts. An empty table gives an empty result. Extra columns are ignored
by ``score`` and passed through by ``keep_good``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import bounded, fresh, prepare, saved, texts_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SHARE = 0.75  # of a group's rows that carry the estimate
STEPS = 3
PRIOR_ROWS = 200  # rows that the estimate of the wider group counts for
BIN = 1e-3  # width of the quantile bins: of a statistic, and of log(1 + squared distance)
TAIL = 1e-3  # of the chi-square distribution beyond the cutoff
MAX_MODELS = 100_000  # broadcast bound (rows of about 500 bytes)

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
PUNCT = np.array([c for c in range(33, 127) if not chr(c).isalnum() and c not in set(SYMBOLS.tolist())])
DIMS = ["symbols", "upper", "punct", "word_length", "repeats", "dup_lines", "neighbours"]
#: A standard deviation that every estimate has at least: deviations well below it do not matter for quality.
FLOOR = [0.04, 0.08, 0.08, 0.12, 0.12, 0.15, 0.08]
PSEUDO_CHARS, PSEUDO_WORDS, PSEUDO_LINES = 100, 30, 6
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, " + ", ".join(f"{c} double" for c in DIMS)


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more, the first occurrence included."""
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    starts = len(a) - window + 1
    if starts < 2 or len(ids) == len(a):
        return 0
    span = 1
    while span < window:  # identifiers of twice as long windows from pairs of identifiers; the last step may overlap
        step = min(span, window - span)
        pair = a[:-step] * (int(a.max()) + 1) + a[step:]
        a = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        span += step
    twice = np.bincount(a)[a] > 1
    if not twice.any():
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: bytes) -> tuple:
    """Counts, base verdict and transformed statistics of one text."""
    words = text.split()
    n = len(words)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(hist[128:192].sum())
    word_chars = chars - int(hist[32] + hist[9:14].sum())
    n_symbols = int(hist[SYMBOLS].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeat_words(words)
    lower = text.lower().split()
    n_neighbours = sum(map(bytes.__eq__, lower, lower[1:]))
    failed = n < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n

    def share(part: int, whole: int, pseudo: int) -> float:
        return math.asin(math.sqrt(min(1.0, part / (whole + pseudo))))

    return (n, word_chars, n_symbols, n_dup, n_repeat, failed,
            share(n_symbols, chars, PSEUDO_CHARS), share(int(hist[65:91].sum()), chars, PSEUDO_CHARS),
            share(int(hist[PUNCT].sum()), chars, PSEUDO_CHARS),
            math.log((word_chars + 6 * PSEUDO_WORDS) / (n + PSEUDO_WORDS)),
            share(n_repeat, n, PSEUDO_WORDS), share(n_dup, len(lines), PSEUDO_LINES),
            share(n_neighbours, n, PSEUDO_WORDS))


def _with_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch, without its last column (the text), with the statistics after its columns."""
    for batch in batches:
        rows = [statistics(t) for t in texts_of(batch.column(batch.num_columns - 1))]
        new = [pa.array(c, t) for c, t in zip(
            zip(*rows) if rows else [()] * (6 + len(DIMS)),
            [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * len(DIMS))]
        kept = batch.columns[:-1]
        yield pa.RecordBatch.from_arrays([*kept, *new], [f"c{i}" for i in range(len(kept) + len(new))])


def with_statistics(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the statistics as further columns under names that do not clash; also their names."""
    prepare(df.sparkSession)
    names, renamed = list(df.columns), {}
    fields = [f.strip().split(" ") for f in STATS.split(", ")]
    for name, _ in fields:
        renamed[name] = fresh(names, name)
        names.append(renamed[name])
    copy = df.select(*(F.col(f"`{c}`") for c in df.columns), F.col(f"`{text}`").alias(fresh(names, "text_copy")))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields),
                        *(f"`{renamed[n]}` {t}" for n, t in fields)])
    return copy.mapInArrow(_with_statistics, schema), renamed


# --- chi-square distribution -------------------------------------------------------------------------------


def chi2_below(x: float, dims: float) -> float:
    """P(chi-square with ``dims`` degrees of freedom <= x), by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = dims / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, dims: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, dims) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float, dims: int) -> float:
    """Factor that makes the scatter of the inner ``share`` of normal data unbiased."""
    return share / chi2_below(chi2_quantile(share, dims), dims + 2)


# --- minimum covariance determinant -----------------------------------------------------------------------


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(DIMS)) for j in range(i, len(DIMS))]


PARAMS = "model string, start int, n double, det double, " + ", ".join(
    [f"m{i} double" for i in range(len(DIMS))] + [f"{x}{i}_{j} double" for x in "cp" for i, j in _pairs()])


def _spread(r: dict, of: str) -> np.ndarray:
    """The symmetric matrix in the fields ``of`` of a row."""
    out = np.zeros((len(DIMS), len(DIMS)))
    for i, j in _pairs():
        out[i, j] = out[j, i] = r[f"{of}{i}_{j}"]
    return out


def _param_row(model: str, start: int, n: float, mean: np.ndarray, cov: np.ndarray) -> list:
    inverse = np.linalg.inv(cov)
    return [model, start, float(n), float(np.linalg.slogdet(cov)[1]), *mean, *(m[i, j] for m in (cov, inverse) for i, j in _pairs())]


def _invert(frames: Iterator[pd.DataFrame], factor: float) -> Iterator[pd.DataFrame]:
    """Moments (n, s_i, q_i_j) of each (model, start) to mean, scatter, precision and log determinant."""
    for frame in frames:
        rows = []
        for r in frame.to_dict("records"):
            mean = np.array([r[f"s{i}"] for i in range(len(DIMS))]) / r["n"]
            cov = (_spread(r, "q") / r["n"] - np.outer(mean, mean)) * factor + np.diag(np.square(FLOOR))
            rows.append(_param_row(r["model"], r["start"], r["n"], mean, cov))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in PARAMS.split(", ")])


def _drawn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of PARAMS with a group's ``rows`` and the wider group's estimate (prefix ``w_``) to the estimate drawn
    towards it."""
    for frame in frames:
        rows = []
        for r in frame.to_dict("records"):
            own = r["rows"] / (r["rows"] + PRIOR_ROWS)
            mean, wide = ([r[f"{x}m{i}"] for i in range(len(DIMS))] for x in ("", "w_"))
            rows.append(_param_row(r["model"], 0, r["rows"], own * np.array(mean) + (1 - own) * np.array(wide),
                                   own * _spread(r, "c") + (1 - own) * _spread(r, "w_c")))
        yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in PARAMS.split(", ")])


def drawn(params: DataFrame, wider: DataFrame) -> DataFrame:
    """``params`` (PARAMS, rows, wide: the wider model's name) drawn towards the estimates ``wider`` (PARAMS)."""
    wide = wider.select(*(F.col(c).alias(f"w_{c}") for c in wider.columns))
    return params.join(bounded(wide, MAX_MODELS), F.col("wide") == F.col("w_model")).mapInPandas(_drawn, PARAMS)


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    x = [F.col(c) for c in DIMS]
    return rows.groupBy("model", "start").agg(
        F.count("*").cast("double").alias("n"), *(F.sum(c).alias(f"s{i}") for i, c in enumerate(x)),
        *(F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i, j in _pairs()),
    ).mapInPandas(lambda f: _invert(f, factor), PARAMS)


def quantile_bins(rows: DataFrame, by: list[str], share: float) -> DataFrame:
    """(``by``, edge): the least ``bin`` of each group up to which at least ``share`` of its rows lie."""
    counts = rows.groupBy(*by, "bin").agg(F.count("*").alias("rows"))
    own = Window.partitionBy(*by)
    upto = counts.withColumn("upto", F.sum("rows").over(own.orderBy("bin"))).withColumn("n", F.sum("rows").over(own))
    return upto.where(F.col("upto") >= share * F.col("n")).groupBy(*by).agg(F.min("bin").alias("edge"))


def medians(rows: DataFrame, values: list[Column], name: str) -> DataFrame:
    """Median of each of ``values`` per model, to half a bin: (model, ``name``0, ``name``1, ...)."""
    bins = F.array(*(F.floor(v / BIN) for v in values))
    edges = quantile_bins(rows.select("model", F.posexplode(bins).alias("dim", "bin")), ["model", "dim"], 0.5)
    return edges.groupBy("model").agg(*(
        F.max(F.when(F.col("dim") == i, (F.col("edge") + 0.5) * BIN)).alias(f"{name}{i}") for i in range(len(values))))


def distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance of the columns ``x`` under the joined parameters."""
    gap = [c - F.col(f"m{i}") for i, c in enumerate(x)]
    return sum((gap[i] * gap[j] * F.col(f"p{i}_{j}") * (1 if i == j else 2) for i, j in _pairs()), F.lit(0.0))


def fit(rows: DataFrame) -> DataFrame:
    """MCD parameters per model, from ``rows`` (model, the DIMS): one row per model."""
    d = len(DIMS)
    x = [F.col(c) for c in DIMS]
    median = saved(medians(rows, x, "m"))
    mad = medians(rows.join(bounded(median, MAX_MODELS), "model"), [F.abs(c - F.col(f"m{i}")) for i, c in enumerate(x)], "a")
    variance = [F.pow(F.col(f"a{i}") * 1.4826, 2) + FLOOR[i] ** 2 for i in range(d)]
    robust = median.join(mad, "model").select(
        "model", F.lit(0).alias("start"), F.lit(0.0).alias("n"), F.lit(0.0).alias("det"), *(f"m{i}" for i in range(d)),
        *((variance[i] if i == j else F.lit(0.0)).alias(f"c{i}_{j}") for i, j in _pairs()),
        *((1 / variance[i] if i == j else F.lit(0.0)).alias(f"p{i}_{j}") for i, j in _pairs()))
    params = saved(robust.union(_moments(rows.withColumn("start", F.lit(1)), 1.0)))
    for _ in range(STEPS):
        near = rows.join(bounded(params, MAX_MODELS), "model").withColumn("bin", F.floor(F.log1p(F.greatest(distance(x), F.lit(0.0))) / BIN))
        edge = saved(quantile_bins(near, ["model", "start"], SHARE))
        inner = near.join(bounded(edge, MAX_MODELS), ["model", "start"]).where("bin <= edge")
        params = saved(_moments(inner, consistency(SHARE, d)))
    best = params.groupBy("model").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
    best = saved(params.join(best, ["model", "start"]))
    inner = rows.join(bounded(best, MAX_MODELS), "model").where(distance(x) <= chi2_quantile(0.975, d))
    return saved(_moments(inner, consistency(0.975, d)))


def _models(stats: DataFrame, lang: str, source: str, failed: str) -> DataFrame:
    """lang, source, rows past the base rules, rows_lang of their language, and the names of the models that they are
    fitted to: own, by_lang and the table's."""
    n = stats.where(~F.col(failed)).groupBy(F.col(lang).alias("lang"), F.col(source).alias("source")).agg(F.count("*").alias("rows"))
    return n.select("lang", "source", "rows", F.sum("rows").over(Window.partitionBy("lang")).alias("rows_lang"),
                    F.concat(F.lit("own "), F.to_json(F.struct("lang", "source"))).alias("own"),
                    F.concat(F.lit("lang "), F.to_json(F.struct("lang"))).alias("by_lang"), F.lit("all").alias("whole"))


def _judge(stats: DataFrame, models: DataFrame, params: DataFrame, lang: str, source: str, names: dict[str, str]) -> DataFrame:
    """``stats`` with the columns of its model's parameters and ``d2`` (null without a model)."""
    models = models.select("lang", "source", F.col("own").alias("model")).join(params, "model").withColumnsRenamed(
        {"lang": "model_lang", "source": "model_source"})
    models = bounded(saved(models), MAX_MODELS)
    joined = stats.join(models, stats[lang].eqNullSafe(models["model_lang"]) & stats[source].eqNullSafe(models["model_source"]), "left")
    return joined.withColumn("d2", distance([stats[names[c]] for c in DIMS]))


def _fitted(stats: DataFrame, lang: str, source: str, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    models = saved(_models(stats, lang, source, names["base_failed"]))
    rows = stats.where(~F.col(names["base_failed"])).select(
        F.col(lang).alias("l"), F.col(source).alias("s"), *(F.col(names[c]).alias(c) for c in DIMS))
    rows = rows.join(bounded(models, MAX_MODELS), rows["l"].eqNullSafe(models["lang"]) & rows["s"].eqNullSafe(models["source"]))
    alone = fit(rows.select(F.explode(F.array("own", "by_lang", "whole")).alias("model"), *DIMS))
    langs = models.select(F.col("by_lang").alias("model"), F.col("rows_lang").alias("rows"), F.col("whole").alias("wide")).distinct()
    langs = saved(drawn(alone.join(langs, "model"), alone))
    return models, saved(drawn(alone.join(models.select(F.col("own").alias("model"), "rows", F.col("by_lang").alias("wide")), "model"), langs))


def score(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Counts, base verdict, squared distance (``outlier_d2``, null without a model) and ``kept`` per row of ``docs``."""
    stats, names = with_statistics(docs.select("doc_id", "lang", "source", "text"))
    stats = saved(stats.drop("text"))
    models, params = _fitted(stats, "lang", "source", names)
    cutoff = chi2_quantile(1 - tail, len(DIMS))
    return _judge(stats, models, params, "lang", "source", names).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"),
        stats["lang"], stats["source"], *DIMS, F.col("d2").alias("outlier_d2"))


def keep_good(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """``docs`` without the rows that the base rules or the outlier test reject; columns unchanged.

    The statistics are made twice (once for the estimates, once beside the
    row they judge), so that the texts are never shuffled.
    """
    light, names = with_statistics(docs.select("lang", "source", "text"))
    light = saved(light.drop("text"))
    models, params = _fitted(light, "lang", "source", names)
    inner = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    of = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    stats, names = with_statistics(inner, of["text"])
    cutoff = chi2_quantile(1 - tail, len(DIMS))
    judged = _judge(stats, models, params, of["lang"], of["source"], names)
    kept = judged.where(~F.col(names["base_failed"]) & F.coalesce(F.col("d2") <= cutoff, F.lit(True)))
    return kept.select(*(F.col(of[c]).alias(c) for c in docs.columns))
