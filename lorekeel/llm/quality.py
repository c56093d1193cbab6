"""Operator 1, quality rules with minimum-covariance-determinant estimates by language and source.

Each text gives counts (the base rules) and a vector of transformed shares. Where the base
rules pass, a robust centre and scatter are estimated for each language and source,
and a document far from its own group's centre is rejected.

The estimate is the deterministic kind: from two starts (medians with quantile widths;
all rows), concentration steps replace centre and scatter by those of the ``SHARE`` of rows
that are closest, for each group and start until its own determinant stops falling; the start with the least determinant
wins, and one reweighting step follows. Centre and scatter of a group are then drawn towards its language's, and
those towards all rows', as if ``PRIOR_ROWS`` rows had those, so that small groups are not
estimated from a few rows and large ones keep their own. A step is one aggregate over all rows: distances
fall into bins of 1/8 octave, each bin of a group holds its count and moments, and the bins up
to the one that completes the share are added up. So a group of any size, also one that
holds a third of all rows, is combined before the shuffle, and no row is ordered or collected. Every
statistic's variance has a floor, which keeps a scatter regular where most rows have 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorekeel.llm.batches import map_batches, text_slices, words_of
from lorekeel.session import cut

#: Statistics of the vector and the least standard deviation that each is given, so small that each can reject a document on its own.
FLOORS = {"v_word_length": 0.05, "v_symbols": 0.03, "v_capitals": 0.03, "v_marks": 0.03, "v_repeats": 0.05, "v_lines": 0.05}
#: Share of a group's rows that the estimate rests on; rows that a language's estimate counts as beside those of a group of it.
SHARE, PRIOR_ROWS = 0.75, 10
#: A clean document is rejected once in so many if transformed statistics are normal; theirs have heavier tails, so it is far out.
ONE_IN = 1_000_000_000
#: Parts that a group's rows are dealt into when they meet its estimate.
SALTS = 32
#: The least fall of a group's log determinant for which its concentration steps go on; floors bound it from below, so they end.
SETTLED = 1e-3

NAMES = list(FLOORS)
P = len(NAMES)
CROSS = [(i, j) for i in range(P) for j in range(i + 1)]


def chi2_cdf(x: float, df: int) -> float:
    """Of an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(q: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, df) < q else (low, mid)
    return low


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole):
            texts = pc.fill_null(batch.column("text"), "")
            starts, codes, distinct = words_of(texts)
            chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.concatenate(([0], np.cumsum(chars[codes]))) if len(codes) else np.zeros(1, np.int64)
            # the code of a word followed by another, then of three in a row; equal exactly where the words are
            wide, n = np.int64(len(distinct)), len(codes)
            codes = codes.astype(np.int64)
            two = codes[:-1] * wide + codes[1:] if n > 1 else np.empty(0, np.int64)
            if wide >= 1 << 20:
                two = np.unique(two, return_inverse=True)[1]
            three = two[:-1] * wide + codes[2:] if n > 2 else np.empty(0, np.int64)
            repeats, again = [], []
            for text, a, b in zip(texts.to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                repeats.append(_covered(three[a : max(a, b - 2)]))
                seen = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
                again.append(len(seen) - len(set(seen)))
            count = lambda pattern: pc.count_substring_regex(texts, pattern).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "lang", "source")), pa.array(np.diff(starts)), pa.array(np.diff(total[starts])),
                 count("[#*$%&|<>]"), pa.array(again, pa.int64()), pa.array(repeats, pa.int64()), count(r"\p{Lu}"), count(r"[\p{P}\p{S}]"), count("\n")],
                ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_breaks"],
            )


def _covered(windows: np.ndarray) -> int:
    """Words that lie in a window found twice or more."""
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    words = np.zeros(len(windows) + 2, bool)
    hit = np.concatenate((order[1:][same], order[:-1][same]))
    for k in range(3):
        words[hit + k] = True
    return int(words.sum())


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts, base verdict and vector of every row; a null text has no words and fails the base rules."""
    given = docs.select(*(F.col(c).alias(n) for c, n in ((id_col, "doc_id"), (lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    kinds = ", ".join(f"{c} {given.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_breaks")
    counted = map_batches(given, _counts, kinds + "".join(f", {c} long" for c in longs))
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return counted.select(
        "doc_id", "lang", "source", *longs[:5],
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("v_word_length"),
        share("n_symbols", "word_chars").alias("v_symbols"), share("n_capitals", "word_chars").alias("v_capitals"), share("n_marks", "word_chars").alias("v_marks"),
        share("n_repeat_words", "n_words").alias("v_repeats"), F.sqrt(F.col("n_dup_lines") / (F.col("n_breaks") + 1)).alias("v_lines"),
        (F.monotonically_increasing_id() % SALTS).alias("salt"),
    )


def _solved(n: pd.Series, sums: pd.Series, cross: pd.Series, factor: pd.Series) -> pd.DataFrame:
    """Centre, floored scatter and its inverse Cholesky factor (lower triangles by rows) and log determinant."""
    out = []
    for k, s, c, f in zip(n, sums, cross, factor):
        mu = np.asarray(s) / k
        cov = np.zeros((P, P))
        for (i, j), x in zip(CROSS, c):
            cov[i, j] = cov[j, i] = f * (x / k - mu[i] * mu[j])
        values, vectors = np.linalg.eigh(cov)
        cov = (vectors * np.maximum(values, 0)) @ vectors.T + np.diag(np.square(list(FLOORS.values())))
        chol = np.linalg.cholesky(cov)
        white = np.linalg.inv(chol)
        out.append((mu.tolist(), [cov[i, j] for i, j in CROSS], [white[i, j] for i, j in CROSS], 2 * float(np.log(np.diag(chol)).sum())))
    return pd.DataFrame(out, columns=["mu", "cov", "white", "logdet"])


def _whitened(cov: pd.Series) -> pd.Series:
    """Inverse Cholesky factors of scatters, both as lower triangles by rows."""
    out = []
    for c in cov:
        full = np.zeros((P, P))
        for (i, j), x in zip(CROSS, c):
            full[i, j] = full[j, i] = x
        white = np.linalg.inv(np.linalg.cholesky(full))
        out.append([white[i, j] for i, j in CROSS])
    return pd.Series(out)


def _distance():
    """Squared Mahalanobis distance of a row's vector under its ``mu`` and ``white``."""
    total, k = [], 0
    for i in range(P):
        parts = []
        for j in range(i + 1):
            parts.append(F.col("white")[k] * (F.col(NAMES[j]) - F.col("mu")[j]))
            k += 1
        y = reduce(lambda a, b: a + b, parts)
        total.append(y * y)
    return reduce(lambda a, b: a + b, total)


def _moments() -> list:
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)]
    return [F.count(F.lit(1)).alias("n"), *sums, *(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"c{i}_{j}") for i, j in CROSS)]


def _from_moments(df: DataFrame, keys: list[str], factor) -> DataFrame:
    sums, cross = F.array(*(f"s{i}" for i in range(P))), F.array(*(f"c{i}_{j}" for i, j in CROSS))
    solved = F.pandas_udf(_solved, "mu array<double>, cov array<double>, white array<double>, logdet double")
    return df.select(*keys, F.col("n").cast("double"), solved("n", sums, cross, factor).alias("e")).select(*keys, "n", "e.mu", "e.cov", "e.white", "e.logdet")


def _meeting(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows with their group's estimates, joined by group and salt: were they dealt by group alone, the next aggregate would not combine before its shuffle."""
    dealt = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
    return rows.join(dealt, ["group_key", "salt"])


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(group_key, rows, mu, cov) for ``rows`` of group_key, salt and the vector's statistics."""
    keys = ["group_key", "start"]
    all_rows = rows.groupBy("group_key").agg(*_moments()).withColumn("start", F.lit("all"))
    sizes = cut(all_rows.select("group_key", F.col("n").alias("rows")))
    mids = rows.groupBy("group_key").agg(*(F.percentile_approx(c, [0.16, 0.5, 0.84], 1000).alias(c) for c in NAMES))
    width = lambda i: (F.col(NAMES[i])[2] - F.col(NAMES[i])[0]) / 2
    middle = mids.select(
        "group_key", F.lit("middle").alias("start"), F.lit(1).alias("n"), *(F.col(c)[1].alias(f"s{i}") for i, c in enumerate(NAMES)),
        *((F.col(NAMES[i])[1] * F.col(NAMES[j])[1] + (width(i) * width(i) if i == j else F.lit(0.0))).alias(f"c{i}_{j}") for i, j in CROSS),
    )
    share = SHARE / chi2_cdf(chi2_quantile(SHARE, P), P + 2)
    # a start's own scatter is no concentrated one, so that the first step is always taken
    now = cut(_from_moments(all_rows.unionByName(middle), keys, F.lit(1.0)).select(*keys, "mu", "white", F.lit(float("inf")).alias("logdet")))
    ended = []
    while not now.isEmpty():
        step = _from_moments(_closest(_meeting(rows, now), sizes, keys), keys, F.lit(share)).select(*keys, *(F.col(c).alias(f"new_{c}") for c in ("mu", "white", "logdet")))
        both = cut(now.join(step, keys))
        falls = F.col("logdet") - F.col("new_logdet") >= SETTLED
        ended.append(both.where(~falls).select(*now.columns))
        now = both.where(falls).select(*keys, *(F.col(f"new_{c}").alias(c) for c in ("mu", "white", "logdet")))
    done = reduce(DataFrame.unionByName, ended) if ended else now
    best = done.withColumn("place", F.row_number().over(Window.partitionBy("group_key").orderBy("logdet", "start"))).where("place = 1")
    near = _meeting(rows, cut(best.select("group_key", "mu", "white"))).where(_distance() <= chi2_quantile(0.975, P))
    factor = 0.975 / chi2_cdf(chi2_quantile(0.975, P), P + 2)
    last = _from_moments(near.groupBy("group_key").agg(*_moments()), ["group_key"], F.lit(factor))
    return last.select("group_key", "mu", "cov").join(sizes, "group_key")


def _drawn(own: str, towards: str):
    """An estimate drawn towards another by ``PRIOR_ROWS``; the other where there is none of its own."""
    a, b = F.col(own), F.col(towards)
    mix = lambda x, y: (x * a["rows"] + y * PRIOR_ROWS) / (a["rows"] + PRIOR_ROWS)
    mixed = F.struct(a["rows"].alias("rows"), F.zip_with(a["mu"], b["mu"], mix).alias("mu"), F.zip_with(a["cov"], b["cov"], mix).alias("cov"))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(mixed)


def _closest(rows: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of the rows in the closest distance bins that together hold ``SHARE`` of the group."""
    binned = F.floor(F.greatest(F.log2(F.greatest(_distance(), F.lit(1e-6))), F.lit(-20.0)) * 8).cast("int")
    bins = rows.withColumn("bin", binned).groupBy(*keys, "bin").agg(*_moments())
    closer = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inside = bins.withColumn("before", F.coalesce(F.sum("n").over(closer), F.lit(0))).join(sizes, "group_key").where(F.expr(f"before < ceil(rows * {SHARE})"))
    names = ["n", *(f"s{i}" for i in range(P)), *(f"c{i}_{j}" for i, j in CROSS)]
    return inside.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, source, the five counts, base_failed, distance, kept.

    ``distance`` is the squared robust distance from the row's own language and source, whose estimate is drawn
    towards the language's and that towards all rows'. A null language or source is a group as any other. A null or
    empty text has no words and fails the base rules; a text of any length is counted whole. Repeated rows are rows of their own and count
    as such in the estimates. Of starts with one determinant the first by name wins, and a distance at the cut itself is kept.
    If no row passes the base rules, all distances are null
    and nothing is kept. Other columns are not read, whatever their names. An empty table gives no rows.
    """
    rows = cut(text_statistics(docs, id_col, text_col, lang_col, source_col))
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    own, of_lang, of_all = F.concat_ws("\x1f", F.lit("2"), named("lang"), named("source")), F.concat_ws("\x1f", F.lit("1"), named("lang")), F.lit("0")
    fit = rows.where("not base_failed").select(F.explode(F.array(own, of_lang, of_all)).alias("group_key"), "salt", *NAMES)
    found = cut(robust_estimates(fit))

    best = cut(rows.select(own.alias("own"), of_lang.alias("of_lang")).distinct()).withColumn("of_all", of_all)
    for level in ("own", "of_lang", "of_all"):
        best = best.join(found.select(F.col("group_key").alias(level), F.struct("rows", "mu", "cov").alias(f"e_{level}")), level, "left")
    best = best.withColumn("e_of_lang", _drawn("e_of_lang", "e_of_all")).withColumn("e", _drawn("e_own", "e_of_lang")).where("e is not null")
    best = best.select("own", "e.mu", F.pandas_udf(_whitened, "array<double>")("e.cov").alias("white"))
    judged = rows.withColumn("own", own).join(cut(best), "own", "left").withColumn("distance", _distance())
    far = chi2_quantile(1 - 1 / ONE_IN, P)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= far, F.lit(True))
    return judged.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
