"""Quality rules by robust multivariate outliers, in DataFrame functions only.

Each document becomes a vector of transformed text statistics. Per language and source a
minimum covariance determinant estimate (the mean and covariance of the tightest part of the
group) is found by concentration steps from several starts, for each language and for all rows
besides. A group's estimate is completed by a fixed number of rows that are as its language's, and
that one's by rows as all are, so a small group leans on its language and a large one stands for
itself, without a size at which that turns over. Documents far from it by Mahalanobis distance are
rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import words, written

SYMBOLS = r"[#*$%&|<>]"
#: Statistics of the vector, and the spread below which a difference means nothing.
STATS = {"symbols": 0.01, "dup_lines": 0.06, "repeats": 0.08, "word_length": 0.3}
P = len(STATS)
#: Chi-square with 4 degrees of freedom at 0.5 and 0.975.
CHI_MEDIAN, CHI_975 = 3.357, 11.143
#: Rejected beyond this squared distance: chi-square with 4 degrees of freedom at 0.9999.
CUTOFF = 23.513
#: Share of a group that the tightest part holds; concentration steps.
SHARE, STEPS = 0.75, 4
#: So many rows as its language's complete a group's estimate (as all rows', a language's).
PRIOR = 100
#: Key of the group of all rows.
ALL = "0"
#: A group's rows are joined with its estimate in this many parts.
SALTS = 32


def _get(array: Column, i: Column) -> Column:
    return F.get(array, i)


def repeat_words(df: DataFrame, out: str = "n_repeat_words") -> DataFrame:
    """Adds the words (``_w``) that lie in a 3-word window found twice or more.

    Windows are hashed and packed with their place into one long (as many low bits as the
    place needs), sorted, and compared with their neighbours; the few whose hash parts meet
    are compared again as text. Linear but for the sort, also for one word repeated a million
    times; every step is a projection, nothing is shuffled.
    """
    bits = F.length(F.bin(F.size("_w").cast("long")))
    d = df.withColumns({"_b": bits, "_h": F.transform("_w", lambda w: F.xxhash64(w))})
    packed = F.transform(
        F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0))),
        lambda x, i: F.call_function("shiftleft", F.xxhash64(x, _get(F.col("_h"), i + 1), _get(F.col("_h"), i + 2)), F.col("_b")).bitwiseOR(i.cast("long")))
    d = d.withColumn("_v", packed).drop("_h").withColumn("_v", F.sort_array("_v"))
    top = lambda x: F.call_function("shiftright", x, F.col("_b"))
    near = F.filter("_v", lambda x, i: (top(x) == top(_get(F.col("_v"), i + 1)))
                    | (top(x) == top(_get(F.col("_v"), i - 1))))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_b")) - 1
    d = d.withColumn("_p", F.transform(near, lambda x: x.bitwiseAND(mask).cast("int"))).drop("_v")
    gram = lambda p: F.concat_ws(" ", _get(F.col("_w"), p), _get(F.col("_w"), p + 1), _get(F.col("_w"), p + 2))
    d = d.withColumn("_g", F.sort_array(F.transform("_p", lambda p: F.struct(gram(p).alias("g"), p.alias("p")))))
    same = F.filter("_g", lambda x, i: (x["g"] == _get(F.col("_g"), i + 1)["g"])
                    | (x["g"] == _get(F.col("_g"), i - 1)["g"]))
    d = d.withColumn("_p", F.sort_array(F.transform(same, lambda x: x["p"]))).drop("_g")
    gap = F.transform("_p", lambda p, i: F.least(F.lit(3), p - F.coalesce(_get(F.col("_p"), i - 1), F.lit(-3))))
    return d.withColumn(out, F.aggregate(gap, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_p", "_b")


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text; one row per input row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(
        "doc_id", "lang", "source", words(F.col("text")).alias("_w"), lines.alias("_l"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS + "+", ""))).cast("long").alias("n_symbols"))
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
    }).drop("_l")
    return repeat_words(d).drop("_w").withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _forward(x: list[Column], low: dict[tuple[int, int], Column]) -> Column:
    """Squared length of L^-1 x for a lower triangular L."""
    z: list[Column] = []
    for i in range(P):
        v = x[i]
        for j in range(i):
            v = v - low[i, j] * z[j]
        z.append(v / low[i, i])
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _shape(d: DataFrame, starts) -> DataFrame:
    """Adds the mean, the Cholesky factor ``l{s}_ij`` of the ridged covariance and its
    determinant, from the moments of each start s; all starts in the same few projections."""
    floor = [v * v for v in STATS.values()]
    lower = [(i, j) for i in range(P) for j in range(i + 1)]
    d = d.withColumns({f"m{s}_{i}": F.coalesce(F.col(f"s{s}_{i}") / F.col(f"n{s}"), F.lit(0.0))
                       for s in starts for i in range(P)})
    d = d.withColumns({f"c{s}_{i}{j}": F.coalesce(
        F.col(f"q{s}_{i}{j}") / F.col(f"n{s}") - F.col(f"m{s}_{i}") * F.col(f"m{s}_{j}"), F.lit(0.0))
        + F.lit(floor[i] if i == j else 0.0) for s in starts for i, j in lower})

    def rest(s: int, i: int, j: int) -> Column:
        v = F.col(f"c{s}_{i}{j}")
        for k in range(j):
            v = v - F.col(f"l{s}_{i}{k}") * F.col(f"l{s}_{j}{k}")
        return v

    for j in range(P):  # column by column: first its diagonal, then what stands below
        d = d.withColumns({f"l{s}_{j}{j}": F.sqrt(F.greatest(rest(s, j, j), F.lit(floor[j] * 1e-3))) for s in starts})
        if j < P - 1:
            d = d.withColumns({f"l{s}_{i}{j}": rest(s, i, j) / F.col(f"l{s}_{j}{j}") for s in starts for i in range(j + 1, P)})
    return d.withColumns({f"det{s}": reduce(Column.__mul__, [F.col(f"l{s}_{i}{i}") for i in range(P)]) for s in starts})


#: Names of the sums of values and products of the first start.
SUMS = [f"s0_{i}" for i in range(P)] + [f"q0_{i}{j}" for i in range(P) for j in range(i + 1)]


def _keep(s: int) -> list[str]:
    return [f"m{s}_{i}" for i in range(P)] + [f"l{s}_{i}{j}" for i in range(P) for j in range(i + 1)] + [f"det{s}"]


def _distance(s: int) -> Column:
    low = {(i, j): F.col(f"l{s}_{i}{j}") for i in range(P) for j in range(i + 1)}
    return _forward([F.col(f"x{i}") - F.col(f"m{s}_{i}") for i in range(P)], low)


def _moments(inside: Column, s: int) -> list[Column]:
    one = lambda v: F.sum(F.when(inside, v))
    return [F.sum(F.when(inside, 1.0)).alias(f"n{s}")] + [one(F.col(f"x{i}")).alias(f"s{s}_{i}") for i in range(P)] + [
        one(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{s}_{i}{j}") for i in range(P) for j in range(i + 1)]


def _joined(x: DataFrame, params: DataFrame, how: str = "inner") -> DataFrame:
    """Each row with its group's row; groups are salted, as one may hold a third of all rows."""
    salted = params.withColumnRenamed("g", "_pg").withColumn("_ps", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return x.join(salted, (F.col("g") == F.col("_pg")) & (F.col("salt") == F.col("_ps")), how).drop("_pg", "_ps")


def levels(rows: DataFrame) -> DataFrame:
    """Each row three times: in its group, its language and among all (column ``g``)."""
    return rows.withColumn("g", F.explode(F.array("g", "up", F.lit(ALL)))).drop("up")


def completed(rows: DataFrame, found: DataFrame, means: list[str]) -> DataFrame:
    """g and the ``means`` of each group of the rows: over its n rows and PRIOR more.

    ``found`` has a row per group of every level (g, n, means). The further rows are as the
    language's means, which are completed in the same way from the means over all.
    """
    top = found.where(F.col("g") == ALL).first()
    at = lambda v: found.select(F.col("g").alias(f"_{v}"), F.col("n").alias(f"n_{v}"),
                                *[F.col(c).alias(f"{c}_{v}") for c in means])
    groups = rows.select("g", "up").distinct().join(at("own"), F.col("g") == F.col("_own"), "left").join(
        at("up"), F.col("up") == F.col("_up"), "left")

    def more(level: str, mean: str, parent: Column) -> Column:
        n = F.coalesce(F.col(f"n_{level}"), F.lit(0.0))
        return (n * F.coalesce(F.col(f"{mean}_{level}"), F.lit(0.0)) + PRIOR * parent) / (n + PRIOR)

    return groups.select("g", *[more("own", c, more("up", c, F.lit(top[c] if top else None).cast("double"))).alias(c)
                                for c in means])


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the group ``g`` and the vector ``x0 .. x3`` to the counts.

    Ratios are smoothed (a short text's single repeat says little); the mean word length is
    its difference from the group's median (completed by the language's), shrunk for short
    texts. ``up`` is the key of the language.
    """
    s = stats.withColumns({
        "g": F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))), "up": F.concat(F.lit("1"), F.to_json(F.struct("lang"))),
        "salt": F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(SALTS)).cast("int")})
    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    middle = levels(s.where(~F.col("base_failed")).select("g", "up", length.alias("_length"))).groupBy("g").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.percentile_approx("_length", 0.5, 1000).alias("_mid"))
    s = _joined(s, completed(s, written(middle.coalesce(1)), ["_mid"]), "left")
    n = F.col("n_words").cast("double")
    return s.withColumns({
        "x0": F.col("n_symbols") / (F.col("word_chars") + F.lit(50.0)),
        "x1": F.col("n_dup_lines") / (F.col("n_lines") + F.lit(5.0)),
        "x2": F.col("n_repeat_words") / (n + F.lit(50.0)),
        "x3": F.coalesce((length - F.col("_mid")) * F.sqrt(n / (n + F.lit(200.0))), F.lit(0.0)),
    }).drop("_mid")


def estimates(x: DataFrame) -> DataFrame:
    """Reweighted MCD mean and Cholesky factor of every group (columns ``m0_*``, ``l0_*``).

    Three starts (median with fixed spreads, all rows, the rows around the median) go through
    STEPS concentration steps; the smallest determinant wins; rows within the 97.5 % ellipsoid
    give the final estimate. Quantiles come from a mergeable sketch (rank error 1/1000) and
    moments from partial sums, so a group of any size is never gathered; a step's table has a
    row per group. Beside the estimate: n, the rows it rests on, and the means of their values
    and products (``s0_*``, ``q0_*``).
    """
    level = lambda col, q: F.percentile_approx(col, q, 1000)
    starts = range(3)
    first = x.groupBy("g").agg(*[level(F.col(f"x{i}"), 0.5).alias(f"med{i}") for i in range(P)],
                               *[c for c in _moments(F.lit(True), 1)])
    spread = [v * v for v in STATS.values()]
    made = {f"n{s}": F.lit(1.0) for s in (0, 2)}
    for s in (0, 2):
        made |= {f"s{s}_{i}": F.col(f"med{i}") for i in range(P)}
        made |= {f"q{s}_{i}{j}": F.col(f"med{i}") * F.col(f"med{j}") + F.lit(spread[i] if i == j and s == 0 else 0.0)
                 for i in range(P) for j in range(i + 1)}
    first = _shape(first.withColumns(made), starts)
    params = written(first.select("g", *[c for s in starts for c in _keep(s)]).coalesce(1))
    for step in range(STEPS):
        d = _joined(x, params).withColumns({f"d{s}": _distance(s) for s in starts})
        share = lambda s: 0.5 if step == 0 and s == 2 else SHARE  # noqa: E731, B023
        cut = d.groupBy("g").agg(*[level(F.col(f"d{s}"), share(s)).alias(f"t{s}") for s in starts])
        d = _joined(d.select("g", "salt", *[f"x{i}" for i in range(P)], *[f"d{s}" for s in starts]), cut)
        new = d.groupBy("g").agg(*[c for s in starts for c in _moments(F.col(f"d{s}") <= F.col(f"t{s}"), s)])
        new = _shape(new, starts)
        params = written(new.select("g", *[c for s in starts for c in _keep(s)]).coalesce(1))
    best = F.least(*[F.col(f"det{s}") for s in starts])
    pick = lambda c: F.coalesce(*[F.when(F.col(f"det{s}") == best, F.col(c.replace("0", str(s), 1))) for s in starts])
    chosen = params.select("g", *[pick(c).alias(c) for c in _keep(0)])
    # Scale by the median distance, then reweight: rows inside the ellipsoid count.
    d = _joined(x, chosen).withColumn("d0", _distance(0))
    scale = d.groupBy("g").agg((level(F.col("d0"), 0.5) / F.lit(CHI_MEDIAN)).alias("k"))
    d = _joined(d, scale).withColumn("inside", F.col("d0") <= F.lit(CHI_975) * F.greatest(F.col("k"), F.lit(1.0)))
    final = d.groupBy("g").agg(*_moments(F.col("inside"), 0))
    return written(_shape(final, [0]).select("g", F.col("n0").alias("n"), *_keep(0), *[
        (F.col(c) / F.col("n0")).alias(c) for c in SUMS]).coalesce(1))


def judge(docs: DataFrame) -> DataFrame:
    """One row per input row: counts, ``base_failed``, ``distance2`` and ``kept``.

    NULL and empty texts have no words and fail the base rules. NULL lang or source is a value
    like any other. A group without rows that pass the base rules needs no estimate; one of a
    single row is judged nearly by its language. Repeated rows are judged alike; an empty table
    gives an empty result.
    """
    stats = written(text_statistics(docs))
    x = vectors(stats)
    passed = x.where(~F.col("base_failed"))
    found = estimates(levels(passed.select("g", "up", "salt", *[f"x{i}" for i in range(P)])))
    means = completed(passed, found, SUMS).withColumn("n0", F.lit(1.0))
    params = written(_shape(means, [0]).select("g", *_keep(0)).coalesce(1))
    d = _joined(x, params, "left")
    d = d.withColumn("distance2", _distance(0))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.coalesce(F.col("distance2") <= CUTOFF, F.lit(False))).alias("kept"),
        "lang", "source", "distance2")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    keyed = docs.select(F.struct("*").alias("_row"), "doc_id", "lang", "source",
                        F.xxhash64("doc_id", "text").alias("_t"))
    verdict = judge(docs.select(F.struct("doc_id", F.xxhash64("doc_id", "text").alias("h")).alias("doc_id"),
                                "text", "lang", "source"))
    good = verdict.where("kept").select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_h"),
                                        F.col("lang").alias("_lang"), F.col("source").alias("_source")).distinct()
    on = (F.col("_t") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("lang").eqNullSafe(
        F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return keyed.join(good, on, "left_semi").select("_row.*")


