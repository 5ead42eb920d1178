"""Quality rules: base limits, and robust outliers per language and source.

Only DataFrame functions: statistics of a text are expressions on its row, and the
minimum covariance determinant estimates are repeated aggregations over small rows.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import set_aside, written

SPACE = r"[ \t\n\x0B\f\r]+"
WINDOW = 5
# Rows of its language that stand next to a group's own ones, and rows of all languages
# next to a language's: so estimates of small groups lean on others, without a switch.
PRIOR_ROWS = 200
# Share of a group's rows that the covariance with the least determinant covers.
CORE = 0.75
STEPS = 4
DIMENSIONS = 5
# Least standard deviation of each transformed statistic.
FLOORS = (0.35, 0.12, 0.35, 0.35, 0.12)
# Median of chi square with DIMENSIONS degrees of freedom, fixed.
CHI_MEDIAN = 4.3515
# Squared distance beyond which a row is rejected: below one in 10^9 of normal rows.
CUTOFF = 50.0

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, name: str = "rules") -> DataFrame:
    """``docs`` with a struct of the statistics of its column ``text``."""

    def window(i: Column) -> list[Column]:
        return [F.get("__words", i + k) for k in range(WINDOW)]

    count = F.size("__words")
    starts = F.sequence(F.lit(0), count - WINDOW)
    same = lambda k, other: F.get("__sorted", k)["w"] == F.get("__sorted", other)["w"]
    repeated = F.array_compact(
        F.transform(
            F.sequence(F.lit(0), F.size("__sorted") - 1),
            lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get("__sorted", k)["i"]),
        )
    )
    covered = F.aggregate(
        "__repeated",
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")
        ),
        lambda a: a["n"],
    )
    blank = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        docs.withColumn("__text", blank)
        .withColumn("__words", F.filter(F.split("__text", SPACE), lambda w: w != ""))
        .withColumn(
            "__lines",
            F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")),
        )
        # Equal windows have equal hashes, so rows without equal ones are done.
        .withColumn(
            "__hashes",
            F.when(count >= WINDOW, F.transform(starts, lambda i: F.xxhash64(*window(i)))),
        )
        .withColumn(
            "__sorted",
            F.when(
                F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
                F.sort_array(
                    F.transform(
                        starts, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i"))
                    )
                ),
            ),
        )
        .withColumn("__repeated", F.when(F.col("__sorted").isNotNull(), F.sort_array(repeated)))
        # A row of one: what follows reads the statistics, and never derives them anew.
        .withColumn(
            name,
            F.explode(F.array(F.struct(
                count.cast("long").alias("n_words"),
                F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
                (F.length("__text") - F.length(F.regexp_replace("__text", r"[#*$%&|<>]+", "")))
                .cast("long")
                .alias("n_symbols"),
                (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
                F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                F.size("__lines").cast("long").alias("n_lines"),
            ))),
        )
        .drop("__text", "__words", "__lines", "__hashes", "__sorted", "__repeated")
    )


def base_failed(rules: str) -> Column:
    words, repeats = F.col(f"{rules}.n_words"), F.col(f"{rules}.n_repeat_words")
    return (words < 10) | (100 * repeats > 20 * words)


def vector(rules: str) -> list[Column]:
    """Statistics on scales on which clean texts are about normal."""
    of = lambda field: F.col(f"{rules}.{field}").cast("double")
    words, chars = F.greatest(of("n_words"), F.lit(1.0)), F.greatest(of("word_chars"), F.lit(1.0))
    return [
        F.log(words),
        F.log(chars / words),
        F.log1p(100 * of("n_symbols") / chars),
        F.log1p(of("n_dup_lines")) * (of("n_dup_lines") / F.greatest(of("n_lines"), F.lit(1.0))),
        F.sqrt(of("n_repeat_words") / words),
    ]


def group_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Language and source as text; null is a group of its own, and so is a missing column."""

    def key(name: str) -> Column:
        if name not in docs.columns:
            return F.lit("-")
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))

    return key("lang"), key("source")


XS = [f"x{i}" for i in range(DIMENSIONS)]
PAIRS = list(combinations_with_replacement(range(DIMENSIONS), 2))


def _cells(rows: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    """Rows by grid cell. A group has as many cells as its range is wide, whatever its rows."""
    return rows.groupBy(*keys, F.floor(F.col(value) / width).alias("cell")).agg(F.count("*").alias("n"))


def _quantile(cells: DataFrame, keys: list[str], share: float, width: float) -> DataFrame:
    """keys, ``edge``, the upper edge of the grid cell that holds the quantile, and rows."""
    merged = cells.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counted = merged.select(
        "*",
        F.sum("n").over(up_to).alias("below"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    rank = F.ceil(share * F.col("total"))
    return counted.where((F.col("below") >= rank) & (F.col("below") - F.col("n") < rank)).select(
        *keys, ((F.col("cell") + 1) * width).alias("edge"), "total"
    )


def _grid_quantile(rows: DataFrame, keys: list[str], value: str, share: float, width: float) -> DataFrame:
    return _quantile(_cells(rows, keys, value, width), keys, share, width).drop("total")


def _factor(moments: DataFrame) -> DataFrame:
    """Means and the triangular factor of the covariance, its diagonal floored."""
    out = moments
    factor: dict[tuple[int, int], Column] = {}
    for j in range(DIMENSIONS):
        for i in range(j, DIMENSIONS):
            value = F.col(f"p{j}{i}") - F.col(f"m{j}") * F.col(f"m{i}")
            for k in range(j):
                value = value - factor[i, k] * factor[j, k]
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + FLOORS[j] ** 2)
            else:
                value = value / factor[j, j]
            out = out.withColumn(f"l{i}{j}", value)
            factor[i, j] = F.col(f"l{i}{j}")
    spread = sum(F.log(factor[j, j]) for j in range(DIMENSIONS))
    return out.withColumn("spread", spread).drop(*(f"p{i}{j}" for i, j in PAIRS))


def _squared_distance() -> Column:
    """Of a row's vector from the estimate joined to it, by forward substitution."""
    z: list[Column] = []
    for i in range(DIMENSIONS):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * z[k]
        z.append(value / F.col(f"l{i}{i}"))
    return sum(value * value for value in z)


MOMENTS = [f"m{i}" for i in range(DIMENSIONS)] + [f"p{i}{j}" for i, j in PAIRS]
GROUP = ["lang_key", "source_key"]


def _leaning(own: DataFrame, behind: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Means of ``own`` (sums ``values`` over ``n`` rows), as if PRIOR_ROWS rows with the
    means of ``behind`` stood next to them."""
    means = behind.select(*keys, *(F.col(v).alias(f"behind_{v}") for v in values))
    return own.join(means, keys).select(
        *(c for c in own.columns if c not in values and c != "n"),
        *(((F.col(v) + PRIOR_ROWS * F.col(f"behind_{v}")) / (F.col("n") + PRIOR_ROWS)).alias(v) for v in values),
    )


def _moments(core: DataFrame) -> DataFrame:
    """Means and mean products of each group and start, leaning on its language's."""
    products = [F.sum(x) for x in XS] + [F.sum(F.col(XS[i]) * F.col(XS[j])) for i, j in PAIRS]
    sums = written(
        core.groupBy(*GROUP, "start").agg(F.count("*").alias("n"), *(p.alias(v) for p, v in zip(products, MOMENTS))),
        "core",
    )
    merged = [F.sum(v).alias(v) for v in ("n", *MOMENTS)]
    whole = sums.groupBy("start").agg(*merged).select("start", *((F.col(v) / F.col("n")).alias(v) for v in MOMENTS))
    language = _leaning(sums.groupBy("lang_key", "start").agg(*merged), whole, ["start"], MOMENTS)
    return _leaning(sums, language, ["lang_key", "start"], MOMENTS)


def _middles(distances: DataFrame) -> DataFrame:
    """Medians of ``rank`` by group, leaning on the median of the language."""
    cells = written(_cells(distances, GROUP, "rank", 0.02), "ranks").withColumn("all", F.lit(0))

    def of(*keys: str) -> DataFrame:
        found = _quantile(cells, list(keys), 0.5, 0.02)
        return found.select(*keys, F.col("total").alias("n"), (F.col("edge") * F.col("total")).alias("edge"))

    whole = of("all").select("all", (F.col("edge") / F.col("n")).alias("edge"))
    language = _leaning(of("lang_key").withColumn("all", F.lit(0)), whole, ["all"], ["edge"])
    return _leaning(of(*GROUP), language, ["lang_key"], ["edge"])


def fit(rows: DataFrame) -> DataFrame:
    """Estimates for each language and source from rows (lang_key, source_key, x0 to x4).

    Two starts per group, scaled by the median and the deviation from it: by the sum
    and by the maximum of the scaled coordinates. Each of STEPS concentration steps
    takes the CORE share of rows nearest to the last estimate and estimates anew; the
    start that ends with the smaller determinant stays. Estimates lean on the language's
    core, and that on the core of all, with the weight of PRIOR_ROWS rows. Ranks are
    counted on a fine grid, so they are sums that no order of rows changes.
    """
    rows = rows.select(*GROUP, *XS)
    long = rows.select(
        *GROUP,
        F.explode(
            F.array(*(F.struct(F.lit(i).alias("i"), F.col(x).alias("v")) for i, x in enumerate(XS)))
        ).alias("s"),
    ).select(*GROUP, "s.i", "s.v")
    middle = written(_grid_quantile(long, [*GROUP, "i"], "v", 0.5, 0.01), "middle")
    off = long.join(middle.withColumnRenamed("edge", "middle"), [*GROUP, "i"]).select(
        *GROUP, "i", F.abs(F.col("v") - F.col("middle")).alias("off")
    )
    deviation = _grid_quantile(off, [*GROUP, "i"], "off", 0.5, 0.01).withColumnRenamed("edge", "off")
    start = written(
        middle.join(deviation, [*GROUP, "i"])
        .groupBy(*GROUP)
        .agg(
            *(F.max(F.when(F.col("i") == i, F.col("edge"))).alias(f"m{i}") for i in range(DIMENSIONS)),
            *(F.max(F.when(F.col("i") == i, F.col("off"))).alias(f"s{i}") for i in range(DIMENSIONS)),
        ),
        "start",
    )
    scaled = [
        (F.col(x) - F.col(f"m{i}")) / F.greatest(F.col(f"s{i}") * 1.4826, F.lit(FLOORS[i]))
        for i, x in enumerate(XS)
    ]
    near = rows.join(start, GROUP).select(
        *GROUP,
        *XS,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("start"), sum(z * z for z in scaled).alias("d2")),
                F.struct(F.lit(1).alias("start"), F.greatest(*(z * z for z in scaled)).alias("d2")),
            )
        ).alias("s"),
    ).select(*GROUP, *XS, "s.start", "s.d2")
    keys = [*GROUP, "start"]
    twice = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    model = None
    for step in range(STEPS):
        if step:
            near = twice.join(model, keys).select(*keys, *XS, _squared_distance().alias("d2"))
        ranked = near.withColumn("rank", F.log(F.col("d2") + 1e-6))
        limit = written(_grid_quantile(ranked, keys, "rank", CORE, 0.02), "limit")
        core = ranked.join(limit, keys).where(F.col("rank") < F.col("edge"))
        model = written(_factor(_moments(core)), "model")
    best = model.groupBy(*GROUP).agg(
        F.min_by(F.struct(*(c for c in model.columns if c not in keys)), F.struct("spread", "start")).alias("e")
    ).select(*GROUP, "e.*")
    distances = rows.join(best, GROUP).select(*GROUP, F.log(_squared_distance() + 1e-6).alias("rank"))
    scale = F.greatest(F.exp("edge") / CHI_MEDIAN, F.lit(1.0)).alias("scale")
    return written(best.drop("spread").join(_middles(distances), GROUP).select(
        *GROUP, *best.drop(*GROUP, "spread").columns, scale
    ), "estimates")


def vectors(rows: DataFrame, rules: str = "rules") -> DataFrame:
    """Group keys, statistics and transformed vectors of rows that have statistics."""
    lang, source = group_keys(rows)
    return rows.select(
        lang.alias("lang_key"),
        source.alias("source_key"),
        base_failed(rules).alias("failed"),
        *(v.alias(x) for v, x in zip(vector(rules), XS)),
    )


def judged(rows: DataFrame, estimates: DataFrame, rules: str = "rules") -> DataFrame:
    """Rows with a struct ``verdict``: base_failed, distance (squared), kept."""
    lang, source = group_keys(rows)
    keyed = rows.withColumns({"__lang": lang, "__source": source})
    inner = [c for c in estimates.columns if c not in ("lang_key", "source_key")]
    own = estimates.select(
        F.col("lang_key").alias("__lang"), F.col("source_key").alias("__source"), F.struct(*inner).alias("__e")
    )
    x = vector(rules)
    z: list[Column] = []
    for i in range(DIMENSIONS):
        value = x[i] - F.col(f"__e.m{i}")
        for k in range(i):
            value = value - F.col(f"__e.l{i}{k}") * F.col(f"__z{k}")
        z.append(value / F.col(f"__e.l{i}{i}"))
    out = keyed.join(own, ["__lang", "__source"], "left")
    for i, value in enumerate(z):
        out = out.withColumn(f"__z{i}", value)
    squared = sum(F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(DIMENSIONS)) / F.col("__e.scale")
    verdict = F.struct(
        base_failed(rules).alias("base_failed"),
        squared.alias("distance"),
        (~base_failed(rules) & F.coalesce(squared <= CUTOFF, F.lit(True))).alias("kept"),
    )
    return out.withColumn("verdict", verdict).drop("__lang", "__source", "__e", *(f"__z{i}" for i in range(DIMENSIONS)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Statistics and verdict for each row of ``docs`` (doc_id, text, lang, source).

    A null text has no words, and fails the base rules as an empty one does; null or
    missing lang and source form groups of their own; repeated rows are judged each
    alike; an empty table gives no rows; further columns are not read. Texts are read
    whole. The estimate of a language and source leans on its language's, with the weight of
    PRIOR_ROWS rows, and that on the one of all; where no row passes the base rules there
    is no estimate and no second rule.
    """
    columns = [c for c in ("lang", "source") if c in docs.columns]
    rows = written(
        with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *columns)).drop("text"),
        "statistics",
    )
    estimates = fit(vectors(rows).where(~F.col("failed")))
    return judged(rows, estimates).select(
        "doc_id", *(f"rules.{name}" for name in STATISTICS), "verdict.base_failed", "verdict.distance", "verdict.kept"
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all their columns as they are, whatever
    their names. The texts are not shuffled: statistics are derived once for the
    estimates and once more next to the text."""
    held, back = set_aside(docs, "text", "lang", "source")
    needed = [name for name in ("text", "lang", "source") if name in held.columns]
    rows = written(with_statistics(held.select(*needed)).drop("text"), "statistics")
    estimates = fit(vectors(rows).where(~F.col("failed")))
    return judged(with_statistics(held), estimates).where("verdict.kept").select(*back)
