"""Quality rules: robust multivariate outliers within a language and source, DataFrame functions only.

Each text gives statistics (counted over the whole text) and from them a vector of five
transformed ones. Per language and source, a minimum-covariance-determinant estimate is found:
from each of three starts, concentration steps (distances from the estimate so far, the nearest half
of the texts, their mean and covariance) go on until the determinant stops falling, and the
estimate of least determinant is taken. As half of a group makes the estimate, junk may be up to
nearly half of it. A text is rejected when its squared Mahalanobis distance from that estimate
passes the cut-off, and before that by the base rules.

The starts are fixed, not drawn: medians and median absolute deviations; the mean and covariance of
the points drawn in by tanh; and those of the points' directions from the medians. They stay with the
bulk of a group; a half that has a smaller determinant elsewhere, around many copies of one junk text, is
not looked for. The covariance has
a floor on its diagonal, since a statistic that is zero for nearly all texts has no spread of its own;
the determinant is that of the covariance with its floor. Groups under `MIN_TEXTS` are pooled by
language, and such pools in turn into one; under that number no text is rejected but by the base
rules. Every estimate covers all texts of its group that pass the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import SPACE_CHARS, WORD, fresh, stored

#: Standard deviations that no coordinate of the vector goes below, in its order:
#: word length, symbols, repeated words, repeated lines, upper case. In a group without symbols or repeats, a text
#: alone in having them is rejected from 3.6 % symbols, or 40 % of words or of lines repeated.
FLOORS = (0.05, 0.3, 0.217, 0.433, 0.2)
DIMS = range(len(FLOORS))
MIN_TEXTS = 50
#: Steps end where the logarithm of the determinant falls by less; each step taken lowers it by as much, and the floors bound it.
LEAST_FALL = 1e-3
#: Brings the variance of tanh of a normal variable back to one.
TANH_SCALE = 1.59
#: Tables of one row a pool and start (at most 30 numbers) are broadcast up to so many rows, 5 MB; larger ones are joined in salted parts.
SMALL, SALTS = 20_000, 64
#: A median absolute deviation as a standard deviation.
DEVIATION = 1.4826
#: Quantiles of chi-square with five degrees of freedom: the median and 0.9999.
MEDIAN, CUTOFF = 4.351, 25.745
#: Bins per doubling of 1 + squared distance: quantiles are read from counts by bin.
BINS = 256

NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """Every row with a struct column `name` of the counts, base_failed and the vector x0..x4."""
    words, hashes, ordered, places, parts = fresh(docs, "words", "hashes", "ordered", "places", "parts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    with_words = docs.withColumns({
        words: F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
        parts: F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    three = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    with_hashes = with_words.withColumn(hashes, F.when(F.size(words) >= 3, three).otherwise(F.array().cast("array<bigint>")))
    # Sorted only where some window occurs twice.
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    with_ordered = with_hashes.withColumn(
        ordered, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(none)
    )
    repeated = F.filter(
        ordered,
        lambda e, j: F.coalesce(F.get(ordered, j - 1)["h"] == e["h"], F.lit(False))
        | F.coalesce(F.get(ordered, j + 1)["h"] == e["h"], F.lit(False)),
    )
    with_places = with_ordered.withColumn(places, F.array_sort(F.transform(repeated, lambda e: e["i"])))
    covered = F.transform(
        places, lambda v, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), v - F.get(places, j - 1)))
    )
    chars = F.char_length(F.translate(text, SPACE_CHARS, ""))
    counts = with_places.withColumn(
        name,
        F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            chars.cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            (F.size(parts) - F.size(F.array_distinct(parts))).cast("bigint").alias("n_dup_lines"),
            total(covered).cast("bigint").alias("n_repeat_words"),
            F.size(parts).alias("n_lines"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
        ),
    ).drop(words, hashes, ordered, places, parts)
    at = F.col(name)
    n, long = F.greatest(at["n_words"], F.lit(1)), F.greatest(at["word_chars"], F.lit(1))
    vector = [
        F.log(long / n),
        F.log1p(100 * at["n_symbols"] / long),
        F.log1p(5 * at["n_repeat_words"] / n),
        # Four lines are added, so that one repeated line of a few does not weigh as a quarter of many.
        F.log1p(20 * at["n_dup_lines"] / (at["n_lines"] + 4)),
        F.log1p(20 * at["n_upper"] / long),
    ]
    failed = (at["n_words"] < 50) | (100 * at["n_repeat_words"] > 50 * at["n_words"])
    return counts.withColumn(
        name,
        F.struct(*[at[c].alias(c) for c in NUMBERS], failed.alias("base_failed"), *[v.alias(f"x{i}") for i, v in enumerate(vector)]),
    )


def squared_distance() -> Column:
    """Squared length of the whitened difference from the mean; the factor's rows are flat columns."""
    parts = ["(" + " + ".join(f"w{i}{j} * (x{j} - m{j})" for j in range(i + 1)) + ")" for i in DIMS]
    return F.expr(" + ".join(f"{y} * {y}" for y in parts))


def keys_of(frame: DataFrame) -> list[str]:
    return [c for c in ("pool", "start") if c in frame.columns]


def whitened(moments: DataFrame) -> DataFrame:
    """Mean, inverse Cholesky factor and log determinant of each group, from its sums (one small row a group).

    Written as texts of expressions and in few levels, since planning is most of the time these rows take.
    """

    def minus(first: str, products: list[str]) -> str:
        return " - ".join([first, *products])

    cov = {(j, i): f"s{j}{i} / n - (s{i} / n) * (s{j} / n)" for i in DIMS for j in range(i + 1)}
    named = [f"s{i} / n AS m{i}" for i in DIMS]
    named += [f"{f'greatest({c}, 0D) + {FLOORS[i]}D * {FLOORS[i]}D' if i == j else c} AS c{i}{j}" for (j, i), c in cov.items()]
    out = moments.selectExpr(*keys_of(moments), *named)
    for i in DIMS:
        # The floor keeps what is left of the diagonal positive; rounding cannot take it below a millionth.
        rest = minus(f"c{i}{i}", [f"l{i}{k} * l{i}{k}" for k in range(i)])
        out = out.selectExpr("*", f"sqrt(greatest({rest}, 1e-6D * {FLOORS[i]}D * {FLOORS[i]}D)) AS l{i}{i}")
        below = [f"({minus(f'c{j}{i}', [f'l{j}{k} * l{i}{k}' for k in range(i)])}) / l{i}{i} AS l{j}{i}" for j in DIMS if j > i]
        out = out.selectExpr("*", *below) if below else out
    for i in DIMS:
        row = [f"-({' + '.join(f'l{i}{k} * w{k}{j}' for k in range(j, i))}) / l{i}{i} AS w{i}{j}" for j in range(i)]
        out = out.selectExpr("*", f"1 / l{i}{i} AS w{i}{i}", *row)
    determinant = "2 * (" + " + ".join(f"ln(l{i}{i})" for i in DIMS) + ") AS log_det"
    return out.selectExpr(*keys_of(moments), determinant, *[f"m{i}" for i in DIMS], *[f"w{i}{j}" for i in DIMS for j in range(i + 1)])


def pools(vectors: DataFrame) -> DataFrame:
    """(group, pool, n): the texts each group is judged with; no row where they are too few."""
    groups = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = F.when(F.col("n") >= MIN_TEXTS, F.to_json(F.struct("lang", "source")))
    groups = groups.withColumn("pool", own)
    small = groups.where(F.col("pool").isNull())
    by_lang = small.groupBy("lang").agg(F.sum("n").alias("n_lang")).where(F.col("n_lang") >= MIN_TEXTS)
    by_lang = by_lang.select(F.col("lang").alias("pool_lang"), F.to_json(F.struct("lang")).alias("lang_pool"))
    groups = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("pool_lang")) & F.col("pool").isNull(), "left")
    groups = groups.withColumn("pool", F.coalesce("pool", "lang_pool", F.lit("{}")))
    named = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "pool", "n")
    enough = named.groupBy("pool").agg(F.sum("n").alias("in_pool")).where(F.col("in_pool") >= MIN_TEXTS)
    return named.join(enough, "pool").select("g_lang", "g_source", "pool")


def same_group() -> Column:
    return F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))


def same_pool() -> Column:
    return F.col("pool") == F.col("of_pool")


def is_few(to_pool: DataFrame) -> bool:
    """Whether tables with three rows for each group, so for each pool, may be broadcast."""
    return 3 * to_pool.count() <= SMALL


def meet(rows: DataFrame, small: DataFrame, same: Column, few: bool, how: str = "inner") -> DataFrame:
    """The rows with what the stored table `small` says of their pool or group.

    `small` is broadcast if its rows are `few`. Else each of its rows is repeated for every
    salt and the rows are dealt by pool and salt, so a pool with most of the rows is spread.
    """
    if few:
        return rows.join(F.broadcast(small), same, how)
    salted = small.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, same & (F.col("salt") == F.col("of_salt")), how).drop("of_salt")


def salt() -> Column:
    """A part for each row, to be stored with it."""
    return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")


def moments(rows: DataFrame) -> DataFrame:
    sums = [f"sum(x{i}) AS s{i}" for i in DIMS] + [f"sum(x{j} * x{i}) AS s{j}{i}" for i in DIMS for j in range(i + 1)]
    return rows.groupBy(*keys_of(rows)).agg(F.expr("CAST(count(*) AS double) AS n"), *map(F.expr, sums))


def half() -> Column:
    """The least subset whose estimate resists the most junk: (n + p + 1) / 2 of a pool of n texts."""
    return F.floor((F.col("all") + len(FLOORS) + 1) / 2)


def distance_bin() -> Column:
    return F.floor(BINS * F.log2(1 + squared_distance()))


def quantile(rows: DataFrame, needed: Column) -> DataFrame:
    """(keys, edge): the distance bin by which `needed` texts are reached. Counts by bin, so no sort of a group."""
    from pyspark.sql import Window

    keys = keys_of(rows)
    counts = rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    so_far, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    counts = counts.withColumns({"below": F.sum("n").over(so_far), "all": F.sum("n").over(whole)})
    return counts.where(F.col("below") >= needed).groupBy(*keys).agg(F.min("bin").alias("edge"))


def with_edges(rows: DataFrame, estimate: DataFrame, needed: Column, few: bool) -> DataFrame:
    """The estimates with the edge of their nearest `needed` texts."""
    binned = meet(rows, estimate.withColumnRenamed("pool", "of_pool"), same_pool(), few)
    edges = quantile(binned.select(*keys_of(estimate), distance_bin().alias("bin")), needed)
    return stored(estimate.join(edges, keys_of(estimate)))


def middles(rows: DataFrame, values: list[Column], name: str) -> DataFrame:
    """(pool, name0..name4): the median of each value."""
    return rows.groupBy("pool").agg(*[F.percentile_approx(v, F.lit(0.5), F.lit(1000)).alias(f"{name}{i}") for i, v in enumerate(values)])


def starts(rows: DataFrame, few: bool) -> DataFrame:
    """(pool, start, log_det, mean, factor): three estimates for each pool to start from, not yet of any subset."""
    centre = stored(middles(rows, [F.col(f"x{i}") for i in DIMS], "m"))
    about = meet(rows, centre.withColumnRenamed("pool", "of_pool"), same_pool(), few)
    spread = middles(about.select("pool", *[F.abs(F.col(f"x{i}") - F.col(f"m{i}")).alias(f"a{i}") for i in DIMS]), [F.col(f"a{i}") for i in DIMS], "d")
    whole = [F.sqrt((DEVIATION * F.col(f"d{i}")) ** 2 + FLOORS[i] ** 2).alias(f"d{i}") for i in DIMS]
    scale = stored(centre.join(spread, "pool").select("pool", *[f"m{i}" for i in DIMS], *whole))
    factor = [(1 / F.col(f"d{i}") if i == j else F.lit(0.0)).alias(f"w{i}{j}") for i in DIMS for j in range(i + 1)]
    medians = scale.select("pool", F.lit("medians").alias("start"), F.lit(float("inf")).alias("log_det"), *[f"m{i}" for i in DIMS], *factor)

    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}") for i in DIMS]
    length = F.sqrt(F.greatest(sum((v * v for v in z), F.lit(0.0)), F.lit(1e-12)))
    kinds = {"drawn in": [TANH_SCALE * F.tanh(v) for v in z], "directions": [len(FLOORS) ** 0.5 * v / length for v in z]}
    points = [
        F.struct(F.lit(kind).alias("start"), *[(F.col(f"m{i}") + F.col(f"d{i}") * v).alias(f"x{i}") for i, v in enumerate(moved)])
        for kind, moved in kinds.items()
    ]
    moved = meet(rows, scale.withColumnRenamed("pool", "of_pool"), same_pool(), few)
    moved = moved.select("pool", F.explode(F.array(*points)).alias("point")).select("pool", "point.*")
    others = whitened(moments(moved)).withColumn("log_det", F.lit(float("inf")))
    return medians.unionByName(others)


def concentrated(rows: DataFrame, few: bool) -> DataFrame:
    """(pool, log_det, mean, factor) of least determinant over all starts of each pool.

    A start whose determinant has stopped falling keeps its last estimate and reads no further rows. Texts
    that tie with the farthest of the half are all taken. Equal determinants: the first start by name.
    """
    going, done = stored(starts(rows, few)), None
    numbers = [c for c in going.columns if c not in ("pool", "start")]
    while going.count():
        marked = with_edges(rows, going, half(), few)
        near = meet(rows, marked.withColumnRenamed("pool", "of_pool"), same_pool(), few)
        near = near.where(distance_bin() <= F.col("edge")).select(*keys_of(near), *[f"x{i}" for i in DIMS])
        after = whitened(moments(near)).select("pool", "start", F.struct(*numbers).alias("after"))
        both = going.select("pool", "start", F.struct(*numbers).alias("before")).join(after, ["pool", "start"])
        fell = F.col("after.log_det") < F.col("before.log_det") - LEAST_FALL
        both = stored(both.withColumn("fell", fell))
        ended = both.where(~F.col("fell")).select("pool", "start", "before.*")
        going = both.where("fell").select("pool", "start", "after.*")
        done = ended if done is None else done.unionByName(ended)
    order = ["log_det", "start", *[c for c in numbers if c != "log_det"]]
    return done.groupBy("pool").agg(F.min(F.struct(*order)).alias("least")).select("pool", "least.*").drop("start")


def estimates(stats: DataFrame) -> DataFrame:
    """(g_lang, g_source, log_det, mean, factor, limit): what each language and source is judged by.

    `stats` holds lang, source, base_failed, salt and the vector of every text; only texts that pass
    the base rules count. Nulls in lang or source are groups like others.
    """
    vectors = stats.where(~F.col("base_failed")).select("lang", "source", "salt", *[f"x{i}" for i in DIMS])
    to_pool = stored(pools(vectors))
    few = is_few(to_pool)
    rows = stored(meet(vectors, to_pool, same_group(), few).select("pool", "salt", *[f"x{i}" for i in DIMS]))
    if to_pool.isEmpty():
        estimate = starts(rows, few).drop("start")
    else:
        estimate = concentrated(rows, few)
    # The median distance of the group brings the cut-off to the scale of its bulk.
    judged = with_edges(rows, stored(estimate), 0.5 * F.col("all"), few)
    scale = F.greatest(F.lit(1.0), (F.pow(F.lit(2.0), (F.col("edge") + 1) / BINS) - 1) / MEDIAN)
    judged = judged.withColumn("limit", CUTOFF * scale).drop("edge")
    return stored(to_pool.join(judged, "pool").drop("pool"))


def judged(stats: DataFrame, estimate: DataFrame) -> DataFrame:
    """The statistics with distance (null without an estimate) and kept."""
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("limit"), F.lit(True))
    out = meet(stats, estimate, same_group(), is_few(estimate), "left").withColumn("distance", squared_distance())
    return out.withColumn("kept", kept)


def flat(docs: DataFrame, *keep: str) -> DataFrame:
    """One row a text: `keep`, lang, source and its statistics as columns."""
    named = dict.fromkeys([*keep, "lang", "source"])
    rows = with_statistics(docs.select(*named, "text"), "statistics")
    return rows.select(*named, salt(), "statistics.*")


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts, base_failed, distance, kept) of every row.

    A null or empty text has no words and fails the base rules. Null and repeated ids are judged
    row by row; other columns are not read. An empty table gives an empty result.
    """
    stats = stored(flat(docs, "doc_id"))
    return judged(stats, estimates(stats)).select("doc_id", *NUMBERS, "base_failed", "distance", "kept")


def keep_regular(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    Rows are written once with their statistics, so that these are worked out once and no row has to
    be found by its id.
    """
    (box,) = fresh(docs, "statistics_of_row")
    marks = [F.col(box)[c].alias(c) for c in ["base_failed", *[f"x{i}" for i in DIMS]]]
    rows = with_statistics(docs, box)
    rows = stored(rows.select(F.struct(*docs.columns).alias("row"), "lang", "source", salt(), *marks))
    return judged(rows, estimates(rows.drop("row"))).where("kept").select("row.*")
