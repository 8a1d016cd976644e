"""Soft-membership mixing: document rates that bring domain token totals to targets.

A naive Bayes classifier is counted from the labelled table: which words, and which of
a few marks of form, a document has.  Features that a
domain's documents have as often as others count nothing, and a text whose set of
five-word shingles is equal to that of an earlier one of its domain, or near it, is a
copy and not counted.  It gives every document posteriors over the domains.  With t tokens and posteriors p, a document taken at rate r adds r * t * p
to the expected totals; projected-gradient least squares fits the rates in
[0, max_rate] so that the totals meet the targets.  Each step is one aggregate of as
many sums as there are domains, and every row then moves its own rate.  Rates begin
at one, so the solution stays near the corpus as it is.

All is column expressions and small aggregates.  Features are counted by bucket first
and by their own hash in the buckets that differ; the model keeps `max_features` of them at
most and warns if it is full, and so do rates that still move after the last step.

Defined cases: rows of `labels` with a null label are not used; a document labelled
more than once counts as toxic if any label says so, else by its lowest quality;
without labels the posteriors are the priors; null and empty texts have no
tokens, the prior as posterior, and the rate of that mixture; repeated rows get equal
rates; texts of any length are read whole, counts being doubles where they are
multiplied; an empty table gives no rows; targets without any tokens to meet them leave
the rates as near as they can be.  The row itself is kept in a struct, so other
columns may have any names.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.llm.quality import BLANKS, words_of
from adperf.sources.staging import stage

DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}
BUCKETS = 1 << 16
#: Features of the model, the most significant first; its size, whatever the vocabulary.
FEATURES = 1 << 16
#: Standard errors by which a domain's documents must differ for a feature to count.
SIGNIFICANT = 4.5
#: A feature tells of a domain if this share of its documents are of it, and against a
#: domain if it is so many times rarer there; smaller effects depend on language and
#: length, say little, and are many.
MOSTLY, RARER = 0.5, 5.0
#: Copies share this much of their shingles.  Two equal ones of the LEAST smallest hashes
#: of two sets say that they are compared; a pair at the threshold has no such two with a
#: chance of about 1 in 1,400.
SHINGLE, SIMILAR = 5, (75, 100)
LEAST = 6
#: Labelled rows the classifier is counted from, the smallest hashes first; a bound, not a size.
MAX_LABELLED = 200_000
#: A mark of form counts as so many words.
MARK_WEIGHT = 2
STEPS, TOLERANCE = 40, 1e-4
#: How far the heaviest target lies above its available tokens: its documents stay whole.
HEADROOM = 1.05
SEED = 20240101


def domain(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def with_features(rows: DataFrame, text: str) -> DataFrame:
    """`_hashes` of the words of a text in lower case without what is around them, and `_f`, hashes of its features.

    Features are the words and marks of form: symbols, capitals, repeated words.  Each
    pass over the text is a column of its own, or it would be done for every use.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    n = F.greatest(F.length(whole), F.lit(1)).cast("double")  # products of counts do not fit an int

    def grade(part: Column) -> Column:
        return F.floor(F.log2(part.cast("double") * 1024 / n + 1)).cast("string")

    plain = F.array_remove(F.split(F.lower(whole), "[^\\p{L}\\p{Nd}]+"), "")  # what stands around them leaves empty ones
    read = rows.withColumns({
        "_hashes": F.transform(plain, lambda w: F.xxhash64(w)), "_marked": F.regexp_replace(whole, "[^\\p{Lu}#*$%&|<>!]+", "")})
    read = read.withColumns({
        "_symbols": F.length(F.regexp_replace("_marked", "\\p{Lu}+", "")), "_distinct": F.array_distinct("_hashes")})
    size = F.size("_hashes")
    graded = read.withColumns({
        "_gs": grade(F.col("_symbols")), "_gu": grade(F.length("_marked") - F.col("_symbols")),
        "_gr": grade((size - F.size("_distinct")) * n / F.greatest(size, F.lit(1)) / 4)})
    marks = F.when(F.btrim(whole, F.lit(BLANKS)) != "", F.array(*[
        F.xxhash64(F.concat(F.lit(f"\x01{name}{k}:"), F.col(f"_g{name}"))) for name in "sur" for k in range(MARK_WEIGHT)]))
    named = F.concat("_distinct", F.coalesce(marks, F.array().cast("array<long>")))
    return graded.withColumn("_f", named).drop("_marked", "_symbols", "_distinct", "_gs", "_gu", "_gr")


def _shingles(hashes: Column) -> Column:
    """The set of five-word shingles of a text from the hashes of its words; all words, if fewer."""
    n = F.size(hashes)
    runs = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)]))
    return F.when(n >= SHINGLE, F.sort_array(F.array_distinct(runs))).when(n > 0, F.array(F.xxhash64(hashes))).otherwise(
        F.array().cast("array<long>"))


def without_copies(rows: DataFrame) -> DataFrame:
    """_domain and _f of the rows (_id, _domain, _f, _words) that are no copies of an earlier one of their domain.

    `_words` holds the words or, as whole numbers, their hashes.
    Equal sets are one row.  A row is compared, on whole sets, with the first of every
    band that it shares, so the comparisons grow with the rows.  Texts without words
    count once for each id.  Rows are stored once; only their numbers, names, sizes and
    bands are grouped, and of the arrays only the sets of texts to be compared move.
    """
    if dict(rows.dtypes)["_words"] != "array<bigint>":
        rows = rows.withColumn("_words", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_set", _shingles(F.col("_words"))).drop("_words")
    name = F.when(F.size("_set") > 0, F.xxhash64("_set")).otherwise(F.xxhash64("_id", F.lit(SEED)))
    pairs = [(F.get("_set", i), F.get("_set", j)) for j in range(LEAST) for i in range(j)]
    bands = F.array_compact(F.array(
        F.when(F.size("_set") == 1, F.xxhash64(F.get("_set", 0))),
        *[F.when(b.isNotNull(), F.xxhash64(a, b)) for a, b in pairs]))
    # the number is part of the stored row, so it names the row from here on
    rows = stage(rows.select(
        F.monotonically_increasing_id().alias("_row"), "_id", "_domain", "_f", "_set", name.alias("_name"),
        F.size("_set").alias("_size"), bands.alias("_bands")), "texts")
    one = rows.groupBy("_domain", "_name").agg(F.min(F.struct("_id", "_row", "_size", "_bands")).alias("_one"))
    one = stage(one.select("_domain", "_name", "_one.*"), "sets")

    banded = one.filter("_size > 0").select("_domain", "_id", "_row", "_size", F.explode("_bands").alias("_band"))
    banded = stage(banded, "bands")
    first = banded.groupBy("_domain", "_band").agg(
        F.min(F.struct("_id", "_row", "_size")).alias("_first"), F.count("*").alias("_rows")).filter("_rows > 1")
    # a band of two rows at least: bounded by the bands of the labelled rows
    pairs = banded.join(F.broadcast(first.select("_domain", "_band", "_first")), ["_domain", "_band"])
    need, of = SIMILAR
    small, large = F.least("_size", "_first._size"), F.greatest("_size", "_first._size")
    pairs = pairs.filter((F.col("_row") != F.col("_first._row")) & (small * of >= large * need))
    pairs = stage(pairs.select("_row", F.col("_first._row").alias("_other")).distinct(), "pairs")
    sets = rows.select("_row", "_set")
    # bounded as the pairs are: the stored sets stay where they are until they are known to be compared
    mine = sets.join(F.broadcast(pairs), "_row")
    theirs = sets.join(F.broadcast(pairs.select(F.col("_other").alias("_row")).distinct()), "_row", "left_semi")
    met = mine.join(theirs.select(F.col("_row").alias("_other"), F.col("_set").alias("_other_set")), "_other")
    both = F.size(F.array_intersect("_set", "_other_set"))
    near = both * of >= (F.size("_set") + F.size("_other_set") - both) * need
    copies = met.filter(near).select("_row").distinct()
    kept = stage(one.join(copies, "_row", "left_anti").select("_row"), "kept")
    return rows.join(F.broadcast(kept), "_row", "left_semi").select("_domain", "_f")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = MAX_LABELLED, max_features: int = FEATURES,
) -> DataFrame:
    """feature and one weight per domain, of the features that count; a null feature has the score of a text without any. Stored."""
    known = labels.select(
        F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("q"), F.col("toxic").cast("int").alias("x")
    ).dropna().groupBy("_id").agg(F.min("q").alias("q"), F.max("x").alias("x"))
    known = known.select("_id", domain(F.col("q"), F.col("x")).alias("_domain")).dropna()
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    text = F.col(text_col).cast("string")
    # `max_labelled` short rows at most, so the texts stay where they are
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).join(F.broadcast(known), "_id")
    rows = with_features(rows, "_t").select("_id", "_domain", "_f", F.col("_hashes").alias("_words"))
    rows = stage(without_copies(rows), "labelled")
    counts = [F.coalesce(F.sum((F.col("_domain") == d).cast("long")), F.lit(0)).alias(d) for d in DOMAINS]
    sizes = rows.agg(*[c.alias(f"n_{d}") for c, d in zip(counts, DOMAINS, strict=True)])
    sizes = stage(sizes.withColumn("n", sum((F.col(f"n_{d}") for d in DOMAINS), F.lit(0))), "sizes")

    def telling(counted: DataFrame, key: str) -> DataFrame:
        joined = counted.join(F.broadcast(sizes))  # one row
        present, absent, most = [], [], F.lit(0.0)
        everywhere = sum((F.col(x) for x in DOMAINS), F.lit(0))
        for d in DOMAINS:
            usual = F.col(f"n_{d}") * everywhere / F.col("n")
            errors = F.abs(F.col(d) - usual) / F.sqrt(usual + 1)
            with_it = F.log((F.col(d) + 0.5) / (usual + 0.5))
            without = F.log((F.col(f"n_{d}") - F.col(d) + 0.5) / (F.col(f"n_{d}") - usual + 0.5))
            mostly = (F.col(d) >= MOSTLY * everywhere) & (F.col(d) >= 2 * usual)
            tells = (errors > SIGNIFICANT) & (mostly | (F.col(d) * RARER <= usual))
            present.append(F.when(tells, with_it - without).otherwise(0.0).alias(d))
            absent.append(F.when(tells, without).otherwise(0.0).alias(f"no_{d}"))
            most = F.greatest(most, errors)
        found = joined.select(key, *present, *absent, most.alias("errors"))
        return found.filter(" or ".join(f"{d} <> 0" for d in DOMAINS))

    seen = rows.select("_domain", F.explode("_f").alias("feature"))
    bucket = F.pmod("feature", F.lit(BUCKETS)).alias("bucket")
    # a bucket differs less than a feature in it, as the others in it do not: half the errors find it
    by_bucket = seen.select("_domain", bucket).groupBy("bucket").agg(*counts)
    usual = [F.col(f"n_{d}") * sum((F.col(x) for x in DOMAINS), F.lit(0)) / F.col("n") for d in DOMAINS]
    differs = [F.abs(F.col(d) - u) > SIGNIFICANT / 2 * F.sqrt(u + 1) for d, u in zip(DOMAINS, usual, strict=True)]
    some = by_bucket.join(F.broadcast(sizes)).filter(differs[0] | differs[1] | differs[2]).select("bucket")
    narrowed = seen.withColumn("bucket", bucket).join(F.broadcast(some), "bucket", "left_semi")  # BUCKETS rows at most
    found = telling(narrowed.groupBy("feature").agg(*counts), "feature")
    found = stage(found.orderBy(F.desc("errors"), "feature").limit(max_features), "telling")
    if found.count() == max_features:
        warnings.warn(f"the classifier is full: {max_features} features, raise max_features", stacklevel=2)
    # a document without any feature: the log priors and what all absences say
    none = found.agg(*[F.coalesce(F.sum(f"no_{d}"), F.lit(0.0)).alias(f"no_{d}") for d in DOMAINS])
    bare = sizes.join(F.broadcast(none)).select(F.lit(None).cast("long").alias("feature"), *[  # one row each
        (F.log((F.col(f"n_{d}") + 1) / (F.col("n") + len(DOMAINS))) + F.col(f"no_{d}")).alias(d) for d in DOMAINS])
    return stage(found.select("feature", *DOMAINS).unionByName(bare), "classifier")


def posteriors(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _text (a hash), _tokens and _p, the posteriors in the order of DOMAINS, of each row. Stored."""
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_text"), text.alias("_t"),
        F.size(words_of(text)).cast("long").alias("_tokens"), F.monotonically_increasing_id().alias("_row"),
    )
    rows = with_features(rows, "_t")
    keys = ["_row", "_id", "_text", "_tokens"]
    # most features are not of the model and go before they are added up; one that every row has keeps all rows
    every = F.xxhash64(F.lit("\x01"))
    seen = rows.select(*keys, F.explode(F.concat("_f", F.array(every))).alias("feature"))
    known = model.filter("feature is not null")
    known = known.unionByName(model.filter("feature is null").select(every.alias("feature"), *[F.lit(0.0).alias(d) for d in DOMAINS]))
    # FEATURES rows at most; a row of documents lies in one partition, so its sums leave it added up
    sums = seen.join(F.broadcast(known), "feature").groupBy(*keys).agg(*[F.sum(d).alias(d) for d in DOMAINS])
    prior = model.filter("feature is null").first()
    scores = sums.withColumn("_s", F.array(*[F.lit(prior[d]) + F.col(d) for d in DOMAINS]))
    scores = scores.withColumn("_e", F.transform("_s", lambda x: F.exp(x - F.array_max("_s"))))
    total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return stage(
        scores.select("_id", "_text", "_tokens", F.transform("_e", lambda x: x / total).alias("_p")), "posteriors")


def fit_rates(
    weighed: DataFrame, weights: dict[str, float] | None = None, total_tokens: float | None = None,
    max_rate: float = 1.0, steps: int = STEPS,
) -> tuple[Column, list[dict]]:
    """The rate of a row as an expression over `_tokens` and `_p`, and the totals of each step.

    Without `total_tokens` the total is such that the domain of the largest weight
    is asked for HEADROOM times what it has.  The gradient of a domain is scaled by
    that domain's own tokens, so one step width serves domains of any size.
    """
    wanted = {d: max(0.0, (weights or WEIGHTS).get(d, 0.0)) for d in DOMAINS}
    mass = F.col("_tokens").cast("double")

    def totals(rate: Column) -> dict:
        sums = [F.coalesce(F.sum(rate * mass * F.col("_p")[k]), F.lit(0.0)).alias(d) for k, d in enumerate(DOMAINS)]
        return weighed.agg(*sums).first().asDict()  # one sum per domain

    rate: Column = F.lit(1.0)
    has = totals(rate)
    trace = [has]
    norm = sum(wanted.values())
    if not norm or not sum(has.values()):
        return rate, trace
    first = max(DOMAINS, key=lambda d: wanted[d])
    budget = total_tokens or HEADROOM * has[first] * norm / wanted[first]
    targets = {d: budget * w / norm for d, w in wanted.items()}
    now = has
    for _ in range(steps):
        slopes = [(now[d] - targets[d]) / has[d] if has[d] > 0 else 0.0 for d in DOMAINS]
        move = sum((F.col("_p")[k] * F.lit(s) for k, s in enumerate(slopes)), F.lit(0.0))
        rate = F.least(F.greatest(rate - move, F.lit(0.0)), F.lit(float(max_rate)))
        before, now = now, totals(rate)
        trace.append(now)
        if max(abs(now[d] - before[d]) for d in DOMAINS) <= TOLERANCE * sum(has.values()):
            break
    else:
        warnings.warn(f"the rates still moved after {steps} steps, raise steps", stacklevel=2)
    return rate, trace


def mix(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    weights: dict[str, float] | None = None, total_tokens: float | None = None, max_rate: float = 1.0,
    max_features: int = FEATURES, steps: int = STEPS,
) -> DataFrame:
    """doc_id, tokens, a posterior per domain, rate, copies and text_hash of every row.

    `copies` is the rate rounded up or down by a number drawn from the id, so that its
    expectation is the rate; equal ids draw equal numbers.
    """
    model = train(docs, labels, id_col, text_col, max_features=max_features)
    weighed = posteriors(docs, model, id_col, text_col)
    rate, _ = fit_rates(weighed, weights, total_tokens, max_rate, steps)
    drawn = F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 20)) / (1 << 20)
    rows = weighed.withColumn("rate", F.round(rate, 6))
    return rows.select(
        F.col("_id").alias("doc_id"), F.col("_tokens").alias("tokens"),
        *[F.round(F.col("_p")[k], 6).alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate",
        F.floor(F.col("rate") + drawn).cast("long").alias("copies"), F.col("_text").alias("text_hash"),
    )


def mixed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The rows of `docs`, unchanged, each as often as its copies say."""
    decided = mix(docs, labels, id_col, text_col, **options).filter("copies > 0").groupBy("doc_id", "text_hash").agg(
        F.max("copies").alias("copies"))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    met = rows.join(decided, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
    return met.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")
