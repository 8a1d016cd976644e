"""Quality rules by distribution divergence.

Two histograms of each document, its character classes and the common words of its
language, are compared with the same histograms of all documents of that language
by Jensen-Shannon distance (base 2, from 0 to 1).  A document that lies further from
its language than a threshold is rejected; short texts, whose histograms say little,
get a wider one and very short ones none.  Two plain rules come first: too few words, and too
many words in repeated five-word windows.

All is column expressions and no text is shuffled.  `judge` stores the counts of each
row and takes the references (one row per language) and verdicts from them;
`keep`, which returns whole rows, reads the texts twice instead.

Defined cases: a null text is an empty one and fails the word rule; an unlisted language
has no common words, so only characters are compared, with that language if it has
enough text; languages with less text and null are one group, a mixture of scripts, so
its distance is given but rejects nothing;
repeated rows get equal verdicts; an empty table gives no rows; very long texts are
read whole.  The row itself is kept in a struct, so other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adperf.sources.staging import stage

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Texts below these sizes are not compared.
MIN_COMPARED_WORDS = 40
MIN_COMPARED_CHARS = 300
#: Characters from which on an unlisted language has a reference of its own, and such languages at most.
MIN_REFERENCE_CHARS, MAX_LANGUAGES = 30_000, 1000
#: Distance allowed, and what short texts may have beyond it, over the root of their size.
MAX_CHARS, MAX_CHARS_SHORT = 0.20, 1.5
MAX_WORDS, MAX_WORDS_SHORT = 0.04, 3.7

# The most common words of the languages compared.
COMMON_WORDS = {
    "en": "the of and to in is that it for was with be by on this from are as an a".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par sur pas au avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y los se del las un por con no una su para es al lo".split(),
}
SLOTS = 20
SPACE = "[ \\t-\\r]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Character classes, each taken out of what the ones before have left.
CLASSES = ("\\p{Ll}+", SPACE, "\\p{Lu}+", "\\p{Nd}+", "[.,;:!?'\"()\\-]+", "[#*$%&|<>]+")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; `windows` are their hashes in order."""
    n = F.size(windows)
    ranked = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s: Column) -> Column:
        def one(k: Column) -> Column:
            here = s[k]["h"]
            before = (k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == here)
            after = (k < n - 1) & (s[F.least(k + 1, n - 1)]["h"] == here)
            return F.when(before | after, s[k]["i"])

        return F.array_sort(F.array_compact(F.transform(F.sequence(F.lit(0), n - 1), one)))

    covered = F.aggregate(
        F.transform(F.array(ranked), twice)[0],
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")),
        lambda a: a["total"].cast("long"),
    )
    return F.when(F.size(F.array_distinct(windows)) == n, F.lit(0).cast("long")).otherwise(covered)


def features(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """All rows as `_row`, with the counts of the rules, `_lang`, `_chars`, `_common` and `_windows`.

    Steps that are used more than once are columns of their own, so none is computed twice.
    """
    lang = F.col(lang_col).cast("string")
    rows = docs.select(
        F.struct("*").alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_r0"),
        F.coalesce(lang, F.lit("")).alias("_lang"),
    )
    rows = rows.withColumns({"_w": words_of(F.col("_r0")), "_lines": F.filter(
        F.split("_r0", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")})
    for i, pattern in enumerate(CLASSES, 1):
        rows = rows.withColumn(f"_r{i}", F.regexp_replace(f"_r{i - 1}", pattern, ""))
    lengths = [F.length(f"_r{i}") for i in range(len(CLASSES) + 1)]
    chars = [a - b for a, b in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]
    every = sorted({w for listed in COMMON_WORDS.values() for w in listed})
    short = F.filter("_w", lambda w: F.length(w) <= max(map(len, every)))
    some = F.filter(F.transform(short, F.lower), lambda w: w.isin(*every))
    rows = rows.withColumns({
        "_spaced": F.concat(F.lit(" "), F.array_join(some, "  "), F.lit(" ")),
        "_hashes": F.transform("_w", lambda w: F.xxhash64(w)),
    })
    counted = F.transform(_word_lists(F.col("_lang")), lambda w: (
        (F.length("_spaced") - F.length(F.replace("_spaced", w, F.lit("")))) / F.length(w)).cast("double"))
    rows = rows.withColumn("_counted", counted)
    n = F.size("_w")
    rest = n - F.aggregate("_counted", F.lit(0.0), lambda a, x: a + x)
    window = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))
    rows = rows.withColumns({"_windows": F.when(n >= WINDOW, window)})
    return rows.select(
        "_row", "_lang", lengths[0].alias("_size"), n.cast("long").alias("n_words"),
        (lengths[0] - chars[1]).cast("long").alias("word_chars"), chars[5].cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), "_windows",
        F.array(*[c.cast("double") for c in chars]).alias("_chars"),
        F.when(F.col("_counted").isNotNull(), F.concat("_counted", F.array(rest))).alias("_common"),
    )


def _word_lists(lang: Column) -> Column:
    found = F.lit(None).cast("array<string>")
    for name, listed in COMMON_WORDS.items():
        found = F.when(lang == name, F.array(*[F.lit(f" {w} ") for w in listed])).otherwise(found)
    return found


def with_repeats(rows: DataFrame) -> DataFrame:
    """The rows with `n_repeat_words` in place of `_windows`."""
    repeats = F.coalesce(_repeat_words(F.col("_windows")), F.lit(0).cast("long"))
    return rows.withColumn("n_repeat_words", repeats).drop("_windows")


def references(rows: DataFrame) -> DataFrame:
    """One row per language with enough text and one, of a null language, for all others: its classes
    and common words, over all documents. The sums by language are stored."""
    sums = [F.sum(F.col("_chars")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    sums += [F.sum(F.col("_common")[i]).alias(f"w{i}") for i in range(SLOTS + 1)]
    summed = stage(rows.groupBy("_lang").agg(*sums), "languages")
    listed, size = F.col("_lang").isin(*COMMON_WORDS), sum((F.col(f"c{i}") for i in range(len(CLASSES) + 1)), F.lit(0.0))
    own = summed.filter(listed | ((F.col("_lang") != "") & (size >= MIN_REFERENCE_CHARS)))
    own = own.orderBy(listed.desc(), size.desc(), "_lang").limit(len(COMMON_WORDS) + MAX_LANGUAGES)
    rest = summed.join(F.broadcast(own.select("_lang")), "_lang", "left_anti")  # MAX_LANGUAGES and the listed ones at most
    others = rest.agg(*[F.sum(c).alias(c) for c in summed.columns[1:]])
    return own.unionByName(others.withColumn("_lang", F.lit(None).cast("string"))).select(
        F.col("_lang").alias("_ref_lang"),
        F.array(*[f"c{i}" for i in range(len(CLASSES) + 1)]).alias("_ref_chars"),
        F.when(F.col("w0").isNotNull(), F.array(*[f"w{i}" for i in range(SLOTS + 1)])).alias("_ref_common"),
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of one length; null if one is empty."""
    def total(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    def term(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def divergence(pair: Column) -> Column:
        p, q = pair["p"] / pair["tp"], pair["q"] / pair["tq"]
        m = (p + q) / 2
        return (term(p, m) + term(q, m)) / 2

    tp, tq = total(counts), total(reference)
    pairs = F.zip_with(counts, reference, lambda p, q: F.struct(
        p.alias("p"), q.alias("q"), tp.alias("tp"), tq.alias("tq")))
    js = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + divergence(x))
    return F.when((tp > 0) & (tq > 0), F.sqrt(F.greatest(js, F.lit(0.0))))


def verdicts(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """The rows with js_chars, js_words, base_failed and kept."""
    own = refs.filter("_ref_lang is not null")  # MAX_LANGUAGES and the listed ones at most
    others = refs.filter("_ref_lang is null").select(F.col("_ref_chars").alias("_other_chars"))  # one row
    judged = rows.join(F.broadcast(own), F.col("_lang") == F.col("_ref_lang"), "left").join(F.broadcast(others))
    judged = judged.withColumn("_ref_chars", F.coalesce("_ref_chars", "_other_chars"))
    judged = judged.withColumns({
        "js_chars": js_distance(F.col("_chars"), F.col("_ref_chars")),
        "js_words": js_distance(F.col("_common"), F.col("_ref_common")),
    })
    n, chars = F.col("n_words"), F.col("_size")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    far_chars = F.col("_ref_lang").isNotNull() & (chars >= MIN_COMPARED_CHARS) & (
        F.col("js_chars") > MAX_CHARS + MAX_CHARS_SHORT / F.sqrt(chars.cast("double")))
    far_words = (n >= MIN_COMPARED_WORDS) & (
        F.col("js_words") > MAX_WORDS + MAX_WORDS_SHORT / F.sqrt(n.cast("double")))
    far = F.coalesce(far_chars, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return judged.withColumns({"base_failed": failed, "kept": ~failed & ~far})


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, the counts, base_failed, kept and both distances of every row."""
    rows = with_repeats(features(docs, text_col, lang_col))
    rows = stage(rows.withColumn("doc_id", F.col(f"_row.`{id_col}`").cast("long")).drop("_row"), "rules")
    return verdicts(rows, references(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "js_chars", "js_words",
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows that the rules keep, unchanged."""
    rows = features(docs, text_col, lang_col)
    judged = verdicts(with_repeats(rows), references(rows))
    # A predicate is not moved below a projection with a row number.  Moved, it would be
    # written out in terms of the text, each step as often as later ones use it.
    judged = judged.withColumn("_number", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("_number") >= 0)).select("_row.*")
