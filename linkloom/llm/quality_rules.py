"""Quality rules: base counts, then Jensen-Shannon distances to histograms of the document's language.

For each text: counts of words, symbols, repeated lines and words in repeated 5-word windows; a histogram
of character classes; and a histogram of a language's common words. The references are the summed
histograms of all documents of that language which the base rules keep, and, the second time, which lie
near the first reference. A document fails if a distance
(square root of the divergence with logarithms of base 2) is beyond its bound and the text is long enough
for that histogram. All is done with DataFrame functions; only one small row per document is written in
between, and only per-language sums are shuffled.

Defined cases: a null or blank text has no words and fails the base rules. A null language is compared
with the histogram of all documents without language; a language without a word list, or without
references, gets no word test. A text without any common word has the word distance 1. Repeated rows each get
their own verdict, and the filter keeps or drops each row by its own, whatever its doc_id; a verdict depends on
text and language only, so rows are found again by these. A very long text is one task's row, with arrays of its
words and windows. Other columns are never read. Window equality is that of 64-bit hashes of the five words. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import WHITE, drop_rows, row_key, stage

# Common function words of each language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in a is that for it as was with be by on not he this are",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au",
}
#: A class distance fails beyond MAX_CLASS_DISTANCE + CLASS_NOISE / sqrt(words), as short texts scatter more.
MAX_CLASS_DISTANCE, CLASS_NOISE, MIN_CLASS_WORDS = 0.1, 0.5, 20
MAX_WORD_DISTANCE, MIN_WORD_WORDS = 0.75, 100
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: The references are built twice; the second time without documents so far from the first, which are mostly junk.
TRIM_DISTANCE = 0.13
#: Character classes, each with the pattern that removes it, frequent ones first; the last class is what no pattern removes.
CLASSES = (r"[a-z]+", WHITE, r"[A-Z]+", r"[.,;:!?'\"()-]+", r"\p{Ll}+", r"\p{Lu}+", r"\p{Nd}+", r"[#*$%&|<>]+", r"\p{L}+")


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def js_distance(p: Column, q: Column) -> Column:
    """Distance of two arrays of counts: 1 if only the first has no count, null if the second has none."""
    ps, qs = _fold(p), _fold(q)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def term(a: Column, b: Column) -> Column:
        x, y = a / ps, b / qs
        return (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2

    return F.when((ps > 0) & (qs > 0), F.sqrt(F.greatest(_fold(F.zip_with(p, q, term)), F.lit(0.0)))).when((ps == 0) & (qs > 0), F.lit(1.0))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the base counts and both histograms."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    df = df.withColumn("key", row_key(F.col("text"), F.col("lang")))
    df = df.withColumn("w", F.array_remove(F.split("text", WHITE), ""))
    df = df.withColumn("n_words", F.size("w").cast("long"))
    w = F.col("w")
    windows = F.transform(F.sequence(F.lit(0), F.size("w") - 5), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))
    df = df.withColumn("h", F.when(F.col("n_words") >= 6, windows))
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    df = df.withColumn("s", F.when(repeats, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("s")
    same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    twice = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
    df = df.withColumn("at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    steps = F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), lambda a, b: F.least(F.lit(5), b - a))
    covered = F.when(F.size("at") > 0, F.aggregate(steps, F.lit(0), lambda a, b: a + b)).otherwise(0)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    joined = F.array_join("w", "")
    df = df.withColumn("joined", joined)
    # What is left of the text after each class is removed; lengths differ by the class's count.
    for k, pattern in enumerate(CLASSES):
        df = df.withColumn(f"rest{k}", F.regexp_replace("text" if k == 0 else f"rest{k - 1}", pattern, ""))
    lengths = [F.length("text"), *(F.length(f"rest{k}") for k in range(len(CLASSES)))]
    removed = [(a - b).cast("double") for a, b in zip(lengths, lengths[1:], strict=False)]
    # ASCII and other small letters are one class, and so are capitals: quoting another language is no fault.
    classes = F.array(removed[0] + removed[4], removed[1], removed[2] + removed[5], removed[3], *removed[6:], lengths[-1].cast("double"))
    # The common words alone, each between two blanks, so that each word is counted by one replacement.
    known = sorted({form for words in COMMON_WORDS.values() for x in words.split() for form in (x, x.capitalize(), x.upper())})
    df = df.withColumn("common", F.concat(F.lit(" "), F.lower(F.array_join(F.filter("w", lambda x: x.isin(known)), "  ")), F.lit(" ")))
    bins = F.lit(None)
    for lang, words in COMMON_WORDS.items():
        bins = F.when(F.col("lang") == lang, F.array(*map(F.lit, words.split()))).otherwise(bins)
    df = df.withColumn("bins", bins)
    common = F.col("common")
    count = lambda x: ((F.length(common) - F.length(F.replace(common, F.concat(F.lit(" "), x, F.lit(" ")), F.lit("")))) / (F.length(x) + 2))
    return df.select(
        "doc_id", "lang", "key", "n_words",
        F.length("joined").cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        classes.alias("classes"),
        F.transform("bins", count).alias("word_counts"),
    )


def quality_verdicts(docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE, class_noise: float = CLASS_NOISE, min_class_words: int = MIN_CLASS_WORDS, max_word_distance: float = MAX_WORD_DISTANCE, min_word_words: int = MIN_WORD_WORDS, trim_distance: float = TRIM_DISTANCE, **columns) -> DataFrame:
    """One row per row of docs: doc_id, the counts, both distances, base_failed, kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = stage(document_counts(docs, **columns).withColumn("base_failed", failed).withColumn("lang_key", F.coalesce("lang", F.lit(""))), "quality-counts")
    n_words = len(next(iter(COMMON_WORDS.values())).split())
    total = lambda name, n: F.array(*(F.coalesce(F.sum(F.col(name)[k]), F.lit(0.0)) for k in range(n)))

    def compared(good: DataFrame) -> DataFrame:
        reference = good.groupBy("lang_key").agg(total("classes", len(CLASSES) - 1).alias("ref_classes"), total("word_counts", n_words).alias("ref_words"))
        df = counts.join(stage(reference, "quality-references"), "lang_key", "left")
        return df.withColumns({"class_distance": js_distance(F.col("classes"), F.col("ref_classes")), "word_distance": js_distance(F.col("word_counts"), F.col("ref_words"))})

    first = compared(counts.filter("not base_failed"))
    df = compared(first.filter(~F.col("base_failed") & (F.coalesce("class_distance", F.lit(0.0)) <= trim_distance)).select(counts.columns))
    far_classes = (F.col("n_words") >= min_class_words) & (F.col("class_distance") > max_class_distance + class_noise / F.sqrt("n_words"))
    far_words = (F.col("n_words") >= min_word_words) & (F.col("word_distance") > max_word_distance)
    far = F.coalesce(far_classes, F.lit(False)) | F.coalesce(far_words, F.lit(False))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "key")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns."""
    verdicts = stage(quality_verdicts(docs, text_col=text_col, lang_col=lang_col, **options).filter("not kept").select("key"), "quality-verdicts")
    return drop_rows(docs, row_key(F.coalesce(text_col, F.lit("")), F.col(lang_col)), verdicts)
