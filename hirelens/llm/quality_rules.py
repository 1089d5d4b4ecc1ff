r"""Quality rules by distribution divergence.

A document's character classes and common words form two histograms. References are the summed
histograms of all documents of a language, gathered over the whole corpus. The Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1) to the reference decides, guarded by
minimum lengths below which a histogram says too little. Everything is built-in functions.

A document is compared with the reference of its own ``lang``; a null lang, or one with fewer than
``MIN_REFERENCE`` words in all, takes the reference of all documents together.

Words are runs of anything but the blanks \x20 and \x09-\x0D. Defined results: a null or empty text
has no words and fails the base rule. Repeated rows give equal results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm import tools
from hirelens.llm.spans import quoted

BLANKS = " \t\n\x0b\f\r"
# Frequent words of four languages.
COMMON = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "on", "with", "as", "was", "are", "be", "this", "from", "by"],
    "de": ["der", "die", "und", "das", "von", "zu", "den", "mit", "ist", "nicht", "ein", "eine", "auf", "im", "dem", "sich", "als"],
    "fr": ["le", "la", "les", "et", "des", "un", "une", "est", "que", "qui", "dans", "pour", "pas", "du", "sur", "au"],
    "es": ["el", "los", "las", "que", "en", "y", "del", "se", "por", "con", "no", "una", "su", "para", "al", "es"],
}
WORDS = sorted({w for words in COMMON.values() for w in words})
CLASSES = ("lower", "upper", "digit", "stop", "symbol", "other")

MIN_CHARS, MIN_COMMON, MIN_REFERENCE = 60, 40, 1000
# The largest distances, and what a short document may add to them: this much over the root of its words.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.15, 0.17
CHAR_ALLOWANCE, WORD_ALLOWANCE = 1.2, 1.6


def _let(value: str, name: str, body: str) -> str:
    """A SQL expression that computes ``value`` once and names it within ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeated_words(words: str) -> str:
    """Words that stand in an 8-word window found twice or more; the first occurrence counts too.

    Windows are hashed to 64 bits. Only texts with a repeated hash are sorted.
    """
    window = ", ".join(f"w[i + {j}]" for j in range(8))
    hashes = _let(words, "w", f"transform(sequence(0, size(w) - 8), i -> xxhash64({window}))")
    twice = "filter(s, (x, k) -> (k > 0 and s[k - 1].h = x.h) or (k + 1 < size(s) and s[k + 1].h = x.h))"
    sorted_hashes = _let("sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i)))", "s", f"sort_array(transform({twice}, x -> x.i))")
    covered = _let(sorted_hashes, "p", "aggregate(sequence(1, size(p)), 0L, (n, k) -> n + if(k = size(p), 8, least(8, p[k] - p[k - 1])))")
    return f"if(size({words}) < 9, 0L, {_let(hashes, 'h', f'if(size(array_distinct(h)) = size(h), 0L, {covered})')})"


def _left(pattern: str) -> str:
    """Code points that remain when every match is taken out."""
    return f"cast(length(regexp_replace(__text, {quoted(pattern)}, '')) as bigint)"


def measured(docs: DataFrame) -> DataFrame:
    """Base counts and both histograms of every row of docs; the text itself is left behind."""
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    docs = docs.withColumn("__trimmed", F.btrim("__text", F.lit(BLANKS)))
    docs = docs.withColumn("__words", F.when(F.col("__trimmed") != "", F.split("__trimmed", r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))
    docs = docs.withColumn("__lines", F.expr(f"filter(split(__text, '\\n'), x -> btrim(x, {quoted(BLANKS)}) <> '')"))
    forms = ", ".join(f"'{w}', '{w.capitalize()}'" for w in WORDS)
    docs = docs.withColumn("__common", F.expr(f"filter(__words, x -> x in ({forms}))"))
    return docs.select(
        "doc_id",
        "lang",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.expr(_left("[^#*$%&|<>]+")).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr(repeated_words("__words")).alias("n_repeat_words"),
        F.expr(_left(r"\p{Ll}+")).alias("not_lower"),
        F.expr(_left(r"[^\p{Lu}]+")).alias("upper"),
        F.expr(_left("[^0-9]+")).alias("digit"),
        F.expr(_left("[^.,;:?!'\"()-]+")).alias("stop"),
        F.length("__text").cast("long").alias("chars"),
        F.array(*((F.size("__common") - F.size(F.array_remove(F.array_remove("__common", w), w.capitalize()))).cast("long") for w in WORDS)).alias("common"),
    )


def histograms(rows: DataFrame) -> DataFrame:
    """Two arrays of counts: classes (without blanks) and words (common ones, then all others)."""
    blank = F.col("chars") - F.col("word_chars")
    lower = F.col("chars") - F.col("not_lower")
    other = F.col("not_lower") - blank - F.col("upper") - F.col("digit") - F.col("stop") - F.col("n_symbols")
    total = F.expr("aggregate(common, 0L, (a, x) -> a + x)")
    return rows.withColumn("classes", F.array(lower, "upper", "digit", "stop", "n_symbols", other)).withColumn("words", F.concat("common", F.array(F.col("n_words") - total)))


def references(rows: DataFrame) -> DataFrame:
    """lang, ref_classes, ref_words: histograms summed over all rows of the language; lang '' is all rows."""
    sizes = {"classes": len(CLASSES), "words": len(WORDS) + 1}
    sums = [F.sum(F.col(name)[i]).alias(f"{name}_{i}") for name, n in sizes.items() for i in range(n)]
    each = rows.filter("lang <> ''").groupBy("lang").agg(*sums)
    whole = each.drop("lang").unionByName(rows.filter("lang is null or lang = ''").agg(*sums).na.fill(0))
    whole = whole.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in whole.columns)).withColumn("lang", F.lit(""))
    both = each.unionByName(whole)
    arrays = [F.array(*(f"{name}_{i}" for i in range(n))).alias(f"ref_{name}") for name, n in sizes.items()]
    return both.select("lang", *arrays).filter(F.expr(f"lang = '' or aggregate(ref_words, 0L, (a, x) -> a + x) >= {MIN_REFERENCE}"))


def distance(p: str, q: str) -> str:
    """A SQL expression: the Jensen-Shannon distance of two arrays of counts; 0 if either is empty."""
    total = "aggregate({0}, 0D, (a, x) -> a + x)".format
    term = "if({0} > 0, {0} * log2(2 * {0} / ({0} + {1})), 0D)".format
    pairs = f"zip_with(transform({p}, x -> x / pt), transform({q}, x -> x / qt), (x, y) -> {term('x', 'y')} + {term('y', 'x')})"
    body = f"if(pt = 0 or qt = 0, 0D, sqrt(greatest(0D, aggregate({pairs}, 0D, (a, x) -> a + x) / 2)))"
    return _let(total(p), "pt", _let(total(q), "qt", body))


def judged(docs: DataFrame) -> DataFrame:
    """Base counts, base_failed, both distances and kept, for every row of docs."""
    rows = tools.staged(histograms(measured(docs)).drop("not_lower", "upper", "digit", "stop", "chars", "common"), "measured")
    known = tools.staged(references(rows), "references").withColumnRenamed("lang", "ref_lang")
    # languages are few; the table of references is small, and which of them exist decides the key
    named = rows.join(known.select(F.col("ref_lang").alias("lang"), F.lit(True).alias("__known")), "lang", "left")
    named = named.withColumn("ref_lang", F.when(F.col("__known"), F.col("lang")).otherwise(""))
    rows = named.join(known, "ref_lang")
    rows = rows.withColumn("char_distance", F.expr(distance("classes", "ref_classes"))).withColumn("word_distance", F.expr(distance("words", "ref_words")))
    failed = F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")
    far = F.expr(f"""(word_chars >= {MIN_CHARS} and char_distance > {MAX_CHAR_DISTANCE}D + {CHAR_ALLOWANCE}D / sqrt(n_words))
        or (n_words >= {MIN_COMMON} and word_distance > {MAX_WORD_DISTANCE}D + {WORD_ALLOWANCE}D / sqrt(n_words))""")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~far).alias("kept"), "char_distance", "word_distance"
    )


def report(docs: DataFrame) -> DataFrame:
    return judged(docs).drop("char_distance", "word_distance")

