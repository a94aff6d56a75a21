"""Quality rules by distribution divergence, in DataFrame operations only.

A document's character-class histogram and its histogram of common words are compared with
language references by Jensen-Shannon distance (0 to 1).  The references are the summed
histograms of all documents of a language, and of all documents for those without one.  A
distance counts only with enough material (``MIN_CHARS`` characters, ``MIN_COMMON`` common words);
a document is kept unless a distance that counts is over its limit, or the base rules fail.

One pass over the texts makes a narrow row of counts per document (checkpointed); the references
are one row per language, partially aggregated before their shuffle, and joined back by language
(broadcast behind a check of the row count).

With ``corpus_words`` (what the registered query uses) the words are the ``TOP_WORDS`` most frequent
words of letters of each language, counted over all documents (of all languages for those without
one), and a last bin holds all other words, so that a text without any common word is far from its
reference.  The distance counts from ``MIN_JUDGED`` words on; since the divergence of n drawn words
over k bins is (k - 1) / (8 n ln 2) by chance alone, that much is allowed on top of the squared limit
``MAX_ALL_WORDS_DISTANCE``.  Without ``corpus_words`` the histogram has the fixed ``COMMON_WORDS`` only.

Repeated 5-word windows are found within a row:
hashes first, and only where two are equal a sort of the window texts.

Defined cases: null and empty texts have all counts 0 and fail the base rules; a null language is
compared with the reference of all documents; repeated rows are rows of their own; equal texts get
equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import SPACE, broadcast_if_small, cut, let, text_of, words_of

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_CHARS = 200
MIN_COMMON = 20
MAX_CLASS_DISTANCE = 0.33
MAX_WORD_DISTANCE = 0.75
# with words from corpus counts and a bin for all others
TOP_WORDS = 20
MIN_JUDGED = 40
MAX_ALL_WORDS_DISTANCE = 0.18

# Frequent function words, by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine",
    "en": "the of and to in a is that it for was on with as be by at from",
    "es": "de la que el en y a los se del las un por con no una para",
    "fr": "de la le et les des en un du une que est pour qui dans par pas sur",
}


def common_words() -> list[str]:
    return sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})


def top_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``top_lang``, ``top``: the most frequent words of letters of each language, and of all documents
    under a null language; ties go to the first word in code-point order."""
    words = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text_of(F.col(f"`{text_col}`")).alias("t"))
    words = words.select("lang", F.explode(words_of(F.lower("t"))).alias("w"))
    seen = cut(words.groupBy("lang", "w").agg(F.count("*").alias("n")).where(r"w RLIKE '^\\p{L}+$'"))
    of_all = seen.groupBy("w").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "w", "n")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    ranked = seen.where("lang IS NOT NULL").unionByName(of_all).withColumn("k", F.row_number().over(order)).where(F.col("k") <= TOP_WORDS)
    return cut(ranked.groupBy(F.col("lang").alias("top_lang")).agg(F.sort_array(F.collect_list(F.struct("k", "w")))["w"].alias("top")))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words covered by a window of ``window`` words that occurs twice or more in the array."""

    def covered(sorted_windows: Column) -> Column:
        same = lambda i, x: F.coalesce(F.get(sorted_windows, i)["w"] == x["w"], F.lit(False))
        twice = F.filter(sorted_windows, lambda x, i: same(i - 1, x) | same(i + 1, x))
        return let(F.sort_array(F.transform(twice, lambda x: x["at"])), lambda p: F.aggregate(
            F.transform(p, lambda a, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - a, F.lit(window)))),
            F.lit(0), lambda s, x: s + x))

    def body(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(window))))
        windows = F.sort_array(F.transform(starts, lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, window), " ").alias("w"), i.alias("at"))))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(windows, covered)))

    return let(words, lambda w: F.when(F.size(w) < window, F.lit(0)).otherwise(body(w)))


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           *, top: DataFrame | None = None) -> DataFrame:
    """Per document the base counts, and the histograms ``classes`` and ``common`` (with ``top`` over the
    words of the document's language and all others)."""
    col = lambda c: F.col(f"`{c}`")
    rows = docs.select(col(id_col).alias("doc_id"), col(lang_col).cast("string").alias("lang"), text_of(col(text_col)).alias("t"))
    names = common_words()
    codes = [chr(0x4E00 + i) for i in range(len(names) if top is None else TOP_WORDS)]
    # one letter per common word, so that counting them is a length difference
    if top is None:
        code = F.create_map(*(F.lit(x) for pair in zip(names, codes) for x in pair))
        letters = let(words_of(F.lower("t")), lambda w: F.array_join(
            F.transform(F.filter(w, lambda x: x.isin(names)), lambda x: F.element_at(code, x)), ""))
    else:
        rows = rows.join(broadcast_if_small(top), F.col("lang").eqNullSafe(F.col("top_lang")), "left")
        # null for other words, most of them by their length alone; array_join leaves nulls out
        known = F.struct(
            F.map_from_arrays("top", F.slice(F.array(*map(F.lit, codes)), F.lit(1), F.size("top"))).alias("code"),
            F.array_max(F.transform("top", F.length)).alias("longest"), F.col("w"))
        letters = F.when(F.col("top").isNull(), "").otherwise(let(known, lambda s: F.array_join(F.transform(
            s["w"], lambda x: F.when(F.length(x) <= s["longest"], F.element_at(s["code"], F.lower(x)))), "")))
    held = [letters.alias("letters")] if top is None else ["top"]
    rows = rows.select("doc_id", "lang", "t", *held, words_of(F.col("t")).alias("w"), _without(F.col("t"), "[a-z]+").alias("r1"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id",
        "lang",
        F.size("w").alias("n_words"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        (F.length("r1") - F.length(_without(F.col("r1"), "[#*$%&|<>]"))).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.length("t").alias("n"),
        F.col("r1"),
        (F.col("letters") if top is None else letters).alias("letters"),
    )
    # character classes by what successive removals take away
    steps = [SPACE + "+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()-]+", "[#*$%&|<>]+", r"[^\p{L}]+"]
    left = F.col("r1")
    for i, pattern in enumerate(steps):
        rows = rows.withColumn(f"r{i + 2}", _without(left, pattern))
        left = F.col(f"r{i + 2}")
    sizes = [F.col("n"), *(F.length(f"r{i + 1}") for i in range(len(steps) + 1))]
    classes = [a - b for a, b in zip(sizes, sizes[1:])] + [sizes[-1]]
    common = [F.length("letters") - F.length(F.replace(F.col("letters"), F.lit(c), F.lit(""))) for c in codes]
    if top is not None:
        common.append(F.col("n_words") - F.length("letters"))
    return rows.select(
        "doc_id", "lang",
        *(F.col(c).cast("long").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.array(*classes).alias("classes"),
        F.array(*common).alias("common"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of one length; null where one is empty."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda s, x: s + x)
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    def body(t: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: let(
            F.struct((a / t["p"]).alias("a"), (b / t["q"]).alias("b")),
            lambda s: part(s["a"], (s["a"] + s["b"]) / 2) + part(s["b"], (s["a"] + s["b"]) / 2)))
        mean = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2
        return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean)))

    sums = F.struct(total(p).alias("p"), total(q).alias("q"))
    return let(sums, lambda t: F.when((t["p"] > 0) & (t["q"] > 0), body(t)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
          max_class: float = MAX_CLASS_DISTANCE, max_word: float | None = None, corpus_words: bool = False) -> DataFrame:
    """Base counts and failure, the two distances (null: not enough material) and ``kept``."""
    max_word = max_word if max_word is not None else MAX_ALL_WORDS_DISTANCE if corpus_words else MAX_WORD_DISTANCE
    rows = cut(counts(docs, id_col, text_col, lang_col, top=top_words(docs, text_col, lang_col) if corpus_words else None))
    n_common = TOP_WORDS + 1 if corpus_words else len(common_words())
    n_classes = 8
    summed = lambda name, n: F.array(*(F.sum(F.get(name, F.lit(i)).cast("double")) for i in range(n))).alias(f"ref_{name}")
    both = [summed("classes", n_classes), summed("common", n_common)]
    refs = rows.where("lang IS NOT NULL").groupBy("lang").agg(*both)
    refs = refs.unionByName(rows.agg(*both).withColumn("lang", F.lit(None).cast("string")))
    refs = cut(refs.withColumnRenamed("lang", "ref_lang"))
    rows = rows.join(broadcast_if_small(refs), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    chars = F.aggregate("classes", F.lit(0), lambda s, x: s + x)
    common = F.aggregate("common", F.lit(0), lambda s, x: s + x)
    enough = F.col("n_words") >= MIN_JUDGED if corpus_words else common >= MIN_COMMON
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.when(chars >= MIN_CHARS, js_distance(F.col("classes"), F.col("ref_classes"))).alias("class_distance"),
        F.when(enough, js_distance(F.col("common"), F.col("ref_common"))).alias("word_distance"),
    )
    by_chance = F.lit(TOP_WORDS / (8 * math.log(2))) / F.col("n_words")
    word_limit = F.sqrt(F.lit(max_word * max_word) + by_chance) if corpus_words else F.lit(max_word)
    fine = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= max_class) & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= word_limit)
    return rows.withColumn("kept", ~F.col("base_failed") & fine)
