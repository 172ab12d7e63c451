"""Quality rules by distribution divergence, with DataFrame functions only.

Per document two histograms are taken over the whole text: character classes,
and the common words of its language. The reference of a language is the sum
of the histograms of all its documents that pass the base rules and are long
enough. A document is rejected when the Jensen-Shannon distance (square root
of the divergence in bits) of a histogram to its reference exceeds a
threshold; short texts, whose histograms are noisy, are not compared.

Base rules: fewer than MIN_WORDS words, or more than half of the words in
3-word windows that occur twice or more in the text.

All counts of a document are computed in its own row (built-in string and array
functions, O(n log n) in its words); only the per-language sums are shuffled,
after map-side aggregation, and joined back as one small row per language.

Edge cases: a null or empty text has no words and fails the base rules; a null
language is a language of its own; a language without listed words has only
the character histogram; a language without reference documents rejects
nothing; repeated rows get equal results and count each in the reference; other columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.session import cut_lineage

from .common import WORD_PATTERN

MIN_WORDS = 50
REPEAT_PERCENT = 50
CHARACTER_DISTANCE, CHARACTER_LEAST = 0.27, 200  # threshold; characters needed
WORD_DISTANCE, WORD_LEAST = 0.24, 120            # threshold; words needed
MANY_REPEATS = 32  # distinct repeated windows from which they are found by sorting

# Frequent function words of a language; a histogram's last bin
# holds all other words.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "ein", "für", "auf"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "with"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
}
# Character classes besides the rest (lower case and other letters).
CLASSES = {"space": r"[\x20\x09-\x0D]", "upper": r"\p{Lu}", "digit": r"[0-9]", "stop": r"[.,;:'()-]",
           "mark": r"[!?#*$%&|<>=+_/\\\[\]{}~^@]"}
SYMBOLS = r"[#*$%&|<>]"


def _sql_words(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _features(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, classes, common (histograms as arrays of long)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    count = {k: F.regexp_count("text", F.lit(p)).cast("long") for k, p in CLASSES.items()}
    d = d.select("doc_id", "lang", "text", F.length("text").cast("long").alias("chars"),
                 F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                 *[c.alias(f"c_{k}") for k, c in count.items()],
                 F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), F.lit(1)).alias("w"),
                 F.expr(r"filter(split(text, '\n'), l -> regexp_count(l, '[^\\x20\\x09-\\x0D]') > 0)").alias("lines"))
    listed = "case lang " + " ".join(f"when '{k}' then {_sql_words(v)}" for k, v in COMMON_WORDS.items())
    d = d.withColumns({
        "n_words": F.size("w").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        # 3-word windows as hashes, exact up to 64-bit collisions inside one text
        "h": F.expr("if(size(w) < 3, array(), transform(slice(w, 1, size(w) - 2), "
                    "(x, i) -> xxhash64(x, w[i + 1], w[i + 2])))"),
        "listed": F.expr(listed + " else cast(array() as array<string>) end"),
    }).drop("lines", "text")
    d = d.withColumns({
        "hits": F.expr("filter(w, x -> length(x) <= 4 and array_contains(listed, x))"),
        "sorted": F.sort_array("h"),
    })
    d = d.withColumn("twice", F.expr("array_distinct(filter(sorted, (x, i) -> i > 0 and x = sorted[i - 1]))"))
    # places of repeated windows: by membership if few values repeat, else by
    # sorting (hash, place) pairs and comparing neighbours
    d = d.withColumn("pairs", F.expr(f"if(size(twice) > {MANY_REPEATS}, "
                                     "sort_array(transform(h, (x, i) -> struct(x as x, i as i))), "
                                     "cast(array() as array<struct<x: bigint, i: int>>))"))
    d = d.withColumn("places", F.expr(f"""
        case when size(twice) = 0 then cast(array() as array<int>)
        when size(twice) <= {MANY_REPEATS} then
          filter(transform(h, (x, i) -> if(array_contains(twice, x), i, -1)), i -> i >= 0)
        else sort_array(transform(filter(pairs, (p, j) -> (j > 0 and pairs[j - 1].x = p.x)
          or (j < size(pairs) - 1 and pairs[j + 1].x = p.x)), p -> p.i)) end"""))
    covered = ("aggregate(places, struct(cast(0 as bigint) as n, cast(-3 as int) as last), "
               "(s, i) -> struct(s.n + least(3, i - s.last) as n, i as last), s -> s.n)")
    common = "transform(listed, c -> cast(size(hits) - size(array_remove(hits, c)) as bigint))"
    rest = F.col("chars") - sum((F.col(f"c_{k}") for k in CLASSES), F.lit(0))
    return d.select(
        "doc_id", "lang", "n_words", (F.col("chars") - F.col("c_space")).alias("word_chars"), "n_symbols",
        "n_dup_lines", F.expr(covered).alias("n_repeat_words"),
        F.array(rest, *[F.col(f"c_{k}") for k in CLASSES]).alias("classes"),
        F.expr(f"concat({common}, array(cast(size(w) - size(hits) as bigint)))").alias("common"))


def js_distance(own: str, reference: str) -> str:
    """SQL text: Jensen-Shannon distance of two histograms of equal size; null
    where one is empty."""
    p, q = f"(c / aggregate({own}, 0D, (s, x) -> s + x))", f"(r / aggregate({reference}, 0D, (s, x) -> s + x))"
    term = f"if({{a}} > 0, {{a}} * log2(2 * {{a}} / ({p} + {q})), 0D)"
    both = f"({term.format(a=p)} + {term.format(a=q)}) / 2"
    return (f"if(array_max({own}) > 0 and array_max({reference}) > 0, sqrt(greatest(0D, "
            f"aggregate(zip_with({own}, {reference}, (c, r) -> {both}), 0D, (s, x) -> s + x))), null)")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, char_distance, word_distance."""
    f = cut_lineage(_features(docs, id_col, text_col, lang_col).withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words")))
    sized = f.filter(f"not base_failed and n_words >= {WORD_LEAST}")
    n_classes, n_common = len(CLASSES) + 1, max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"k{i}") for i in range(n_classes)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"m{i}") for i in range(n_common)]
    reference = sized.groupBy("lang").agg(*sums).select(
        F.col("lang").alias("of"), F.array(*[f"k{i}" for i in range(n_classes)]).alias("ref_classes"),
        F.filter(F.array(*[f"m{i}" for i in range(n_common)]), lambda x: x.isNotNull()).alias("ref_common"))
    joined = f.join(reference, F.col("lang").eqNullSafe(F.col("of")), "left")
    joined = joined.withColumns({
        "char_distance": F.expr(f"if(aggregate(classes, 0L, (s, x) -> s + x) >= {CHARACTER_LEAST}, "
                                f"{js_distance('classes', 'ref_classes')}, null)"),
        "word_distance": F.expr(f"if(n_words >= {WORD_LEAST} and size(common) > 1, "
                                f"{js_distance('common', 'ref_common')}, null)")})
    close = F.expr(f"coalesce(char_distance <= {CHARACTER_DISTANCE}, true) and "
                   f"coalesce(word_distance <= {WORD_DISTANCE}, true)")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & close).alias("kept"), "char_distance", "word_distance")
