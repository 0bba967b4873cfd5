"""Text column expressions. All are native Spark expressions (whole-stage codegen or
JVM higher-order functions); no Python runs per row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match).
# English stop words: Spark's default list (StopWordsRemover, "english", 181 words).
ENGLISH_STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what
which who whom this that these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's
let's ought that's there's what's when's where's who's why's would
""".split())
# Report tokenizer: runs of ASCII letters, digits and apostrophes.
REPORT_TOKEN_PATTERN = "[a-zA-Z0-9']+"
# Vectoriser tokens: runs of two or more word characters (letters, numbers, underscore).
WORD_PATTERN = "[\\p{L}\\p{N}_]{2,}"
# Whitespace as Python's str.split() sees it.
WHITESPACE_RUN = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                  "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+")
# Letters only (Python str.isalpha).
ALPHA_WORD = "^\\p{L}+$"
# Label slug: every run of characters other than ASCII letters and digits becomes "_".
SLUG_PATTERN = "[^a-zA-Z0-9]+"
# Timestamp tag format yyyyMMdd_HHmmss.
TIMESTAMP_TAG = "yyyyMMdd_HHmmss"
# ---------------------------------------------------------------------------


def tokenize(text: Column, stopwords=ENGLISH_STOPWORDS) -> Column:
    """Lower-case, pull ``[a-zA-Z0-9']+`` runs, drop stop words -> array<string>."""
    toks = F.regexp_extract_all(F.lower(text), F.lit(REPORT_TOKEN_PATTERN), 0)
    stop = list(stopwords)
    return F.filter(toks, lambda t: ~t.isin(stop))


def clean_text(text: Column, stopwords=ENGLISH_STOPWORDS) -> Column:
    """Training clean: lower, split on whitespace, keep alphabetic non-stop-words, join by space."""
    stop = list(stopwords)
    toks = F.split(F.lower(text), WHITESPACE_RUN)
    kept = F.filter(toks, lambda t: t.rlike(ALPHA_WORD) & ~t.isin(stop))
    return F.array_join(kept, " ")


def normalize_space(text: Column) -> Column:
    """Word-cloud clean: null -> '', lower, whitespace runs -> one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WHITESPACE_RUN, " "))


def text_length(text: Column) -> Column:
    """Characters (code points) in the text; null counts as 0."""
    return F.length(F.coalesce(text, F.lit(""))).cast("bigint")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Expressions referenced inside a higher-order function's lambda are evaluated
    per element; binding them first keeps array work linear.
    """
    return F.get(F.transform(F.array(value), body), 0)


@lru_cache(maxsize=1)
def _combining_class() -> str:
    """Regex class of every code point with a non-zero canonical combining class."""
    cps = [cp for cp in range(0x300, 0x110000)
           if not 0xD800 <= cp <= 0xDFFF and unicodedata.combining(chr(cp))]
    parts, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        parts.append(f"\\x{{{cps[i]:X}}}" if i == j else f"\\x{{{cps[i]:X}}}-\\x{{{cps[j]:X}}}")
        i = j + 1
    # every such code point is a mark; testing \p{M} first lets letters fail fast
    return "[\\p{M}&&[" + "".join(parts) + "]]"


# ICU (shipped with Spark) compatibility decomposition; gives the same code points as
# Python's unicodedata.normalize("NFKD", ...).
_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def strip_accents(text: Column) -> Column:
    """Compatibility-decompose (NFKD) and drop combining marks, JVM-side, with ICU's
    normaliser (shipped with Spark) through ``reflect``. ASCII-only text is returned as is."""
    nfkd = F.reflect(F.lit(_ICU_NORMALIZER), F.lit("decompose"), text, F.lit(True))
    stripped = F.regexp_replace(nfkd, _combining_class(), "")
    return F.when(text.rlike("[^\\x00-\\x7F]"), stripped).otherwise(text)


def vectorizer_tokens(text: Column) -> Column:
    """Vectoriser analyser: lower, strip accents, words of >= 2 word characters."""
    return F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(WORD_PATTERN), 0)


def word_ngrams(tokens: Column) -> Column:
    """Unigrams followed by space-joined bigrams of an array of tokens."""
    def body(toks):
        bigrams = F.transform(F.slice(toks, 2, F.greatest(F.size(toks), F.lit(0))),
                              lambda nxt, i: F.concat(F.get(toks, i), F.lit(" "), nxt))
        return F.concat(toks, bigrams)
    return let(tokens, body)


def term_counts(terms: Column, kind: str = "string") -> Column:
    """Run-length count of an array of terms (of type ``kind``) -> array<struct<term, tf>> sorted by term.

    Runs inside the row (sort + one pass), so counting needs no shuffle.
    """
    empty = F.array().cast(f"array<struct<term:{kind},tf:bigint>>")

    def counted(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                          lambda i: (i == 1) | (F.try_element_at(s, i) != F.try_element_at(s, i - 1)))

        def runs(st_arr):
            return F.transform(st_arr, lambda st, j: F.struct(
                F.try_element_at(s, st).alias("term"),
                (F.coalesce(F.try_element_at(st_arr, j + 2), n + 1) - st).cast("bigint").alias("tf")))
        return F.when(n > 0, let(starts, runs)).otherwise(empty)
    return let(F.array_sort(terms), counted)


def label_slug(label: Column) -> Column:
    return F.regexp_replace(label, SLUG_PATTERN, "_")


def timestamp_tag(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_TAG)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percent with ``digits`` decimals; 0 when the denominator is 0."""
    return F.coalesce(F.round(F.try_divide(part * F.lit(100.0), whole), digits), F.lit(0.0))


def norm_label(label: Column) -> Column:
    """Case- and space-insensitive label form."""
    return F.lower(F.trim(label))
