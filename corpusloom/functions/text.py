"""Column functions for text: cleaning, tokens, n-grams, hashing, rewriting.

All of them are built-in Spark expressions.  Word boundaries are spelled out as
ASCII look-arounds because Java's ``\\b`` treats accented letters as word
characters while the semantics here are ASCII.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import fixed_values as fv

# Unicode white space, spelled out: Java's \s alone is ASCII only.
WS = r"[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: The same characters one by one, for Spark's own trim.
WS_CHARS = " \t\n\x0b\f\r\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"
# White space that is not one blank between words; a letter fails at the first test.
_LOOSE_WS = f"(?![!-~])(?:{WS.replace(chr(92) + 's', chr(92) + 't-' + chr(92) + 'r', 1)}{WS}*| {WS}+)"
NOT_AFTER_WORD = "(?<![A-Za-z0-9_])"
NOT_BEFORE_WORD = "(?![A-Za-z0-9_])"
ORDINALS = "①②③④⑤⑥⑦⑧⑨⑩"


def any_word(words: list[str], ignore_case: bool = True) -> str:
    """Pattern that matches one of ``words`` as a whole (ASCII) word."""
    return ("(?i)" if ignore_case else "") + NOT_AFTER_WORD + "(?:" + "|".join(words) + ")" + NOT_BEFORE_WORD


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", None).otherwise(c)


def clean_text(c: Column) -> Column:
    """Collapse runs of white space to one blank and trim; null becomes ''."""
    return F.trim(F.regexp_replace(or_empty(c), _LOOSE_WS, " "))


def normalize_key(c: Column) -> Column:
    return F.lower(clean_text(c))


def trim_ws(c: Column) -> Column:
    return F.trim(or_empty(c), F.lit(WS_CHARS))


def dedup_key(c: Column) -> Column:
    """Lower-case; every run outside ``[a-z0-9]`` and CJK ideographs is one blank."""
    return F.trim(F.regexp_replace(F.lower(or_empty(c)), "[^a-z0-9一-鿿]+", " "))


def words_in_clean(clean: Column) -> Column:
    """Word count of an already cleaned text (words are separated by one blank)."""
    # no branches: Spark shares ``clean`` only between parts that are always evaluated
    blanks = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return (blanks + (clean != "").cast("int")).cast("long")


def word_count(c: Column) -> Column:
    return words_in_clean(clean_text(c))


def space_tokens(clean: Column) -> Column:
    """Tokens of a cleaned text; '' has none."""
    return F.array_remove(F.split(clean, " "), "")


def alnum_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(or_empty(c)), F.lit("[a-z0-9']+"), F.lit(0))


def _windows(tokens: Column, n: int, join) -> Column:
    """Fold each run of ``n`` neighbouring tokens with ``join``.

    Shifted slices are zipped, so no lambda reads the token array itself:
    wherever the optimizer moves the expression, the work stays linear.
    """
    m = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    out = F.slice(tokens, F.lit(1), m)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(tokens, F.lit(k + 1), m), join)
    return out


def ngrams(tokens: Column, n: int) -> Column:
    return _windows(tokens, n, lambda a, b: F.concat_ws(" ", a, b))


def ngram_hashes(tokens: Column, n: int) -> Column:
    """64-bit hash of each n-gram: what set operations at scale run on."""
    return _windows(F.transform(tokens, lambda t: F.xxhash64(t)), n, lambda a, b: F.xxhash64(a, b))


def item_hashes(items: Column) -> Column:
    """64-bit hash of each item, for ``hash_windows``."""
    return F.transform(items, lambda t: F.xxhash64(t))


def hash_windows(hashes: Column, n: int) -> Column:
    """``ngram_hashes`` from a *column* of ``item_hashes``: as an expression they would be made anew for every slice."""
    return _windows(hashes, n, lambda a, b: F.xxhash64(a, b))


def char_ngram_hashes(text: Column, n: int) -> Column:
    return ngram_hashes(characters(text), n)


def characters(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")


def strip_framing(c: Column) -> Column:
    """Drop a leading ``<image>`` marker."""
    return trim_ws(F.regexp_replace(or_empty(c), f"(?i)^<image>{WS}*", ""))


def sentence_count(c: Column) -> Column:
    hits = F.regexp_count(or_empty(c), F.lit(f"[.!?]+(?={WS}|\\z)"))
    return F.greatest(F.lit(1), hits).cast("long")


def opener_bucket(c: Column, empty: str = "∅") -> Column:
    """``opener_of`` behind a leading ``<image>`` marker."""
    return opener_of(strip_framing(c), empty)


def opener_of(c: Column, empty: str = "∅") -> Column:
    """First three words, lower-cased, only ``[a-z0-9 ]`` kept."""
    lead = F.regexp_extract(
        trim_ws(c), rf"^([^A-Za-z0-9]*)(\S+{WS}+\S+{WS}+\S+|\S+{WS}+\S+|\S+)", 2
    )
    kept = F.trim(F.regexp_replace(F.regexp_replace(F.lower(lead), "[^a-z0-9 ]", ""), " +", " "))
    bucket = F.concat_ws(" ", F.slice(F.split(kept, " "), 1, 3))
    return F.when(bucket == "", F.lit(empty)).otherwise(bucket)


def lead_fingerprint(c: Column, length: int = 60) -> Column:
    """First sentence, cut at ``length`` characters, lower-cased."""
    return F.lower(F.substring(F.regexp_extract(trim_ws(c), r"^[^.!?\n]*", 0), 1, length))


def jargon_hits(c: Column, terms: list[str] = fv.JARGON_TERMS) -> Column:
    return F.regexp_count(or_empty(c), F.lit(any_word([t.replace("-", r"[\-/]") for t in terms]))).cast("long")


def split_label(raw: Column) -> tuple[Column, Column]:
    """``label（a、b）`` -> (label, [a, b]); a leading circled ordinal is dropped."""
    text = strip_ordinal(raw)
    shape = r"^([^（(]+)[（(]([^）)]+)[）)]$"
    has_examples = text.rlike(shape)
    inner = F.regexp_extract(text, shape, 2)
    examples = F.filter(F.transform(F.split(inner, "[、,，]"), clean_text), lambda x: x != "")
    return (
        F.when(has_examples, clean_text(F.regexp_extract(text, shape, 1))).otherwise(text),
        F.when(has_examples, examples).otherwise(F.array().cast("array<string>")),
    )


def strip_ordinal(c: Column) -> Column:
    return F.regexp_replace(clean_text(c), f"^[{ORDINALS}]{WS}*", "")


def normalize_application(c: Column) -> Column:
    """Drop a trailing 类; add 应用 unless the name already ends in 应用 or 页面."""
    base = F.regexp_replace(clean_text(c), "类$", "")
    return (
        F.when(base == "", F.lit(fv.GENERIC_APP))
        .when(base.rlike("(应用|页面)$"), base)
        .otherwise(F.concat(base, F.lit("应用")))
    )


def ensure_app_name(c: Column) -> Column:
    text = clean_text(c)
    return (
        F.when(text == "", text)
        .when(text.rlike("(" + "|".join(fv.APP_NAME_SUFFIXES) + ")$"), text)
        .otherwise(F.concat(text, F.lit("应用")))
    )


def label_tokens(label: Column) -> Column:
    """Break a scene label into tokens of two or more characters."""
    flat = F.regexp_replace(clean_text(label), "[（）()]", " ")
    parts = F.transform(F.split(flat, rf"[/、,&]| and | And |\s+-\s+|\s+"), clean_text)
    return F.filter(parts, lambda t: (F.length(t) >= 2) & ~t.isin(fv.LABEL_TOKEN_STOPWORDS))


def contains_any(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def tags_by_rules(c: Column, rules, lead: Column | None = None, default: list[str] | None = None) -> Column:
    """Ordered distinct tags of every rule with a keyword in ``c``.

    ``lead`` is an array put in front of the hits; ``default`` is used when
    nothing matched.
    """
    none = F.array().cast("array<string>")
    hits = [
        F.when(contains_any(c, words), F.array(*[F.lit(t) for t in tags])).otherwise(none) for words, tags in rules
    ]
    found = F.array_distinct(F.concat(*([lead] if lead is not None else []), *hits))
    if default is None:
        return found
    return F.when(F.size(found) == 0, F.array(*[F.lit(d) for d in default])).otherwise(found)


def rotate(arr: Column, offset: Column) -> Column:
    """Rotate left by ``offset``; works for negative offsets and empty arrays."""
    k = F.pmod(offset, F.greatest(F.size(arr), F.lit(1))).cast("int")
    return F.concat(F.slice(arr, k + 1, F.size(arr)), F.slice(arr, F.lit(1), k))


def cyclic(arr: Column, i: Column) -> Column:
    """``arr[i mod size]``; null for an empty array."""
    return F.get(arr, F.pmod(i, F.greatest(F.size(arr), F.lit(1))).cast("int"))


def short_hash(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 10)


def hash_number(c: Column) -> Column:
    """First 32 bits of sha1 as a non-negative number."""
    return F.conv(F.substring(F.sha1(c), 1, 8), 16, 10).cast("long")


def unit_hash(c: Column) -> Column:
    """Deterministic number in [0, 1) for ``c``: independent of partitioning."""
    return hash_number(c) / F.lit(4294967296.0)


def seeded_index(seed: Column, n: Column | int, offset: int = 0) -> Column:
    size = F.lit(n) if isinstance(n, int) else n
    return F.pmod(hash_number(F.concat(seed.cast("string"), F.lit(f":{offset}"))), size)


def pick_seeded(items: list[str], seed: Column, offset: int = 0) -> Column:
    return F.get(F.array(*[F.lit(i) for i in items]), seeded_index(seed, len(items), offset).cast("int"))


def opener_for(id_col: Column, openers: list[str] = fv.OPENERS) -> Column:
    return F.get(
        F.array(*[F.lit(o) for o in openers]), F.pmod(hash_number(id_col.cast("string")), F.lit(len(openers))).cast("int")
    )


def round_to(c: Column, digits: int) -> Column:
    """Half-up rounding by floor(x*10^d + 0.5) / 10^d."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5)).cast("long")


def ratio(num: Column, den: Column, digits: int = 6, empty: float = 0.0) -> Column:
    return F.when(den == 0, F.lit(empty)).otherwise(
        round_to(num.cast("double") / F.when(den == 0, None).otherwise(den).cast("double"), digits)
    )


def translate_label(c: Column, table=fv.LABEL_TRANSLATIONS, empty: str = "the product") -> Column:
    """Apply ordered substring replacements, then tidy brackets, slashes and blanks."""
    text = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), table, clean_text(c))
    text = F.regexp_replace(text, "[（）()]", " ")
    text = F.regexp_replace(text, f"{WS}*/{WS}*", " and ")
    text = F.trim(F.regexp_replace(text, f"{WS}+", " "))
    return F.when(text == "", F.lit(empty)).otherwise(text)


def _swap_nouns(c: Column, nouns: list[str], new: str) -> Column:
    """Replace whole words, once per spelling: UPPER, Capitalised, anything else."""
    upper = any_word([n.upper() for n in nouns], ignore_case=False)
    capital = any_word([n[0].upper() + "(?i:" + n[1:] + ")" for n in nouns], ignore_case=False)
    for pattern, word in ((upper, new.upper()), (capital, new.capitalize()), (any_word(nouns), new)):
        c = F.regexp_replace(c, pattern, word)
    return c


def rewrite_summary(before: Column, after: Column) -> list[Column]:
    """Aggregates of a rewrite: rows, changed rows, mean words before and after."""
    mean = lambda c: F.floor(F.coalesce(F.avg(word_count(c)), F.lit(0.0)) * 100 + 0.5) / 100
    changed = F.count_if(~before.eqNullSafe(after))
    return [F.count("*").alias("rows"), changed.alias("changed"), mean(before).alias("mean_words_before"), mean(after).alias("mean_words_after")]


def rewrite_scope(c: Column) -> Column:
    """Lift page- and feature-level wording to app/tool level and fix articles."""
    nouns = fv.PAGE_NOUNS + fv.TOOL_NOUNS
    sized = (
        "(?i)" + NOT_AFTER_WORD + "(?:" + "|".join(fv.SIZE_WORDS) + f"){WS}+(?=(?:" + "|".join(nouns) + ")" + NOT_BEFORE_WORD + ")"
    )
    c = F.regexp_replace(or_empty(c), sized, "")
    c = F.regexp_replace(c, "[ \t]+", " ")
    c = _swap_nouns(c, fv.PAGE_NOUNS, "app")
    c = _swap_nouns(c, fv.TOOL_NOUNS, "tool")
    c = F.regexp_replace(c, NOT_AFTER_WORD + f"a{WS}+app" + NOT_BEFORE_WORD, "an app")
    c = F.regexp_replace(c, NOT_AFTER_WORD + f"an{WS}+tool" + NOT_BEFORE_WORD, "a tool")
    return trim_ws(c)
