"""Column functions for text whose rules are Unicode-wide: one place for the regex dialect.

Java's classes are ASCII-only unless a pattern starts with (?U), and its line anchors also stop at
U+0085 and U+2028 unless it starts with (?d); every pattern here states what it needs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Article numbers such as 제4조 and 제4조의2 (fixed values, like all patterns of this module).
ARTICLE = r"제\d+조(?:의\d+)?"
ARTICLE_WITH_PARTS = r"제\d+조(?:제\d+항)?(?:제\d+호)?"
SUPERSCRIPTS, PLAIN = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "0123456789+-"
UNITS = "mSv|밀리시버트|Sv|rem|Bq|TBq|GBq|MBq|mCi|Ci|C/kg|R|mR|mA|kV|년|개월|일|시간|분|명|배|퍼센트|%|m|㎡|㎥|cm|mm"
REFERENCE = r"제\s*\d+\s*조(?:의\d+)?|제\s*\d+\s*항|제\s*\d+\s*호|별표\s*\d+|별지\s*제?\d+"
NOT_A_VALUE = (
    r"제\s*\d+\s*(?:조|항|호|목|란|장|절)(?:의\d+)?|별표\s*\d+|별지\s*제?\d+호?|<개정[^>]*>|"
    r"\d{4}\s*[.년]\s*\d{1,2}\s*[.월]\s*\d{1,2}\s*일?|\d{4}\s*년|제\s*\d+\s*호"
)
SCIENTIFIC = r"\d+(?:\.\d+)?e-?\d+"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """The column with '' for null."""
    return F.coalesce(as_column(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(as_column(c), r"(?U)^\s+|\s+$", "")


def squeeze(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), r"(?U)\s+", "")


def zero_fill(c: Column | str, width: int) -> Column:
    """Zeros on the left up to width; longer values stay whole."""
    c = as_column(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def unique_matches(c: Column | str, pattern: str, group: int = 0) -> Column:
    """Distinct matches in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(text(c), F.lit(pattern), F.lit(group)))


# --- article numbers ----------------------------------------------------------------------------


def norm_article(c: Column | str) -> Column:
    """제4조제6항 -> 제4조, blanks gone; what is no article number stays as it is."""
    squeezed = squeeze(text(c))
    head = F.regexp_extract(squeezed, f"^({ARTICLE})", 1)
    return F.when(head != "", head).otherwise(as_column(c))


def article_from_parts(number: Column | str, branch: Column | str) -> Column:
    """('0121', '02') -> 제121조의2; '' where the number is none."""
    n, b = as_column(number).try_cast("int"), F.coalesce(as_column(branch).try_cast("int"), F.lit(0))
    base = F.concat(F.lit("제"), n.cast("string"), F.lit("조"))
    return F.when(n.isNull(), "").when(b != 0, F.concat(base, F.lit("의"), b.cast("string"))).otherwise(base)


def article_sort_key(c: Column | str) -> Column:
    """(number, branch) as a struct of ints; (0, 0) where there is none."""
    c = text(c)
    part = lambda g: F.coalesce(F.regexp_extract(c, r"^제(\d+)조(?:의(\d+))?", g).try_cast("int"), F.lit(0))
    return F.struct(part(1).alias("number"), part(2).alias("branch"))


def sorted_articles(numbers: Column) -> Column:
    """An array of article numbers in the order of number and branch."""
    keyed = F.transform(numbers, lambda a: F.struct(article_sort_key(a).alias("k"), a.alias("a")))
    return F.transform(F.array_sort(keyed), lambda s: s["a"])


# --- names --------------------------------------------------------------------------------------


def norm_name(c: Column | str) -> Column:
    """Without blanks, underscores, middle dots and round brackets."""
    return F.regexp_replace(text(c), r"(?U)[\s_·ㆍ()]", "")


def is_subsequence(short: Column | str, long: Column | str) -> Column:
    """Whether the characters of short stand in long in this order: each step jumps past the next
    place of its character."""
    long = as_column(long)
    ends = F.aggregate(F.split(as_column(short), ""), F.lit(1), lambda at, ch: F.when((at == 0) | (ch == ""), at).otherwise(_past(ch, long, at)))
    return (as_column(short) == "") | (ends > 0)


def _past(ch: Column, long: Column, at: Column) -> Column:
    found = F.call_function("locate", ch, long, at)
    return F.when(found > 0, found + 1).otherwise(0)


# --- numbers ------------------------------------------------------------------------------------


def canon(c: Column | str) -> Column:
    """Every scientific notation as <mantissa>e<exponent>.

    As the published form does, an exponent needs no caret, so 5×1000 becomes 5e0.
    """
    s = F.regexp_replace(text(c), "[−–]", "-")
    s = F.regexp_replace(s, r"(?s)<sup>(.*?)</sup>", r"^$1")
    s = F.translate(s, SUPERSCRIPTS, PLAIN)
    s = F.regexp_replace(s, r"(?<=\d),(?=\d{3})", "")
    for pattern in (r"(?U)(\d+(?:\.\d+)?)\s*[×xX*]\s*10\s*\^?\s*(?:\+|(-))?0*(\d+)", r"(?U)(\d+(?:\.\d+)?)\s*[Ee]\s*(?:\+|(-))0*(\d+)"):
        s = F.regexp_replace(s, pattern, r"$1e$2$3")
    return F.regexp_replace(s, r"e-0(?!\d)", "e0")


def numbers(c: Column | str) -> Column:
    """Distinct number tokens after canon; a scientific number is one token."""
    s = canon(c)
    return F.array_distinct(F.concat(F.regexp_extract_all(s, F.lit(SCIENTIFIC), F.lit(0)), F.regexp_extract_all(F.regexp_replace(s, SCIENTIFIC, " "), F.lit(r"\d+(?:\.\d+)?"), F.lit(0))))


def norm_text(c: Column | str) -> Column:
    return F.regexp_replace(canon(c), "[^가-힣0-9A-Za-z]", "")


def propose_keys(c: Column | str) -> Column:
    """The numbers of a reference answer without article, item and annex numbers, sorted."""
    return F.array_sort(numbers(F.regexp_replace(text(c), f"(?U){REFERENCE}", " ")))


def has_one(nums: Column, plain: Column, key: Column) -> Column:
    k = strip(canon(key))
    return F.when(k.rlike(r"^\d+(?:\.\d+)?(?:e-?\d+)?$"), F.array_contains(nums, k)).otherwise(F.contains(plain, norm_text(key)))


def has_all(c: Column | str, keys: Column | str) -> Column:
    """keys: array of arrays of alternatives; every key needs one alternative in the text."""
    nums, plain = numbers(c), norm_text(c)
    return F.forall(as_column(keys), lambda alternatives: F.exists(alternatives, lambda k: has_one(nums, plain, k)))


def values(c: Column | str, strict: bool = True) -> Column:
    """Numbers that stand for values. strict: only scientific ones and those with a unit."""
    s = F.regexp_replace(canon(c), f"(?U){NOT_A_VALUE}", " ")
    number = r"(?<![\w.])\d+(?:\.\d+)?(?:e-?\d+)?"
    if not strict:
        return F.array_distinct(F.regexp_extract_all(s, F.lit(f"(?U){number}"), F.lit(0)))
    scientific = F.regexp_extract_all(s, F.lit(rf"(?U)(?<![\w.]){SCIENTIFIC}"), F.lit(0))
    with_unit = F.regexp_extract_all(s, F.lit(rf"(?U)({number})\s*(?:{UNITS})\b"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(F.concat(scientific, with_unit), lambda v: strip(canon(v)))))


# --- counting -----------------------------------------------------------------------------------


def count_literal(c: Column, find: Column) -> Column:
    """Occurrences of a literal, without overlaps."""
    return F.when(find == "", 0).otherwise(((F.length(c) - F.length(F.replace(c, find, F.lit("")))) / F.greatest(F.length(find), F.lit(1))).cast("int"))


def text_len(c: Column | str) -> Column:
    """Characters without tags, marks of markup and white space."""
    s = F.regexp_replace(F.regexp_replace(text(c), "<[^>]+>", ""), r"[#*|\\_-]", "")
    return F.length(squeeze(s))


def num_set(c: Column | str) -> Column:
    """Decimals and whole numbers of two or more digits, commas dropped."""
    s = F.regexp_replace(F.regexp_replace(text(c), "<[^>]+>", " "), ",", "")
    return F.array_distinct(F.regexp_extract_all(s, F.lit(r"\d+\.\d+|\d{2,}"), F.lit(0)))


def content_chars(c: Column | str) -> Column:
    s = F.regexp_replace(F.regexp_replace(text(c), "<[^>]+>", " "), "&[a-z]+;", " ")
    return F.regexp_replace(s, "[^가-힣0-9A-Za-z]", "")


@F.pandas_udf(T.IntegerType())
def _bag_difference(a: pd.Series, b: pd.Series) -> pd.Series:
    from collections import Counter

    return pd.Series([(Counter(x) - Counter(y)).total() for x, y in zip(a, b)], dtype="int32")


def char_bag_diff(a: Column | str, b: Column | str) -> Column:
    """How many content characters of a (with multiplicity) are missing in b."""
    return _bag_difference(content_chars(a), content_chars(b))


def math_loss(c: Column | str) -> Column:
    """Places where a number is followed by a multiplication sign but its power is gone."""
    s = F.regexp_replace(text(c), r"(?s)<sup>.*?</sup>", "⌃")
    raised = "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⌃"
    no_power = F.regexp_extract_all(s, F.lit(rf"(?U)\d[\d.,]*\s*×\s*(?![\d\s{raised}])[^\s<]{{0,12}}"), F.lit(0))
    no_exponent = F.regexp_extract_all(s, F.lit(rf"(?U)\d[\d.,]*\s*×\s*10(?![\d\s\^\-−{raised}])[^\s<]{{0,12}}"), F.lit(0))
    return F.concat(no_power, no_exponent)
