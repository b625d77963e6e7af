"""Text folding and word splitting, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Locales with a label catalogue; English is the fallback (fixed values).
LOCALES = [
    "en", "zh", "es", "fr", "de", "pt", "it", "nl", "ja", "ko", "ru", "tr", "id", "hi", "th", "ar",
]
FALLBACK_LOCALE = "en"

# Arabic folding (fixed values): letters that change, the letters they become, and the
# marks that vanish (tatweel, the harakat, superscript alef, bare hamza).
FOLD_FROM = "\u0622\u0623\u0625\u0671\u0649\u0629\u0624\u0626" + "٠١٢٣٤٥٦٧٨٩"
FOLD_TO = "\u0627\u0627\u0627\u0627\u064a\u0647\u0648\u064a" + "0123456789"
DROPPED = "\u0640\u064b\u064c\u064d\u064e\u064f\u0650\u0651\u0652\u0670\u0621"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ARABIC_BLOCK = "[\u0600-\u06ff]"
ARTICLE = "\u0627\u0644"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def normalize(c, locale: str | None = None, fold_persian: bool = False) -> Column:
    """Lower case, Arabic folding where it applies, single spaces."""
    low = F.lower(_col(c))
    more = (PERSIAN_DIGITS, "0123456789") if fold_persian else ("", "")
    # translate drops the characters that have no counterpart
    folded = F.translate(low, FOLD_FROM + more[0] + DROPPED, FOLD_TO + more[1])
    if locale != "ar":
        folded = F.when(low.rlike(ARABIC_BLOCK), folded).otherwise(low)
    return F.trim(F.regexp_replace(folded, r"(?U)\s+", " "))


def applied_rules(c, locale: str | None = None) -> Column:
    """Names of the rule groups that ran, for explaining a match."""
    arabic = F.lit(True) if locale == "ar" else F.lower(_col(c)).rlike(ARABIC_BLOCK)
    rules = F.array(F.lit("lowercase"), F.when(arabic, F.lit("arabic")), F.lit("collapse_whitespace"))
    return F.array_compact(rules)


def tokenize(c) -> Column:
    """Words of a normalized text, without the leading Arabic article of longer words."""
    words = F.filter(F.split(_col(c), r"[^\p{IsAlphabetic}\p{N}]+"), lambda w: w != "")
    return F.transform(
        words,
        lambda w: F.when((F.length(w) > 4) & w.startswith(ARTICLE), F.substring(w, 3, 1 << 30)).otherwise(w),
    )


def match_normalized(df: DataFrame, c: str, text: str, locale: str | None = None, like: bool = False) -> DataFrame:
    """Rows whose field equals (or, with ``like``, contains) the text after folding both."""
    left, right = normalize(c, locale), normalize(F.lit(text), locale)
    return df.where(left.contains(right) if like else left == right)


def is_supported_locale(locale: str) -> bool:
    return locale in LOCALES


def translate_fallback(keys: DataFrame, labels: DataFrame, locale: str) -> DataFrame:
    """Label per key in ``locale``, else in English.

    ``labels`` holds ``key, locale, label`` with one row per key and locale.  One
    grouped pass picks both candidates, so labels are joined once.
    """
    wanted = labels.where(F.col("locale").isin(locale, FALLBACK_LOCALE))
    own = F.when(F.col("locale") == locale, F.col("label"))
    spare = F.when(F.col("locale") == FALLBACK_LOCALE, F.col("label"))
    best = wanted.groupBy("key").agg(
        F.coalesce(F.max(own), F.max(spare)).alias("label"),
        F.max(own).isNull().alias("is_fallback"),
    )
    return keys.join(best, "key", "left")
