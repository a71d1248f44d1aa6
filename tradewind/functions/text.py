"""Text normalisation built from native string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the two truth values in the raw deal files.
TRUE_WORDS = ("true", "t", "yes", "1")
FALSE_WORDS = ("false", "f", "no", "0")

_GAP = r"([^\p{L}\p{N}])"
_BREAK = "\x01 "


def blank_to_null(text: Column) -> Column:
    """Trim spaces; an empty remainder becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def title_words(text: Column) -> Column:
    """Capitalise after every non-alphanumeric character.

    Spark's initcap() only starts a word after white space, which leaves "d'oeste" and
    "embu-guacu" half in lower case.  A break ending in a space is put behind every gap
    character for initcap() to see, and taken out again.
    """
    marked = F.regexp_replace(F.lower(text), _GAP, "$1" + _BREAK)
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def truth_value(text: Column) -> Column:
    """Three-valued boolean from free text: anything unknown is NULL."""
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


# The same as SQL text, for plans with hundreds of expressions: a text is one call to the JVM,
# a Column one for every function in it.


def blank_to_null_sql(text: str) -> str:
    return f"nullif(trim({text}), '')"


def title_words_sql(text: str) -> str:
    marked = f"regexp_replace(lower({text}), r'{_GAP}', '$1\\u0001 ')"
    return f"replace(initcap({marked}), '\\u0001 ', '')"


def truth_value_sql(text: str) -> str:
    listed = lambda words: ", ".join(f"'{w}'" for w in words)
    return (
        f"CASE WHEN lower(trim({text})) IN ({listed(TRUE_WORDS)}) THEN true"
        f" WHEN lower(trim({text})) IN ({listed(FALSE_WORDS)}) THEN false END"
    )
