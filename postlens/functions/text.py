"""Column expressions for text: blanks, clauses, tags, content keys.

Patterns are Java regular expressions with ``(?Ud)`` in front, so that character
classes are Unicode's and ``.`` stops at line feeds only.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BLANK = r"[\s\x1c-\x1f]"
#: The characters that BLANK stands for.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MISSING = "<missing>"
CONTENT_FIELDS = ("title", "description", "requirements")
#: Patterns of a rule table, which every task holds.
MAX_RULES = 10_000


def rx(pattern: str, flags: str = "") -> str:
    return f"(?Ud{flags}){pattern}"


def has(text: Column, pattern: str, flags: str = "", seen: Column | None = None) -> Column:
    """Whether the pattern occurs; false for a null text.

    seen: those of its ``needed`` words (and others) that the text, or one that holds it, has (``words_in``): without any of them the pattern is not tried.
    """
    found = F.coalesce(text.rlike(rx(pattern, flags)), F.lit(False))
    return found if seen is None else possible(pattern, seen) & found


@cache
def needed(pattern: str) -> tuple[str, ...]:
    """Words without blanks, lower case, one of which is in any text with the pattern; none if no such words are known."""

    def of(items) -> frozenset[str]:
        found, run = [], ""
        for op, x in [*items, (None, None)]:
            kind = str(op)
            if kind == "LITERAL" and not chr(x).isspace():
                run += chr(x)
                continue
            found, run = found + [frozenset([run.lower()])] * bool(run), ""
            if kind == "SUBPATTERN":
                found.append(of(x[-1]))
            elif kind == "BRANCH" and all(each := [of(y) for y in x[1]]):
                found.append(frozenset().union(*each))
            elif kind in ("MAX_REPEAT", "MIN_REPEAT") and x[0]:
                found.append(of(x[2]))
            elif kind == "IN" and all(str(k) == "LITERAL" and not chr(v).isspace() for k, v in x):
                found.append(frozenset(chr(v).lower() for _, v in x))
        # of what must be there one behind the other, that whose words are rarest: the longest ones
        return max((f for f in found if f), key=lambda f: (min(len(w.encode()) for w in f), -len(f)), default=frozenset())

    words = of(re._parser.parse(pattern))
    return tuple(sorted(w for w in words if not any(v in w for v in words if v != w)))


def _constant(words: Sequence[str]) -> Column:
    """Words without blanks as an array: one literal, where an array of literals would make long plans."""
    return F.split(F.lit(" ".join(words)), " ")


def possible(pattern: str, seen: Column) -> Column:
    """Whether the pattern may occur where only these words do."""
    words = needed(pattern)
    return F.arrays_overlap(seen, _constant(words)) if words else F.lit(True)


def folded(text: Column) -> Column:
    """Lower case by the rules of patterns without case, for which the letters \u017f, \u0131, \u0130 and the Kelvin sign are s, i, i and k."""
    return F.lower(F.translate(text, "\u017f\u0131\u0130\u212a", "siik"))


def words_in(text: Column, words: Sequence[str]) -> Column:
    """Those of the words that a ``folded`` text (a column, as it is read for each word) has."""
    # a text without a character from U+2E80 on has no word that needs one
    latin = [w for w in words if max(w) < "\u2e80"]
    return F.filter(F.when(text.rlike("[\u2e80-\\x{10ffff}]"), _constant(words)).otherwise(_constant(latin)), lambda w: F.contains(text, w))


def strip(text: Column) -> Column:
    """Without blanks of any kind at either end (SQL's trim knows the space alone). Looks at the ends only, unlike a pattern."""
    return F.btrim(text, F.lit(BLANKS))


def text_of(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def is_missing(text: Column) -> Column:
    """Null or blank."""
    return text_of(text) == ""


def or_missing(text: Column) -> Column:
    return F.when(is_missing(text), MISSING).otherwise(strip(text))


def normalized(text: Column) -> Column:
    """One space for each run of blanks, lower case."""
    return F.lower(F.regexp_replace(text_of(text), rx(f"{BLANK}+"), " "))


def distinct_texts(values: Column) -> Column:
    """Stripped, without blanks and repetitions; the first of equals stays."""
    return F.array_distinct(F.filter(F.transform(values, text_of), lambda x: x != ""))


def clauses(text: Column, ordered: bool = True) -> Column:
    """Parts between ``；;。`` and line ends; ``ordered=False``: as a sorted set."""
    parts = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[；;。\n\r]+"), strip), lambda x: x != "")
    return parts if ordered else F.array_sort(F.array_distinct(parts))


def segments(text: Column) -> Column:
    """Distinct clauses in their order, each on one line with single spaces."""
    return F.array_distinct(F.transform(clauses(text), lambda x: F.regexp_replace(x, rx(f"{BLANK}+"), " ")))


def matched_terms(text: Column, pattern: str, flags: str = "") -> Column:
    """All matches, stripped, the first spelling of each regardless of case."""
    found = F.filter(F.transform(F.regexp_extract_all(text, F.lit(rx(pattern, flags)), 0), strip), lambda x: x != "")
    empty = F.slice(found, 1, 0)
    return F.aggregate(found, empty, lambda out, x: F.when(F.exists(out, lambda y: F.lower(y) == F.lower(x)), out).otherwise(F.concat(out, F.array(x))))


Rules = Sequence[tuple[str, str]]


def tags(text: Column, rules: Rules, seen: Column | None = None) -> Column:
    """Names of the rules whose pattern occurs, in the rules' order."""
    return F.array_compact(F.array(*[F.when(has(text, pattern, seen=seen), name) for name, pattern in rules]))


def tag_rows(rows: DataFrame, text: str, rules: DataFrame) -> DataFrame:
    """The same with rules as a table ``name, pattern``: a row for each match."""
    if rules.limit(MAX_RULES + 1).count() > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: each is held against every text")
    return rows.join(F.broadcast(rules), F.regexp_like(F.col(text), F.col("pattern")))


#: Texts normalised at a time: a batch of long ones is never in Python's memory as a whole, but for its Arrow form.
TEXTS_AT_ONCE = 64


def _normal(text: str | None) -> str:
    lines = re.sub(r"[^\S\n]+", " ", re.sub(r"\r\n?", "\n", unicodedata.normalize("NFKC", text or "")))
    return re.sub(r" ?\n[ \n]*", "\n", lines).strip().casefold()


@F.arrow_udf(StringType())
def normalize_content(texts: pa.Array) -> pa.Array:
    """Compatibility form, case-folded, lines with single spaces, no empty lines. Spark has no function for the first two."""
    parts = [pa.array([_normal(t) for t in texts.slice(a, TEXTS_AT_ONCE).to_pylist()], pa.string()) for a in range(0, len(texts), TEXTS_AT_ONCE)]
    return pa.concat_arrays([pa.array([], pa.string()), *parts])


def content_key(fields: Sequence[str] = CONTENT_FIELDS) -> Column:
    return F.struct(*[normalize_content(F.coalesce(F.col(f), F.lit(""))).alias(f) for f in fields])


def content_sha256(fields: Sequence[str] = CONTENT_FIELDS) -> Column:
    """SHA-256 of the normalised fields with a line of dashes between."""
    return F.sha2(F.concat_ws("\n---\n", *[normalize_content(F.coalesce(F.col(f), F.lit(""))) for f in fields]), 256)


def classifier_input(jobs: DataFrame) -> DataFrame:
    """Only the three fields a classifier may see, stripped."""
    return jobs.select(*[text_of(F.col(f)).alias(f) for f in CONTENT_FIELDS])


def share(count: Column, denominator: Column) -> Column:
    """Null where there is nothing to share."""
    return F.try_divide(count, denominator)
