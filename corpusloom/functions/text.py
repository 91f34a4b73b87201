"""Text as columns: normalising, tokens, fingerprints, SimHash, overlaps, spans and payloads.

Everything runs in the JVM but for Unicode compatibility composition (nfkc) and SimHash, which are Arrow UDFs.
The other functions take text that nfkc has been applied to where that matters.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from corpusloom.functions.fixed import QUESTION_LABELS, STOPWORDS

#: What Python calls white space but the blank, spelt out for Java, which looks up single Latin-1 characters in a table of bits
#: and tries ranges one after another.
_ODD = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf"[\x20{_ODD}]"
#: Runs of white space that are not one blank.
_RUN = rf"[{_ODD}]{SPACE}*|\x20{SPACE}+"
_ASCII_RUN = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f][\x20\t\n\x0b\f\r\x1c\x1d\x1e\x1f]*|\x20[\x20\t\n\x0b\f\r\x1c\x1d\x1e\x1f]+"
TOKEN = r"(?i)[a-z0-9]+(?:['’][a-z0-9]+)?"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once: higher-order functions share no repeated parts, and a part that stands in a
    lambda is computed for each element."""
    return F.get(F.transform(F.array(value), then), 0)


#: Characters that compatibility composition may change, alone or with what stands before them: all but ASCII, the Latin-1
#: letters and signs that it leaves alone, dashes and quotation marks.
UNSAFE = r"[^\x00-\x9f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff\u2013\u2014\u2018-\u201f]"


def is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def _unsafe(text: Column) -> Column:
    """Whether a text has an unsafe character. The pattern of these is slow, so it sees only what is not ASCII."""
    return ~is_ascii(text) & F.regexp_replace(text, r"[\x00-\x7f]+", "").rlike(UNSAFE)


def nfkc(text: Column) -> Column:
    """Compatibility composition; only texts with an unsafe character go to Python."""

    @F.pandas_udf(StringType())
    def compose(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))

    return F.coalesce(compose(F.when(_unsafe(text), text)), text)


def nfkc_all(texts: Column) -> Column:
    """nfkc of each text of an array."""

    @F.pandas_udf(ArrayType(StringType()))
    def compose(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else [None if t is None else unicodedata.normalize("NFKC", t) for t in v])

    return F.coalesce(compose(F.when(F.exists(texts, _unsafe), texts)), texts)


def with_nfkc(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: nfkc(F.col(c)) for c in columns})


def descending(text: Column) -> Column:
    """An array that sorts in the opposite order of a short text (an id): its code points negated, and a last one that puts a
    longer text before its own beginning."""
    codes = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: -F.ascii(c))
    return F.concat(codes, F.array(F.lit(1)))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def clean_text(text: Column) -> Column:
    """One space for each run of white space, no byte order mark, nothing at the ends; null gives an empty string."""
    bare = _without_mark(text)
    return F.trim(F.when(is_ascii(bare), F.regexp_replace(bare, _ASCII_RUN, " ")).otherwise(F.regexp_replace(bare, _RUN, " ")))


def _without_mark(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("\ufeff"), F.lit(""))


def cleaning_operations(raw: Column, composed: Column) -> Column:
    """Which of unicode_nfkc, bom_removed and whitespace_normalized changed the text, in this order."""
    raw, without_mark = F.coalesce(raw, F.lit("")), _without_mark(composed)
    names = F.array(
        F.when(F.coalesce(composed, F.lit("")) != raw, F.lit("unicode_nfkc")),
        F.when(F.contains(F.coalesce(composed, F.lit("")), F.lit("\ufeff")), F.lit("bom_removed")),
        F.when(clean_text(composed) != without_mark, F.lit("whitespace_normalized")),
    )
    return F.array_compact(names)


def tokens(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits; no white space is in one, so the text need not be cleaned for them."""
    # all words at once: a function of each element is interpreted for each
    return split_key(comparison_key(text))


def split_key(key: Column) -> Column:
    """The tokens that comparison_key() joined."""
    return F.array_remove(F.split(key, " "), "")


def comparison_key(text: Column) -> Column:
    """The tokens of a text, joined by spaces."""
    return _word_key(F.array_join(F.regexp_extract_all(_without_mark(text), F.lit(TOKEN), F.lit(0)), " "))


def fingerprint(text: Column) -> Column:
    return F.sha2(comparison_key(text), 256)


def alphabetic_ratio(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))
    return F.when(F.length(text) > 0, letters / F.length(text)).otherwise(F.lit(0.0))


def contains_any(text: Column, terms) -> Column:
    """Whether any of the terms (literals) occurs. A search for each is far quicker than an alternation at every character."""
    return let(text, lambda t: reduce(Column.__or__, [F.contains(t, F.lit(term)) for term in terms]))


def occurrences(text: Column, term: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(term), F.lit("")))) / len(term)).cast("int")


def ngrams(words: Column, n: int) -> Column:
    """Runs of n tokens joined by spaces, repeats included; none where there are fewer."""
    count = F.size(words) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>")
    )


def repeated_ngram(words: Column, n: int = 8, times: int = 3) -> Column:
    """Whether some n-gram occurs `times` times: equal n-grams stand together once sorted, so one look `times - 1` ahead tells.
    Hashes of n-grams are looked over first, and n-grams themselves only where that many hashes are equal."""

    def tell(ordered: Column) -> Column:
        last = F.size(ordered) - times
        ahead = lambda i: F.get(ordered, i) == F.get(ordered, i + times - 1)
        return F.when(last >= 0, F.exists(F.sequence(F.lit(0), last), ahead)).otherwise(F.lit(False))

    def sought(w: Column) -> Column:
        hashed = let(F.sort_array(_ngram_hashes(w, n)), tell)
        return F.when(F.size(w) < n * times, F.lit(False)).when(hashed, let(F.sort_array(ngrams(w, n)), tell)).otherwise(F.lit(False))

    return let(words, sought)


def _ngram_hashes(words: Column, n: int) -> Column:
    """A hash of each run of n words, of which there are n at least: of two shorter runs' hashes, of runs twice as long each time."""
    both = lambda by: lambda h: F.zip_with(F.slice(h, F.lit(1), F.size(h) - by), F.slice(h, F.lit(by + 1), F.size(h) - by), lambda x, y: F.xxhash64(x, y))
    hashes, width = F.transform(words, lambda w: F.xxhash64(w)), 1
    while width < n:
        by = min(width, n - width)
        hashes, width = let(hashes, both(by)), width + by
    return hashes


#: Hashes whose bits are counted at once.
SLICE = 1 << 16
_ASCII_WORD = re.compile(TOKEN, re.ASCII)


def shingles(text: str) -> list[str]:
    """Three-token shingles with repeats; the tokens themselves where there are fewer than three."""
    text = text if text.isascii() else unicodedata.normalize("NFKC", text).replace("\ufeff", "")
    words = [w.replace("’", "'").lower() for w in _ASCII_WORD.findall(text)]
    return words if len(words) < 3 else [f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:], strict=False)]


def simhash_of(features: Sequence[str]) -> int:
    """64-bit SimHash of the first halves of sha-256, signed: a bit is set where as many or more hashes have it than not; 0 of none."""
    count, sums = len(features), np.zeros(64, dtype=np.int64)
    if not count:
        return 0
    for at in range(0, count, SLICE):
        data = b"".join(hashlib.sha256(f.encode()).digest()[:8] for f in features[at : at + SLICE])
        sums += np.unpackbits(np.frombuffer(data, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums >= count).view(">i8")[0])


def simhash(text: Column) -> Column:
    """simhash_of the shingles of the composed text, 0 of null. An Arrow function: counting 64 bits a shingle by higher-order
    functions is far slower."""

    @F.pandas_udf(LongType())
    def hashed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: simhash_of(shingles(v or ""))).astype("int64")

    return hashed(text)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def content_tokens(text: Column) -> Column:
    return content_words(tokens(text))


def content_words(words: Column) -> Column:
    """The distinct tokens of three letters or more that are no stop words."""
    return F.filter(F.array_except(words, F.array(*map(F.lit, STOPWORDS))), lambda t: F.length(t) > 2)


def overlap(answer_tokens: Column, source_tokens: Column) -> Column:
    """Share of the first set that is in the second; 0 of an empty set."""
    share = lambda a: F.when(F.size(a) > 0, F.size(F.array_intersect(a, source_tokens)) / F.size(a)).otherwise(F.lit(0.0))
    return let(answer_tokens, share)


def common_prefix(left: Column, right: Column) -> Column:
    """Number of leading tokens that two arrays share."""

    def count(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        size = F.least(F.size(a), F.size(b))
        differs = F.array_position(F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(1), size), lambda x, y: x == y), F.lit(False))
        return let(differs, lambda d: F.when(d > 0, d - 1).otherwise(size.cast("bigint")))

    return let(F.struct(left.alias("a"), right.alias("b")), count)


def common_prefix_ratio(left: Column, right: Column) -> Column:
    """Shared leading tokens by the length of the shorter array."""
    size = F.least(F.size(left), F.size(right))
    return F.when(size > 0, common_prefix(left, right) / size).otherwise(F.lit(0.0))


def left_coverage_ratio(left: Column, right: Column) -> Column:
    """Shared leading tokens by the length of the left array."""
    return F.when((F.size(left) > 0) & (F.size(right) > 0), common_prefix(left, right) / F.size(left)).otherwise(F.lit(0.0))


def prefix_signature(words: Column, count: int = 12) -> Column:
    return F.array_join(F.slice(words, 1, count), " ")


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def source_words(text: Column) -> Column:
    """The words of a text as found, the gaps around them, and their keys with a space before, between and after."""
    found = F.struct(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)).alias("words"), F.split(text, TOKEN, -1).alias("gaps"))
    padded = lambda f: F.struct(f["words"].alias("words"), f["gaps"].alias("gaps"), _padded(f["words"]).alias("keys"))
    return let(found, padded)


def _padded(words: Column) -> Column:
    return F.concat(F.lit(" "), _word_key(F.array_join(words, " ")), F.lit(" "))


def _word_key(word: Column) -> Column:
    return F.lower(F.replace(word, F.lit("’"), F.lit("'")))


def span_in(quote: Column, source: Column) -> Column:
    """(start, end) in code points of the first run of a source's words that equals the quote's words, whatever stands between
    them; null without any. source: source_words()'s. The number of spaces before the place of the quote's keys in the source's
    keys is the number of words before it; lengths of words and gaps up to there are the offset."""

    def at_word(x: Column) -> Column:
        length = lambda parts: F.aggregate(parts, F.lit(0), lambda n, part: n + F.length(part))
        last = x["first"] + x["count"] - 1
        upto = lambda i: length(F.slice(source["gaps"], F.lit(1), i + 1)) + length(F.slice(source["words"], F.lit(1), i))
        return F.struct(upto(x["first"]).alias("start"), (upto(last) + F.length(F.get(source["words"], last))).alias("end"))

    def sought(words: Column) -> Column:
        before = F.substring(source["keys"], F.lit(1), F.position(_padded(words), source["keys"]))
        spaces = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
        return F.when((F.size(words) > 0) & (F.length(before) > 0), let(F.struct((spaces - 1).alias("first"), F.size(words).alias("count")), at_word))

    return let(F.regexp_extract_all(quote, F.lit(TOKEN), F.lit(0)), sought)


def evidence_span(quote: Column, source: Column) -> Column:
    return let(source_words(F.coalesce(source, F.lit(""))), lambda s: span_in(F.coalesce(quote, F.lit("")), s))


def json_payload(text: Column) -> Column:
    """The text from its first opening to its last closing brace, code fences off; null without them."""
    bare = F.regexp_replace(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r"^```(?:json)?\s*", ""), r"\s*```$", "")
    found = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def tagged_field(text: Column, name: str) -> Column:
    """What stands between <name> and </name>, stripped; null if there is none."""
    found = F.regexp_extract(text, f"(?s)<{name}>(.*?)</{name}>", 1)
    return F.when(text.rlike(f"(?s)<{name}>.*?</{name}>"), strip(found))


def question_cleaned(text: Column, prefixes=QUESTION_LABELS) -> Column:
    """Quotes and a leading label off; null where it is then too short or asks nothing."""
    bare = F.regexp_replace(strip(text), "^[\"'“”]+|[\"'“”]+$", "")
    bare = strip(F.regexp_replace(bare, "(?i)^(?:" + "|".join(map(re.escape, prefixes)) + ")", ""))
    return F.when((F.length(bare) >= 8) & F.contains(bare, F.lit("?")), bare)


def evaluation_tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9']+"), F.lit(0)))


def chat_text(messages: Column, end: str = "<end>") -> Column:
    """Model text of an array of (role, content)."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<"), m["role"], F.lit(">\n"), m["content"], F.lit(end))), "\n")
