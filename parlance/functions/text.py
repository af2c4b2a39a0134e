"""Text normalisation, script tests, parsing of model replies, prompts. All but ``nfc`` are built-in functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Number words in the order they are replaced, and digits of the script.
NUMBER_WORDS = (("একশ", "100"), ("একশো", "100"), ("এক হাজার", "1000"), ("একহাজার", "1000"))
DIGITS = "০১২৩৪৫৬৭৮৯"
# Punctuation of the two normalisations, the second wider; both hold the zero-width joiners.
DELETED = "[।,.!?‌‍]"
SPACED = "[।,.!?;:\"'()\\[\\]{}—–\\-‌‍]"
SPEAKER_MARK = "(প্র|উ)\\s*[:ঃ]\\s*"
BENGALI = "[\\x{0980}-\\x{09FF}]"
#: White space as Unicode has it; Java's \s is ASCII only.
SPACE = "[\\s\\x{85}\\p{Z}]"


@F.arrow_udf(T.StringType())
def _nfc(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in text.to_pylist()], pa.string())


def nfc(text: Column) -> Column:
    """Canonical composition. No built-in has it; texts of one byte a character don't reach Python's normaliser."""
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(_nfc(text))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def base_norm(text: Column, punctuation: str = "delete", compose: bool = True) -> Column:
    """NFC and trimming, then punctuation deleted (no trim after) or turned into spaces (trimmed after)."""
    t = strip(nfc(text) if compose else text)
    if punctuation == "delete":
        return squeeze(F.regexp_replace(t, DELETED, ""))
    return strip(squeeze(F.regexp_replace(t, SPACED, " ")))


def num_norm(text: Column) -> Column:
    """Number words one after the other, then digits, then white space."""
    for word, digits in NUMBER_WORDS:
        text = F.replace(text, F.lit(word), F.lit(digits))
    return strip(squeeze(F.translate(text, DIGITS, "0123456789")))


def strip_speakers(text: Column) -> Column:
    return F.regexp_replace(text, SPEAKER_MARK, " ")


def script_ratio(text: Column, script: str = BENGALI) -> Column:
    """Characters of a script for each letter; signs count above the line only, so it can exceed one."""
    letters = F.regexp_count(text, F.lit("\\p{L}"))
    return F.when(letters > 0, F.regexp_count(text, F.lit(script)) / letters)


def is_script(text: Column, least: float = 0.5, script: str = BENGALI) -> Column:
    return F.coalesce(script_ratio(text, script) >= least, F.lit(False))


def first_line_of_script(text: Column, script: str = BENGALI) -> Column:
    """The first line with a character of the script, trimmed; the whole text if there is none."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x.rlike(script))
    return F.coalesce(F.try_element_at(lines, F.lit(1)), text)


def tokens(text: Column) -> Column:
    """White-space separated words; none for a blank text."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def sentences(text: Column, mark: str = "।") -> Column:
    """Trimmed sentences that aren't blank; the whole text if none is left."""
    parts = F.filter(F.transform(F.split(text, mark), strip), lambda s: s != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(text))


def alignment_text(text: Column, dictionary: str) -> Column:
    """Lower case, white space as bars, only the dictionary's characters, bars single and not at the ends."""
    allowed = "".join("\\" + c if c in "\\]^-[&|" else c for c in dictionary)
    t = F.regexp_replace(F.lower(text), f"{SPACE}+", "|")
    t = F.regexp_replace(t, f"[^{allowed}|]", "")
    return F.regexp_replace(F.regexp_replace(t, "\\|+", "|"), "^\\||\\|$", "")


def parse_numbered(reply: Column) -> Column:
    """A map from number to text of the lines ``n. text``; blank texts are left out and the last of a number wins."""
    line = "^(\\d{1,9})[.):\\s]+\\s*(.*)"
    lines = F.transform(F.split(reply, "\n"), strip)
    pair = lambda x, i: F.struct(F.regexp_extract(x, line, 1).try_cast("int").alias("n"), i.alias("i"), strip(F.regexp_extract(x, line, 2)).alias("t"))
    named = F.array_sort(F.filter(F.transform(lines, pair), lambda p: p["n"].isNotNull() & (p["t"] != "")))
    # in order of number and place, a number's last is followed by another number: one pass over neighbours
    follows = _once(named, lambda a: F.zip_with(a, F.slice(a, 2, F.size(a)), lambda p, q: F.when(p["n"].isNotNull() & ~p["n"].eqNullSafe(q["n"]), F.struct(p["i"].alias("i"), p["n"].alias("n"), p["t"].alias("t")))))
    return F.map_from_entries(F.transform(F.array_sort(F.array_compact(follows)), lambda p: F.struct(p["n"].alias("n"), p["t"].alias("t"))))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def parse_choice(reply: Column, n: Column) -> Column:
    """The zero-based position that the first whole number of a reply names, or null."""
    k = F.regexp_extract(reply, "(?<![\\p{L}\\p{N}_])(\\d+)(?![\\p{L}\\p{N}_])", 1).try_cast("long")
    return F.when((k >= 1) & (k <= n), (k - 1).cast("int"))


def numbered_block(items: Column, bilingual: bool) -> Column:
    """Prompt lines of an array of structs (speaker_id, raw_text, translation), numbered from one."""
    flat = lambda c: F.replace(c, F.lit("\n"), F.lit(" "))

    def line(x: Column, i: Column) -> Column:
        head = F.concat((i + 1).cast("string"), F.lit(". ["), x["speaker_id"], F.lit("] "))
        if bilingual:
            return F.concat(head, F.lit("Source: "), flat(x["raw_text"]), F.lit("\n   Translation: "), flat(x["translation"]))
        return F.concat(head, flat(x["raw_text"]))

    return F.array_join(F.transform(items, line), "\n")


def candidate_block(candidates: Column) -> Column:
    """Prompt lines of an array of structs (dist, word), ranked from one, distances with two decimals."""
    return F.array_join(F.transform(candidates, lambda c, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), c["word"], F.lit("  (DTW "), F.format_string("%.2f", c["dist"]), F.lit(")"))), "\n")


def fill(template: str, **values: Column) -> Column:
    """A prompt template with ``{name}`` places filled by columns."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def chat_messages(system: Column, user: Column, native: Column, english: Column | None = None) -> Column:
    """Chat records of three roles; the answer's second line is left out where there is no English."""
    answer = F.concat(F.lit("BN: "), native)
    if english is not None:
        answer = F.concat(answer, F.when(F.coalesce(english, F.lit("")) != "", F.concat(F.lit("\nEN: "), english)).otherwise(""))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(message("system", system), message("user", user), message("assistant", answer))


def guarded(reply: Column, source: Column) -> Column:
    """A model's reply, or its source where the reply is empty or far longer, or the source is blank."""
    r = F.coalesce(strip(reply), F.lit(""))
    bad = (r == "") | (F.length(r) > F.greatest(F.lit(40), F.length(source) * 4))
    return F.when((strip(source) == "") | bad, source).otherwise(r)


def display_label(kind: Column) -> Column:
    return F.replace(F.upper(kind), F.lit("_"), F.lit("-"))


def unknown(key: Column) -> Column:
    return F.concat(F.lit("Unknown ("), key, F.lit(")"))
