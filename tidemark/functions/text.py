"""Text functions, Column -> Column. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Character classes removed from texts, and the prefixes masked or dropped.
SYMBOL_CLASS = r"\x{200d}\x{231a}\x{23cf}\x{23e9}\x{24c2}-\x{10ffff}"
WIDE_SYMBOL_CLASS = r"\x{00f0}-\x{1f251}\x{1f300}-\x{1f64f}\x{1f680}-\x{1f6ff}\x{1f900}-\x{1f999}"
PROFILE_PREFIX = "https://twitter.com/"
USER_MASK = "@user"
LINK_MASK = "http"

WORD_GAP = r"[^\p{L}\p{N}']+"
PIECE = r"[\p{L}\p{N}']+|[^\p{L}\p{N}']+"


def mask_tokens(text: Column) -> Column:
    """Mask user mentions and links; a token is what lies between single spaces.

    The patterns begin with their literal and look back for the space, so the matcher skips
    ahead quickly; a text without the literal is not matched at all.
    """
    users = F.regexp_replace(text, "@(?<![^ ]@)[^ ]+", USER_MASK)
    masked = F.when(text.contains("@"), users).otherwise(text)
    links = F.regexp_replace(masked, "http(?<![^ ]http)[^ ]*", LINK_MASK)
    return F.when(text.contains("http"), links).otherwise(masked)


def whole_word(words: Sequence[str]) -> str:
    """Pattern for any of the words, not inside a longer word."""
    return rf"(?<![\p{{L}}\p{{N}}'])(?:{'|'.join(map(_quoted, words))})(?![\p{{L}}\p{{N}}'])"


def _quoted(word: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in word)


def strip_symbols(text: Column, made_from: Column | None = None) -> Column:
    """Delete emoji and symbol characters, newlines and tabs (nothing is put in their place).

    Only texts with a character as high as the lowest symbol are searched for symbols. The test
    may look at the text this one was made from, so that ``text`` is computed in one place only.
    """
    plain = F.replace(F.replace(text, F.lit("\n"), F.lit("")), F.lit("\t"), F.lit(""))
    has_high = (text if made_from is None else made_from).rlike(r"[\x{200d}-\x{10ffff}]")
    return F.when(has_high, F.regexp_replace(plain, f"[{SYMBOL_CLASS}]+", "")).otherwise(plain)


def clean_text(text: Column) -> Column:
    """Mask first, then strip: text glued to a link by a newline goes with the link."""
    text = text.cast("string")
    return strip_symbols(mask_tokens(text), made_from=text)


def strip_wide(text: Column) -> Column:
    """The wider strip: within the basic plane only U+0000 to U+00EF stay."""
    return F.regexp_replace(text, f"[{WIDE_SYMBOL_CLASS}]+", "")


def strip_profile_prefix(text: Column) -> Column:
    return F.replace(text, F.lit(PROFILE_PREFIX), F.lit(""))


def tokens(text: Column) -> Column:
    """Lower-cased words: runs of letters, digits and apostrophes of any script."""
    return F.array_remove(F.split(F.lower(text), WORD_GAP, -1), "")


def pieces(text: Column) -> Column:
    """Words and the gaps between them in order; joined they give the lower-cased text back."""
    return F.regexp_extract_all(F.lower(text), F.lit(PIECE), F.lit(0))


def sentences(text: Column) -> Column:
    """Runs between sentence marks that hold more than blanks."""
    runs = F.regexp_extract_all(text, F.lit("[^.!?]+"), F.lit(0))
    return F.filter(runs, lambda run: run.rlike(r"[^ \n\r\t\f]"))


def starts_with_letter(word: Column) -> Column:
    """Only the first character counts: abc123 and n't stay, 's and 1st go."""
    return word.rlike("^[a-zA-Z]")


def is_ascii_word(word: Column) -> Column:
    return word.rlike("^[a-zA-Z]+$")


def ascii_letters_or_empty(word: Column) -> Column:
    return word.rlike("^[a-zA-Z]*$")
