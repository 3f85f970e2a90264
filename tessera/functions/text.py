"""Text expressions. All of them stay inside generated code; none is a Python function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The usual English stop words of mail cleaning.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between "
    "into through during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't "
    "wouldn wouldn't"
).split()

# The ASCII punctuation marks, as character ranges.
PUNCTUATION = r"[!-/:-@\[-`{-~]"
# White space of Unicode texts, as ranges.
SPACE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = f"https?://[^{SPACE}]+"
# Two or more capitalised words in a row.
NAME_RUN = r"[A-Z][A-Za-z&]+(?: [A-Z][A-Za-z&]+)+"


def cleaned_comment(text: Column) -> Column:
    """Lower case, no http links, only a-z and white space; line ends become spaces and runs of spaces one space.

    Other white space stays as it is, except at the ends.
    """
    out = F.regexp_replace(F.lower(text), URL, "")
    out = F.regexp_replace(out, "\n", " ")
    out = F.regexp_replace(out, f"[^a-z{SPACE}]", "")
    return F.regexp_replace(F.regexp_replace(out, " +", " "), f"^[{SPACE}]+|[{SPACE}]+$", "")


def mail_tokens(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Alphabetic words of two or more letters that are not stop words."""
    words = F.split(F.regexp_replace(F.lower(text), PUNCTUATION, " "), r"\s+")
    return F.filter(words, lambda w: w.rlike(r"^\p{L}{2,}$") & ~w.isin(*stop_words))


def cleaned_mail(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    return F.array_join(mail_tokens(text, stop_words), " ")


def words(text: Column) -> Column:
    """Non-empty pieces between white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def comment_words(text: Column) -> Column:
    """``words`` of the ``cleaned_comment``, without the steps that only change the white space between them."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), URL, ""), f"[^a-z{SPACE}]+", "")
    return F.array_remove(F.split(out, f"[{SPACE}]+"), "")


def name_mentions(text: Column, pattern: str = NAME_RUN) -> Column:
    """Rule form of organisation mentions: runs of capitalised words."""
    return F.regexp_extract_all(text, F.lit(pattern), 0)
