"""Text expressions: cleaning, tokens, personal data, extraction.

Fixed values: the patterns below. They use only constructs that Java and RE2 read alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}",
    "card": r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# card before phone, so that a card number is not read as a phone number
PII_ORDER = ("email", "card", "ssn", "ip", "phone")
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
ANY_DATE = r"[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}"
HEADING = r"(?:^|\n)#[ \t]+([^\n]+)"
AMOUNT = r"[$€£][0-9]+(?:[.,][0-9]+)*"
TRACKING = r"[?&](?:utm_[a-z]+|ref|fbclid|gclid)=[^&#\s]*"
WORD = r"[^\p{L}\p{N}]+"


def count_matches(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def redact(text: Column) -> Column:
    """Every personal-data match replaced by its type in brackets."""
    for kind in PII_ORDER:
        text = F.regexp_replace(text, PII[kind], f"[{kind.upper()}]")
    return text


def tokens(text: Column) -> Column:
    """Lower-case words; everything but letters and digits separates."""
    return F.filter(F.split(F.lower(text), WORD), lambda w: w != "")


def clean(text: Column) -> Column:
    """Without page marks, control characters, tracking parameters, empty table rows and blank runs."""
    for pattern, into in (
        (r"(?i)page [0-9]+ of [0-9]+", ""),
        (r"- [0-9]+ -", ""),
        (r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""),
        (TRACKING, ""),
        (r"(?m)^[ |\t-]*\|[ |\t-]*$", ""),
        (r"[ \t]+", " "),
        (r"\n{3,}", "\n\n"),
    ):
        text = F.regexp_replace(text, pattern, into)
    return F.trim(text)


def title(text: Column) -> Column:
    """The first heading, or the first line of a text without headings."""
    heading = F.trim(F.regexp_extract(text, HEADING, 1))
    return F.when(heading != "", heading).otherwise(F.split_part(text, F.lit("\n"), F.lit(1)))


def plain(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags removed, five entities resolved."""
    for pattern, into in (
        (r"(?is)<script.*?</script>", " "),
        (r"(?is)<style.*?</style>", " "),
        (r"(?s)<!--.*?-->", " "),
        (r"(?s)<[^>]+>", " "),
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
        (r"\s+", " "),
    ):
        html = F.regexp_replace(html, pattern, into)
    return F.trim(html)


def each_token(text: Column) -> Column:
    """Generator of the tokens; texts without any give one NULL, to be filtered by the caller.

    The outer form keeps Spark from testing (and so computing) the token list twice.
    """
    return F.explode_outer(tokens(text))
