"""Column -> Column string functions. All native expressions: null in, null out.

Replacements by regular expression run only on strings that a plain search marks as in
need of them. Such functions use their argument several times: apply them in projections of their
own (see :func:`triplewright.operators.facts.in_steps`), not nested in one another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from triplewright.functions.fold import ASCII_LONG, ASCII_SINGLE, DROPPED

# The characters that end a raw address and are stripped there
# (Unicode white space plus the four ASCII separators U+001C..U+001F).
TRAILING_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: addresses separate their lines by a backslash followed by "n".
ADDRESS_BREAK = "\\n"


def without_ends(x: Column) -> Column:
    """The text without its first and last character, e.g. an IRI without its brackets."""
    return F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0)))


def path_end(token: Column) -> Column:
    """``<http://host/1-42>`` -> ``1-42``."""
    return F.substring_index(without_ends(token), "/", -1)


def local_name(token: Column) -> Column:
    """``<http://host/path#name>`` -> ``name``: the part after the last ``/``, then after the last ``#``."""
    return F.substring_index(path_end(token), "#", -1)


def literal_value(x: Column) -> Column:
    """Lexical form of a literal: text before the first ``^^``, quotes stripped at both ends.

    A language tag stays: ``"A"@en`` -> ``A"@en``.
    """
    return F.btrim(F.substring_index(x, "^^", 1), F.lit('"'))


def iri_id(x: Column) -> Column:
    """``<https://host/1-42>`` -> ``1-42``: last path segment minus its last character."""
    tail = F.substring_index(x, "/", -1)
    return F.left(tail, F.greatest(F.length(tail) - 1, F.lit(0)))


def clean_name(x: Column) -> Column:
    """Commas become spaces, full stops vanish."""
    return F.replace(F.replace(x, F.lit(","), F.lit(" ")), F.lit("."), F.lit(""))


def collapse_ws(x: Column) -> Column:
    """Each run of (ASCII) white space becomes one space."""
    irregular = reduce(Column.__or__, [F.contains(x, F.lit(s)) for s in ("  ", "\t", "\n", "\x0b", "\f", "\r")])
    return F.when(irregular, F.regexp_replace(x, r"\s+", " ")).otherwise(x)


def strip_apostrophe(x: Column) -> Column:
    """Remove one leading and one trailing apostrophe; inner ones stay."""
    return F.when(F.contains(x, F.lit("'")), F.regexp_replace(x, "^'|'$", "")).otherwise(x)


def clean_address(x: Column) -> Column:
    """Escaped line breaks become spaces, trailing white space goes."""
    return F.rtrim(F.replace(x, F.lit(ADDRESS_BREAK), F.lit(" ")), F.lit(TRAILING_SPACE))


def address_country(x: Column) -> Column:
    """Last but one line of an address; null when the address has a single line."""
    lines = F.split(x, r"\\n", -1)
    return F.try_element_at(lines, F.lit(-2))


def url_host(x: Column, strict: bool = False) -> Column:
    """Host of a bracketed URL.

    Default: text after the last ``//`` up to the next ``/``, so a path with a double slash
    wins over the host. Slashes pair up from the left: ``///x`` is ``//`` before ``/x``.
    ``strict`` parses the URL instead and gives null for a URL without scheme or host.
    """
    url = without_ends(x)
    if strict:
        return F.try_parse_url(url, F.lit("HOST"))
    return F.substring_index(F.element_at(F.split(url, "//", -1), -1), "/", 1)


def _is_ascii(x: Column) -> Column:
    return F.octet_length(x) == F.length(x)


def exchange_letters(x: Column) -> Column:
    """Each character with a one-character ASCII form becomes that; ASCII strings skip the work."""
    exchanged = F.translate(x, "".join(ASCII_SINGLE) + DROPPED, "".join(ASCII_SINGLE.values()))
    return F.when(_is_ascii(x), x).otherwise(exchanged)


def spell_out_letters(x: Column) -> Column:
    """The rarer characters whose ASCII form is longer become that; strings without any skip the work."""
    spelled_out = x
    for char, text in ASCII_LONG.items():
        spelled_out = F.replace(spelled_out, F.lit(char), F.lit(text))
    without = F.translate(x, "".join(ASCII_LONG), "")
    return F.when(_is_ascii(x) | (F.octet_length(without) == F.octet_length(x)), x).otherwise(spelled_out)


def ascii_fold(x: Column) -> Column:
    """Transliterate Latin, Greek and Cyrillic letters and common signs to ASCII. Other scripts pass through unchanged."""
    return spell_out_letters(exchange_letters(x))


# The cleaning of a company name, step by step.
NAME_STEPS = (F.trim, clean_name, collapse_ws, strip_apostrophe, exchange_letters, spell_out_letters)


# White space in lines of triples, within ``(?U)``.
_SPACE = r"[\s\x1c-\x1f]"


def triple_pattern(base: str) -> str:
    """Regular expression of an N-Triples line with a subject under ``base``.

    Group 1 is the rest of the subject, group 2 the bracketed predicate. ``(?d)`` lets
    ``.`` stop at line feeds only, ``(?U)`` makes ``\\s`` match Unicode white space. The closing `` .``
    is looked for from the end, where it is as a rule; which one is found changes neither group.
    """
    return rf"(?dU)<\Q{base}\E(.+)>{_SPACE}(<.*?>){_SPACE}.*{_SPACE}\."


def is_triple_pattern(base: str) -> str:
    """Matches the lines that :func:`triple_pattern` matches, in fewer steps: it has no groups, so the first subject will do."""
    return rf"(?dU)<\Q{base}\E.+?>{_SPACE}<.*?>{_SPACE}.*{_SPACE}\."


def triple_head_pattern(base: str) -> str:
    """The same, with both groups of :func:`triple_pattern` and what is between them as group 1."""
    return rf"(?dU)<\Q{base}\E(.+>{_SPACE}<.*?>){_SPACE}.*{_SPACE}\."


# Parts such a head: no longer subject would have matched the line, so it ends where the last predicate begins.
HEAD_PARTS = rf"(?dU)^(.+)>{_SPACE}(<.*)"


def regex_group(line: Column, pattern: str, group: int) -> Column:
    """Capture group of the first match, empty when there is none."""
    return F.regexp_extract(line, pattern, group)


def is_plain_triple(first: Column, second: Column, rest: Column) -> Column:
    """Whether group 2 of :func:`triple_pattern` can only be the second token of a line, for any base.

    The tokens are those between single spaces, ``rest`` is all behind the second one. That is bracketed,
    with no other bracket that closes, and the rest has none either but before a final `` .``: so the
    predicate that the pattern looks for can begin and end nowhere else.
    """
    inner = F.substring(second, F.lit(1), F.greatest(F.length(second) - 1, F.lit(0)))
    bracketed = F.startswith(second, F.lit("<")) & F.endswith(second, F.lit(">")) & ~F.contains(inner, F.lit(">"))
    closed = F.contains(F.left(rest, F.greatest(F.length(rest) - len("> ."), F.lit(0))), F.lit(">"))
    return F.endswith(first, F.lit(">")) & bracketed & F.endswith(rest, F.lit(" .")) & ~closed

