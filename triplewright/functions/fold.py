"""Transliteration table for :func:`triplewright.functions.text.ascii_fold`.

Accented letters follow from a rule (canonical or compatibility decomposition, combining
marks dropped); only letters and signs without such a decomposition are listed.
"""

from __future__ import annotations

import unicodedata

# Latin letters and signs whose ASCII form does not follow from decomposition.
SPECIAL = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "Ss",
    "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Þ": "Th", "þ": "th",
    "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h",
    "Ŧ": "T", "ŧ": "t", "ı": "i", "ĸ": "k", "Ŋ": "NG", "ŋ": "ng", "ŉ": "'n",
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=",
    "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "«": "<<", "¬": "!",
    "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "´": "'", "µ": "u",
    "¶": "P", "·": "*", "¸": ",", "»": ">>", "¿": "?", "×": "x", "÷": "/",
    "¼": "1/4", "½": "1/2", "¾": "3/4", "™": "(tm)", "€": "EUR", "…": "...",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,",
}

# Cyrillic and Greek capitals; the small letters follow by case.
CYRILLIC = {
    "А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ё": "E", "Ж": "Zh", "З": "Z", "И": "I",
    "Й": "I", "К": "K", "Л": "L", "М": "M", "Н": "N", "О": "O", "П": "P", "Р": "R", "С": "S", "Т": "T",
    "У": "U", "Ф": "F", "Х": "Kh", "Ц": "Ts", "Ч": "Ch", "Ш": "Sh", "Щ": "Shch", "Ъ": "'", "Ы": "Y",
    "Ь": "'", "Э": "E", "Ю": "Iu", "Я": "Ia", "Є": "Ie", "І": "I", "Ї": "Yi", "Ґ": "G", "Ј": "J", "Љ": "Lj",
    "Њ": "Nj", "Ћ": "Tsh", "Ђ": "Dj", "Џ": "Dzh", "Ў": "U",
}
GREEK = {
    "Α": "A", "Β": "B", "Γ": "G", "Δ": "D", "Ε": "E", "Ζ": "Z", "Η": "E", "Θ": "Th", "Ι": "I", "Κ": "K",
    "Λ": "L", "Μ": "M", "Ν": "N", "Ξ": "X", "Ο": "O", "Π": "P", "Ρ": "R", "Σ": "S", "Τ": "T", "Υ": "U",
    "Φ": "Ph", "Χ": "Kh", "Ψ": "Ps", "Ω": "O", "Ά": "A", "Έ": "E", "Ή": "E", "Ί": "I", "Ό": "O", "Ύ": "U",
    "Ώ": "O", "Ϊ": "I", "Ϋ": "U",
}
# The final form of sigma, which has no capital of its own, and signs.
SMALL_AND_SIGNS = {"ς": "s", "‹": "<", "›": ">", "†": "+", "•": "*", "№": "No", "′": "'", "″": '"'}

# Characters with no ASCII counterpart that are removed (the soft hyphen).
DROPPED = "\u00ad"

# Latin-1, Latin Extended-A and -B, Latin Extended Additional, Latin ligatures, fullwidth ASCII.
_RANGES = ((0xA0, 0x24F), (0x1E00, 0x1EFF), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))


def _decomposed(char: str) -> str:
    parts = unicodedata.normalize("NFKD", char)
    return "".join(c for c in parts if not unicodedata.combining(c))


def _table() -> dict[str, str]:
    table = {}
    for first, last in _RANGES:
        for code in range(first, last + 1):
            char = chr(code)
            plain = _decomposed(char)
            if plain.isascii() and plain.strip():
                table[char] = plain
    for capital, text in (CYRILLIC | GREEK).items():
        table[capital], table[capital.lower()] = text, text.lower()
    table.update(SPECIAL)
    table.update(SMALL_AND_SIGNS)
    return table


_ALL = _table()
ASCII_SINGLE = {char: text for char, text in _ALL.items() if len(text) == 1}
ASCII_LONG = {char: text for char, text in _ALL.items() if len(text) > 1}
