"""Ordered signature rules for licences, over lower-cased words separated by single spaces.

Families times sentence forms give most rules; whole-sentence signatures are listed one by
one. A rule's keyword is a plain string that each of its matches contains.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LicenseRule:
    label: str
    # A rule suppresses what lies within its match, up to its own priority.
    priority: int
    confidence: float
    keyword: str
    regex: str


# Label, keyword, name as a regex over words, versions.
FAMILIES = [
    ("gpl", "gnu general public license", r"gnu general public license", ("1", "2", "3")),
    ("gpl", "gnu gpl", r"gnu gpl", ("2", "3")),
    ("lgpl", "lesser general public license", r"(?:gnu )?lesser general public license", ("2 1", "3")),
    ("lgpl", "library general public license", r"(?:gnu )?library general public license", ("2",)),
    ("agpl", "affero general public license", r"(?:gnu )?affero general public license", ("1", "3")),
    ("gfdl", "free documentation license", r"(?:gnu )?free documentation license", ("1 1", "1 2", "1 3")),
    ("apache", "apache license", r"apache license", ("1 0", "1 1", "2 0")),
    ("apache", "apache software license", r"apache software license", ("1 1", "2 0")),
    ("mit", "mit license", r"mit license", ()),
    ("mit", "expat license", r"expat license", ()),
    ("mit", "x11 license", r"x11 license", ()),
    ("bsd", "bsd license", r"bsd license", ()),
    ("bsd-2-clause", "2 clause bsd", r"2 clause bsd(?: license)?", ()),
    ("bsd-3-clause", "3 clause bsd", r"3 clause bsd(?: license)?", ()),
    ("isc", "isc license", r"isc license", ()),
    ("mpl", "mozilla public license", r"mozilla public license", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", r"eclipse public license", ("1 0", "2 0")),
    ("eupl", "european union public licen", r"european union public licen[cs]e", ("1 1", "1 2")),
    ("cddl", "common development and distribution license", r"common development and distribution license", ("1 0", "1 1")),
    ("cpl", "common public license", r"common public license", ("1 0",)),
    ("artistic", "artistic license", r"artistic license", ("1 0", "2 0")),
    ("zlib", "zlib license", r"zlib license", ()),
    ("boost", "boost software license", r"boost software license", ("1 0",)),
    ("ms-pl", "microsoft public license", r"microsoft public license", ()),
    ("osl", "open software license", r"open software license", ("2 1", "3 0")),
    ("afl", "academic free license", r"academic free license", ("2 1", "3 0")),
    ("python", "python software foundation license", r"python software foundation license", ("2",)),
    ("php", "php license", r"php license", ("3 0", "3 01")),
    ("ruby", "ruby license", r"ruby license", ()),
    ("unlicense", "unlicense", r"unlicense", ()),
    ("wtfpl", "do what the fuck you want to public license", r"do what the fuck you want to public license", ("2",)),
    ("ofl", "open font license", r"(?:sil )?open font license", ("1 0", "1 1")),
    ("odbl", "open database license", r"open database license", ("1 0",)),
    ("odc-by", "open data commons attribution license", r"open data commons attribution license", ("1 0",)),
    ("ogl", "open government licen", r"open government licen[cs]e", ("1 0", "2 0", "3 0")),
    ("cc0", "cc0", r"(?:creative commons )?cc0", ("1 0",)),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd", ("3 0", "4 0")),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa", ("3 0", "4 0")),
    ("cc-by-nc", "cc by nc", r"cc by nc", ("3 0", "4 0")),
    ("cc-by-nd", "cc by nd", r"cc by nd", ("3 0", "4 0")),
    ("cc-by-sa", "cc by sa", r"cc by sa", ("3 0", "4 0")),
    ("cc-by", "cc by", r"cc by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "creative commons attribution", r"creative commons attribution share ?alike", ("3 0", "4 0")),
    ("cc-by-nc", "creative commons attribution", r"creative commons attribution non ?commercial", ("3 0", "4 0")),
    ("cc-by", "creative commons attribution", r"creative commons attribution", ("3 0", "4 0")),
]

# Label, regex of an SPDX identifier over words.
IDENTIFIERS = [
    ("gpl", r"gpl [123](?: 0)?(?: (?:only|or later))?"),
    ("lgpl", r"lgpl [23](?: [01])?(?: (?:only|or later))?"),
    ("agpl", r"agpl [13](?: 0)?(?: (?:only|or later))?"),
    ("apache", r"apache [12] [01]"),
    ("mit", r"mit"),
    ("bsd-2-clause", r"bsd 2 clause"),
    ("bsd-3-clause", r"bsd 3 clause"),
    ("isc", r"isc"),
    ("mpl", r"mpl [12] [01]"),
    ("epl", r"epl [12] 0"),
    ("cc0", r"cc0 1 0"),
    ("cc-by", r"cc by [234] [05]"),
    ("cc-by-sa", r"cc by sa [34] 0"),
    ("cc-by-nc", r"cc by nc [34] 0"),
    ("unlicense", r"unlicense"),
    ("zlib", r"zlib"),
    ("boost", r"bsl 1 0"),
]

# Label, keyword, regex of a sentence found in the licence itself.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright notice and this permission notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "nor the names of its contributors", r"neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors"),
    ("isc", "permission to use copy modify and", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("gpl", "under the terms of the gnu general public license", r"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "without even the implied warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("apache", "you may not use this file except in compliance", r"you may not use this file except in compliance with the license"),
    ("mpl", "subject to the terms of the mozilla public license", r"subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "without any express or implied warranty", r"this software is provided as is without any express or implied warranty"),
    ("unlicense", "released into the public domain", r"free and unencumbered software released into the public domain"),
    ("cc0", "waive all copyright", r"waive all copyright and related or neighboring rights"),
    ("boost", "permission is hereby granted free of charge to any person or organization", r"permission is hereby granted free of charge to any person or organization"),
    ("public-domain", "public domain", r"(?:is|are|dedicated to|released into|in) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
]

_GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|made available) under (?:the )?(?:terms of )?(?:the )?"
_COPY = r"(?:copy of|text of|terms of|see|conditions of|obtain) the "
_VERSION = r"(?: as published by the free software foundation)?(?: international)?(?: license)?(?: either)?(?: version| v)? "


def _rules() -> list[LicenseRule]:
    rules = [LicenseRule(label, 3, 1.0, f"spdx license identifier {regex[:2]}", f"spdx license identifier {regex}") for label, regex in IDENTIFIERS]
    rules += [LicenseRule(label, 3, 0.95, keyword, regex) for label, keyword, regex in SENTENCES[:13]]
    rules += [LicenseRule(label, 1, 0.4, keyword, regex) for label, keyword, regex in SENTENCES[13:]]
    for label, keyword, name, versions in FAMILIES:
        for version in versions:
            rules.append(LicenseRule(f"{label}-{version.replace(' ', '.')}", 2, 0.95, keyword, f"{name}{_VERSION}{version}"))
        rules.append(LicenseRule(label, 2, 0.9, keyword, f"{_GRANT}{name}"))
        rules.append(LicenseRule(label, 2, 0.85, keyword, f"{_COPY}{name}"))
        rules.append(LicenseRule(label, 1, 0.7, keyword, name))
    return rules


# In order: earlier rules win between equal matches of equal priority.
RULES = _rules()
# Each keyword contains one of these; a text without any of them needs no rule.
GATE = (
    "licen",
    "gnu gpl",
    "clause bsd",
    "cc0",
    "cc by",
    "creative commons",
    "permission",
    "public domain",
    "all rights reserved",
    "copyright",
    "redistribution and use",
    "nor the names",
    "warranty",
    "in compliance",
)
# Each of the above contains one of these, without white space, so they are searched in raw texts.
RAW_GATE = ("licen", "gnu", "bsd", "cc", "creative", "permission", "public", "right", "redistribution", "names", "warranty", "compliance")
