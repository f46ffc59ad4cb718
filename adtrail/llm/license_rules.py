"""Signature rules of the license scan, in order.

A rule is ``label | priority | confidence | keyword | pattern``. A pattern is
written over words: each blank-separated element is a regular expression for
one word (``><`` inside it is a word boundary), ``x~`` an optional word, ``..n``
up to n arbitrary words. The keyword
is a piece of text that any match contains when the words are written with
blanks: documents without it skip the rule. Priority 1 is best: identifiers
and license texts, 2: notices with a version, 3: names, 4: bare mentions.
Numbers such as 2.0 are two words.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str
    base: bool = False


# fixed values: the base phrases and their labels
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Families written out once per version: label, keyword, name words, versions.
# Each gives a tag, a short name, a long name and a notice per version.
_FAMILIES = (
    ("gpl", "gpl", "gpl", "gnu general public license", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", "lgpl", "gnu (?:lesser|library) general public license", "2.0 2.1 3.0"),
    ("agpl", "agpl", "agpl", "gnu affero general public license", "1.0 3.0"),
    ("gfdl", "gfdl", "gfdl", "gnu free documentation license", "1.1 1.2 1.3"),
    ("apache", "apache", "apache", "apache software~ license", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "mozilla public license", "1.0 1.1 2.0"),
    ("epl", "epl", "epl", "eclipse public license", "1.0 2.0"),
    ("eupl", "eupl", "eupl", "european union public li[cs]en[cs]e", "1.0 1.1 1.2"),
    ("cddl", "cddl", "cddl", "common development and distribution license", "1.0 1.1"),
    ("cpl", "cpl", "cpl", "common public license", "1.0"),
    ("cecill", "cecill", "cecill", "cecill free software license", "1.0 1.1 2.0 2.1"),
    ("osl", "osl", "osl", "open software license", "1.0 1.1 2.0 2.1 3.0"),
    ("afl", "afl", "afl", "academic free license", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "artistic", "artistic license", "1.0 2.0"),
    ("bsl", "bsl", "bsl", "boost software license", "1.0"),
    ("ofl", "ofl", "ofl", "sil open font license", "1.0 1.1"),
    ("lppl", "lppl", "lppl", "latex project public license", "1.0 1.1 1.2 1.3"),
    ("php", "php", "php", "php license", "3.0 3.01"),
    ("zpl", "zpl", "zpl", "zope public license", "1.1 2.0 2.1"),
    ("odbl", "odbl", "odbl", "open database license", "1.0"),
)
_LONG_KEYWORD = {
    "gpl": "gnu", "lgpl": "gnu", "agpl": "affero", "gfdl": "free documentation", "apache": "apache", "mpl": "mozilla",
    "epl": "eclipse", "eupl": "european union", "cddl": "common development", "cpl": "common public", "cecill": "cecill",
    "osl": "open software", "afl": "academic free", "artistic": "artistic", "bsl": "boost", "ofl": "open font",
    "lppl": "latex project", "php": "php", "zpl": "zope", "odbl": "open database",
}
_CC = (("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution share(?:><)?alike"),
       ("cc-by-nc", "by nc", "attribution non(?:><)?commercial"), ("cc-by-nd", "by nd", "attribution no(?:><)?deriv(?:ative)?s?"),
       ("cc-by-nc-sa", "by nc sa", "attribution non(?:><)?commercial share(?:><)?alike"),
       ("cc-by-nc-nd", "by nc nd", "attribution non(?:><)?commercial no(?:><)?deriv(?:ative)?s?"))
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# label | priority | confidence | keyword | pattern
_SINGLE = """
mit | 1 | 1.0 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
isc | 1 | 1.0 | permission to use | permission to use copy modify and or~ distribute this software for any purpose with or without fee
bsd-3-clause | 1 | 1.0 | neither the name | neither the name of ..8 nor the names of ..4 contributors may be used to endorse
bsd-2-clause | 1 | 0.9 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-4-clause | 1 | 1.0 | advertising materials | all advertising materials mentioning features or use of this software must display
zlib | 1 | 1.0 | express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense | 1 | 1.0 | public domain | this is free and unencumbered software released into the public domain
wtfpl | 1 | 1.0 | what the | do what the f[a-z]+ you want to public license
bsl-1.0 | 1 | 1.0 | boost software | boost software license version 1 0
gpl-2.0-or-later | 1 | 1.0 | either version 2 | gnu general public license ..14 either version 2 of the license or ..4 any later version
gpl-3.0-or-later | 1 | 1.0 | either version 3 | gnu general public license ..14 either version 3 of the license or ..4 any later version
lgpl-2.1-or-later | 1 | 1.0 | either version 2.1 | gnu lesser general public license ..14 either version 2 1 of the license or ..4 any later version
lgpl-3.0-or-later | 1 | 1.0 | either version 3 | gnu lesser general public license ..14 either version 3 of the license or ..4 any later version
agpl-3.0-or-later | 1 | 1.0 | affero | gnu affero general public license ..14 either version 3 of the license or ..4 any later version
apache-2.0 | 1 | 1.0 | apache | licensed under the apache license version 2 0 the license you may not use this file except in compliance
apache-2.0 | 1 | 1.0 | apache.org | www apache org licenses license 2 0
mpl-2.0 | 1 | 1.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
cc0-1.0 | 1 | 1.0 | cc0 | spdx license identifier cc0 1 0
cc0-1.0 | 1 | 0.95 | publicdomain/zero | creativecommons org publicdomain zero 1 0
mit | 1 | 1.0 | spdx | spdx license identifier mit
isc | 1 | 1.0 | spdx | spdx license identifier isc
zlib | 1 | 1.0 | spdx | spdx license identifier zlib
unlicense | 1 | 1.0 | spdx | spdx license identifier unlicense
wtfpl | 1 | 1.0 | spdx | spdx license identifier wtfpl
bsd-2-clause | 1 | 1.0 | spdx | spdx license identifier bsd 2 clause
bsd-3-clause | 1 | 1.0 | spdx | spdx license identifier bsd 3 clause
bsd-4-clause | 1 | 1.0 | spdx | spdx license identifier bsd 4 clause
0bsd | 1 | 1.0 | 0bsd | spdx license identifier 0bsd
python-2.0 | 1 | 1.0 | spdx | spdx license identifier python 2 0
ncsa | 1 | 1.0 | spdx | spdx license identifier ncsa
postgresql | 1 | 1.0 | spdx | spdx license identifier postgresql
openssl | 1 | 1.0 | spdx | spdx license identifier openssl
upl-1.0 | 1 | 1.0 | spdx | spdx license identifier upl 1 0
ms-pl | 1 | 1.0 | spdx | spdx license identifier ms pl
ms-rl | 1 | 1.0 | spdx | spdx license identifier ms rl
gpl-with-classpath | 2 | 0.95 | classpath | classpath exception 2 0
gpl-with-linking | 2 | 0.9 | this library | (?:special|linking) exception ..6 link(?:ing)? this library
mit | 2 | 0.95 | mit license | (?:released|licensed|distributed|available|published) under ..4 (?:the|an)~ mit license
mit | 3 | 0.9 | expat | expat license
x11 | 3 | 0.9 | x11 | x11 license
mit-0 | 2 | 0.95 | mit no attribution | mit no attribution
isc | 3 | 0.9 | isc | isc license
zlib | 3 | 0.9 | zlib | zlib (?:libpng)~ license
bsd | 3 | 0.7 | bsd | bsd (?:style)~ license
bsd-2-clause | 2 | 0.9 | bsd license | (?:simplified|freebsd|2|two) (?:clause)~ bsd license
bsd-2-clause | 2 | 0.9 | bsd | bsd 2 clause
bsd-3-clause | 2 | 0.9 | bsd | (?:new|modified|revised|3|three) (?:clause)~ bsd license
bsd-3-clause | 2 | 0.9 | bsd | bsd 3 clause
bsd-4-clause | 2 | 0.9 | bsd | (?:original|old|4|four) (?:clause)~ bsd license
0bsd | 2 | 0.9 | bsd | (?:zero|0) clause bsd
unlicense | 3 | 0.9 | unlicense | the unlicense
wtfpl | 3 | 0.9 | wtfpl | wtfpl
beerware | 3 | 0.9 | beer | beer(?:><)?ware license
vim | 3 | 0.8 | vim | vim license
ruby | 3 | 0.8 | ruby | ruby license
psf-2.0 | 3 | 0.9 | python software | python software foundation license
ncsa | 3 | 0.9 | ncsa | ncsa open source license
postgresql | 3 | 0.9 | postgresql | postgresql license
openssl | 3 | 0.9 | openssl | openssl license
curl | 3 | 0.8 | curl | curl license
json | 3 | 0.9 | json | json license
json | 1 | 0.9 | good, not evil | shall be used for good not evil
ms-pl | 3 | 0.9 | microsoft public | microsoft public license
ms-rl | 3 | 0.9 | microsoft reciprocal | microsoft reciprocal license
upl-1.0 | 3 | 0.9 | universal permissive | universal permissive license
ijg | 3 | 0.8 | jpeg | independent jpeg group
libpng | 3 | 0.9 | libpng | libpng license
intel | 3 | 0.8 | intel open | intel open source license
ibm-ipl | 3 | 0.9 | ibm public | ibm public license
sissl | 3 | 0.9 | sun industry | sun industry standards source license
qpl | 3 | 0.9 | q public | q public license
w3c | 3 | 0.9 | w3c | w3c (?:software)~ (?:notice)~ (?:and)~ license
watcom | 3 | 0.9 | sybase | sybase open watcom public license
nasa | 3 | 0.9 | nasa | nasa open source agreement
elastic-2.0 | 2 | 0.9 | elastic | elastic license (?:version)~ 2 0
sspl-1.0 | 3 | 0.9 | server side | server side public license
busl-1.1 | 3 | 0.9 | business source | business source license
commons-clause | 3 | 0.9 | commons clause | commons clause
ogl-uk | 3 | 0.9 | open government | open government license
pddl-1.0 | 3 | 0.9 | domain dedication | public domain dedication and license
odc-by-1.0 | 3 | 0.9 | open data commons | open data commons attribution license
cdla | 3 | 0.9 | community data | community data license agreement
openrail | 3 | 0.9 | license | (?:open)~ rail (?:m|s|d)~ license
cc0-1.0 | 2 | 0.95 | cc0 | cc0 1 0
cc0-1.0 | 3 | 0.9 | cc0 | cc0
cc-sa | 3 | 0.7 | share | creative commons share(?:><)?alike license
cc | 4 | 0.5 | creative commons | creative commons license
cc | 4 | 0.5 | creativecommons | creativecommons org licenses
gpl | 3 | 0.8 | gnu | gnu gpl
gpl | 3 | 0.8 | gpl | gpl license
gpl | 4 | 0.5 | gpl | (?:under|the) gpl
lgpl | 4 | 0.5 | lgpl | (?:under|the) lgpl
agpl | 4 | 0.5 | agpl | (?:under|the) agpl
gpl | 2 | 0.9 | gnu | gnu public license
lgpl | 3 | 0.8 | lgpl | gnu lgpl
agpl | 3 | 0.8 | agpl | gnu agpl
mpl | 4 | 0.5 | mpl | (?:under|the) mpl
copyleft | 4 | 0.4 | copyleft | copyleft
public-domain | 2 | 0.8 | public domain | (?:released|placed|dedicated|belongs?) (?:into|in|to) the public domain
public-domain | 4 | 0.5 | public domain | public domain
proprietary | 2 | 0.8 | proprietary | proprietary and confidential
proprietary | 2 | 0.8 | prohibited | unauthorized (?:copying|reproduction|distribution|use) ..6 (?:is|are) (?:strictly)~ prohibited
proprietary | 3 | 0.6 | all rights reserved | all rights reserved
proprietary | 3 | 0.7 | end user license | end user license agreement
proprietary | 3 | 0.7 | trade secret | trade secrets? of
free-unknown | 4 | 0.4 | open source | open source license
free-unknown | 4 | 0.4 | free software | free software license
reference | 4 | 0.3 | license | see ..3 license ..3 file
reference | 4 | 0.3 | license | license md
reference | 4 | 0.3 | license | license txt
"""


def _families() -> list[Rule]:
    out = []
    for label, keyword, short, long, versions in _FAMILIES:
        for version in versions.split():
            dotted = version.replace(".", " ")
            number = dotted[:-2] + " 0~" if dotted.endswith(" 0") else dotted
            name = f"{label}-{version}"
            out += [Rule(name, 1, 1.0, "spdx", f"spdx license identifier {short} {dotted} (?:only|or)~ later~"),
                    Rule(name, 2, 0.95, _LONG_KEYWORD[label], f"{long} (?:version|v)~ {number}"),
                    Rule(name, 2, 0.95, _LONG_KEYWORD[label], f"{long} v{number}"),
                    Rule(name, 2, 0.9, keyword, f"{short} (?:version|v)~ {number}"),
                    Rule(name, 2, 0.9, keyword, f"{short}(?:><)?v{number}")]
        out.append(Rule(label, 3, 0.85, _LONG_KEYWORD[label], long))
    for label, tags, names in _CC:
        for version in _CC_VERSIONS:
            dotted = version.replace(".", " ")
            out += [Rule(f"{label}-{version}", 1, 1.0, "creativecommons", f"creativecommons org licenses {tags} {dotted}"),
                    Rule(f"{label}-{version}", 2, 0.95, "cc by", f"cc {tags} {dotted}"),
                    Rule(f"{label}-{version}", 2, 0.95, "creative commons", f"creative commons {names} ..2 {dotted}")]
        out += [Rule(label, 3, 0.85, "cc by", f"cc {tags}"),
                Rule(label, 3, 0.8, "creative commons", f"creative commons {names}")]
    return out


def all_rules() -> list[Rule]:
    single = []
    for line in _SINGLE.strip().splitlines():
        label, priority, confidence, keyword, pattern = (x.strip() for x in line.split(" | "))
        single.append(Rule(label, int(priority), float(confidence), keyword, pattern))
    base = [Rule(label, 3, 0.8, phrase, phrase, True) for phrase, label in BASE]
    return [r._replace(keyword=" ".join(re.findall(r"[0-9a-z]+", r.keyword))) for r in base + single + _families()]


def stem(rule: Rule) -> str:
    """A piece of a single word that every match of the rule contains."""
    if any(w.startswith("licen") for w in rule.pattern.split()):
        return "licen"
    return max(rule.keyword.split(), key=len)


def compile_pattern(pattern: str) -> str:
    """The regular expression over a text written as ``<word><word>...``. It
    is in the common subset of the Java and RE2 dialects."""
    out = []
    for word in pattern.split():
        if word.startswith(".."):
            out.append(f"(?:<[^>]*>){{0,{int(word[2:])}}}")
        elif word.endswith("~"):
            out.append(f"(?:<{word[:-1]}>)?")
        else:
            out.append(f"<{word}>")
    return "".join(out)
