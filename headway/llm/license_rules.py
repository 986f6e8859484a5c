"""Signatures of licences over normalized words (lower case, single spaces).

LICENCES: label; words that tell the label; names as a pattern. Each name makes a rule for a grant ("licensed under
..."), and one for the name alone. TEXTS: sentences of licence texts and headers. TAGS are the words of machine-readable
identifiers.

A rule is tried only where its keyword occurs. keywords() takes for that what no match of the pattern is without: the words
given here where that holds for them, and otherwise words of the pattern.
"""

from __future__ import annotations

from re import _constants as kinds
from re import _parser as parser
from typing import NamedTuple

LICENCES = (
    ("mit", "mit licen|mit x11|mit expat", r"mit(?: x11| expat)? licen[cs]e"),
    ("mit-0", "mit no attribution|mit 0", r"mit no attribution(?: licen[cs]e)?|mit 0 licen[cs]e"),
    ("x11", "x11", r"x11 licen[cs]e"),
    ("expat", "expat", r"expat licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("0bsd", "0bsd", r"0bsd licen[cs]e|zero clause bsd(?: licen[cs]e)?|bsd zero clause licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("apache-1.0", "apache", r"apache(?: software)? licen[cs]e(?: version| v)? 1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? licen[cs]e(?: version| v)? 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2 0 licen[cs]e"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("gpl-1.0", "gnu", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?1(?: 0)?|gnu gpl v?1"),
    ("gpl-2.0", "gnu", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?2(?: 0)?|gnu gpl(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "gnu", r"(?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v) ?3(?: 0)?|gnu gpl(?: version| v)? ?3(?: 0)?"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e"),
    ("lgpl-2.0", "lgpl|lesser|library", r"gnu library general public licen[cs]e(?: version| v)? ?2(?: 0)?|lgpl(?: version| v)? ?2 0"),
    ("lgpl-2.1", "lgpl|lesser", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: version| v) ?2 1|lgpl(?: version| v)? ?2 1"),
    ("lgpl-3.0", "lgpl|lesser", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: version| v) ?3(?: 0)?|lgpl(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "lgpl|lesser", r"(?:gnu )?lesser general public licen[cs]e|gnu lgpl"),
    ("agpl-1.0", "affero", r"affero general public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("agpl-3.0", "affero|agpl", r"(?:gnu )?affero general public licen[cs]e(?: agpl)?(?: version| v) ?3(?: 0)?|agpl(?: version| v)? ?3(?: 0)?"),
    ("agpl", "affero|agpl", r"(?:gnu )?affero general public licen[cs]e|gnu agpl"),
    ("gfdl-1.1", "free documentation", r"gnu free documentation licen[cs]e(?: version| v) ?1 1"),
    ("gfdl-1.2", "free documentation", r"gnu free documentation licen[cs]e(?: version| v) ?1 2"),
    ("gfdl-1.3", "free documentation", r"gnu free documentation licen[cs]e(?: version| v) ?1 3"),
    ("gfdl", "free documentation", r"gnu free documentation licen[cs]e"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[cs]e(?: mpl)?(?: version| v) ?1 0"),
    ("mpl-1.1", "mozilla|mpl", r"mozilla public licen[cs]e(?: mpl)?(?: version| v) ?1 1|mpl(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla|mpl", r"mozilla public licen[cs]e(?: mpl)?(?: version| v) ?2(?: 0)?|mpl(?: version| v)? ?2 0"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("npl", "netscape", r"netscape public licen[cs]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)?(?: epl)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)?(?: epl)? ?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[cs]e"),
    ("cddl-1.0", "cddl|common development", r"common development and distribution licen[cs]e(?: cddl)?(?: version| v)? ?1 0|cddl(?: version| v)? ?1 0"),
    ("cddl-1.1", "cddl|common development", r"common development and distribution licen[cs]e(?: cddl)?(?: version| v)? ?1 1|cddl(?: version| v)? ?1 1"),
    ("cddl", "cddl|common development", r"common development and distribution licen[cs]e|cddl licen[cs]e"),
    ("cpl-1.0", "common public", r"common public licen[cs]e"),
    ("ipl-1.0", "ibm", r"ibm public licen[cs]e"),
    ("spl-1.0", "sun", r"sun public licen[cs]e"),
    ("sissl", "sun", r"sun industry standards source licen[cs]e"),
    ("apsl-2.0", "apple", r"apple public source licen[cs]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("osl-3.0", "open software", r"open software licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("osl", "open software", r"open software licen[cs]e"),
    ("afl-2.1", "academic free", r"academic free licen[cs]e(?: version| v)? ?2 1"),
    ("afl-3.0", "academic free", r"academic free licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("afl", "academic free", r"academic free licen[cs]e"),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e"),
    ("busl-1.1", "business source", r"business source licen[cs]e"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e"),
    ("sspl-1.0", "server side public", r"server side public licen[cs]e"),
    ("commons-clause", "commons clause", r"commons clause(?: licen[cs]e)?"),
    ("polyform-noncommercial", "polyform", r"polyform noncommercial licen[cs]e"),
    ("polyform-small-business", "polyform", r"polyform small business licen[cs]e"),
    ("psf-2.0", "python", r"(?:psf|python software foundation|python) licen[cs]e"),
    ("ruby", "ruby", r"ruby licen[cs]e"),
    ("php-3.01", "php", r"php licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("ssleay", "ssleay", r"ssleay licen[cs]e"),
    ("curl", "curl", r"curl licen[cs]e"),
    ("ijg", "jpeg", r"independent jpeg group licen[cs]e"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e"),
    ("w3c", "w3c", r"w3c software(?: and document)?(?: notice and)? licen[cs]e"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "what the fuck|wtfpl", r"do what the fuck you want to public licen[cs]e|wtfpl licen[cs]e"),
    ("beerware", "beerware|beer ware", r"beer ?ware licen[cs]e"),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[cs]e"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("eupl-1.1", "european union public", r"european union public licen[cs]e(?: eupl)?(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union public", r"european union public licen[cs]e(?: eupl)?(?: version| v)? ?1 2"),
    ("eupl", "european union public", r"european union public licen[cs]e"),
    ("cecill", "cecill", r"cecill(?: [bc])?(?: free software)? licen[cs]e"),
    ("mulan-psl-2.0", "mulan", r"mulan (?:psl|permissive software licen[cs]e)"),
    ("ogl-uk-3.0", "open government", r"open government licen[cs]e"),
    ("odbl-1.0", "odbl|open database", r"open (?:data commons open )?database licen[cs]e|odbl licen[cs]e"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e"),
    ("cc0-1.0", "cc0|creative commons", r"cc0(?: 1 0)?(?: universal)?(?: licen[cs]e)?|creative commons zero"),
    ("cc-by-1.0", "cc by|attribution 1", r"cc by 1 0|creative commons attribution 1 0(?: licen[cs]e)?"),
    ("cc-by-2.0", "cc by|attribution 2", r"cc by 2 0|creative commons attribution 2 0(?: licen[cs]e)?"),
    ("cc-by-2.5", "cc by|attribution 2", r"cc by 2 5|creative commons attribution 2 5(?: licen[cs]e)?"),
    ("cc-by-3.0", "cc by|attribution 3", r"cc by 3 0|creative commons attribution 3 0(?: licen[cs]e)?"),
    ("cc-by-4.0", "cc by|attribution 4", r"cc by 4 0|creative commons attribution 4 0(?: licen[cs]e)?"),
    ("cc-by", "cc by|creative commons", r"cc by|creative commons attribution(?: licen[cs]e)?"),
    ("cc-by-sa-2.0", "sa 2 0|alike 2", r"cc by sa 2 0|(?:creative commons )?attribution share ?alike 2 0"),
    ("cc-by-sa-2.5", "sa 2 5|alike 2", r"cc by sa 2 5|(?:creative commons )?attribution share ?alike 2 5"),
    ("cc-by-sa-3.0", "sa 3 0|alike 3", r"cc by sa 3 0|(?:creative commons )?attribution share ?alike 3 0"),
    ("cc-by-sa-4.0", "sa 4 0|alike 4", r"cc by sa 4 0|(?:creative commons )?attribution share ?alike 4 0"),
    ("cc-by-sa", "by sa|alike", r"cc by sa|(?:creative commons )attribution share ?alike"),
    ("cc-by-nc-2.0", "nc 2 0|commercial 2", r"cc by nc 2 0|(?:creative commons )?attribution non ?commercial 2 0"),
    ("cc-by-nc-3.0", "nc 3 0|commercial 3", r"cc by nc 3 0|(?:creative commons )?attribution non ?commercial 3 0"),
    ("cc-by-nc-4.0", "nc 4 0|commercial 4", r"cc by nc 4 0|(?:creative commons )?attribution non ?commercial 4 0"),
    ("cc-by-nc", "by nc|commercial", r"cc by nc|(?:creative commons )attribution non ?commercial"),
    ("cc-by-nc-sa-3.0", "nc sa 3|alike 3", r"cc by nc sa 3 0|(?:creative commons )?attribution non ?commercial share ?alike 3 0"),
    ("cc-by-nc-sa-4.0", "nc sa 4|alike 4", r"cc by nc sa 4 0|(?:creative commons )?attribution non ?commercial share ?alike 4 0"),
    ("cc-by-nc-sa", "nc sa|commercial share", r"cc by nc sa|(?:creative commons )attribution non ?commercial share ?alike"),
    ("cc-by-nd-4.0", "nd 4|derivatives 4", r"cc by nd 4 0|(?:creative commons )?attribution no ?derivatives 4 0"),
    ("cc-by-nd", "by nd|derivatives|derivs", r"cc by nd|(?:creative commons )attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc-nd-4.0", "nc nd 4|derivatives 4", r"cc by nc nd 4 0|(?:creative commons )?attribution non ?commercial no ?derivatives 4 0"),
    ("cc-by-nc-nd", "nc nd|derivatives|derivs", r"cc by nc nd|(?:creative commons )attribution non ?commercial no ?deriv(?:ative)?s"),
    ("creative-commons", "creative commons", r"creative commons licen[cs]e"),
    ("openrail", "rail", r"(?:bigscience |creativeml )?open ?rail(?: m)?(?: \+\+)?(?: licen[cs]e)?"),
    ("proprietary", "proprietary", r"proprietary licen[cs]e"),
)

#: label, priority, keyword, pattern
TEXTS = (
    ("mit", 1, "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 2, "copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 2, "merchantability", r"the software is provided as is without warranty of any kind express or implied"),
    ("isc", 1, "hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", 2, "hereby granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software"),
    ("bsd", 2, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 2, "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", 2, "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 1, "endorse", r"neither the names? of .{1,120}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 1, "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", 1, "apache", r"you may not use this file except in compliance with the licen[cs]e you may obtain a copy of the licen[cs]e at"),
    ("apache-2.0", 1, "apache org", r"(?:http|https) www apache org licenses license 2 0"),
    ("gpl", 2, "free software foundation", r"redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation"),
    ("gpl-2.0", 1, "either version 2", r"gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e"),
    ("gpl-3.0", 1, "either version 3", r"gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e"),
    ("lgpl-2.1", 1, "either version 2 1", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the licen[cs]e"),
    ("lgpl-3.0", 1, "either version 3", r"gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e"),
    ("agpl-3.0", 1, "affero", r"gnu affero general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e"),
    ("gpl", 3, "gnu org", r"(?:http|https) www gnu org licenses gpl(?: \d 0)?"),
    ("lgpl", 3, "gnu org", r"(?:http|https) www gnu org licenses lgpl(?: \d \d)?"),
    ("agpl", 3, "gnu org", r"(?:http|https) www gnu org licenses agpl(?: 3 0)?"),
    ("gfdl", 1, "free documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("mpl-2.0", 1, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("mpl-1.1", 1, "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("epl-2.0", 1, "eclipse", r"made available under the terms of the eclipse public licen[cs]e 2 0"),
    ("epl-1.0", 1, "eclipse", r"made available under the terms of the eclipse public licen[cs]e v1 0"),
    ("cddl", 1, "common development", r"subject to the terms of the common development and distribution licen[cs]e"),
    ("zlib", 1, "altered source", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("bsl-1.0", 1, "boost", r"distributed under the boost software licen[cs]e version 1 0"),
    ("unlicense", 1, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", 2, "public domain", r"(?:released|placed|dedicated)(?: in)?(?: into| to)? the public domain"),
    ("public-domain", 3, "public domain", r"(?:is|are) in the public domain"),
    ("cc0-1.0", 1, "cc0", r"dedicated to the public domain under (?:the )?cc0(?: 1 0)?(?: universal)?"),
    ("creative-commons", 3, "creativecommons", r"(?:http|https) (?:www )?creativecommons org licenses [a-z ]{2,9} \d \d"),
    ("wtfpl", 1, "want to", r"you just do what the fuck you want to"),
    ("beerware", 1, "buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("openssl", 1, "openssl", r"this product includes software developed by the openssl project"),
    ("php-3.01", 1, "php", r"this product includes php software freely available from"),
    ("ofl-1.1", 1, "font software", r"this font software is licensed under the sil open font licen[cs]e version 1 1"),
    ("x11", 1, "x consortium", r"the name of the x consortium shall not be used in advertising"),
    ("all-rights-reserved", 2, "all rights reserved", r"all rights reserved"),
    ("proprietary", 2, "written permission", r"may not be (?:copied|reproduced|distributed|republished)(?: [a-z]+){0,8} without(?: the)?(?: [a-z]+){0,3} written permission"),
    ("proprietary", 2, "confidential", r"proprietary and confidential"),
    ("no-warranty", 3, "warranty", r"without warranty of any kind"),
)

#: label, words of its identifier
TAGS = tuple(
    (tag.lower(), tag.lower().replace("-", " ").replace(".", " "))
    for tag in (
        "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause "
        "BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 "
        "CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3 GPL-2.0 GPL-2.0-only GPL-2.0-or-later "
        "GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only "
        "LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 SSPL-1.0 "
        "Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib"
    ).split()
)

_GRANT = r"(?:dual |multi )?(?:licen[cs]ed|released|distributed|available|published|provided|covered)(?: to you)? (?:under|by|subject to)(?: the)?(?: terms of)?(?: the)? "


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


#: Between the parts of a text whose place in it isn't fixed.
_GAP = "\x00"


def variants(parsed) -> list[str]:
    """The texts that a parsed pattern stands for: every choice and option taken apart, _GAP for whatever varies else."""
    texts = [""]
    for kind, value in parsed:
        if kind is kinds.LITERAL:
            more = [chr(value)]
        elif kind is kinds.SUBPATTERN:
            more = variants(value[3])
        elif kind is kinds.BRANCH:
            more = [text for branch in value[1] for text in variants(branch)]
        elif kind is kinds.MAX_REPEAT and value[:2] == (0, 1):
            more = ["", *variants(value[2])]
        else:
            more = [_GAP]
        texts = [text + end for text in texts for end in more]
    return texts


def keywords(given: str, pattern: str) -> list[str]:
    """Words of which every match of the pattern, between spaces, holds one: those in `given` (separated by |), as whole
    words if they can be, for the variants that hold them, and the longest fixed part of each other variant."""
    texts = [f" {text} " for text in variants(parser.parse(pattern))]
    found = []
    for word in given.split("|"):
        held = [text for text in texts if word in text]
        if held:
            found.append(next(k for k in (f" {word} ", f" {word}", word) if all(k in text for text in held)))
            texts = [text for text in texts if word not in text]
    rest = {max(text.split(_GAP), key=len) for text in texts}
    return found + sorted(k for k in rest if not any(o in k for o in rest if o != k))


def _rules() -> list[Rule]:
    def rule(label: str, priority: int, confidence: float, given: str, words: str, pattern: str) -> list[Rule]:
        return [Rule(label, priority, confidence, keyword, pattern) for keyword in keywords(given, words)]

    tags = [(label, f"spdx license identifier {words}") for label, words in TAGS]
    rules = [r for label, p in tags for r in rule(label, 1, 1.0, "spdx", p, p)]
    rules += [r for label, priority, given, p in TEXTS if priority == 1 for r in rule(label, 1, 1.0, given, p, p)]
    for label, given, names in LICENCES:
        rules += rule(label, 1, 0.95, given, names, f"{_GRANT}(?:{names})")
    rules += [r for label, priority, given, p in TEXTS if priority == 2 for r in rule(label, 2, 0.85, given, p, p)]
    for label, given, names in LICENCES:
        rules += rule(label, 2, 0.75, given, names, f"(?:{names})")
    rules += [r for label, priority, given, p in TEXTS if priority == 3 for r in rule(label, 3, 0.5, given, p, p)]
    return rules


RULES = tuple(_rules())
PRIORITIES = 3
