"""Signature rules of the license scan: hand-written phrases, in order.

A phrase is written in words. ``a|b`` is either word, a word may be a regular
expression, ``word?`` may be missing, ``...`` stands for up to three words of any kind, and
``NAME`` for the names of a family. A rule's keywords are words of which every match has
one or more; they gate the rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SIGNATURE, NOTICE, NAMED, MENTION = 1, 2, 3, 4  # priorities, strongest first
CONFIDENCE = {SIGNATURE: 1.0, NOTICE: 0.9, NAMED: 0.7, MENTION: 0.4}


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False


def pattern_of(phrase: str, names: str = "") -> str:
    """Regular expression over words written as ``<word>``."""
    out = []
    for word in phrase.split():
        if word == "NAME":
            out.append(names)
        elif word == "...":
            out.append("(?:<[^<>]*>){0,3}")
        else:
            optional = word.endswith("?")
            word = word[:-1] if optional else word
            word = f"<(?:{word})>" if "|" in word else f"<{word}>"
            out.append(f"(?:{word})?" if optional else word)
    return "".join(out)


def either(phrases: list[str]) -> str:
    return "(?:" + "|".join(map(pattern_of, phrases)) + ")"


# The phrases and labels that the scan's contract names.
BASE = [("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"), ("cc-by-nc", "cc", "cc by nc")]

# label, keywords, names (a name alone counts as a mention if it starts with "!")
FAMILIES = [
    ("mit", "mit expat", ["mit", "mit x11", "expat"]),
    ("x11", "x11", ["x11"]),
    ("apache-2", "apache asl", ["!apache software? licen[cs]e? version|v|ver? 2|v2 0?", "!asl 2 0?"]),
    ("apache-1.1", "apache", ["!apache software? licen[cs]e? version|v|ver? 1|v1 1"]),
    ("apache", "apache", ["apache software?"]),
    ("0bsd", "0bsd bsd", ["!0bsd", "!0|zero clause bsd", "!bsd 0|zero clause"]),
    ("bsd-2-clause", "bsd", ["!2|two clause bsd", "!bsd 2|two clause", "!simplified bsd", "!freebsd bsd?"]),
    ("bsd-3-clause", "bsd", ["!3|three clause bsd", "!bsd 3|three clause", "!new|modified|revised bsd"]),
    ("bsd-4-clause", "bsd", ["!4|four clause bsd", "!bsd 4|four clause", "!original|old bsd"]),
    ("bsd", "bsd", ["bsd style?"]),
    ("isc", "isc", ["isc"]),
    ("zlib", "zlib", ["zlib", "zlib libpng"]),
    ("libpng", "libpng", ["libpng"]),
    ("boost-1.0", "boost bsl", ["!boost software licen[cs]e version|v? 1? 0?", "bsl 1 0"]),
    ("unlicense", "unlicense", ["!unlicense"]),
    ("wtfpl", "wtfpl", ["!wtfpl"]),
    ("beerware", "beerware beer", ["!beerware", "beer ware"]),
    ("ncsa", "ncsa", ["!university of illinois ncsa", "ncsa open? source?"]),
    ("postgresql", "postgresql", ["postgresql"]),
    ("psf-2", "psf python", ["!psf", "!python software foundation", "python"]),
    ("php-3", "php", ["php version|v? 3 0?|1?", "php"]),
    ("ruby", "ruby", ["ruby"]),
    ("openssl", "openssl", ["openssl", "openssl ssleay"]),
    ("openldap", "openldap", ["openldap public?"]),
    ("curl", "curl", ["curl"]),
    ("icu", "icu", ["icu"]),
    ("unicode", "unicode", ["unicode", "unicode data files and software"]),
    ("w3c", "w3c", ["w3c software? notice? and?"]),
    ("ijg", "ijg jpeg", ["!independent jpeg group", "ijg"]),
    ("json", "json", ["json"]),
    ("vim", "vim", ["vim"]),
    ("sleepycat", "sleepycat", ["!sleepycat"]),
    ("zope-2", "zope zpl", ["!zope public", "zpl 2 1?"]),
    ("artistic-2", "artistic", ["!artistic licen[cs]e? version|v? 2 0?"]),
    ("artistic-1", "artistic", ["!artistic licen[cs]e? version|v? 1 0?", "artistic"]),
    ("cpl-1.0", "cpl common", ["!common public version|v? 1? 0?", "cpl 1 0"]),
    ("ipl-1.0", "ibm", ["!ibm public"]),
    ("nasa-1.3", "nasa", ["!nasa open source agreement"]),
    ("qpl-1.0", "qpl", ["!q public", "qpl"]),
    ("ecl-2.0", "educational ecl", ["!educational community", "ecl 2 0"]),
    ("afl-3.0", "afl academic", ["!academic free", "afl 3 0"]),
    ("osl-3.0", "osl", ["osl 3 0", "osl"]),
    ("ofl-1.1", "ofl sil", ["!sil open font", "!ofl 1 1", "ofl"]),
    ("ms-pl", "microsoft ms", ["!microsoft public", "!ms pl"]),
    ("ms-rl", "microsoft ms", ["!microsoft reciprocal", "!ms rl"]),
    ("busl-1.1", "busl business", ["!business source", "!busl 1 1"]),
    ("sspl-1", "sspl", ["!server side public", "!sspl"]),
    ("elastic-2", "elastic", ["!elastic licen[cs]e 2 0?"]),
    ("polyform-nc", "polyform", ["!polyform noncommercial"]),
    ("openrail", "openrail", ["!bigscience? openrail m?"]),
    ("odbl", "odbl database", ["!open database", "!odbl 1? 0?"]),
    ("odc-by", "odc", ["!odc by", "odc attribution"]),
    ("pddl", "pddl", ["!pddl 1? 0?"]),
    ("cc0-1.0", "cc0", ["!cc0 1? 0?"]),
]
# label, keywords, names, versions: one family for each version, one for "or later" and one without
VERSIONED = [
    ("gpl", "gpl gnu gplv general", ["!gnu? general public licen[cs]e", "!gnu? gpl"], ["1", "2", "3"]),
    ("lgpl", "lgpl lesser library", ["!gnu? lesser|library general public licen[cs]e", "!gnu? lgpl"], ["2", "2 1", "3"]),
    ("agpl", "agpl affero", ["!gnu? affero general public licen[cs]e", "!gnu? agpl"], ["1", "3"]),
    ("gfdl", "gfdl documentation", ["!gnu? free documentation licen[cs]e", "!gnu? gfdl"], ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla mpl", ["!mozilla public licen[cs]e", "!mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse epl", ["!eclipse public licen[cs]e", "!epl"], ["1 0", "2 0"]),
    ("cddl", "cddl", ["!common development and distribution licen[cs]e ... cddl", "!cddl"], ["1 0", "1 1"]),
    ("eupl", "eupl european", ["!european union public licen[cs]e", "!eupl"], ["1 1", "1 2"]),
]
SHORT_VERSIONED = {"gpl": "gplv", "lgpl": "lgplv", "agpl": "agplv"}
# parts of a Creative Commons licence's name
CC_PARTS = {"by": "attribution", "nc": "non? noncommercial|commercial", "sa": "share? sharealike|alike", "nd": "no? derivatives|derivs|noderivs|noderivatives|derivative"}
CC_KINDS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]

FORMS = [
    (SIGNATURE, "spdx licen[cs]e identifier NAME"),
    (NOTICE, "licensed|released|distributed|published|available|provided|covered|issued|redistributed|offered under|by the? terms? and? conditions? of? the? NAME licen[cs]e?"),
    (NOTICE, "is|are|be|code|work|file|software under the? terms? of? the? NAME licen[cs]e"),
    (NOTICE, "subject|according|pursuant to the? terms? and? conditions? of? the? NAME licen[cs]e"),
    (NOTICE, "licen[cs]e is? the? NAME licen[cs]e?"),
    (NAMED, "NAME public? licen[cs]e|licensed version|v? v?[1-9]? 0?"),
]
# full texts and notices: label, keywords, phrase
SIGNATURES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", "the software is provided as is without warranty of any kind ... merchantability fitness for a particular purpose and noninfringement"),
    ("isc", "hereby", "permission to use copy modify and|or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "endorse", "neither the name of ... ... nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("zlib", "express", "this software is provided as is without any express or implied warranty"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("boost-1.0", "machine", "machine executable object code generated by a source language processor"),
    ("apache-2", "apache", "www apache org licenses license 2 0"),
    ("apache-2", "apache", "you may not use this file except in compliance with the license ... ... ... ... apache"),
    ("gpl", "gnu", "gnu general public license as published by the free software foundation"),
    ("gpl-3-plus", "foundation", "free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-plus", "foundation", "free software foundation either version 2 of the license or at your option any later version"),
    ("gpl", "gnu", "www gnu org licenses gpl ..."),
    ("lgpl", "lesser", "gnu lesser general public license as published by the free software foundation"),
    ("agpl-3", "affero", "gnu affero general public license as published by the free software foundation"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "eclipse", "www eclipse org legal epl v10 html"),
    ("epl-2.0", "eclipse", "www eclipse org legal epl 2 0"),
    ("cddl", "cddl", "the contents of this file are subject to the terms of the common development and distribution license ... cddl"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("public-domain", "domain", "released|placed|dedicated in|into|to the public domain"),
    ("public-domain", "domain", "this|work|file is in the public domain"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("cc0-1.0", "waived", "has waived all copyright and related or neighboring rights"),
    ("ofl-1.1", "sil", "this font software is licensed under the sil open font license"),
    ("perl", "perl", "under the same terms as perl itself"),
    ("artistic-1", "perl", "terms of either the gnu general public license or the artistic license ... ... perl"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("json", "evil", "the software shall be used for good not evil"),
    ("psf-2", "psf", "psf license agreement for python"),
    ("proprietary", "reserved", "all rights reserved ... may not be reproduced|copied|redistributed|distributed"),
    ("proprietary", "confidential", "confidential and proprietary information of"),
    ("proprietary", "proprietary", "this software is proprietary"),
    ("commercial", "commercial", "may not be used for commercial purposes without a? written? commercial? licen[cs]e|permission"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
]


def _family(label: str, keywords: str, names: list[str]):
    bare = [n[1:] for n in names if n[0] == "!"]
    every = either([n.lstrip("!") for n in names])
    for priority, form in FORMS:
        yield Rule(label, priority, tuple(keywords.split()), pattern_of(form, every))
    if bare:
        yield Rule(label, MENTION, tuple(keywords.split()), either(bare))


def _versions(label: str, keywords: str, names: list[str], versions: list[str]):
    short = SHORT_VERSIONED.get(label)
    for v in versions:
        words = f"{v} 0?" if " " not in v else v
        own = [f"{n} version|v|ver? v?{words}" for n in names]
        first = words.split()
        if short:
            own += [f"!{short}{' '.join(first)}", f"!{label}{' '.join(first)}"]
        more = f"{keywords} {short}{first[0]} {label}{first[0]}" if short else keywords
        name = f"{label}-{v.replace(' ', '.')}"
        yield from _family(f"{name}-plus", more, [f"{n} or any? at? your? option? any? later|newer|greater|higher version?" for n in own])
        yield from _family(name, more, own)
    yield from _family(label, keywords, names)


def _creative_commons():
    for kind in CC_KINDS:
        long = " ".join(CC_PARTS[p] for p in kind.split())
        version = "version? v? [1-4]? 0|5? international|unported|generic?"
        yield from _family("cc-" + kind.replace(" ", "-"), "cc creative",
                           [f"!cc {kind} {version}", f"!creative commons {long} {version}"])
        yield Rule("cc-" + kind.replace(" ", "-"), SIGNATURE, ("creativecommons",), pattern_of(f"creativecommons org licenses {kind} [1-4] 0|5"))


def all_rules() -> list[Rule]:
    """Base phrases first, then the rules of the method."""
    rules = [Rule(label, MENTION, (keyword,), pattern_of(phrase), True) for label, keyword, phrase in BASE]
    rules += [Rule(label, SIGNATURE, tuple(keywords.split()), pattern_of(phrase)) for label, keywords, phrase in SIGNATURES]
    for family in FAMILIES:
        rules += _family(*family)
    for family in VERSIONED:
        rules += _versions(*family)
    rules += _creative_commons()
    for r in rules:
        re.compile(r.pattern)
    return rules
