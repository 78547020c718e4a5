"""Signature rules of licences, over texts reduced to words.

A text is seen as its lower-case words, each with one space before and after.
A rule has a label, a priority (a smaller one wins), a score (how sure a match
is), a keyword that any text with a match contains, and a regular expression,
some also one for what stands before the match. Sentences are written out
below; names and identifiers are built from families, versions and lists.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    score: float
    keyword: str
    pattern: str
    base: bool = False
    # What stands before a match: words that are no part of it.
    behind: str = ""
    # Whether it applies inside announced expressions of identifiers only.
    announced: bool = False


# Priorities: an identifier, a full name with a version, a full name, a hint.
IDENTIFIER, VERSIONED, NAMED, HINT = 0, 1, 2, 3
SCORES = {IDENTIFIER: 1.0, VERSIONED: 0.95, NAMED: 0.8, HINT: 0.4}

# Label stem, keyword, ways to write the name, versions.
FAMILIES = (
    ("apache", "apache", (r"apache(?: software)? licen[cs]e", r"apache"), ("1.0", "1.1", "2.0")),
    ("gpl", "general public licen", (r"(?:gnu )?general public licen[cs]e",), ("1.0", "2.0", "3.0")),
    ("gpl", " gpl", (r"(?:gnu )?gpl(?:v)?",), ("1.0", "2.0", "3.0")),
    ("lgpl", "lesser general public licen", (r"(?:gnu )?lesser general public licen[cs]e",), ("2.1", "3.0")),
    ("lgpl", "library general public licen", (r"(?:gnu )?library general public licen[cs]e",), ("2.0", "2.1")),
    ("lgpl", " lgpl", (r"(?:gnu )?lgpl(?:v)?",), ("2.0", "2.1", "3.0")),
    ("agpl", "affero general public licen", (r"(?:gnu )?affero general public licen[cs]e",), ("1.0", "3.0")),
    ("agpl", " agpl", (r"(?:gnu )?agpl(?:v)?",), ("1.0", "3.0")),
    ("gfdl", "free documentation licen", (r"(?:gnu )?free documentation licen[cs]e",), ("1.1", "1.2", "1.3")),
    ("mpl", "mozilla public licen", (r"mozilla public licen[cs]e",), ("1.0", "1.1", "2.0")),
    ("mpl", " mpl", (r"mpl(?: licen[cs]e)?",), ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public licen", (r"eclipse public licen[cs]e",), ("1.0", "2.0")),
    ("cddl", "common development and distribution licen", (r"common development and distribution licen[cs]e",), ("1.0", "1.1")),
    ("eupl", "european union public licen", (r"european union public licen[cs]e",), ("1.0", "1.1", "1.2")),
    ("ofl", "open font licen", (r"(?:sil )?open font licen[cs]e",), ("1.0", "1.1")),
    ("afl", "academic free licen", (r"academic free licen[cs]e",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("osl", "open software licen", (r"open software licen[cs]e",), ("1.0", "2.0", "2.1", "3.0")),
    ("lppl", "latex project public licen", (r"latex project public licen[cs]e",), ("1.0", "1.1", "1.2", "1.3")),
    ("artistic", "artistic licen", (r"artistic licen[cs]e",), ("1.0", "2.0")),
    ("python", "python software foundation licen", (r"python software foundation licen[cs]e",), ("2.0",)),
    ("php", "php licen", (r"php licen[cs]e",), ("3.0", "3.01")),
    ("bsl", " boost ", (r"boost(?: software)? licen[cs]e",), ("1.0",)),
    ("busl", "business source licen", (r"business source licen[cs]e",), ("1.0", "1.1")),
    ("sspl", "server side public licen", (r"server side public licen[cs]e",), ("1.0",)),
    ("ms-pl", "microsoft public licen", (r"microsoft public licen[cs]e",), ()),
    ("ms-rl", "microsoft reciprocal licen", (r"microsoft reciprocal licen[cs]e",), ()),
    ("cpl", "common public licen", (r"common public licen[cs]e",), ("1.0",)),
    ("ipl", "ibm public licen", (r"ibm public licen[cs]e",), ("1.0",)),
    ("qpl", "q public licen", (r"q public licen[cs]e",), ("1.0",)),
    ("zpl", "zope public licen", (r"zope public licen[cs]e",), ("1.1", "2.0", "2.1")),
    ("ecl", "educational community licen", (r"educational community licen[cs]e",), ("1.0", "2.0")),
    ("odbl", "open database licen", (r"(?:odc )?open database licen[cs]e",), ("1.0",)),
    ("odc-by", "open data commons attribution", (r"open data commons attribution licen[cs]e",), ("1.0",)),
    ("pddl", "public domain dedication and licen", (r"public domain dedication and licen[cs]e",), ("1.0",)),
    ("ogl", "open government licen", (r"open government licen[cs]e",), ("1.0", "2.0", "3.0")),
    ("cecill", " cecill", (r"cecill(?: [abc])?",), ("1.0", "1.1", "2.0", "2.1")),
    ("mulan", "mulan", (r"mulan (?:psl|permissive software licen[cs]e)",), ("1.0", "2.0")),
    ("mit", " mit ", (r"mit licen[cs]e", r"(?:expat|x11) mit licen[cs]e"), ()),
    ("isc", " isc ", (r"isc licen[cs]e",), ()),
    ("zlib", " zlib", (r"zlib(?: libpng)? licen[cs]e",), ()),
    ("unlicense", "unlicense", (r"(?:the )?unlicense",), ()),
    ("wtfpl", " wtfpl", (r"wtfpl",), ("2.0",)),
    ("x11", " x11 ", (r"x11 licen[cs]e",), ()),
    ("postgresql", " postgresql ", (r"postgresql licen[cs]e",), ()),
    ("openssl", " openssl ", (r"openssl licen[cs]e",), ()),
    ("curl", " curl ", (r"curl licen[cs]e",), ()),
    ("ncsa", " ncsa ", (r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e",), ()),
    ("beerware", "beer", (r"beer ?ware(?: licen[cs]e)?",), ()),
    ("unicode", "unicode licen", (r"unicode licen[cs]e",), ()),
    ("vim", " vim ", (r"vim licen[cs]e",), ()),
    ("ruby", " ruby ", (r"ruby s? ?licen[cs]e",), ()),
    ("bsd", " bsd ", (r"(?:modified |simplified |new |revised |original )?bsd(?: style)? licen[cs]e",), ()),
)

# Creative Commons: the parts of a kind, each as initials and in words.
CC_PARTS = (("by", "attribution"), ("nc", r"non ?commercial"), ("nd", r"no ?deriv(?:ative)?s?"), ("sa", r"share ?alike"))
CC_KINDS = ("by", "by-nc", "by-nd", "by-sa", "by-nc-nd", "by-nc-sa")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Identifiers that are no stem with one of its versions: label, words of the identifier.
IDENTIFIERS = (
    ("mit", "mit"),
    ("mit-0", "mit 0"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("0bsd", "0bsd"),
    ("bsd-2-clause-patent", "bsd 2 clause patent"),
    ("bsd-4", "bsd 4 clause"),
    ("bsd-3-clause-clear", "bsd 3 clause clear"),
    ("bsd-2", "bsd 2 clause"),
    ("bsd-3", "bsd 3 clause"),
    ("ms-pl", "ms pl"),
    ("ms-rl", "ms rl"),
    ("unlicense", "unlicense"),
    ("wtfpl", "wtfpl"),
    ("x11", "x11"),
    ("postgresql", "postgresql"),
    ("openssl", "openssl"),
    ("curl", "curl"),
    ("ncsa", "ncsa"),
    ("beerware", "beerware"),
    ("vim", "vim"),
    ("ruby", "ruby"),
    ("python-2.0", "psf 2 0"),
    ("bsl-1.0", "bsl 1 0"),
    ("cc0", "cc0 1 0"),
    ("cc-pddc", "cc pddc"),
    ("hpnd", "hpnd"),
    ("icu", "icu"),
    ("ijg", "ijg"),
    ("intel", "intel"),
    ("libpng", "libpng(?: 2 0)?"),
    ("libtiff", "libtiff"),
    ("naist", "naist 2003"),
    ("ntp", "ntp"),
    ("sissl", "sissl(?: 1 2)?"),
    ("sleepycat", "sleepycat"),
    ("tcl", "tcl"),
    ("unicode", "unicode (?:3 0|dfs 201[56])"),
    ("upl-1.0", "upl 1 0"),
    ("w3c", "w3c(?: 1998110[0-9])?"),
    ("xnet", "xnet"),
    ("blueoak-1.0.0", "blueoak 1 0 0"),
    ("cal-1.0", "cal 1 0(?: combined work exception)?"),
    ("fsfap", "fsfap"),
    ("gfdl-1.3", "gfdl 1 3 (?:only|no invariants only|invariants only)"),
    ("elastic-2.0", "elastic 2 0"),
    ("polyform", "polyform (?:noncommercial|small business) 1 0 0"),
)

# Words of expressions beside those of the identifiers, and of the exceptions that follow "with".
JOINERS = ("or", "and", "with", "only", "later", "exception", "classpath", "llvm", "gcc", "bison", "autoconf", "linux", "syscall", "note", "openssl", "[0-9]{1,2}")

# Names so short that they count by themselves only beside another one, joined by "or" or "and".
SHORT = ("mit", "isc", "zlib", "0bsd", "x11", "boost", "unlicense")
PARTNERS = ("mit", "isc", "zlib", "0bsd", "bsd", "apache", "a?l?gpl(?:v?[23])?", "mpl", "epl", "unlicense", "cc0", "wtfpl", "boost", "bsl")

# Sentences of licence texts and other notices: label, keyword, pattern, priority.
SENTENCES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software", NAMED),
    ("isc", "permission to use copy", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", NAMED),
    ("bsd", "redistribution and use in source", r"redistribution and use in source and binary forms with or without modification are permitted", NAMED),
    ("bsd-3", "neither the name of", r"neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used", NAMED),
    ("apache", "you may not use this file except", r"you may not use this file except in compliance with the license", NAMED),
    ("gpl", "free software you can redistribute", r"this (?:program|library) is free software you can redistribute it and or modify it", NAMED),
    ("zlib", "this software is provided as is", r"this software is provided as is without any express or implied warranty", HINT),
    ("cc0", " cc0", r"cc0(?: 1 0)?(?: universal)?", VERSIONED),
    ("cc0", "creative commons zero", r"creative commons zero(?: v?1 0)?", VERSIONED),
    ("public-domain", "public domain", r"(?:is |are )?(?:released |placed |dedicated )?(?:in|into|to) the public domain", NAMED),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential", NAMED),
    ("proprietary", "unauthorized copying", r"unauthorized copying of (?:\S+ ){1,8}?is strictly prohibited", NAMED),
    ("proprietary", "do not redistribute", r"do not redistribute", HINT),
    ("mit", "the above copyright notice and this permission notice", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software", NAMED),
    ("mit-0", "without restriction", r"deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so(?! subject)", NAMED),
    ("mit", "without restriction", r"deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software(?= and to permit persons to whom the software is furnished to do so subject)", NAMED),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the(?: above)? copyright notice(?: this list of conditions and the following disclaimer)?", NAMED),
    ("bsd", "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer)?", NAMED),
    ("bsd-4", "all advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", NAMED),
    ("bsd-3", "the name of the author may not be used", r"the names? of the authors? may not be used to endorse or promote products derived from this software", NAMED),
    ("apache", "for the specific language governing permissions", r"see the licen[cs]e for the specific language governing permissions and limitations under the licen[cs]e", NAMED),
    ("apache-2.0", "apache org licenses license 2 0", r"(?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?", VERSIONED),
    ("apache", "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements", NAMED),
    ("apache-1.1", "this product includes software developed by the apache", r"this product includes software developed by the apache (?:software foundation|group)", NAMED),
    ("gpl", "gnu org licenses", r"(?:https? )?(?:www )?gnu org licenses(?: old licenses)?(?: gpl(?: [123](?: 0)?)?)?(?: html| txt)?", NAMED),
    ("lgpl", "gnu org licenses", r"(?:https? )?(?:www )?gnu org licenses(?: old licenses)? lgpl(?: [23](?: [01])?)?(?: html| txt)?", NAMED),
    ("agpl", "gnu org licenses", r"(?:https? )?(?:www )?gnu org licenses agpl(?: 3(?: 0)?)?(?: html| txt)?", NAMED),
    ("gpl", "without even the implied warranty", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", HINT),
    ("gpl-linking", "special exception", r"as a special exception the copyright holders of this (?:library|program) give you permission to link", NAMED),
    ("gpl-classpath", "classpath exception", r"(?:gnu )?classpath exception", NAMED),
    ("mpl-2.0", "mozilla org mpl", r"(?:https? )?(?:www )?mozilla org mpl 2 0", VERSIONED),
    ("mpl", "subject to the terms of the mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0", VERSIONED),
    ("epl", "eclipse org legal", r"(?:https? )?(?:www )?eclipse org (?:legal )?epl(?: v10| 2 0)?(?: html)?", NAMED),
    ("cc0", "waived all copyright", r"waived all copyright and related or neighbou?ring rights", NAMED),
    ("cc0", "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero 1 0", VERSIONED),
    ("cc-by", "creativecommons org licenses by", r"creativecommons org licenses by (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("cc-by-sa", "creativecommons org licenses by sa", r"creativecommons org licenses by sa (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("cc-by-nd", "creativecommons org licenses by nd", r"creativecommons org licenses by nd (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("cc-by-nc", "creativecommons org licenses by nc", r"creativecommons org licenses by nc (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd (?:1|2|3|4) [05](?! [0-9])", VERSIONED),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain", NAMED),
    ("unlicense", "unlicense org", r"(?:https? )?unlicense org", NAMED),
    ("wtfpl", "do what the fuck you want", r"do what the fuck you want to(?: public licen[cs]e)?", NAMED),
    ("beerware", "you can buy me a beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer(?: in return)?", NAMED),
    ("zlib", "altered source versions must be", r"altered source versions must be plainly marked as such", NAMED),
    ("zlib", "the origin of this software must not", r"the origin of this software must not be misrepresented", NAMED),
    ("bsl", "machine executable object code", r"solely in the form of machine executable object code generated by a source language processor", NAMED),
    ("openssl", "developed by the openssl project", r"this product includes software developed by the openssl project(?: for use in the openssl toolkit)?", NAMED),
    ("postgresql", "without a written agreement", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", NAMED),
    ("hpnd", "both that copyright notice and this permission notice", r"both that copyright notice and this permission notice appear in supporting documentation", NAMED),
    ("x11", "shall not be used in advertising or otherwise", r"shall not be used in advertising or otherwise to promote the sale use or other dealings in this software", NAMED),
    ("ncsa", "deal with the software without restriction", r"to deal with the software without restriction", NAMED),
    ("ofl", "reserved font name", r"(?:with )?reserved font names?", NAMED),
    ("artistic", "standard version of the package", r"(?:copies of the )?source form of the standard version of th(?:e|is) package", NAMED),
    ("perl", "same terms as perl", r"under the same terms as perl(?: itself| 5)?", NAMED),
    ("ruby", "same terms as ruby", r"under the same terms as ruby(?: itself)?", NAMED),
    ("python", "psf license agreement", r"psf licen[cs]e agreement(?: for python [0-9](?: [0-9]+){0,2})?", NAMED),
    ("non-commercial", "commercial use", r"for non ?commercial use only", NAMED),
    ("non-commercial", "not for commercial", r"not for commercial use", NAMED),
    ("non-commercial", "research purposes only", r"for (?:academic and |non ?commercial )?research purposes only", NAMED),
    ("proprietary", "trade secret", r"(?:contains|constitutes?) (?:\S+ ){0,6}?trade secrets?(?: of)?", NAMED),
    ("proprietary", "may not be reproduced", r"may not be reproduced(?: or)?(?: \S+){0,6}? without(?: the)?(?: prior)?(?: express)? written (?:permission|consent)", NAMED),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary(?: information)?", NAMED),
    ("proprietary", "end user license", r"end user licen[cs]e agreement", NAMED),
    ("proprietary", "internal use only", r"for internal use only", HINT),
    ("warranty", "without warranty of any kind", r"(?:provided )?as is without warranty of any kind(?: express or implied)?", HINT),
    ("warranty", "in no event shall", r"in no event shall (?:the )?(?:\S+ ){1,8}?be liable", HINT),
    ("dual", "dual licen", r"dual licen[cs]ed(?: under)?", HINT),
    ("dual", "at your option", r"at your option", HINT),
    ("licensed", "distributed under", r"distributed under the (?:terms of the )?\S+ licen[cs]e", HINT),
    ("licensed", "terms and conditions", r"subject to the(?: following)? terms and conditions", HINT),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9][0-9]", HINT),
    ("licensed", "licensed under", r"licensed under(?: the)? \S+", HINT),
    ("licensed", " licen", r"see(?: the)? licen[cs]e(?: file)? for(?: more)?(?: details| information)?", HINT),
)

# The phrases and labels that always count, whatever else matches.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))


def _version(version: str) -> str:
    """The words of a version; a last part of zero may be left out."""
    head, _, tail = version.partition(".")
    return rf"{head}(?: {tail})?" if tail == "0" else rf"{head} {tail}"


def _family_rules() -> list[Rule]:
    rules = []
    for stem, keyword, names, versions in FAMILIES:
        for name in names:
            full = not (stem == "apache" and name == "apache")
            # The version of an abbreviation may be written in one word with it: GPLv2, GPL2.
            between = r"(?:(?: version| v)? v?|v?)" if keyword.startswith(" ") else r"(?: version| v)? (?:v)?"
            if full:
                rules.append(Rule(stem, NAMED, SCORES[NAMED], keyword, rf"(?:the )?{name}"))
            # Longer versions first, so that 2.1 is not read as 2.
            for version in sorted(versions, key=len, reverse=True):
                for tail, suffix in (("", ""), ("-or-later", r" or(?: at your option)?(?: any)? later(?: version)?")):
                    pattern = rf"(?:the )?{name}{between}{_version(version)}{suffix}"
                    # A version that ends here: no further number belongs to it.
                    end = "" if suffix else r"(?! [0-9])"
                    rules.append(Rule(f"{stem}-{version}{tail}", VERSIONED, SCORES[VERSIONED], keyword, pattern + end))
    for n, name in enumerate(("zero", "one", "two", "three", "four")):
        rules.append(
            Rule(f"bsd-{n}", VERSIONED, SCORES[VERSIONED], " bsd ", rf"(?:bsd (?:{n}|{name}) clause|(?:{n}|{name}) clause bsd)(?: licen[cs]e)?")
        )
    return rules


def _cc_rules() -> list[Rule]:
    spelt = dict(CC_PARTS)
    rules = []
    for kind in CC_KINDS:
        parts = kind.split("-")
        short = "cc " + " ".join(parts)
        # In words the order of the parts varies by version.
        orders = {" ".join(spelt[p] for p in ("by", *rest)) for rest in itertools.permutations(parts[1:])}
        long = rf"creative commons (?:{'|'.join(sorted(orders))})"
        for keyword, name, more in ((" cc by", short, r"(?! (?:nc|nd|sa) )"), ("creative commons", long, r"(?! (?:non|no|share))")):
            rules.append(Rule(f"cc-{kind}", NAMED, SCORES[NAMED], keyword, name + more))
            for version in CC_VERSIONS:
                tail = r"(?: international| unported| generic)?(?: licen[cs]e)?"
                pattern = rf"{name}(?: licen[cs]e)?(?: version)? {_version(version)}{tail}(?! [0-9])"
                rules.append(Rule(f"cc-{kind}-{version}", VERSIONED, SCORES[VERSIONED], keyword, pattern))
    return rules


def _identifiers(named: list[Rule]) -> list[tuple[str, str]]:
    """Label and words of every identifier: of the versions, as they are written in their labels, and of the list."""
    versions = {(r.label, r.label.replace("-", " ").replace(".", " ")) for r in named if r.priority == VERSIONED}
    return sorted(versions) + list(IDENTIFIERS)


def announced() -> str:
    """An expression of identifiers: "MIT OR (Apache-2.0 AND ISC)", behind the words that announce it."""
    known = _identifiers(_family_rules() + _cc_rules())
    chain = "|".join(sorted({w for _, name in known for w in name.split() if w.isalnum() and not w.isdigit()} | set(JOINERS)))
    return rf"(?<= spdx licen[cs]e identifier )(?:(?:{chain}) ){{1,40}}"


def _identifier_rules(named: list[Rule]) -> list[Rule]:
    return [
        Rule(label, IDENTIFIER, SCORES[IDENTIFIER], "identifier", rf"{name}(?: only)?(?! [0-9])", announced=True)
        for label, name in _identifiers(named)
    ]


def _short_rules() -> list[Rule]:
    """Short names before or after another one: "MIT OR Apache-2.0"."""
    partner = "|".join(PARTNERS)
    found = []
    for name in SHORT:
        label = {"boost": "bsl"}.get(name, name)
        found.append(Rule(label, NAMED, SCORES[NAMED], f" {name} ", rf"{name}(?= (?:or|and) (?:the )?(?:{partner}) )"))
        before = rf"(?:{partner})(?: licen[cs]e)?(?: [0-9])?(?: [0-9])? (?:or|and) (?:the )?"
        found.append(Rule(label, NAMED, SCORES[NAMED], f" {name} ", name, behind=before))
    return found


def rules() -> tuple[Rule, ...]:
    """All rules: base phrases, identifiers, names and sentences, in this order."""
    found = [Rule(label, NAMED, 0.6, phrase, phrase, True) for label, phrase in BASE]
    named = _family_rules() + _cc_rules()
    found += _identifier_rules(named) + named + _short_rules()
    found += [Rule(label, priority, SCORES[priority], keyword, pattern) for label, keyword, pattern, priority in SENTENCES]
    return tuple(found)
