"""Signatures of licences and notices, as regular expressions over lower-cased text.

Each licence of ``_LICENCES`` states its label, a keyword that any of its names contains, its
identifiers (as lists of licences have them; empty where another entry has them) and its names.
From these come rules: the identifier in a tag, also inside an expression with and, or, with and
parentheses; the identifier granted ("licensed under ..."); an identifier that says enough by
itself; the name granted; the full name alone. ``_PHRASES`` are signatures of their own: openings,
headers and notices of the texts. Rules come in the order of their priority, 0 first. A rule with a
group detects the group only.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    gate: str  # a text without this is not looked at
    keyword: str  # nor is the rule tried without this
    pattern: re.Pattern
    score: float


#: label, keyword, identifiers, names. Words stand for their plain forms; the scan folds wrapped lines.
_LICENCES = [
    ("apache-1.0", "apache", r"apache-1\.0", r"apache (?:software )?licen[cs]e,? ?(?:version|v\.?)? ?1\.0|apache[- ](?:version |v)?1\.0 licen[cs]e"),
    ("apache-1.1", "apache", r"apache-1\.1", r"apache (?:software )?licen[cs]e,? ?(?:version|v\.?)? ?1\.1|apache[- ](?:version |v)?1\.1 licen[cs]e"),
    ("apache-2.0", "apache", r"apache-2\.0", r"apache (?:software )?licen[cs]e,? ?(?:version|v\.?)? ?2(?:\.0)?|apache[- ](?:version |v)?2(?:\.0)? licen[cs]e"),
    ("mit", "mit", r"mit", r"mit (?:\(expat\) )?licen[cs]e"),
    ("mit-0", "mit", r"mit-0", r"mit no attribution(?: licen[cs]e)?"),
    ("x11", "x11", r"x11", r"x11 licen[cs]e"),
    ("expat", "expat", r"expat", r"expat licen[cs]e"),
    ("bsd-0-clause", "bsd", r"0bsd", r"(?:zero[- ]clause|0-clause) bsd(?: licen[cs]e)?"),
    ("bsd-1-clause", "bsd", r"bsd-1-clause", r"(?:bsd 1-clause|1-clause bsd)(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", r"bsd-2-clause", r"(?:bsd 2-clause|2-clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"bsd-3-clause", r"(?:bsd 3-clause|3-clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"bsd-4-clause", r"(?:bsd 4-clause|4-clause bsd|original bsd)(?: licen[cs]e)?"),
    ("isc", "isc", r"isc", r"isc licen[cs]e"),
    ("gpl-1.0", "gpl", r"gpl-1\.0(?:-only|-or-later|\+)?", r"gplv?1(?:\.0)?\b"),
    ("gpl-2.0", "gpl", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gpl ?(?:version |v\.? ?)?2(?:\.0)?\b"),
    ("gpl-3.0", "gpl", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gpl ?(?:version |v\.? ?)?3(?:\.0)?\b"),
    ("gpl-1.0", "general public", "", r"gnu general public licen[cs]e,? ?(?:version|v\.?)? ?1(?:\.0)?"),
    ("gpl-2.0", "general public", "", r"gnu general public licen[cs]e,? ?(?:version|v\.?)? ?2(?:\.0)?"),
    ("gpl-3.0", "general public", "", r"gnu general public licen[cs]e,? ?(?:version|v\.?)? ?3(?:\.0)?"),
    ("lgpl-2.0", "lgpl", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"lgpl ?(?:version |v\.? ?)?2\.0"),
    ("lgpl-2.1", "lgpl", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"lgpl ?(?:version |v\.? ?)?2\.1"),
    ("lgpl-3.0", "lgpl", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"lgpl ?(?:version |v\.? ?)?3(?:\.0)?\b"),
    ("lgpl-2.1", "lesser general", "", r"gnu lesser general public licen[cs]e,? ?(?:version|v\.?)? ?2\.1"),
    ("lgpl-3.0", "lesser general", "", r"gnu lesser general public licen[cs]e,? ?(?:version|v\.?)? ?3(?:\.0)?"),
    ("agpl-1.0", "affero", "", r"affero general public licen[cs]e,? ?(?:version|v\.?)? ?1(?:\.0)?"),
    ("agpl-3.0", "affero", "", r"(?:gnu )?affero general public licen[cs]e(?:,? (?:version|v\.?) ?3(?:\.0)?)?"),
    ("agpl-3.0", "agpl", r"agpl-3\.0(?:-only|-or-later|\+)?", r"agpl ?(?:version |v\.? ?)?3(?:\.0)?\b"),
    ("gfdl-1.1", "documentation license", r"gfdl-1\.1", r"gnu free documentation license,? ?(?:version|v\.?)? ?1\.1"),
    ("gfdl-1.2", "documentation license", r"gfdl-1\.2", r"gnu free documentation license,? ?(?:version|v\.?)? ?1\.2"),
    ("gfdl-1.3", "documentation license", r"gfdl-1\.3", r"gnu free documentation license,? ?(?:version|v\.?)? ?1\.3"),
    ("mpl-1.0", "mozilla", r"mpl-1\.0", r"mozilla public licen[cs]e,? ?(?:version|v\.?)? ?1\.0"),
    ("mpl-1.1", "mozilla", "", r"mozilla public licen[cs]e,? ?(?:version|v\.?)? ?1\.1"),
    ("mpl-2.0", "mozilla", "", r"mozilla public licen[cs]e,? ?(?:version|v\.?)? ?2(?:\.0)?"),
    ("mpl-1.1", "mpl", r"mpl-1\.1", r"mpl ?v?1\.1"),
    ("mpl-2.0", "mpl", r"mpl-2\.0", r"mpl ?v?2(?:\.0)?\b"),
    ("epl-1.0", "epl", r"epl-1\.0", r"epl ?v?1\.0"),
    ("epl-2.0", "epl", r"epl-2\.0", r"epl ?v?2\.0"),
    ("epl-1.0", "eclipse", "", r"eclipse public licen[cs]e(?: -)?,? ?(?:version|v\.?) ?1\.0"),
    ("epl-2.0", "eclipse", "", r"eclipse public licen[cs]e(?: -)?,? ?(?:version|v\.?) ?2(?:\.0)?"),
    ("edl-1.0", "eclipse", r"edl-1\.0", r"eclipse distribution licen[cs]e"),
    ("cddl-1.0", "cddl", r"cddl-1\.0", r"cddl ?v?1\.0"),
    ("cddl-1.1", "cddl", r"cddl-1\.1", r"cddl ?v?1\.1"),
    ("cddl", "common development", "", r"common development and distribution licen[cs]e"),
    ("cpl-1.0", "common public", r"cpl-1\.0", r"common public licen[cs]e,? ?(?:version|v\.?)? ?1\.0"),
    ("cpal-1.0", "attribution", r"cpal-1\.0", r"common public attribution licen[cs]e"),
    ("eupl-1.1", "eupl", r"eupl-1\.1", r"eupl ?v?1\.1"),
    ("eupl-1.2", "eupl", r"eupl-1\.2", r"eupl ?v?1\.2"),
    ("eupl", "european union", "", r"european union public licen[cs]e"),
    ("artistic-1.0", "artistic", r"artistic-1\.0", r"artistic licen[cs]e(?:,? (?:version|v\.?))? ?1\.0"),
    ("artistic-2.0", "artistic", r"artistic-2\.0", r"artistic licen[cs]e(?:,? (?:version|v\.?))? ?2\.0"),
    ("bsl-1.0", "boost", r"bsl-1\.0", r"boost software licen[cs]e"),
    ("busl-1.1", "business source", r"busl-1\.1", r"business source licen[cs]e"),
    ("sspl-1.0", "server side", r"sspl-1\.0", r"server side public licen[cs]e"),
    ("elastic-2.0", "elastic", r"elastic-2\.0", r"elastic licen[cs]e(?: v?2(?:\.0)?)?"),
    ("zlib", "zlib", r"zlib", r"zlib(?:/libpng)? licen[cs]e"),
    ("libpng", "libpng", r"libpng(?:-2\.0)?", r"libpng licen[cs]e"),
    ("openssl", "openssl", r"openssl", r"openssl licen[cs]e"),
    ("curl", "curl", r"curl", r"curl licen[cs]e"),
    ("python-2.0", "python", r"psf-2\.0|python-2\.0", r"python software foundation licen[cs]e"),
    ("php-3.01", "php", r"php-3\.0[01]?", r"php licen[cs]e"),
    ("ruby", "ruby", r"ruby", r"ruby licen[cs]e"),
    ("perl", "perl", r"perl", r"same terms as perl itself"),
    ("postgresql", "postgres", r"postgresql", r"postgresql licen[cs]e"),
    ("ncsa", "ncsa", r"ncsa", r"(?:university of illinois/)?ncsa(?: open source)? licen[cs]e"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl\b"),
    ("unlicense", "unlicense", r"unlicense", r"the unlicense"),
    ("vim", "vim", r"vim", r"vim licen[cs]e"),
    ("tcl", "tcl", r"tcl", r"tcl/tk licen[cs]e"),
    ("ftl", "freetype", r"ftl", r"freetype (?:project )?licen[cs]e"),
    ("ofl-1.1", "font license", r"ofl-1\.[01]", r"(?:sil )?open font license(?:,? (?:version|v\.?) ?1\.1)?"),
    ("ijg", "jpeg group", r"ijg", r"independent jpeg group licen[cs]e"),
    ("afl-3.0", "academic free", r"afl-[123]\.[0-2]", r"academic free licen[cs]e"),
    ("osl-3.0", "open software license", r"osl-[123]\.[0-2]", r"open software license"),
    ("ms-pl", "microsoft", r"ms-pl", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"ms-rl", r"microsoft reciprocal licen[cs]e"),
    ("qpl-1.0", "q public", r"qpl-1\.0", r"q public licen[cs]e"),
    ("sleepycat", "sleepycat", r"sleepycat", r"sleepycat licen[cs]e"),
    ("upl-1.0", "universal permissive", r"upl-1\.0", r"universal permissive licen[cs]e"),
    ("mulan-2.0", "mulan", r"mulanpsl-[12]\.0", r"mulan permissive software licen[cs]e"),
    ("w3c", "w3c", r"w3c(?:-19980720|-20150513)?", r"w3c software (?:notice and )?licen[cs]e"),
    ("ecl-2.0", "educational community", r"ecl-[12]\.0", r"educational community licen[cs]e"),
    ("lppl-1.3c", "latex", r"lppl-1\.[0-3][ac]?", r"latex project public licen[cs]e"),
    ("cecill-2.1", "cecill", r"cecill-[12]\.[01]|cecill-[bc]", r"cecill(?: free software)? licen[cs]e"),
    ("odbl-1.0", "database license", r"odbl-1\.0", r"open (?:data commons open )?database license"),
    ("odc-by-1.0", "data commons", r"odc-by-1\.0", r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", "data commons", r"pddl-1\.0", r"open data commons public domain dedication"),
    ("ogl-uk-3.0", "open government", r"ogl-uk-[123]\.0", r"open government licen[cs]e(?: v?[123]\.0)?"),
    ("cc0-1.0", "cc0", r"cc0-1\.0", r"cc0(?: 1\.0(?: universal)?)?"),
    ("openrail", "rail", r"openrail(?:\+\+)?", r"open ?rail(?:-[ms])? licen[cs]e"),
]

#: Creative Commons: part after "by", its words in full.
_COMMONS = [
    ("cc-by-nc-nd", r"[- ]nc[- ]nd", r"[- ]non-?commercial[- ]no ?-?deriv(?:ative)?s?"),
    ("cc-by-nc-sa", r"[- ]nc[- ]sa", r"[- ]non-?commercial[- ]share-? ?alike"),
    ("cc-by-nc", r"[- ]nc", r"[- ]non-?commercial"),
    ("cc-by-nd", r"[- ]nd", r"[- ]no ?-?deriv(?:ative)?s?"),
    ("cc-by-sa", r"[- ]sa", r"[- ]share-? ?alike"),
    ("cc-by", r"", r""),
]
_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

#: label, gate, keyword, pattern, score: notices and sentences of licence texts.
_PHRASES = [
    ("mit", "permission", "free of charge", r"permission is hereby granted,\s+free of charge,\s+to any person obtaining a copy", 0.95),
    ("isc", "permission", "hereby granted", r"permission to use,\s+copy,\s+modify,\s+and(?:/or)? distribute this software for any purpose", 0.9),
    ("bsd-2-clause", "redistribution", "binary forms", r"redistribution and use in source and binary forms,\s+with or without\s+modification", 0.8),
    ("bsd-3-clause", "redistribution", "endorse", r"neither the name of [^\n]{0,80} nor the names of its\s+contributors may be used to endorse", 0.9),
    ("gpl", "free software", "redistribute it", r"free software[:;,]? you can redistribute it and/or modify\s+it under the terms", 0.9),
    ("gpl", "general public license", "general public license", r"(?:gnu )?general public license", 0.7),
    ("lgpl", "general public license", "lesser", r"(?:gnu )?lesser general public license", 0.8),
    ("lgpl", "general public license", "library", r"(?:gnu )?library general public license", 0.8),
    ("apache", "licen", "apache", r"apache(?: software)? license", 0.7),
    ("bsd", "licen", "bsd", r"bsd(?:-style)? licen[cs]e", 0.6),
    ("creative-commons", "creative commons", "creative commons", r"creative commons(?: attribution)? licen[cs]e", 0.7),
    ("public-domain", "public domain", "public domain", r"(?:released|placed|dedicated|put) (?:in|into|to) the public domain", 0.8),
    ("reserved", "rights reserved", "rights reserved", r"all rights reserved", 0.6),
    ("some-reserved", "rights reserved", "rights reserved", r"some rights reserved", 0.6),
    ("no-reserved", "rights reserved", "rights reserved", r"no rights reserved", 0.6),
    ("copyright", "copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d(?: ?[-,–] ?(?:19|20)\d\d)*", 0.5),
    ("copyleft", "copyleft", "copyleft", r"copyleft\b", 0.4),
    ("proprietary", "proprietary", "confidential", r"proprietary and confidential|confidential and proprietary", 0.7),
    ("proprietary", "licen", "proprietary", r"proprietary licen[cs]e", 0.7),
    ("commercial", "licen", "commercial", r"commercial licen[cs]e (?:agreement|is required|from)", 0.6),
    ("eula", "licen", "end user", r"end[- ]user licen[cs]e agreement", 0.7),
    ("no-warranty", "warrant", "as is", r"provided [\"“]?as is[\"”]?,? without (?:any )?(?:express or implied )?warrant(?:y|ies)", 0.3),
]

#: Openings, headers and notices as they stand in licence texts and files: label, gate, keyword, pattern, score.
_TEXTS = [
    ("apache-2.0", "compliance", "apache", r"licensed under the apache license,? version 2\.0 \(the [\"“]?license[\"”]?\);? you may not use this file except in compliance", 1.0),
    ("apache-2.0", "terms and conditions", "apache", r"apache license version 2\.0,? january 2004", 1.0),
    ("apache-1.1", "redistribution", "apache software foundation", r"this product includes software developed by the apache software foundation", 0.8),
    ("mpl-2.0", "source code form", "mozilla", r"this source code form is subject to the terms of the mozilla public license,? v\. ?2\.0", 1.0),
    ("mpl-1.1", "contents of this file", "mozilla", r"the contents of this file are subject to the mozilla public license version 1\.1", 1.0),
    ("epl-1.0", "accompanying materials", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1\.0", 1.0),
    ("epl-2.0", "accompanying materials", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v ?\. ?)?2\.0", 1.0),
    ("edl-1.0", "accompanying materials", "eclipse distribution", r"made available under the terms of the eclipse distribution license", 0.9),
    ("cddl", "contents of this file", "common development", r"the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("gpl", "received a copy", "general public license", r"you should have received a copy of the gnu general public license", 0.9),
    ("lgpl", "received a copy", "lesser", r"you should have received a copy of the gnu lesser general public license", 0.9),
    ("lgpl", "received a copy", "library", r"you should have received a copy of the gnu library general public license", 0.9),
    ("agpl-3.0", "received a copy", "affero", r"you should have received a copy of the gnu affero general public license", 0.9),
    ("gpl-2.0", "verbatim copies", "june 1991", r"gnu general public license version 2,? june 1991", 1.0),
    ("gpl-3.0", "verbatim copies", "june 2007", r"gnu general public license version 3,? 29 june 2007", 1.0),
    ("lgpl-2.1", "verbatim copies", "february 1999", r"gnu lesser general public license version 2\.1,? february 1999", 1.0),
    ("lgpl-3.0", "verbatim copies", "june 2007", r"gnu lesser general public license version 3,? 29 june 2007", 1.0),
    ("agpl-3.0", "verbatim copies", "november 2007", r"gnu affero general public license version 3,? 19 november 2007", 1.0),
    ("gfdl", "permission is granted", "documentation license", r"permission is granted to copy,? distribute and/or modify this document under the terms of the gnu free documentation license", 0.9),
    ("gpl", "version", "later version", r"either version [123] of the license,? or \(at your option\) any later version", 0.8),
    ("zlib", "as-is", "warranty", r"this software is provided ['‘]as-is['’],? without any express or implied warranty", 0.8),
    ("zlib", "misrepresented", "origin", r"the origin of this software must not be misrepresented", 0.9),
    ("zlib", "altered source", "plainly marked", r"altered source versions must be plainly marked as such", 0.9),
    ("bsl-1.0", "permission", "person or organization", r"permission is hereby granted,? free of charge,? to any person or organization obtaining a copy", 0.95),
    ("mit", "substantial portions", "copyright notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.9),
    ("mit-0", "permission", "without limitation", r"mit no attribution", 0.9),
    ("x11", "x consortium", "advertising", r"except as contained in this notice,? the name of the x consortium shall not be used in advertising", 0.95),
    ("unlicense", "unencumbered", "public domain", r"this is free and unencumbered software released into the public domain", 1.0),
    ("wtfpl", "what the fuck", "public license", r"do what the fuck you want to(?: public license)?", 0.95),
    ("beerware", "beer", "in return", r"you can buy me a beer in return", 0.9),
    ("json", "good, not evil", "software", r"the software shall be used for good,? not evil", 0.9),
    ("isc", "permission", "with or without fee", r"(?<!permission to use, copy, modify, and distribute this software for any )(?<!permission to use, copy, modify, and/or distribute this software for any )purpose with or without fee is hereby granted,? provided that the above copyright notice", 0.9),
    ("bsd-4-clause", "advertising materials", "acknowledg", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 0.95),
    ("bsd-3-clause", "endorse", "specific prior", r"may (?:not )?be used to endorse or promote products derived from this software without specific prior written permission", 0.8),
    ("bsd", "redistributions", "source code must retain", r"redistributions of source code must retain the above copyright notice", 0.7),
    ("bsd", "redistributions", "binary form must", r"redistributions in binary form must reproduce the above copyright notice", 0.7),
    ("ncsa", "permission", "deal with the software", r"to deal with the software without restriction", 0.7),
    ("ofl-1.1", "font software", "open font", r"this font software is licensed under the sil open font license", 1.0),
    ("ofl-1.1", "reserved font name", "font", r"with reserved font names?", 0.8),
    ("artistic-1.0", "the intent of this document", "package", r"the intent of this document is to state the conditions under which a package may be copied", 0.9),
    ("cc0-1.0", "to the extent possible", "waived", r"to the extent possible under law,? .{0,200}?has waived all copyright and related or neighboring rights", 0.95),
    ("cc0-1.0", "associated a work", "public domain", r"the person who associated a work with this deed has dedicated the work to the public domain", 0.95),
    ("creative-commons", "this work is licensed", "creative commons", r"this work is licensed under (?:a|the) creative commons", 0.7),
    ("ms-pl", "accompanying software", "this license governs", r"this license governs use of the accompanying software", 0.8),
    ("python-2.0", "python software foundation", "agreement", r"this license agreement is between the python software foundation", 1.0),
    ("openssl", "openssl", "acknowledg", r"this product includes software developed by the openssl project", 0.9),
    ("perl", "perl", "same terms", r"under the same terms as perl itself", 0.9),
    ("ijg", "independent jpeg", "based in part", r"this software is based in part on the work of the independent jpeg group", 0.9),
    ("ftl", "freetype", "portions", r"portions of this software are copyright .{0,80}? the freetype project", 0.9),
    ("proprietary", "without the", "written permission", r"without the (?:express |prior |express prior )?written (?:permission|consent) of the (?:copyright )?(?:owner|holder|publisher|author)", 0.5),
    ("reserved", "rights", "reserved", r"all rights (?:are|not expressly granted are) reserved", 0.6),
    ("personal-use", "personal", "use only", r"for (?:personal|private)(?:,? non-?commercial)? use only", 0.5),
    ("no-redistribution", "redistribut", "may not", r"may not be (?:copied|reproduced|redistributed)(?: or redistributed)? without", 0.5),
]

_GRANT = r"(?:licen[cs]ed|released|available|distributed|published|covered|dual[- ]licen[cs]ed)\s+(?:to you\s+)?(?:under|by)\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?"
_TAG = r"(?:spdx-license-identifier|license(?:-expression)?|licence)[\"']?\s*[:=]\s*[\"']?"
#: The terms of an expression before the one that is looked for.
_TERMS = r"\(*(?:[a-z0-9.+-]+\)* (?:and|or|with) \(*)*?"
_BEFORE, _END = r"(?<![a-z0-9./_-])", r"(?![a-z0-9])"
#: An identifier that needs no word beside it: a name, a hyphen, a version or a clause.
_TELLING = re.compile(r"[a-z0-9]{3,}-(?:[0-9]|[a-z]+-?[0-9]|clause)")


def _identifiers(ids: str) -> list[tuple[str, str]]:
    """(pattern, what each match begins with) of the identifiers."""
    every = re.split(r"\|(?![^(]*\))", ids) if ids else []
    return [(one, re.match(r"[a-z0-9-]*", one)[0].rstrip("-")) for one in every]


def _rules() -> list[Rule]:
    out = []

    def add(label, priority, gate, keyword, pattern, score):
        out.append(Rule(label, priority, gate, keyword, re.compile(pattern), score))

    for label, keyword, ids, names in _LICENCES:
        gate = "licen" if names.endswith("licen[cs]e") else keyword
        for one, start in _identifiers(ids):
            add(label, 0, "licen", start, rf"{_TAG}{_TERMS}({one}){_END}", 1.0)
            add(label, 1, "under", start, rf"{_GRANT}{one}{_END}(?!\.[0-9])", 0.95)
            if _TELLING.match(one.replace("\\", "")):
                add(label, 2, "-", start, rf"{_BEFORE}{one}{_END}(?!\.[0-9])", 0.8)
        add(label, 1, gate, keyword, rf"{_GRANT}(?:{names})", 0.95)
        add(label, 2, gate, keyword, rf"(?<![a-z0-9])(?:{names})", 0.8)
    for label, short, full in _COMMONS:
        part = label.removeprefix("cc-")
        for version in _VERSIONS:
            v, named = re.escape(version), f"{label}-{version}"
            add(named, 0, "creativecommons", part, rf"creativecommons\.org/licenses/{part}/{v}", 1.0)
            add(named, 1, "cc by", version, rf"(?<![a-z0-9])cc by{short} {v}{_END}", 0.95)
            add(named, 1, "cc-by", version, rf"(?<![a-z0-9])cc-by{short}[- ]{v}{_END}", 0.95)
            name = rf"creative commons attribution{full} {v}(?: international| unported| generic)?"
            add(named, 1, "creative commons", version, name, 0.95)
        for gate in ("cc by", "cc-by"):
            add(label, 2, gate, gate, rf"(?<![a-z0-9]){gate}{short}{_END}", 0.8)
        add(label, 2, "creative commons", "attribution", rf"creative commons attribution{full}{_END}", 0.8)
    for label, gate, keyword, pattern, score in [*_PHRASES, *_TEXTS]:
        add(label, 3, gate, keyword, pattern, score)
    return sorted(out, key=lambda r: r.priority)


RULES = _rules()
