"""Signature rules of the license scan: label, priority, keyword and pattern, most telling first.

A pattern is a regular expression over the words of a text, lower-cased and each between two blanks, so that it
matches whole words only; a single blank in it stands between two words. ``ANY`` stands for one word of any kind.
A rule is tried only on texts that hold its keyword as a word. Priority 1 is a license with its version, 2 a license
without one, 3 a phrase of license texts, 4 a general mention.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


ANY = "[^ \x01]+"
VERSION = r"(?:version |ver |v |v)?"

#: Licenses that come in versions: label, keyword, names, versions (digits as words, "2 0" for 2.0; a lone "3" also is "3 0").
VERSIONED = [
    ("apache", "apache", ["apache (?:software )?license", "apache", "asl"], ["1 0", "1 1", "2 0"]),
    ("gpl", "general", ["gnu general public license", "general public license"], ["1", "2", "3"]),
    ("gpl", "gpl", ["gpl", "gnu gpl"], ["1", "2", "3"]),
    ("lgpl", "lesser", ["gnu lesser general public license", "lesser general public license"], ["2 1", "3"]),
    ("lgpl", "library", ["gnu library general public license", "library general public license"], ["2"]),
    ("lgpl", "lgpl", ["lgpl", "gnu lgpl"], ["2", "2 1", "3"]),
    ("agpl", "affero", ["gnu affero general public license", "affero general public license"], ["1", "3"]),
    ("agpl", "agpl", ["agpl", "gnu agpl"], ["1", "3"]),
    ("gfdl", "documentation", ["gnu free documentation license", "free documentation license"], ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla", ["mozilla public license"], ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", ["mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", ["eclipse public license"], ["1 0", "2 0"]),
    ("epl", "epl", ["epl"], ["1 0", "2 0"]),
    ("eupl", "union", ["european union public licen[cs]e"], ["1 0", "1 1", "1 2"]),
    ("eupl", "eupl", ["eupl"], ["1 0", "1 1", "1 2"]),
    ("cddl", "cddl", ["cddl"], ["1 0", "1 1"]),
    ("cddl", "distribution", ["common development and distribution license"], ["1 0", "1 1"]),
    ("cpl", "common", ["common public license"], ["1 0"]),
    ("artistic", "artistic", ["artistic license", "perl artistic license"], ["1 0", "2 0"]),
    ("boost", "boost", ["boost software license"], ["1 0"]),
    ("osl", "open", ["open software license"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", "academic", ["academic free license"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("ofl", "sil", ["sil open font license"], ["1 0", "1 1"]),
    ("ofl", "ofl", ["ofl"], ["1 0", "1 1"]),
    ("python", "python", ["python software foundation license", "python license"], ["2", "2 0"]),
    ("php", "php", ["php license"], ["3 0", "3 01"]),
    ("zpl", "zope", ["zope public license"], ["1 1", "2 0", "2 1"]),
    ("lppl", "latex", ["latex project public license"], ["1 0", "1 2", "1 3"]),
    ("mulan", "mulan", ["mulan permissive software license"], ["1", "2"]),
    ("odbl", "database", ["open database license"], ["1 0"]),
    ("odc-by", "attribution", ["open data commons attribution license"], ["1 0"]),
    ("cecill", "cecill", ["cecill", "cecill free software license"], ["1 0", "1 1", "2 0", "2 1"]),
    ("apsl", "apsl", ["apsl", "apple public source license"], ["1 0", "1 1", "1 2", "2 0"]),
    ("rpl", "reciprocal", ["reciprocal public license"], ["1 1", "1 5"]),
    ("sspl", "server", ["server side public license"], ["1"]),
    ("busl", "business", ["business source license"], ["1 0", "1 1"]),
    ("wtfpl", "wtfpl", ["wtfpl"], ["1", "2"]),
    ("ogl", "government", ["open government licen[cs]e"], ["1 0", "2 0", "3 0"]),
]

#: Elements of the shared commons licenses, in words and in letters, and the versions that exist.
COMMONS = [
    ("cc-by", "attribution", "by"),
    ("cc-by-sa", "attribution share(?: )?alike", "by sa"),
    ("cc-by-nd", "attribution no(?: )?deriv(?:ative)?s?(?: works)?", "by nd"),
    ("cc-by-nc", "attribution non(?: )?commercial", "by nc"),
    ("cc-by-nc-sa", "attribution non(?: )?commercial share(?: )?alike", "by nc sa"),
    ("cc-by-nc-nd", "attribution non(?: )?commercial no(?: )?deriv(?:ative)?s?(?: works)?", "by nc nd"),
]
COMMONS_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

#: Everything else, as it is written.
PLAIN = [
    Rule("mit", 2, "mit", "(?:the )?mit licen[cs]e"),
    Rule("mit", 2, "mit", "licensed under (?:the )?mit(?: licen[cs]e)?"),
    Rule("mit", 2, "x11", "(?:the )?x11 license"),
    Rule("mit", 2, "expat", "expat license"),
    Rule("mit", 3, "deal", "to deal in the software without restriction"),
    Rule("mit", 3, "merge", "use copy modify merge publish distribute sublicense and or sell"),
    Rule("mit", 3, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    Rule("mit", 3, "substantial", "copies or substantial portions of the software"),
    Rule("bsd-4-clause", 1, "bsd", "bsd (?:4|four) clause(?: license)?"),
    Rule("bsd-4-clause", 1, "bsd", "(?:4|four) clause bsd(?: license)?"),
    Rule("bsd-3-clause", 1, "bsd", "bsd (?:3|three) clause(?: license)?"),
    Rule("bsd-3-clause", 1, "bsd", "(?:3|three) clause bsd(?: license)?"),
    Rule("bsd-3-clause", 1, "bsd", "(?:new|revised|modified) bsd license"),
    Rule("bsd-2-clause", 1, "bsd", "bsd (?:2|two) clause(?: license)?"),
    Rule("bsd-2-clause", 1, "bsd", "(?:2|two) clause bsd(?: license)?"),
    Rule("bsd-2-clause", 1, "bsd", "(?:simplified|freebsd) bsd license"),
    Rule("0bsd", 1, "0bsd", "0bsd"),
    Rule("0bsd", 1, "bsd", "(?:bsd zero clause|zero clause bsd)(?: license)?"),
    Rule("bsd", 2, "bsd", "bsd (?:style )?licen[cs]e"),
    Rule("bsd", 2, "bsd", "licensed under (?:the )?bsd(?: (?:[0-9]|two|three|four) clause)?(?: licen[cs]e)?"),
    Rule("bsd-4-clause", 3, "advertising", "all advertising materials mentioning features or use of this software"),
    Rule("bsd-3-clause", 3, "endorse", "used to endorse or promote products derived from this software"),
    Rule("bsd", 3, "redistributions", "redistributions of source code must retain the above copyright notice"),
    Rule("bsd", 3, "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    Rule("bsd", 3, "redistribution", "redistribution and use in source and binary forms"),
    Rule("isc", 2, "isc", "(?:the )?isc license"),
    Rule("isc", 3, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    Rule("zlib", 2, "zlib", "(?:the )?zlib(?: libpng)? license"),
    Rule("zlib", 3, "misrepresented", "the origin of this software must not be misrepresented"),
    Rule("boost", 2, "boost", "boost software license"),
    Rule("unlicense", 2, "unlicense", "(?:the )?unlicense"),
    Rule("unlicense", 3, "unencumbered", "free and unencumbered software released into the public domain"),
    Rule("wtfpl", 2, "wtfpl", "wtfpl"),
    Rule("wtfpl", 2, "want", "do what the fuck you want to public license"),
    Rule("beerware", 2, "beerware", "beerware(?: license)?"),
    Rule("beerware", 2, "beer", "beer ware license"),
    Rule("apache", 2, "apache", "apache (?:software )?licen[cs]e"),
    Rule("apache", 2, "apache", "licensed under (?:the )?apache(?: (?:software )?license)?(?: version)?(?: [12] [01])?"),
    Rule("apache", 3, "compliance", "you may not use this file except in compliance with the license"),
    Rule("apache", 3, "conditions", "without warranties or conditions of any kind either express or implied"),
    Rule("gpl", 2, "gpl", "(?:gnu )?gpl"),
    Rule("gpl", 2, "general", "gnu general public license"),
    Rule("gpl", 2, "copyleft", "copyleft license"),
    Rule("gpl", 3, "redistribute", "you can redistribute it and or modify it under the terms of"),
    Rule("gpl", 3, "merchantability", "without even the implied warranty of merchantability"),
    Rule("lgpl", 2, "lgpl", "(?:gnu )?lgpl"),
    Rule("lgpl", 2, "lesser", "(?:gnu )?lesser general public license"),
    Rule("lgpl", 2, "library", "(?:gnu )?library general public license"),
    Rule("agpl", 2, "agpl", "(?:gnu )?agpl"),
    Rule("agpl", 2, "affero", "(?:gnu )?affero general public license"),
    Rule("gfdl", 2, "gfdl", "(?:gnu )?gfdl"),
    Rule("gfdl", 2, "documentation", "(?:gnu )?free documentation license"),
    Rule("mpl", 2, "mozilla", "mozilla public license"),
    Rule("mpl", 3, "mozilla", "subject to the terms of the mozilla public license"),
    Rule("epl", 2, "eclipse", "eclipse public license"),
    Rule("cddl", 2, "cddl", "cddl"),
    Rule("eupl", 2, "eupl", "eupl"),
    Rule("artistic", 2, "artistic", "artistic license"),
    Rule("perl", 2, "perl", "same terms as perl(?: itself)?"),
    Rule("python", 2, "python", "python software foundation license"),
    Rule("php", 2, "php", "php license"),
    Rule("ruby", 2, "ruby", "ruby license"),
    Rule("openssl", 2, "openssl", "openssl license"),
    Rule("openssl", 3, "openssl", "software developed by the openssl project"),
    Rule("postgresql", 2, "postgresql", "postgresql licen[cs]e"),
    Rule("ncsa", 2, "ncsa", "(?:university of illinois )?ncsa open source license"),
    Rule("curl", 2, "curl", "curl license"),
    Rule("vim", 2, "vim", "vim license"),
    Rule("tcl", 2, "tcl", "tcl(?: tk)? license"),
    Rule("w3c", 2, "w3c", "w3c software (?:notice and )?license"),
    Rule("ibm", 2, "ibm", "ibm public license"),
    Rule("intel", 2, "intel", "intel open source license"),
    Rule("ms-pl", 2, "microsoft", "microsoft public license"),
    Rule("ms-rl", 2, "microsoft", "microsoft reciprocal license"),
    Rule("ofl", 2, "ofl", "(?:sil )?ofl"),
    Rule("ofl", 2, "font", "(?:sil )?open font license"),
    Rule("odbl", 2, "odbl", "odbl"),
    Rule("pddl", 2, "pddl", "pddl"),
    Rule("pddl", 2, "dedication", "public domain dedication and license"),
    Rule("cc0", 1, "cc0", f"(?:creative commons )?cc0 {VERSION}1 0(?: universal)?"),
    Rule("cc0", 2, "cc0", "cc0"),
    Rule("cc0", 2, "zero", "creative commons zero"),
    Rule("cc0", 3, "waived", "has waived all copyright and related or neighboring rights"),
    Rule("creative-commons", 3, "creative", "(?:licensed|released|available|published) under (?:a |the )?creative commons"),
    Rule("creative-commons", 4, "creative", "creative commons"),
    Rule("creative-commons", 3, "creativecommons", "creativecommons org licenses"),
    Rule("public-domain", 2, "domain", "(?:is |are )?in the public domain"),
    Rule("public-domain", 2, "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    Rule("public-domain", 4, "domain", "public domain"),
    Rule("proprietary", 2, "proprietary", "proprietary and confidential"),
    Rule("proprietary", 2, "unauthorized", "unauthorized (?:copying|use|reproduction|distribution)"),
    Rule("proprietary", 2, "reproduced", "(?:may not|must not|cannot) be (?:copied|reproduced|distributed)"),
    Rule("proprietary", 2, "reproduced", "no part of this (?:book|publication|work|document|site) may be reproduced"),
    Rule("proprietary", 3, "permission", "without (?:the )?(?:prior |express )*(?:written )?permission"),
    Rule("proprietary", 3, "consent", "without (?:the )?(?:prior |express )*(?:written )?consent"),
    Rule("proprietary", 3, "trade", "trade secrets?"),
    Rule("reserved", 2, "reserved", "(?:some|no) rights reserved"),
    Rule("reserved", 3, "reservados", "todos los derechos reservados"),
    Rule("reserved", 3, "reservados", "todos os direitos reservados"),
    Rule("reserved", 3, "vorbehalten", "alle rechte vorbehalten"),
    Rule("reserved", 3, "réservés", "tous droits réservés"),
    Rule("reserved", 3, "riservati", "tutti i diritti riservati"),
    Rule("non-commercial", 3, "commercial", "(?:for )?non commercial (?:use|purposes)(?: only)?"),
    Rule("non-commercial", 3, "noncommercial", "(?:for )?noncommercial (?:use|purposes)(?: only)?"),
    Rule("non-commercial", 3, "personal", "for personal use only"),
    Rule("research-only", 3, "research", "(?:for )?(?:academic|research) (?:use|purposes) only"),
    Rule("evaluation", 3, "evaluation", "for evaluation (?:use|purposes) only"),
    Rule("freeware", 3, "freeware", "freeware"),
    Rule("shareware", 3, "shareware", "shareware"),
    Rule("trademark", 3, "trademarks", "(?:registered )?trademarks? (?:of|are) "
         + "(?:the property of )?their respective (?:owners|holders)"),
    Rule("trademark", 4, "trademark", "(?:is a )?registered trademark of"),
    Rule("no-warranty", 3, "warranty", "provided as is without warranty of any kind"),
    Rule("no-warranty", 3, "warranties", "without warranties of any kind"),
    Rule("no-warranty", 4, "warranty", "no warranty"),
    Rule("no-liability", 3, "liable", "in no event shall (?:the )?" + f"(?:{ANY} ){{1,8}}be liable"),
    Rule("copyright", 3, "copyright", "copyright (?:c )?[0-9]{4}(?: [0-9]{4})?"),
    Rule("copyright", 3, "copyrighted", "copyrighted material"),
    Rule("copyright", 4, "copyright", "copyright (?:notice|holders?|owners?)"),
    Rule("eula", 2, "eula", "eula"),
    Rule("eula", 2, "user", "end user licen[cs]e agreement"),
    Rule("terms", 4, "terms", "(?:subject to|under) the (?:following )?terms"),
    Rule("spdx", 3, "spdx", "spdx license identifier"),
    Rule("permissive", 4, "licensed", f"licensed under (?:the )?(?:{ANY} ){{0,3}}licen[cs]e"),
    Rule("permissive", 4, "released", f"released under (?:the )?(?:{ANY} ){{0,3}}licen[cs]e"),
    Rule("permissive", 4, "distributed", f"distributed under (?:the )?(?:{ANY} ){{0,3}}licen[cs]e"),
    Rule("open-source", 4, "source", "(?:free and )?open source (?:software )?license"),
]


def versioned() -> list[Rule]:
    made = []
    for label, keyword, names, versions in VERSIONED:
        for version in versions:
            number = f"{version}(?: 0)?" if version.isdigit() else version
            family = f"{label}-{version.replace(' ', '.')}"
            for name in names:
                made.append(Rule(family, 1, keyword, f"{name} {VERSION}{number}"))
                if label in ("gpl", "lgpl", "agpl", "gfdl"):
                    made.append(Rule(f"{family}-or-later", 1, keyword, f"{name} {VERSION}{number} or (?:at your option )?(?:any )?later(?: version)?"))
                    made.append(Rule(f"{family}-only", 1, keyword, f"{name} {VERSION}{number} only"))
            if keyword.endswith("gpl"):  # written as one word
                made.append(Rule(family, 1, f"{keyword}v{version[0]}", f"{keyword}v{number}"))
    for label, words, letters in COMMONS:
        for version in COMMONS_VERSIONS:
            family = f"{label}-{version.replace(' ', '.')}"
            made.append(Rule(family, 1, "cc", f"cc {letters} {VERSION}{version}(?: international| unported| generic)?"))
            made.append(Rule(family, 1, "creative", f"creative commons {words} {VERSION}{version}(?: international| unported| generic)?(?: licen[cs]e)?"))
            made.append(Rule(family, 1, "creativecommons", f"creativecommons org licenses {letters} {version}"))
        made.append(Rule(label, 2, "cc", f"cc {letters}(?: licen[cs]e)?"))
        made.append(Rule(label, 2, "creative", f"creative commons {words}(?: licen[cs]e)?"))
    return made


def rules() -> list[Rule]:
    """All rules in order: of equal priority and length the earlier one outranks the later."""
    return sorted([*versioned(), *PLAIN], key=lambda rule: rule.priority)
