"""License signature rules: keyword, pattern, label, priority and confidence.

Patterns are written over canonical words: lower-case words in which every word
has a space on each side (so two words in sequence are two spaces apart). In
a signature one space stands for that gap. Rules come from a table of licenses
and the ways in which a license is announced, plus single rules for notices of
another form. ``keywords`` are strings that every text the rule can match contains
in lower case; the first one, the anchor, is one of few.
"""

from __future__ import annotations

from dataclasses import dataclass

# priorities: a detection is suppressed by one around it of the same or a smaller number
IDENTIFIER, VERSIONED, NAMED, GENERIC = 1, 2, 3, 4
CONFIDENCE = {IDENTIFIER: 1.0, VERSIONED: 0.95, NAMED: 0.85, GENERIC: 0.5}


@dataclass(frozen=True)
class Rule:
    rule_id: str
    keywords: tuple
    signature: str
    label: str
    priority: int
    base: bool = False

    @property
    def pattern(self) -> str:
        """Regular expression over canonical text (common subset of Java and RE2)."""
        return " " + self.signature.replace(" ", "  ") + " "


# The contract's base phrases; their places are counted before any suppression.
BASE_RULES = (
    Rule("base-cc-by", ("cc",), "cc by", "cc-by", GENERIC, True),
    Rule("base-gpl", ("license",), "general public license", "gpl", GENERIC, True),
    Rule("base-reserved", ("reserved",), "all rights reserved", "reserved", GENERIC, True),
)

# (SPDX-like id, words of the id in a tag, full name, keyword of the full name)
LICENSES = (
    ("mit", "mit", "mit license", "mit"),
    ("apache-2.0", "apache 2 0", "apache license", "apache"),
    ("apache-1.1", "apache 1 1", "apache software license", "apache"),
    ("bsd-2-clause", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd) license", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd) license", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|original bsd) license", "bsd"),
    ("0bsd", "0bsd", "zero clause bsd license", "bsd"),
    ("gpl-2.0-only", "gpl 2 0 only", "gnu general public license version 2 only", "general public"),
    ("gpl-2.0-or-later", "gpl 2 0 or later", "gnu general public license version 2 or (?:any )?later", "general public"),
    ("gpl-3.0-only", "gpl 3 0 only", "gnu general public license version 3 only", "general public"),
    ("gpl-3.0-or-later", "gpl 3 0 or later", "gnu general public license version 3 or (?:any )?later", "general public"),
    ("lgpl-2.1", "lgpl 2 1(?: (?:only|or later))?", "gnu lesser general public license version 2 1", "lesser general"),
    ("lgpl-3.0", "lgpl 3 0(?: (?:only|or later))?", "gnu lesser general public license version 3", "lesser general"),
    ("lgpl-2.0", "lgpl 2 0(?: (?:only|or later))?", "gnu library general public license", "library general"),
    ("agpl-3.0", "agpl 3 0(?: (?:only|or later))?", "gnu affero general public license", "affero"),
    ("gfdl-1.3", "gfdl 1 3(?: (?:only|or later))?", "gnu free documentation license", "free documentation"),
    ("mpl-1.1", "mpl 1 1", "mozilla public license version 1 1", "mozilla"),
    ("mpl-2.0", "mpl 2 0", "mozilla public license(?: version)?(?: 2 0)?", "mozilla"),
    ("epl-1.0", "epl 1 0", "eclipse public license(?: version)? 1 0", "eclipse"),
    ("epl-2.0", "epl 2 0", "eclipse public license(?: version)? 2 0", "eclipse"),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e", "european union"),
    ("cddl-1.0", "cddl 1 0", "common development and distribution license", "common development"),
    ("cpl-1.0", "cpl 1 0", "common public license", "common public"),
    ("isc", "isc", "isc license", "isc"),
    ("zlib", "zlib", "zlib license", "zlib"),
    ("bsl-1.0", "bsl 1 0", "boost software license", "boost"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public license", "you want to public"),
    ("artistic-1.0", "artistic 1 0", "artistic license 1 0", "artistic"),
    ("artistic-2.0", "artistic 2 0", "artistic license(?: 2 0)?", "artistic"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("python-2.0", "python 2 0", "python software foundation license", "python software"),
    ("psf-2.0", "psf 2 0", "psf license agreement", "psf"),
    ("ruby", "ruby", "ruby license", "ruby"),
    ("php-3.01", "php 3 01", "php license", "php"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("ncsa", "ncsa", "university of illinois ncsa open source license", "ncsa"),
    ("ms-pl", "ms pl", "microsoft public license", "microsoft public"),
    ("ms-rl", "ms rl", "microsoft reciprocal license", "microsoft reciprocal"),
    ("ofl-1.1", "ofl 1 1", "sil open font license", "open font"),
    ("upl-1.0", "upl 1 0", "universal permissive license", "universal permissive"),
    ("odbl-1.0", "odbl 1 0", "open database license", "open database"),
    ("pddl-1.0", "pddl 1 0", "public domain dedication and license", "public domain"),
    ("odc-by-1.0", "odc by 1 0", "open data commons attribution license", "open data commons"),
    ("cc0-1.0", "cc0 1 0", "cc0(?: 1 0)?(?: universal)?", "cc0"),
    ("cecill-2.1", "cecill 2 1", "cecill free software license", "cecill"),
    ("sspl-1.0", "sspl 1 0", "server side public license", "server side"),
    ("busl-1.1", "busl 1 1", "business source license", "business source"),
    ("elastic-2.0", "elastic 2 0", "elastic license", "elastic"),
    ("openrail", "(?:bigscience )?openrail m?", "responsible ai license", "responsible ai"),
    ("blueoak-1.0.0", "blueoak 1 0 0", "blue oak model license", "blue oak"),
    ("mulan-psl-2.0", "mulanpsl 2 0", "mulan permissive software license", "mulan"),
    ("afl-3.0", "afl 3 0", "academic free license", "academic free"),
    ("osl-3.0", "osl 3 0", "open software license", "open software"),
    ("qpl-1.0", "qpl 1 0", "q public license", "q public"),
    ("ipl-1.0", "ipl 1 0", "ibm public license", "ibm public"),
    ("nasa-1.3", "nasa 1 3", "nasa open source agreement", "nasa"),
    ("w3c", "w3c", "w3c software (?:notice and )?license", "w3c"),
    ("x11", "x11", "x11 license", "x11"),
    ("curl", "curl", "curl license", "curl"),
    ("vim", "vim", "vim license", "vim"),
    ("etalab-2.0", "etalab 2 0", "licence ouverte", "licence ouverte"),
    ("ogl-uk-3.0", "ogl uk 3 0", "open government licence", "open government"),
)

# Creative Commons elements: (id, words of the short form, words of the long form)
CC_ELEMENTS = (
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share(?: )?alike"),
    ("by-nc", "by nc", "attribution non(?: )?commercial"),
    ("by-nd", "by nd", "attribution no(?: )?deriv(?:ative)?s?"),
    ("by-nc-sa", "by nc sa", "attribution non(?: )?commercial share(?: )?alike"),
    ("by-nc-nd", "by nc nd", "attribution non(?: )?commercial no(?: )?deriv(?:ative)?s?"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Versions of the families whose name alone does not tell the license
FAMILIES = (
    ("gpl", "general public", "general public license", ("1", "2", "3")),
    ("lgpl", "lesser general", "lesser general public license", ("2", "2 1", "3")),
    ("agpl", "affero", "affero general public license", ("1", "3")),
    ("apache", "apache", "apache license", ("1 0", "1 1", "2 0")),
    ("mpl", "mozilla", "mozilla public license", ("1 0", "1 1", "2 0")),
    ("gfdl", "free documentation", "free documentation license", ("1 1", "1 2", "1 3")),
)
SHORT_FAMILIES = (("gpl", "gpl", ("1", "2", "3")), ("lgpl", "lgpl", ("2", "2 1", "3")), ("agpl", "agpl", ("1", "3")),
                  ("mpl", "mpl", ("1 0", "1 1", "2 0")), ("gfdl", "gfdl", ("1 1", "1 2", "1 3")))

NOTICES = (
    Rule("copyright-year", ("copyright",), "copyright (?:c |© )?[0-9][0-9][0-9][0-9]", "copyright", GENERIC),
    Rule("copyright-by", ("copyright",), "copyright by", "copyright", GENERIC),
    Rule("some-rights", ("reserved",), "some rights reserved", "some-rights-reserved", GENERIC),
    Rule("no-rights", ("reserved",), "no rights reserved", "public-domain", NAMED),
    Rule("public-domain", ("public", "domain"), "(?:in|into|to) the public domain", "public-domain", NAMED),
    Rule("public-domain-mark", ("public", "domain"), "public domain mark", "public-domain", NAMED),
    Rule("proprietary", ("proprietary",), "proprietary and confidential", "proprietary", NAMED),
    Rule("no-redistribution", ("redistribut",), "may not be redistributed", "no-redistribution", NAMED),
    Rule("personal-use", ("personal", "use"), "for personal use only", "personal-use", NAMED),
    Rule("noncommercial-only", ("commercial",), "for non(?: )?commercial use only", "noncommercial", NAMED),
    Rule("no-ai-training", ("training",), "(?:not|never) be used for (?:ai|machine learning|model) training", "no-ai-training", NAMED),
    Rule("mit-grant", ("hereby", "granted"), "permission is hereby granted free of charge", "mit", NAMED),
    Rule("isc-grant", ("permission", "distribute"), "permission to use copy modify and or distribute this software", "isc", NAMED),
    Rule("bsd-grant", ("redistribution", "and", "use"), "redistribution and use in source and binary forms", "bsd", NAMED),
    Rule("gpl-grant", ("free", "software"), "this program is free software", "gpl", GENERIC),
    Rule("as-is", ("warranty",), "as is without warranty", "disclaimer", GENERIC),
    Rule("cc-generic", ("creative", "commons"), "creative commons licen[cs]e", "cc", GENERIC),
    Rule("cc-legal-code", ("creativecommons",), "creativecommons org licenses", "cc", GENERIC),
    Rule("cc-zero-url", ("creativecommons",), "creativecommons org publicdomain zero 1 0", "cc0-1.0", IDENTIFIER),
    Rule("cc-pd-url", ("creativecommons",), "creativecommons org publicdomain mark 1 0", "public-domain", IDENTIFIER),
    Rule("apache-url", ("apache",), "apache org licenses license 2 0", "apache-2.0", IDENTIFIER),
    Rule("gnu-gpl-url", ("gnu",), "gnu org licenses gpl(?: [0-9] [0-9])?", "gpl", NAMED),
    Rule("gnu-lgpl-url", ("gnu",), "gnu org licenses lgpl(?: [0-9] [0-9])?", "lgpl", NAMED),
    Rule("gnu-agpl-url", ("gnu",), "gnu org licenses agpl(?: [0-9] [0-9])?", "agpl", NAMED),
    Rule("mit-url", ("opensource",), "opensource org licen[cs]es? mit", "mit", IDENTIFIER),
)

# Sentences that stand in license texts, file headers and notices, one rule each (fixed values).
SENTENCES = (
    Rule("mit-notice", ("permission", "notice"), "above copyright notice and this permission notice shall be included", "mit", NAMED),
    Rule("mit-deal", ("restriction", "software"), "to deal in the software without restriction", "mit", NAMED),
    Rule("bsd-source", ("redistribution", "retain"), "redistributions of source code must retain the above copyright notice", "bsd", NAMED),
    Rule("bsd-binary", ("redistribution", "reproduce"), "redistributions in binary form must reproduce the above copyright notice", "bsd", NAMED),
    Rule("bsd-endorse", ("endorse", "promote"), "to endorse or promote products derived from this software", "bsd-3-clause", NAMED),
    Rule("bsd-advertising", ("advertising", "materials"), "all advertising materials mentioning features or use of this software", "bsd-4-clause", NAMED),
    Rule("isc-disclaimer", ("disclaim", "warrant"), "is provided as is and the author disclaims all warranties", "isc", NAMED),
    Rule("zlib-disclaimer", ("warranty", "implied"), "provided as is without any express or implied warranty", "zlib", NAMED),
    Rule("zlib-origin", ("misrepresented", "origin"), "the origin of this software must not be misrepresented", "zlib", NAMED),
    Rule("zlib-altered", ("altered", "plainly"), "altered source versions must be plainly marked as such", "zlib", NAMED),
    Rule("bsl-grant", ("hereby", "organization"), "permission is hereby granted free of charge to any person or organization obtaining a copy", "bsl-1.0", NAMED),
    Rule("unlicense-grant", ("unencumbered", "domain"), "free and unencumbered software released into the public domain", "unlicense", NAMED),
    Rule("unlicense-dedication", ("dedicat", "public"), "dedicates? any and all copyright interest in the software to the public domain", "unlicense", NAMED),
    Rule("apache-basis", ("warrant", "basis"), "distributed on an as is basis without warranties or conditions of any kind", "apache-2.0", NAMED),
    Rule("apache-contributor", ("hereby", "contributor"), "each contributor hereby grants to you a perpetual worldwide non exclusive", "apache-2.0", NAMED),
    Rule("apache-notice", ("apache", "foundation"), "includes software developed (?:by|at) the apache software foundation", "apache", NAMED),
    Rule("license-file", ("licen", "compliance"), "may not use this file except in compliance with the licen[cs]e", "license-header", GENERIC),
    Rule("license-copy-at", ("licen", "obtain"), "may obtain a copy of the licen[cs]e at", "license-header", GENERIC),
    Rule("license-see-file", ("licen", "found"), "licen[cs]e that can be found in the licen[cs]e file", "license-header", GENERIC),
    Rule("gpl-modify", ("licen", "redistribute", "general", "public"), "redistribute it and or modify it under the terms of the gnu general public license", "gpl", NAMED),
    Rule("lgpl-modify", ("licen", "redistribute", "lesser"), "redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl", NAMED),
    Rule("agpl-modify", ("licen", "redistribute", "affero"), "redistribute it and or modify it under the terms of the gnu affero general public license", "agpl", NAMED),
    Rule("gpl-copy", ("licen", "received"), "received a copy of the gnu general public license", "gpl", NAMED),
    Rule("lgpl-copy", ("licen", "received", "lesser"), "received a copy of the gnu lesser general public license", "lgpl", NAMED),
    Rule("agpl-copy", ("licen", "received", "affero"), "received a copy of the gnu affero general public license", "agpl", NAMED),
    Rule("gnu-or-later", ("licen", "later", "either"), "either version [0-9](?: [0-9])? of the license or (?:at your option )?any later version", "or-later", GENERIC),
    Rule("gnu-copyleft", ("licen", "copyleft"), "is a free copyleft license", "gpl-3.0", NAMED),
    Rule("gnu-freedom", ("licen", "freedom"), "licenses for most software are designed to take away your freedom", "gpl-2.0", NAMED),
    Rule("gnu-verbatim", ("permitted", "verbatim"), "everyone is permitted to copy and distribute verbatim copies of this license document", "license-text", GENERIC),
    Rule("gnu-merchantability", ("merchantability", "implied"), "without even the implied warranty of merchantability", "disclaimer", GENERIC),
    Rule("lgpl-library", ("free", "software", "library"), "this library is free software", "lgpl", GENERIC),
    Rule("agpl-remote", ("prominently", "remotely"), "must prominently offer all users interacting with it remotely", "agpl-3.0", NAMED),
    Rule("gfdl-grant", ("licen", "documentation"), "modify this document under the terms of the gnu free documentation license", "gfdl", NAMED),
    Rule("gfdl-covers", ("invariant", "cover"), "no invariant sections no front cover texts and no back cover texts", "gfdl", NAMED),
    Rule("exception-classpath", ("exception", "classpath"), "classpath exception", "classpath-exception", NAMED),
    Rule("exception-gcc", ("exception", "gcc"), "gcc runtime library exception", "gcc-exception", NAMED),
    Rule("exception-special", ("exception", "copyright"), "as a special exception the copyright holders?", "license-exception", GENERIC),
    Rule("mpl-form", ("licen", "mozilla", "source"), "source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", VERSIONED),
    Rule("mpl-contents", ("licen", "mozilla", "contents"), "contents of this file are subject to the mozilla public license", "mpl", NAMED),
    Rule("mpl-copy", ("mpl", "distributed"), "a copy of the mpl was not distributed with this file", "mpl-2.0", NAMED),
    Rule("mpl-secondary", ("licen", "incompatible"), "incompatible with secondary licenses", "mpl-2.0", NAMED),
    Rule("epl-materials", ("licen", "eclipse", "accompanying"), "accompanying materials are made available under the terms of the eclipse public license", "epl", NAMED),
    Rule("cddl-contents", ("licen", "common", "development"), "subject to the terms of the common development and distribution license", "cddl", NAMED),
    Rule("artistic-intent", ("package", "conditions"), "state the conditions under which a package may be copied", "artistic-1.0", NAMED),
    Rule("python-basis", ("python", "licensee"), "making python available to licensee on an as is basis", "python-2.0", NAMED),
    Rule("php-product", ("php", "product"), "this product includes php software", "php", NAMED),
    Rule("openssl-product", ("openssl", "project"), "includes software developed by the openssl project", "openssl", NAMED),
    Rule("unicode-agreement", ("licen", "unicode"), "unicode (?:inc )?license agreement", "unicode", NAMED),
    Rule("ofl-font", ("reserved", "font"), "(?:with )?reserved font names?", "ofl-1.1", NAMED),
    Rule("ofl-release", ("licen", "fonts"), "fonts and derivatives however cannot be released under any other type of license", "ofl-1.1", NAMED),
    Rule("vera-fonts", ("bitstream",), "bitstream vera(?: is a trademark)?", "bitstream-vera", NAMED),
    Rule("wtfpl-terms", ("fuck", "want"), "you just do what the fuck you want to", "wtfpl", NAMED),
    Rule("json-good", ("evil", "software"), "software shall be used for good not evil", "json", NAMED),
    Rule("hippocratic", ("licen", "hippocratic"), "hippocratic license", "hippocratic", NAMED),
    Rule("beerware", ("licen", "beer"), "(?:the )?beer(?: )?ware license", "beerware", NAMED),
    Rule("cc-share", ("redistribut", "medium"), "copy and redistribute the material in any medium or format", "cc", NAMED),
    Rule("cc-credit", ("licen", "appropriate", "credit"), "must give appropriate credit provide a link to the license", "cc", NAMED),
    Rule("cc-no-modified", ("modified", "distribute"), "you may not distribute the modified material", "cc-nd", NAMED),
    Rule("cc-same-license", ("licen", "contributions"), "distribute your contributions under the same license as the original", "cc-sa", NAMED),
    Rule("cc-no-commercial", ("commercial", "material"), "may not use the material for commercial purposes", "cc-nc", NAMED),
    Rule("cc-waived", ("waived", "copyright"), "waived all copyright and related or neighbou?ring rights", "cc0-1.0", NAMED),
    Rule("cc-text-available", ("licen", "available"), "text is available under the creative commons attribution share(?: )?alike license", "cc-by-sa", NAMED),
    Rule("odbl-contents", ("licen", "database"), "licensed under the database contents license", "odbl", NAMED),
    Rule("cdla", ("licen", "community", "data"), "community data license agreement(?: (?:permissive|sharing))?", "cdla", NAMED),
    Rule("sspl-service", ("functionality", "service"), "functionality of the program or (?:a )?modified version available to third parties as a service", "sspl-1.0", NAMED),
    Rule("busl-production", ("licen", "production"), "licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "busl-1.1", NAMED),
    Rule("elastic-hosted", ("hosted", "managed"), "provide the software to third parties as a hosted or managed service", "elastic-2.0", NAMED),
    Rule("commons-clause", ("commons", "clause"), "commons clause(?: license)? condition", "commons-clause", NAMED),
    Rule("commons-clause-sell", ("sell", "grant", "software"), "does not grant to you the right to sell the software", "commons-clause", NAMED),
    Rule("polyform", ("polyform",), "polyform (?:noncommercial|small business|strict|shield|perimeter)(?: license)?", "polyform", NAMED),
    Rule("openrail-use", ("restriction", "based"), "use based restrictions", "openrail", NAMED),
    Rule("llama-community", ("licen", "llama"), "llama(?: [0-9])?(?: [0-9])? community license(?: agreement)?", "llama", NAMED),
    Rule("gemma-terms", ("gemma",), "gemma terms of use", "gemma", NAMED),
    Rule("eula", ("licen", "user"), "end user licen[cs]e agreement", "eula", NAMED),
    Rule("not-sold", ("licen", "sold"), "is licensed not sold", "proprietary", NAMED),
    Rule("no-reverse", ("reverse", "engineer"), "not reverse engineer decompile or disassemble", "proprietary", NAMED),
    Rule("confidential-proprietary", ("proprietary", "confidential"), "confidential and proprietary", "proprietary", NAMED),
    Rule("unauthorized-copying", ("unauthori", "copying"), "unauthori[sz]ed copying of this (?:file|work|document)", "proprietary", NAMED),
    Rule("no-part", ("reproduced", "part"), "no part of this (?:publication|book|document|work|site) may be reproduced", "no-reproduction", NAMED),
    Rule("prior-permission", ("permission", "prior"), "without (?:the )?prior written permission of the (?:publisher|author|copyright holder|owner)", "no-reproduction", NAMED),
    Rule("whole-or-part", ("reproduction", "prohibited"), "reproduction in whole or in part (?:without (?:written )?permission )?is prohibited", "no-reproduction", NAMED),
    Rule("reprinted", ("permission", "reprinted"), "reprinted (?:with|by) (?:kind )?permission", "reprint-permission", GENERIC),
    Rule("no-copies", ("permission", "do"), "do not (?:copy|distribute|redistribute|share) without permission", "no-redistribution", NAMED),
    Rule("internal-use", ("internal", "only"), "for internal use only", "internal-use", NAMED),
    Rule("evaluation-only", ("evaluation", "only"), "for evaluation (?:purposes|use) only", "evaluation-only", NAMED),
    Rule("education-only", ("educational", "only"), "for educational (?:purposes|use) only", "education-only", NAMED),
    Rule("research-only", ("research", "only"), "for (?:academic |scientific )?research (?:purposes|use) only", "research-only", NAMED),
    Rule("not-for-resale", ("resale",), "not for resale", "no-redistribution", NAMED),
    Rule("not-for-commercial", ("commercial", "not"), "not for commercial (?:use|purposes|distribution)", "noncommercial", NAMED),
    Rule("no-mining", ("mining", "data"), "text and data mining (?:is |are )?(?:reserved|prohibited|not permitted|not allowed)", "no-text-mining", NAMED),
    Rule("mining-reserved", ("mining", "rights"), "rights (?:to|for|of) text and data mining(?: are reserved)?", "no-text-mining", NAMED),
    Rule("no-scraping", ("scrap", "may"), "may not be scraped(?: or crawled)?", "no-scraping", NAMED),
    Rule("no-ai-purpose", ("training", "purpose"), "for the purposes? of training (?:artificial intelligence|machine learning|language models)", "no-ai-training", NAMED),
    Rule("us-government", ("government", "work"), "a work of the (?:united states|u s|us)(?: federal)? government", "us-government-work", NAMED),
    Rule("us-no-copyright", ("copyright", "protection"), "not subject to copyright protection in the united states", "us-government-work", NAMED),
    Rule("crown", ("copyright", "crown"), "crown copyright", "crown-copyright", NAMED),
    Rule("ogl-contains", ("licen", "public", "sector"), "contains public sector information licensed under", "ogl-uk", NAMED),
    Rule("dl-de", ("datenlizenz",), "datenlizenz deutschland(?: (?:namensnennung|zero))?", "dl-de", NAMED),
    Rule("reserved-de", ("vorbehalten",), "alle rechte vorbehalten", "all-rights-reserved", GENERIC),
    Rule("reserved-fr", ("droits", "tous"), "tous droits réservés", "all-rights-reserved", GENERIC),
    Rule("reserved-es", ("derechos", "todos"), "todos los derechos reservados", "all-rights-reserved", GENERIC),
    Rule("reserved-it", ("riservati", "diritti"), "tutti i diritti riservati", "all-rights-reserved", GENERIC),
    Rule("reserved-pt", ("direitos", "todos"), "todos os direitos reservados", "all-rights-reserved", GENERIC),
    Rule("gpl-es", ("licencia", "gnu"), "licencia pública general (?:de )?gnu", "gpl", NAMED),
    Rule("gpl-fr", ("licen", "publique"), "licence publique générale gnu", "gpl", NAMED),
    Rule("domain-de", ("gemeinfrei", "werk"), "werk ist gemeinfrei", "public-domain", NAMED),
    Rule("domain-fr", ("domaine", "public"), "(?:dans|appartient au|relève du) (?:le )?domaine public", "public-domain", NAMED),
    Rule("domain-es", ("dominio",), "(?:de|en el|al) dominio público", "public-domain", NAMED),
)


def _anchor(name: str) -> tuple:
    return ("licen",) if "licen" in name else ()


def _dotted(version: str) -> str:
    return version.replace(" ", ".")


def build_rules() -> tuple[Rule, ...]:
    """All rules in order; two rules never share an id."""
    rules = list(BASE_RULES)
    for spdx, words, name, keyword in LICENSES:
        rules.append(Rule(f"spdx-{spdx}", ("spdx",), f"spdx license identifier {words}", spdx, IDENTIFIER))
        rules.append(Rule(f"name-{spdx}", (*_anchor(name), *keyword.split()), name, spdx, NAMED))
        rules.append(Rule(f"under-{spdx}", ("licen", "under"), f"licen[cs]ed under (?:the )?(?:terms of (?:the )?)?(?:{name}|{words})"
                          "(?: licen[cs]e)?", spdx, VERSIONED))
    for element, short, long in CC_ELEMENTS:
        rules.append(Rule(f"cc-{element}", ("cc",), f"cc {short}", f"cc-{element}", NAMED))
        rules.append(Rule(f"cc-long-{element}", ("commons", "creative"), f"creative commons {long}", f"cc-{element}", NAMED))
        rules.append(Rule(f"cc-url-{element}", ("creativecommons",), f"creativecommons org licenses {short}", f"cc-{element}", NAMED))
        for version in CC_VERSIONS:
            label = f"cc-{element}-{_dotted(version)}"
            rules.append(Rule(f"cc-{element}-{version}", ("cc",), f"cc {short} {version}", label, VERSIONED))
            rules.append(Rule(f"cc-long-{element}-{version}", ("commons", "creative"),
                              f"creative commons {long} (?:[a-z]+ )?{version}", label, VERSIONED))
            rules.append(Rule(f"cc-url-{element}-{version}", ("creativecommons",),
                              f"creativecommons org licenses {short} {version}", label, IDENTIFIER))
    for family, keyword, name, versions in FAMILIES:
        for version in versions:
            rules.append(Rule(f"family-{family}-{version}", ("licen", *keyword.split()), f"{name} (?:version |v )?v?{version}",
                              f"{family}-{_dotted(version)}", VERSIONED))
    for family, keyword, versions in SHORT_FAMILIES:
        for version in versions:
            rules.append(Rule(f"short-{family}-{version}", (keyword,), f"{family} (?:version |v )?v?{version}",
                              f"{family}-{_dotted(version)}", VERSIONED))
    return tuple(rules) + NOTICES + SENTENCES
