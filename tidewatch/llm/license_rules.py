"""Signature rules for licenses: sentences of their texts, a table of licenses, and forms in which a
text names one."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

# Label, keywords, SPDX identifiers, ways to write the name, page on the web. A
# name is a pattern over lower-case text; white space in it stands for any white space. Keywords are
# alternatives of single words: every way to write the name has all words of one of them.
LICENSES = (
    ("mit", "mit|expat", "mit(?:-0)?", "mit|expat", r"opensource\.org/licenses/mit"),
    ("apache", "apache", r"apache-(?:1\.[01]|2\.0)", r"apache(?: software)?", r"www\.apache\.org/licenses"),
    ("gpl", "general public|gnu gpl", r"gpl-[123]\.0(?:-only|-or-later|\+)?", r"(?:gnu )?general public|gnu gpl", r"www\.gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("lgpl", "lesser general|library general", r"lgpl-[23]\.[01](?:-only|-or-later|\+)?", r"(?:gnu )?(?:lesser|library) general public", r"www\.gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "affero", r"agpl-[13]\.0(?:-only|-or-later|\+)?", r"(?:gnu )?affero general public", r"www\.gnu\.org/licenses/agpl"),
    ("gfdl", "free documentation", r"gfdl-1\.[123](?:-only|-or-later)?", r"(?:gnu )?free documentation", r"www\.gnu\.org/licenses/fdl"),
    ("bsd", "bsd", r"0?bsd(?:-[1234]-clause)?", r"(?:new |modified |simplified |original |[234]-clause )?bsd(?: [234]-clause)?", r"opensource\.org/licenses/bsd"),
    ("isc", "isc|internet consortium", "isc", "isc|internet systems consortium", r"opensource\.org/licenses/isc"),
    ("mpl", "mozilla", r"mpl-[12]\.[01]", "mozilla public", r"(?:www\.)?mozilla\.org/mpl"),
    ("epl", "eclipse public", r"epl-[12]\.0", "eclipse public", r"www\.eclipse\.org/legal/epl"),
    ("edl", "eclipse distribution", "bsd-3-clause-edl", "eclipse distribution", r"www\.eclipse\.org/org/documents/edl"),
    ("cddl", "cddl|common development", r"cddl-1\.[01]", "common development and distribution|cddl", r"opensource\.org/licenses/cddl"),
    ("cpl", "common public", r"cpl-1\.0", "common public", r"opensource\.org/licenses/cpl"),
    ("eupl", "european union public", r"eupl-1\.[012]", "european union public", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    ("artistic", "artistic", r"artistic-[12]\.0", "(?:perl )?artistic", r"opensource\.org/licenses/artistic"),
    ("zlib", "zlib", "zlib", "zlib(?:/libpng)?", r"opensource\.org/licenses/zlib"),
    ("boost", "boost", r"bsl-1\.0", "boost(?: software)?", r"www\.boost\.org/license"),
    ("unlicense", "unlicense", "unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl|fuck", "wtfpl", "wtfpl|do what the fuck you want to public", r"www\.wtfpl\.net"),
    ("python", "python|psf", r"psf-2\.0|python-2\.0", "python(?: software foundation)?|psf", r"docs\.python\.org/.{0,20}license"),
    ("php", "php", r"php-3\.0[01]?", "php", r"www\.php\.net/license"),
    ("ruby", "ruby", "ruby", "ruby", r"www\.ruby-lang\.org/.{0,10}license"),
    ("openssl", "openssl", "openssl", "openssl", r"www\.openssl\.org/source/license"),
    ("ofl", "open font", r"ofl-1\.[01]", "(?:sil )?open font", r"scripts\.sil\.org/ofl"),
    ("postgresql", "postgresql", "postgresql", "postgresql", r"www\.postgresql\.org/about/licen[cs]e"),
    ("ms-pl", "microsoft public", "ms-pl", "microsoft public", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", "microsoft reciprocal", "ms-rl", "microsoft reciprocal", r"opensource\.org/licenses/ms-rl"),
    ("ncsa", "ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)?", r"opensource\.org/licenses/(?:uoi-)?ncsa"),
    ("afl", "academic free", r"afl-[123]\.[012]", "academic free", r"opensource\.org/licenses/afl"),
    ("osl", "open software", r"osl-[123]\.[01]", "open software", r"opensource\.org/licenses/osl"),
    ("ecl", "educational community", r"ecl-[12]\.0", "educational community", r"opensource\.org/licenses/ecl"),
    ("cecill", "cecill", r"cecill-(?:b|c|[12]\.[01])", "cecill(?:-[bc])?", r"(?:www\.)?cecill\.info"),
    ("qpl", "q public", r"qpl-1\.0", "q public", r"opensource\.org/licenses/qtpl"),
    ("sleepycat", "sleepycat", "sleepycat", "sleepycat", r"opensource\.org/licenses/sleepycat"),
    ("vim", "vim", "vim", "vim", r"vimdoc\.sourceforge\.net/.{0,30}license"),
    ("w3c", "w3c", "w3c(?:-[0-9]+)?", "w3c(?: software)?", r"www\.w3\.org/consortium/legal/.{0,30}software"),
    ("zope", "zope", r"zpl-[12]\.[01]", "zope public", r"opensource\.org/licenses/zpl"),
    ("upl", "universal permissive", r"upl-1\.0", "universal permissive", r"opensource\.org/licenses/upl"),
    ("blueoak", "blue oak", r"blueoak-1\.0\.0", "blue oak model", r"blueoakcouncil\.org/license"),
    ("mulan", "mulan", r"mulanpsl-[12]\.0", "mulan permissive software", r"license\.coscl\.org\.cn/mulan"),
    ("sspl", "server side public", r"sspl-1\.0", "server side public", r"www\.mongodb\.com/licensing/server-side"),
    ("busl", "business source", r"busl-1\.1", "business source", r"mariadb\.com/bsl"),
    ("elastic", "elastic", r"elastic-2\.0", "elastic", r"www\.elastic\.co/licensing/elastic"),
    ("commons-clause", "commons clause", "commons-clause", "commons clause", r"commonsclause\.com"),
    ("odbl", "open database", r"odbl-1\.0", "open database", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by", "open data commons", r"odc-by-1\.0", "open data commons attribution", r"opendatacommons\.org/licenses/by"),
    ("pddl", "public domain dedication", r"pddl-1\.0", "public domain dedication(?: and)?", r"opendatacommons\.org/licenses/pddl"),
    ("cc0", "cc0|creative zero|cc zero", r"cc0-1\.0", r"cc0|creative commons zero|cc zero", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by", "cc|creative", r"cc-by-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)(?! ?-? ?(?:nc|sa|nd|non|share|no))", r"creativecommons\.org/licenses/by/"),
    ("cc-by-sa", "cc|creative", r"cc-by-sa-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:sa|share ?-?alike)", r"creativecommons\.org/licenses/by-sa"),
    ("cc-by-nd", "cc|creative", r"cc-by-nd-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nd|no ?-?deriv\w*)", r"creativecommons\.org/licenses/by-nd"),
    ("cc-by-nc", "cc|creative", r"cc-by-nc-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|non ?-?commercial)(?! ?-? ?(?:sa|nd|share|no ?-?deriv))", r"creativecommons\.org/licenses/by-nc/"),
    ("cc-by-nc-sa", "cc|creative", r"cc-by-nc-sa-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|non ?-?commercial)[ -](?:sa|share ?-?alike)", r"creativecommons\.org/licenses/by-nc-sa"),
    ("cc-by-nc-nd", "cc|creative", r"cc-by-nc-nd-[1234]\.[05]", r"(?:cc|creative commons)[ -](?:by|attribution)[ -](?:nc|non ?-?commercial)[ -](?:nd|no ?-?deriv\w*)", r"creativecommons\.org/licenses/by-nc-nd"),
)

# Form, keyword, pattern, priority, score.
FORMS = (
    ("spdx", "spdx", r"spdx-license-identifier:? *(?:{spdx})\b", 5, 1.0),
    ("granted", "under", r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistribute it)(?: and/or modified| to you)?(?: only)? under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})\b(?: public)?(?: licen[cs]e)?(?:,? (?:version|v) ?[0-9.]*[0-9]| [0-9]\.[0-9])?", 4, 0.95),
    ("subject", "subject", r"subject to (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: licen[cs]e\b(?:,? (?:version|v) ?[0-9.]*[0-9])?|,? (?:version|v) ?[0-9.]*[0-9])", 3, 0.9),
    ("page", "://", r"https?://{page}[^\s\"'<>]*", 3, 0.9),
    ("titled", "licen", r"\b(?:{name}) licen[cs]e(?:,? (?:version|v)? ?[0-9.]*[0-9])?", 2, 0.8),
    ("field", "licen", r"\blicen[cs]e:? (?:the )?(?:{name})\b", 1, 0.7),
)
# Label, short name as it is written with a version, such as GPLv3 or LGPL 2.1.
SHORT = (
    ("gpl", "gpl"),
    ("lgpl", "lgpl"),
    ("agpl", "agpl"),
    ("mpl", "mpl"),
    ("eupl", "eupl"),
    ("cddl", "cddl"),
)
#: A short name with its version, which tells it from other words of the same letters.
SHORT_FORM = r"(?<![a-z0-9-])(?:gnu )?{short}(?: ?-?v(?:ersion)? ?|[ -])[1-3](?:\.[0-9])?(?:\+|\b)(?![a-z0-9.]*[a-z0-9])"
# Label, word that the text has, sentence that tells a license's text or notice from
# others, as a pattern over lower-case text. White space in it stands for any white space, with the marks
# of a comment's lines and quotation marks.
BODIES = (
    ("mit", "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the software\), to deal in the software without restriction"),
    ("mit", "permission", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("ncsa", "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the software\), to deal with the software without restriction"),
    ("boost", "permission", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("isc", "permission", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "permission", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("w3c", "permission", r"permission to copy, modify, and distribute this (?:work|software and its documentation), with or without modification, for any purpose and without fee or royalty is hereby granted"),
    ("upl", "permission", r"permission is hereby granted to any person obtaining a copy of this software, associated documentation and/or data"),
    ("gfdl", "permission", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("bsd", "redistribution", r"redistributions? and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("apache", "licensed", r"licensed under the apache license, version 2\.0 \(the license\); you may not use this file except in compliance with the license"),
    ("apache", "distributed", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an as is basis"),
    ("apache", "contributor", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("gpl", "redistribute", r"(?:this program|this software|this file) is free software[:;,] you can redistribute it and/or modify it under the terms of (?:version [23] of )?the gnu general public license"),
    ("gpl", "everyone", r"gnu general public license version [123],.{0,200}? everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("lgpl", "redistribute", r"(?:this library|this program|this software|this file) is free software[:;,] you can redistribute it and/or modify it under the terms of (?:version [23](?:\.1)? of )?the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute", r"(?:this program|this software|this file) is free software[:;,] you can redistribute it and/or modify it under the terms of (?:version 3 of )?the gnu affero general public license"),
    ("mpl", "mozilla", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mozilla", r"the contents of this file are subject to the mozilla public license"),
    ("epl", "eclipse", r"this program and the accompanying materials are (?:made available|provided) under the terms of the eclipse public license"),
    ("cddl", "distribution", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl", "accompanying", r"the accompanying program is provided under the terms of this common public license"),
    ("zlib", "warranty", r"this software is provided as-is['’”\x22]?, without any express or implied warranty\. in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", r"you just do what the fuck you want to"),
    ("artistic", "intent", r"the intent of this (?:document|license) is to state the conditions under which a package may be copied"),
    ("artistic", "establishes", r"this license establishes the terms under which a given free software package may be copied, modified, distributed, and/or redistributed"),
    ("ofl", "licensed", r"this font software is licensed under the sil open font license"),
    ("python", "python", r"this license agreement is between the python software foundation"),
    ("php", "freely", r"this product includes php software, freely available from"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("cc0", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "commercially", r"you are free to:? share .{0,200}? adapt .{0,200}? for any purpose, even commercially"),
    ("ms-pl", "governs", r"this license governs use of the accompanying software\. if you use the software, you accept this license"),
    ("sspl", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("blueoak", "contributor", r"this license gives everyone as much permission to work with this software as possible, while protecting contributors from liability"),
    ("mulan", "contributor", r"subject to the terms and conditions of this license, each contributor hereby grants to you a perpetual, worldwide, royalty-free, non-exclusive, irrevocable copyright license to reproduce, use, modify, or distribute its contribution"),
    ("commons-clause", "license", r"the grant of rights under the license will not include, and the license does not grant to you, the right to sell the software"),
)
#: Between the words of such a sentence: white space, comment marks, quotation marks.
BODY_GAP = "[\\s*#/;%\"'`\u201c\u201d\u2018\u2019-]+"
BODY_QUOTE = "[\"'`\u201c\u201d\u2018\u2019]*"
BODY_PRIORITY = 6
BODY_SCORE = 1.0

#: A text without any of these cannot match a rule and is not looked at further.
GATE = (
    *("licen", "spdx", "under", "subject", "://"),
    *(short for _, short in SHORT),
    *sorted({keyword for _, keyword, _ in BODIES}),
)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    #: A text that the pattern matches has all words of one of these.
    keywords: tuple[tuple[str, ...], ...]
    pattern: re.Pattern
    priority: int
    score: float


@cache
def rules() -> tuple[Rule, ...]:
    """One rule for each sentence, and for each license and form, in the order of the tables."""
    made = []
    for number, (label, keyword, sentence) in enumerate(BODIES):
        # A quotation mark may stand inside brackets too: ("the Software").
        text = sentence.replace(r"\(", r"\(" + BODY_QUOTE).replace(r"\)", BODY_QUOTE + r"\)").replace(" ", BODY_GAP)
        made.append(
            Rule(f"{label}:text{number}", label, ((keyword,),), re.compile(text, re.DOTALL), BODY_PRIORITY, BODY_SCORE)
        )
    for label, keyword, spdx, name, page in LICENSES:
        for form, needed, pattern, priority, score in FORMS:
            text = pattern.replace("{spdx}", spdx).replace("{name}", name).replace("{page}", page)
            own = [()] if form in ("spdx", "page") else [ways.split() for ways in keyword.split("|")]
            keywords = tuple((needed, *words) for words in own)
            if form != "page":
                text = text.replace(" *", r"\s*").replace(" ?", r"\s?").replace(" ", r"\s+")
                text = text.replace("[\\s+-]", r"[\s-]+")
            made.append(
                Rule(f"{label}:{form}", label, keywords, re.compile(text), priority, score)
            )
    for label, short in SHORT:
        text = SHORT_FORM.replace("{short}", short).replace(" ?", r"\s?").replace("(?:gnu )", r"(?:gnu\s+)")
        text = text.replace("[ -]", r"[\s-]")
        made.append(Rule(f"{label}:short", label, ((short,),), re.compile(text), 1, 0.7))
    return tuple(made)
