"""License signatures: an ordered list of regular expressions over normalised words.

Texts are matched as lower-case words with single spaces between them, so
punctuation never matters: ``CC BY-NC 4.0`` reads ``cc by nc 4 0``. A family has
a title (with the word license), an optional short name, and the words of its
identifier and of its address, all written by hand below. Each becomes a rule
of its form; the legal texts' own sentences are rules of their own. Earlier
rules have priority: base phrases, sentences, tags, addresses, notices, titles,
short mentions.
"""

import re
from functools import cache
from typing import NamedTuple

class Rule(NamedTuple):
    name: str
    label: str
    keywords: tuple[str, ...]  # every match holds one of them
    pattern: re.Pattern
    confidence: float
    base: bool = False


# Phrases and labels of the base detections.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# label | title | short name | identifier words | address words
_FAMILIES = """
mit-0 | mit no attribution(?: license)? | mit 0 | mit 0 | opensource org licenses mit 0
mit | mit(?: x11| expat)? license | | mit | opensource org licenses mit(?: license)?(?: php)?
x11 | x11 license | | x11 | spdx org licenses x11
expat | expat license | | expat | directory fsf org wiki license expat
apache-1 | apache(?: software)? license(?: version| v)? 1(?: [01])? | apache 1 [01] | apache 1 [01] | apache org licenses license 1 [01]
apache-2 | apache(?: software)? license(?: version| v)? 2(?: 0)? | apache(?: v)? ?2(?: 0)? | apache 2 0 | apache org licenses license 2 0
agpl-1 | affero general public license(?: version| v) 1 | agpl v?1(?: 0)? | agpl 1 0(?: only| or later)? | affero org oagpl
agpl-3 | (?:gnu )?affero general public license(?: agpl)?(?: version| v)? 3(?: 0)? | (?:gnu )?agpl ?v?3(?: 0)? | agpl 3 0(?: only| or later)? | gnu org licenses agpl(?: 3 0)?
lgpl-2.1 | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v)? 2 1 | (?:gnu )?lgpl ?v?2 1 | lgpl 2 1(?: only| or later)? | gnu org licenses old licenses lgpl 2 1
lgpl-2 | (?:gnu )?(?:lesser|library) general public license(?: lgpl)?(?: version| v)? 2(?: 0)? | (?:gnu )?lgpl ?v?2(?: 0)? | lgpl 2 0(?: only| or later)? | gnu org licenses old licenses lgpl 2 0
lgpl-3 | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v)? 3(?: 0)? | (?:gnu )?lgpl ?v?3(?: 0)? | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl(?: 3 0)?
gpl-1 | (?:gnu )?general public license(?: gpl)?(?: version| v)? 1(?: 0)? | (?:gnu )?gpl ?v?1(?: 0)? | gpl 1 0(?: only| or later)? | gnu org licenses old licenses gpl 1 0
gpl-2 | (?:gnu )?general public license(?: gpl)?(?: version| v)? 2(?: 0)? | (?:gnu )?gpl ?v?2(?: 0)? | gpl 2 0(?: only| or later)? | gnu org licenses(?: old licenses)? gpl 2 0
gpl-3 | (?:gnu )?general public license(?: gpl)?(?: version| v)? 3(?: 0)? | (?:gnu )?gpl ?v?3(?: 0)? | gpl 3 0(?: only| or later)? | gnu org licenses gpl(?: 3 0)?
lgpl | (?:gnu )?(?:lesser|library) general public license | gnu lgpl | lgpl | gnu org copyleft lesser
agpl | (?:gnu )?affero general public license | gnu agpl | agpl | gnu org licenses why affero gpl
gpl | (?:gnu )?general public license | gnu gpl | gpl | gnu org copyleft gpl
gfdl-1.1 | (?:gnu )?free documentation license(?: version| v)? 1 1 | (?:gnu )?fdl 1 1 | gfdl 1 1(?: only| or later)? | gnu org licenses old licenses fdl 1 1
gfdl-1.2 | (?:gnu )?free documentation license(?: version| v)? 1 2 | (?:gnu )?fdl 1 2 | gfdl 1 2(?: only| or later)? | gnu org licenses old licenses fdl 1 2
gfdl-1.3 | (?:gnu )?free documentation license(?: version| v)? 1 3 | (?:gnu )?fdl 1 3 | gfdl 1 3(?: only| or later)? | gnu org licenses fdl 1 3
gfdl | (?:gnu )?free documentation license | gfdl | gfdl | gnu org copyleft fdl
bsd-0 | (?:zero clause|0 clause) bsd license | bsd 0 clause | 0bsd | opensource org licenses 0bsd
bsd-2 | (?:(?:two|2) clause|simplified|freebsd) (?:bsd )?license | bsd 2 clause | bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3 | (?:(?:three|3) clause|new|modified|revised) bsd license | bsd 3 clause | bsd 3 clause | opensource org licenses bsd 3 clause
bsd-4 | (?:(?:four|4) clause|original|old) bsd license | bsd 4 clause | bsd 4 clause | spdx org licenses bsd 4 clause
bsd | bsd(?: style)? license | bsd licensed | bsd | opensource org licenses bsd license
isc | isc license | | isc | opensource org licenses isc
zlib | zlib(?: libpng)? license | | zlib | opensource org licenses zlib
libpng | libpng license | | libpng(?: 2 0)? | libpng org pub png src libpng license
boost-1 | boost software license(?: version| v)?(?: 1(?: 0)?)? | | bsl 1 0 | boost org license 1 0
mpl-1.0 | mozilla public license(?: mpl)?(?: version| v)? 1 0 | mpl ?v?1 0 | mpl 1 0 | mozilla org mpl 1 0
mpl-1.1 | mozilla public license(?: mpl)?(?: version| v)? 1 1 | mpl ?v?1 1 | mpl 1 1 | mozilla org mpl 1 1
mpl-2 | mozilla public license(?: mpl)?(?: version| v)? 2(?: 0)? | mpl ?v?2(?: 0)? | mpl 2 0 | mozilla org mpl 2 0
mpl | mozilla public license | | mpl | mozilla org mpl
epl-1 | eclipse public license(?: epl)?(?: version| v)? 1(?: 0)? | epl ?v?1(?: 0)? | epl 1 0 | eclipse org legal epl v10
epl-2 | eclipse public license(?: epl)?(?: version| v)? 2(?: 0)? | epl ?v?2(?: 0)? | epl 2 0 | eclipse org legal epl 2 0
edl-1 | eclipse distribution license(?: version| v)? 1(?: 0)? | edl 1 0 | edl 1 0 | eclipse org org documents edl v10
cddl-1 | common development and distribution license(?: cddl)?(?: version| v)?(?: 1 [01])? | cddl(?: 1 [01])? | cddl 1 [01] | opensource org licenses cddl 1 0
cpl-1 | common public license(?: version| v)?(?: 1(?: 0)?)? | cpl 1 0 | cpl 1 0 | opensource org licenses cpl1 0
ipl-1 | ibm public license(?: version| v)?(?: 1(?: 0)?)? | | ipl 1 0 | opensource org licenses ipl 1 0
artistic-1 | (?:perl )?artistic license(?: version| v)? 1(?: 0)? | | artistic 1 0 | opensource org licenses artistic license 1 0
artistic-2 | artistic license(?: version| v)? 2(?: 0)? | | artistic 2 0 | perlfoundation org artistic license 2 0
artistic | artistic license | | artistic | opensource org licenses artistic license
psf-2 | python software foundation license(?: version| v)?(?: 2)? | psf license | (?:psf|python) 2 0 | python org psf license
php-3 | php license(?: version| v)?(?: 3(?: 0[01])?)? | | php 3 0[01]? | php net license
ruby | ruby license | | ruby | ruby lang org en about license txt
openssl | openssl license | | openssl | openssl org source license
postgresql | postgresql license | | postgresql | opensource org licenses postgresql
ncsa | university of illinois ncsa open source license | ncsa open source license | ncsa | opensource org licenses ncsa
w3c | w3c software(?: notice and)? license | | w3c | w3 org consortium legal copyright software
afl-3 | academic free license(?: version| v)?(?: [123](?: [01])?)? | afl ?v?3(?: 0)? | afl 3 0 | opensource org licenses afl 3 0
osl-3 | open software license(?: version| v)?(?: [123](?: [01])?)? | osl 3 0 | osl 3 0 | opensource org licenses osl 3 0
ms-pl | microsoft public license | ms pl | ms pl | opensource org licenses ms pl
ms-rl | microsoft reciprocal license | ms rl | ms rl | opensource org licenses ms rl
eupl-1.1 | european union public license(?: version| v)? 1 1 | eupl ?v?1 1 | eupl 1 1 | joinup ec europa eu community eupl og page eupl 1 1
eupl-1.2 | european union public license(?: version| v)? 1 2 | eupl ?v?1 2 | eupl 1 2 | joinup ec europa eu collection eupl eupl text eupl 12
cecill-2 | cecill(?: free software)? license(?: agreement)?(?: version| v)?(?: 2(?: [01])?)? | cecill 2 [01] | cecill 2 [01] | cecill info licences licence cecill v2
unlicense | the unlicense(?: license)? | | unlicense | unlicense org
wtfpl | do what the fuck you want to public license | wtfpl | wtfpl | wtfpl net
beerware | beer ?ware license | | beerware | spdx org licenses beerware
ofl-1.1 | sil open font license(?: version| v)?(?: 1 1)? | ofl 1 1 | ofl 1 1 | scripts sil org ofl
ubuntu-font | ubuntu font license(?: version| v)?(?: 1 0)? | | ubuntu font 1 0 | ubuntu com legal font licence
odbl-1 | open (?:data commons open )?database license(?: odbl)?(?: version| v)?(?: 1(?: 0)?)? | odbl(?: 1 0)? | odbl 1 0 | opendatacommons org licenses odbl
odc-by-1 | open data commons attribution license | odc by(?: 1 0)? | odc by 1 0 | opendatacommons org licenses by
pddl-1 | (?:open data commons )?public domain dedication and license | pddl | pddl 1 0 | opendatacommons org licenses pddl
cdla-permissive | community data license agreement permissive(?: version| v)?(?: [12] 0)? | cdla permissive [12] 0 | cdla permissive [12] 0 | cdla (?:io|dev) permissive
cdla-sharing | community data license agreement sharing(?: version| v)?(?: 1 0)? | cdla sharing 1 0 | cdla sharing 1 0 | cdla (?:io|dev) sharing
cc0 | creative commons (?:cc0|zero)(?: license)?(?: 1 0)?(?: universal)? | cc0(?: 1 0)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero
cc-pdm | creative commons public domain mark(?: 1 0)? | cc pdm | cc pdm | creativecommons org publicdomain mark
cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: license)? | cc by nc nd(?: [1234] [05])? | cc by nc nd [1234] [05] | creativecommons org licenses by nc nd
cc-by-nc-sa | creative commons attribution non ?commercial share ?alike(?: license)? | cc by nc sa(?: [1234] [05])? | cc by nc sa [1234] [05] | creativecommons org licenses by nc sa
cc-by-nc | creative commons attribution non ?commercial(?: license)? | cc by nc(?: [1234] [05])? | cc by nc [1234] [05] | creativecommons org licenses by nc
cc-by-nd | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: license)? | cc by nd(?: [1234] [05])? | cc by nd [1234] [05] | creativecommons org licenses by nd
cc-by-sa | creative commons attribution share ?alike(?: license)? | cc by sa(?: [1234] [05])? | cc by sa [1234] [05] | creativecommons org licenses by sa
cc-by | creative commons attribution(?: license)? | cc by(?: [1234] [05])? | cc by [1234] [05] | creativecommons org licenses by
openrail | (?:creative ml )?open ?rail(?: m)? license | openrail m | openrail | huggingface co spaces bigscience license
llama-2 | llama 2 community license(?: agreement)? | | llama2 | ai meta com llama license
llama-3 | (?:meta )?llama 3(?: [123])? community license(?: agreement)? | | llama3(?: [123])? | llama meta com llama3 license
busl-1.1 | business source license(?: version| v)?(?: 1 1)? | busl 1 1 | busl 1 1 | mariadb com bsl11
elastic-2 | elastic license(?: version| v)?(?: 2(?: 0)?)? | | elastic 2 0 | elastic co licensing elastic license
sspl-1 | server side public license(?: version| v)?(?: 1)? | sspl(?: 1 0)? | sspl 1 0 | mongodb com licensing server side public license
polyform-nc | polyform noncommercial license(?: 1 0 0)? | | polyform noncommercial 1 0 0 | polyformproject org licenses noncommercial
upl-1 | universal permissive license(?: version| v)?(?: 1(?: 0)?)? | upl 1 0 | upl 1 0 | oss oracle com licenses upl
vim | vim license | | vim | vimhelp org uganda txt
curl | curl license | | curl | curl se docs copyright
"""

# label | words of the legal text
_SENTENCES = r"""
mit | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | the above copyright notice and this permission notice shall be included in all copies
isc | permission to use copy modify and or distribute this software for any purpose with or without fee
bsd | redistributions? (?:and use )?(?:of source code must retain|in source and binary forms with or without modification)
bsd-3 | neither the names? of (?:\S+ ){1,12}?(?:nor|may) (?:\S+ ){0,12}?used to endorse or promote products
bsd-4 | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2 | you may not use this file except in compliance with the license
apache-2 | unless required by applicable law or agreed to in writing software distributed under the license
gpl | you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2 | gnu general public license as published by the free software foundation either version 2
gpl-3 | gnu general public license as published by the free software foundation either version 3
gpl-2 | gnu general public license version 2 as published by the free software foundation
lgpl | you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl-2.1 | gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3 | gnu lesser general public license as published by the free software foundation either version 3
agpl-3 | gnu affero general public license as published by the free software foundation either version 3
gpl | see the gnu general public license for more details
lgpl | see the gnu lesser general public license for more details
agpl | see the gnu affero general public license for more details
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
epl-1 | accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2 | accompanying materials are made available under the terms of the eclipse public license 2 0
cddl-1 | the contents of this file are subject to the terms of the common development and distribution license
boost-1 | distributed under the boost software license version 1 0 see accompanying file
zlib | provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising
unlicense | this is free and unencumbered software released into the public domain
wtfpl | you just do what the fuck you want to
beerware | buy me a beer in return
cc0 | waived? all copyright and related or neighboring rights
cc-by | you must give appropriate credit provide a link to the license
cc-by-nc | you may not use the material for commercial purposes
cc-by-nd | if you remix transform or build upon the material you may not distribute the modified material
cc-by-sa | you must distribute your contributions under the same license as the original
ofl-1.1 | this font software is licensed under the sil open font license
artistic-2 | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee
public-domain | (?:released|placed|dedicated|is) (?:in|into|to|as) the public domain
all-rights-reserved | all rights reserved
"""

_NOTICE = (
    r"(?:licen[sc]ed|released|distributed|redistributed|published|available|provided|offered|covered|governed|shared)"
    r"(?: \S+){0,3}? (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the| a| an)? ")
_LICENSE = "licen[sc]es?"


def _spelled(title: str) -> str:
    """With the word license in both spellings and in plural, and versions as ``version 2``, ``v 2`` or ``v2``."""
    title = title.replace("(?: version| v)? ", "(?: version)? (?:v ?)?").replace("(?: version| v) ", "(?: version (?:v ?)?| v ?)")
    return re.sub(r"\blicense\b", _LICENSE, title)


def keyword(body: str) -> str:
    """The longest text that every match of ``body`` holds, spaces at its ends included."""
    rest, body = None, f" {body} "
    while rest != body:  # groups from the inside out
        rest, body = body, re.sub(r"\(\?:[^()]*\)(?:\{[^}]*\}|[?+*])?\??", "\0", body)
    body = re.sub(r"\[[^\]]*\]\??|\\S[+*]\??|.\?", "\0", body)
    return max(re.findall("[a-z0-9 ]+", body), key=len)


def _rule(name: str, label: str, confidence: float, bodies: list[str], before: str = "", after: str = "", base=False) -> Rule:
    """A rule for any of the bodies, whole words only."""
    pattern = re.compile(f"(?<= ){before}(?:{'|'.join(bodies)}){after}(?= )")
    return Rule(f"{name}:{label}", label, tuple(keyword(b) for b in bodies), pattern, confidence, base)


@cache
def rules() -> list[Rule]:
    """All rules, first ones first."""
    out = [_rule("phrase", label, 1.0, [phrase], base=True) for phrase, label in BASE]
    for place, line in enumerate(_SENTENCES.strip().splitlines()):
        label, body = line.split(" | ", 1)
        vague = label in ("all-rights-reserved", "public-domain")
        out.append(_rule(f"text{place}", label, 0.5 if vague else 1.0, [_spelled(body)]))
    # A bar inside an expression has no space on both sides.
    families = [[f.strip() for f in re.split(r" \|(?= |$)", line)] for line in _FAMILIES.strip().splitlines()]
    for label, _, _, tag, _ in families:
        out.append(_rule("tag", label, 1.0, [f"spdx license identifier {tag}"]))
    for label, *_, address in families:
        out.append(_rule("address", label, 0.9, [address]))
    for label, title, short, _, _ in families:
        out.append(_rule("notice", label, 0.95, [_spelled(t) for t in (title, short) if t], _NOTICE, f"(?: {_LICENSE})?"))
    for label, title, _, _, _ in families:
        out.append(_rule("title", label, 0.8, [_spelled(title)]))
    for label, _, short, _, _ in families:
        if short:
            out.append(_rule("short", label, 0.6, [short]))
    return out
