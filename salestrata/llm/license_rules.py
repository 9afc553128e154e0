"""The signature rules of the license scan.

A line of ``NAMES`` is ``label | keyword | pattern``: the rule is tried on texts that have the
keyword (lower case).  In a pattern a space stands for any run of separators, and
letters match in either case.  From every line follow the rule for the name
itself and one for a grant ("licensed under the ..."); ``TAGS`` and ``NOTICES``
add identifier tags and sentences of license texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Names of licenses as they are written, with the identifiers in use for them.
NAMES = r"""
gpl-3.0 | general public license | gnu general public license version 3
gpl-3.0 | general public license | gnu general public license v ?3(\.0)?
gpl-3.0 | gpl | gnu gpl ?v?(ersion)? ?3(\.0)?
gpl-3.0 | gpl | gplv3
gpl-2.0 | general public license | gnu general public license version 2
gpl-2.0 | general public license | gnu general public license v ?2(\.0)?
gpl-2.0 | gpl | gnu gpl ?v?(ersion)? ?2(\.0)?
gpl-2.0 | gpl | gplv2
gpl-1.0 | general public license | gnu general public license version 1
gpl | general public license | gnu general public license
gpl | gpl | gnu gpl
lgpl-3.0 | lesser general public | gnu lesser general public license version 3
lgpl-3.0 | lgpl | lgplv3
lgpl-2.1 | lesser general public | gnu lesser general public license version 2\.1
lgpl-2.1 | lgpl | lgplv2\.1
lgpl-2.0 | library general public | gnu library general public license
lgpl | lesser general public | gnu lesser general public license
lgpl | lgpl | gnu lgpl
agpl-3.0 | affero | gnu affero general public license version 3
agpl-3.0 | agpl | agplv3
agpl-1.0 | affero | affero general public license version 1
agpl | affero | gnu affero general public license
gfdl-1.3 | documentation license | gnu free documentation license version 1\.3
gfdl-1.2 | documentation license | gnu free documentation license version 1\.2
gfdl-1.1 | documentation license | gnu free documentation license version 1\.1
gfdl | documentation license | gnu free documentation license
apache-2.0 | apache | apache license version 2(\.0)?
apache-2.0 | apache | apache license 2(\.0)?
apache-2.0 | apache | apache software license version 2(\.0)?
apache-2.0 | apache | apache 2\.0 license
apache-1.1 | apache | apache (software )?license version 1\.1
apache-1.0 | apache | apache (software )?license version 1\.0
apache | apache | apache (software )?license
mit | mit | mit license
mit | mit | the mit \(expat\) license
mit | expat | expat license
mit-0 | mit | mit no attribution
mit-modern | mit | mit license modern variant
x11 | x11 | x11 license
bsd-4-clause | bsd | (original|4 clause|four clause) bsd license
bsd-4-clause | bsd | bsd 4 clause
bsd-3-clause | bsd | (new|modified|revised|3 clause|three clause) bsd license
bsd-3-clause | bsd | bsd 3 clause
bsd-2-clause | bsd | (simplified|freebsd|2 clause|two clause) bsd license
bsd-2-clause | bsd | bsd 2 clause
bsd-1-clause | bsd | bsd 1 clause
0bsd | bsd | (zero clause bsd|bsd zero clause)
0bsd | 0bsd | 0bsd
bsd | bsd | bsd license
bsd-patent | bsd | bsd 2 clause plus patent
isc | isc | isc license
zlib | zlib | zlib license
zlib | zlib | zlib libpng license
libpng | libpng | libpng license
mpl-2.0 | mozilla | mozilla public license version 2(\.0)?
mpl-2.0 | mozilla | mozilla public license 2(\.0)?
mpl-1.1 | mozilla | mozilla public license version 1\.1
mpl-1.0 | mozilla | mozilla public license version 1\.0
mpl | mozilla | mozilla public license
npl-1.1 | netscape | netscape public license version 1\.1
npl | netscape | netscape public license
epl-2.0 | eclipse | eclipse public license (version )?(v )?2(\.0)?
epl-1.0 | eclipse | eclipse public license (version )?(v )?1(\.0)?
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license
cpl-1.0 | common public | common public license
cddl-1.1 | development and distribution | common development and distribution license version 1\.1
cddl-1.0 | development and distribution | common development and distribution license
cddl | cddl | cddl license
cpal-1.0 | common public attribution | common public attribution license
ibm-public | ibm public | ibm public license
apsl-2.0 | apple public | apple public source license version 2(\.0)?
apsl | apple public | apple public source license
osl-3.0 | open software | open software license version 3(\.0)?
osl | open software | open software license
afl-3.0 | academic free | academic free license version 3(\.0)?
afl | academic free | academic free license
artistic-2.0 | artistic | artistic license (version )?2(\.0)?
artistic-1.0 | artistic | artistic license (version )?1(\.0)?
artistic | artistic | (perl )?artistic license
bsl-1.0 | boost | boost software license
busl-1.1 | business source | business source license (version )?1\.1
busl | business source | business source license
sspl-1.0 | server side public | server side public license
elastic-2.0 | elastic license | elastic license (version )?2(\.0)?
elastic | elastic license | elastic license
commons-clause | commons clause | commons clause
polyform-nc | polyform | polyform noncommercial license
polyform-sb | polyform | polyform small business license
polyform | polyform | polyform license
eupl-1.2 | european union public | european union public licen[cs]e (version )?(v )?1\.2
eupl-1.1 | european union public | european union public licen[cs]e (version )?(v )?1\.1
eupl | european union public | european union public licen[cs]e
cecill-2.1 | cecill | cecill free software license agreement version 2\.1
cecill | cecill | cecill license
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
ncsa | ncsa | university of illinois ncsa open source license
ncsa | ncsa | ncsa open source license
python-2.0 | python | python software foundation license version 2
python | python | python software foundation license
php-3.01 | php | php license version 3\.01
php | php | php license
ruby | ruby | ruby license
qpl-1.0 | q public | q public license
sleepycat | sleepycat | sleepycat license
vim | vim | vim license
postgresql | postgresql | postgresql licen[cs]e
openssl | openssl | openssl license
ofl-1.1 | open font | sil open font license version 1\.1
ofl | open font | (sil )?open font license
upl-1.0 | universal permissive | universal permissive license
unlicense | unlicense | the unlicense
wtfpl | do what the | do what the f\w*ck you want to public license
wtfpl | wtfpl | wtfpl
beerware | beer | beer ?ware license
cc0-1.0 | cc0 | cc0( 1\.0)?( universal)?
cc0-1.0 | public domain dedication | public domain dedication
pddl-1.0 | public domain dedication | open data commons public domain dedication and license
odbl-1.0 | database license | open (data commons open )?database license
odc-by-1.0 | data commons | open data commons attribution license
cc-by-nc-nd-4.0 | cc by | cc by nc nd 4\.0
cc-by-nc-nd | cc by | cc by nc nd
cc-by-nc-sa-4.0 | cc by | cc by nc sa 4\.0
cc-by-nc-sa-3.0 | cc by | cc by nc sa 3\.0
cc-by-nc-sa | cc by | cc by nc sa
cc-by-nc-4.0 | cc by | cc by nc 4\.0
cc-by-nc-3.0 | cc by | cc by nc 3\.0
cc-by-nc | cc by | cc by nc
cc-by-nd-4.0 | cc by | cc by nd 4\.0
cc-by-nd | cc by | cc by nd
cc-by-sa-4.0 | cc by | cc by sa 4\.0
cc-by-sa-3.0 | cc by | cc by sa 3\.0
cc-by-sa | cc by | cc by sa
cc-by-4.0 | cc by | cc by 4\.0
cc-by-3.0 | cc by | cc by 3\.0
cc-by | cc by | cc by
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(ative)?s
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike
cc-by-nc | creative commons | creative commons attribution non ?commercial
cc-by-nd | creative commons | creative commons attribution no ?deriv(ative)?s
cc-by-sa | creative commons | creative commons attribution share ?alike
cc-by | creative commons | creative commons attribution
creative-commons | creative commons | creative commons license
etalab-2.0 | licence ouverte | licence ouverte (version )?2(\.0)?
etalab | licence ouverte | licence ouverte
ogl-uk-3.0 | open government | open government licen[cs]e (version )?(v )?3(\.0)?
ogl | open government | open government licen[cs]e
dl-de-by-2.0 | datenlizenz | datenlizenz deutschland namensnennung (version )?2\.0
llama-3 | llama 3 | (meta )?llama 3(\.\d)? community license
llama-2 | llama 2 | llama 2 community license
openrail | rail | (creativeml )?open ?rail( m)?( license)?
bigscience-rail | bigscience | bigscience rail license
gemma | gemma | gemma terms of use
proprietary | proprietary | proprietary license
proprietary | all rights reserved | all rights reserved
public-domain | public domain | (in|into|to) the public domain
""".strip()

# Identifiers that stand in tags; the label is the identifier in lower case.
TAGS = """
GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later
LGPL-2.0-only LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0
AGPL-3.0-only AGPL-3.0-or-later GFDL-1.1 GFDL-1.2 GFDL-1.3 Apache-1.0 Apache-1.1 Apache-2.0 MIT MIT-0 X11
BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause 0BSD ISC Zlib libpng-2.0 MPL-1.0 MPL-1.1 MPL-2.0 EPL-1.0
EPL-2.0 CDDL-1.0 CDDL-1.1 CPL-1.0 OSL-3.0 AFL-3.0 Artistic-1.0 Artistic-2.0 BSL-1.0 BUSL-1.1 SSPL-1.0 EUPL-1.1
EUPL-1.2 MS-PL MS-RL NCSA Python-2.0 PHP-3.01 Ruby QPL-1.0 Vim PostgreSQL OpenSSL OFL-1.1 UPL-1.0 Unlicense
WTFPL CC0-1.0 PDDL-1.0 ODbL-1.0 ODC-By-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-3.0
CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0
""".split()

# Sentences that license texts hold word for word.
NOTICES = r"""
mit | free of charge | permission is hereby granted free of charge to any person obtaining a copy
isc | permission to use | permission to use copy modify and or distribute this software for any purpose
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification
bsd-3-clause | endorse or promote | neither the name of .{1,80}? may be used to endorse or promote products
apache-2.0 | apache org | https? www apache org licenses license 2 0
gpl | redistribute it | redistribute it and or modify it under the terms of the gnu general public license
gpl-or-later | any later version | either version \d(\.\d)? of the license or at your option any later version
lgpl | lesser general public | under the terms of the gnu lesser general public license
mpl-2.0 | mozilla org | https? mozilla org mpl 2 0
zlib | as is | this software is provided as is without any express or implied warranty
unlicense | unencumbered | this is free and unencumbered software released into the public domain
bsl-1.0 | boost | distributed under the boost software license
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-nc-sa-4.0 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-4.0 | creativecommons | creativecommons org licenses by 4 0
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
""".strip()

# Priorities, the higher first: a tag says what it means, a grant more than a name.
TAG, NOTICE, GRANT, NAME = 4, 3, 2, 1
WEIGHTS = {TAG: 1.0, NOTICE: 0.95, GRANT: 0.9, NAME: 0.6}
_GRANT = r"(licensed|released|available|distributed|published|provided|covered) (under|by|with) (the )?(terms of )?(the )?"
_GAP = r"[^0-9a-z\x80-\U0010FFFF]+"
_FREE = r"[^0-9a-z\x80-\U0010FFFF]*"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int


def _compiled(pattern: str) -> re.Pattern:
    """A space is a run of separators, " ?" one that may be empty."""
    spaced = pattern.replace(" ?", "\0").replace(" ", _GAP).replace("\0", _FREE)
    return re.compile(rf"(?<![0-9a-z\x80-\U0010FFFF])(?:{spaced})(?![0-9a-z\x80-\U0010FFFF])", re.DOTALL)


def _lines(table: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ")] for line in table.splitlines()]


def rules() -> list[Rule]:
    """All rules, in the order of the tables; patterns are for text with A-Z lowered."""
    named = _lines(NAMES)
    out = [Rule(label, keyword, _compiled(pattern), NAME) for label, keyword, pattern in named]
    out += [Rule(label, keyword, _compiled(_GRANT + pattern), GRANT) for label, keyword, pattern in named]
    out += [Rule(tag.lower(), "license-identifier",
                 re.compile(rf"spdx-license-identifier:[ \t]*{re.escape(tag.lower())}(?![0-9a-z.+-]*[0-9a-z+])"), TAG)
            for tag in TAGS]
    out += [Rule(label, keyword.replace("\\", ""), _compiled(pattern), NOTICE) for label, keyword, pattern in _lines(NOTICES)]
    return out
