"""Signature rules of the license scan, in order.

A rule is ``label | words | pattern``: the pattern is matched against the text's words joined
by single spaces, and is tried only where all the gating words occur. ``LIC`` stands for
both spellings of license. A section has a priority, a confidence, and what its patterns start with.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    number: int
    label: str
    words: frozenset[bytes]
    pattern: re.Pattern
    priority: int
    confidence: float


IDENTIFIERS = """
0bsd | 0bsd | 0bsd
afl-1.1 | afl | afl 1 1
afl-1.2 | afl | afl 1 2
afl-2.0 | afl | afl 2 0
afl-2.1 | afl | afl 2 1
afl-3.0 | afl | afl 3 0
agpl-1.0 | agpl | agpl 1 0(?: only| or later)?
agpl-3.0-only | agpl | agpl 3 0(?: only)?
agpl-3.0-or-later | agpl | agpl 3 0 or later
apache-1.0 | apache | apache 1 0
apache-1.1 | apache | apache 1 1
apache-2.0 | apache | apache 2 0
apsl-2.0 | apsl | apsl 2 0
artistic-1.0 | artistic | artistic 1 0(?: perl| cl8)?
artistic-2.0 | artistic | artistic 2 0
bsd-1-clause | bsd | bsd 1 clause
bsd-2-clause | bsd | bsd 2 clause
bsd-2-clause-patent | bsd | bsd 2 clause patent
bsd-3-clause | bsd | bsd 3 clause
bsd-3-clause-clear | bsd | bsd 3 clause clear
bsd-4-clause | bsd | bsd 4 clause
bsl-1.0 | bsl | bsl 1 0
busl-1.1 | busl | busl 1 1
cc0-1.0 | cc0 | cc0 1 0
cc-by-1.0 | cc | cc by 1 0
cc-by-2.0 | cc | cc by 2 0
cc-by-2.5 | cc | cc by 2 5
cc-by-3.0 | cc | cc by 3 0
cc-by-4.0 | cc | cc by 4 0
cc-by-nc-2.0 | cc | cc by nc 2 0
cc-by-nc-3.0 | cc | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0
cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0
cc-by-nd-3.0 | cc | cc by nd 3 0
cc-by-nd-4.0 | cc | cc by nd 4 0
cc-by-sa-2.5 | cc | cc by sa 2 5
cc-by-sa-3.0 | cc | cc by sa 3 0
cc-by-sa-4.0 | cc | cc by sa 4 0
cddl-1.0 | cddl | cddl 1 0
cddl-1.1 | cddl | cddl 1 1
cecill-2.1 | cecill | cecill 2 1
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
cpl-1.0 | cpl | cpl 1 0
ecl-2.0 | ecl | ecl 2 0
efl-2.0 | efl | efl 2 0
epl-1.0 | epl | epl 1 0
epl-2.0 | epl | epl 2 0
eupl-1.1 | eupl | eupl 1 1
eupl-1.2 | eupl | eupl 1 2
gfdl-1.2 | gfdl | gfdl 1 2(?: only| or later)?
gfdl-1.3 | gfdl | gfdl 1 3(?: only| or later)?
gpl-1.0-only | gpl | gpl 1 0(?: only)?
gpl-1.0-or-later | gpl | gpl 1 0 or later
gpl-2.0-only | gpl | gpl 2 0(?: only)?
gpl-2.0-or-later | gpl | gpl 2 0 or later
gpl-3.0-only | gpl | gpl 3 0(?: only)?
gpl-3.0-or-later | gpl | gpl 3 0 or later
hpnd | hpnd | hpnd
isc | isc | isc
lgpl-2.0-only | lgpl | lgpl 2 0(?: only)?
lgpl-2.0-or-later | lgpl | lgpl 2 0 or later
lgpl-2.1-only | lgpl | lgpl 2 1(?: only)?
lgpl-2.1-or-later | lgpl | lgpl 2 1 or later
lgpl-3.0-only | lgpl | lgpl 3 0(?: only)?
lgpl-3.0-or-later | lgpl | lgpl 3 0 or later
lppl-1.3c | lppl | lppl 1 3c
mit | mit | mit
mit-0 | mit | mit 0
mpl-1.0 | mpl | mpl 1 0
mpl-1.1 | mpl | mpl 1 1
mpl-2.0 | mpl | mpl 2 0(?: no copyleft exception)?
ms-pl | ms | ms pl
ms-rl | ms | ms rl
mulanpsl-2.0 | mulanpsl | mulanpsl 2 0
ncsa | ncsa | ncsa
odbl-1.0 | odbl | odbl 1 0
ofl-1.1 | ofl | ofl 1 1
openssl | openssl | openssl
osl-3.0 | osl | osl 3 0
php-3.01 | php | php 3 01
postgresql | postgresql | postgresql
psf-2.0 | psf | psf 2 0
python-2.0 | python | python 2 0
qpl-1.0 | qpl | qpl 1 0
ruby | ruby | ruby
sspl-1.0 | sspl | sspl 1 0
unicode-dfs-2016 | unicode | unicode dfs 2016
unlicense | unlicense | unlicense
upl-1.0 | upl | upl 1 0
vim | vim | vim
w3c | w3c | w3c
wtfpl | wtfpl | wtfpl
x11 | x11 | x11
zlib | zlib | zlib
zpl-2.1 | zpl | zpl 2 1
"""

SENTENCES = """
mit | permission granted free charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | permission granted without restriction | permission is hereby granted free of charge to any person obtaining a copy of this software(?: \\S+){0,60} without restriction(?: \\S+){0,30} to permit persons to whom the software is furnished to do so the software is provided
x11 | x consortium advertising | except as contained in this notice the name of the x consortium shall not be used in advertising
isc | permission purpose hereby | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | permission purpose hereby fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-2-clause | redistribution binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-3-clause | neither endorse derived | neither the name of(?: \\S+){1,12} nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-4-clause | advertising mentioning | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2.0 | apache compliance | licensed under the apache LIC version 2 0 the LIC you may not use this file except in compliance with the LIC
apache-2.0 | unless applicable basis | unless required by applicable law or agreed to in writing software distributed under the LIC is distributed on an as is basis
apache-2.0 | perpetual worldwide patent | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable(?: except as stated in this section)?(?: copyright| patent) LIC
apache-1.1 | apache foundation includes | this product includes software developed by the apache software foundation
gpl-3.0-or-later | gnu 3 later | (?:it )?under the terms of the gnu general public LIC as published by the free software foundation either version 3 of the LIC or at your option any later version
gpl-2.0-or-later | gnu 2 later | (?:it )?under the terms of the gnu general public LIC as published by the free software foundation either version 2 of the LIC or at your option any later version
gpl-2.0-only | gnu 2 | (?:it )?under the terms of the gnu general public LIC version 2 as published by the free software foundation
gpl-3.0-only | gnu 3 | (?:it )?under the terms of the gnu general public LIC version 3 as published by the free software foundation
lgpl-2.1-or-later | gnu lesser 1 later | under the terms of the gnu lesser general public LIC as published by the free software foundation either version 2 1 of the LIC or at your option any later version
lgpl-3.0-or-later | gnu lesser 3 later | under the terms of the gnu lesser general public LIC as published by the free software foundation either version 3 of the LIC or at your option any later version
lgpl-2.0-or-later | gnu library 2 later | under the terms of the gnu library general public LIC as published by the free software foundation either version 2 of the LIC or at your option any later version
agpl-3.0-or-later | gnu affero 3 later | under the terms of the gnu affero general public LIC as published by the free software foundation either version 3 of the LIC or at your option any later version
gpl | freedom contrast gnu | the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public LIC is intended to guarantee
gpl-3.0 | gnu copyleft kinds | the gnu general public LIC is a free copyleft LIC for software and other kinds of works
agpl-3.0 | affero copyleft kinds | the gnu affero general public LIC is a free copyleft LIC for software and other kinds of works
gpl | permitted everyone verbatim | everyone is permitted to copy and distribute verbatim copies of this LIC document but changing it is not allowed
gpl | warranty merchantability gnu | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public LIC for more details
lgpl | warranty merchantability lesser | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public LIC for more details
agpl | warranty merchantability affero | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public LIC for more details
gfdl | gnu invariant sections | under the terms of the gnu free documentation LIC version 1 [123] or any later version published by the free software foundation with (?:no|the) invariant sections
mpl-2.0 | mozilla subject | this source code form is subject to the terms of the mozilla public LIC v(?:ersion)? 2 0
mpl-1.1 | mozilla contents | the contents of this file are subject to the mozilla public LIC version 1 1
mpl-1.0 | mozilla contents | the contents of this file are subject to the mozilla public LIC version 1 0
cddl-1.0 | common development distribution | the contents of this file are subject to the terms of the common development and distribution LIC
epl-2.0 | eclipse accompanying | this program and the accompanying materials are made available under the terms of the eclipse public LIC (?:v |version )?2 0
epl-1.0 | eclipse accompanying | this program and the accompanying materials are made available under the terms of the eclipse public LIC (?:v |version )?1 0
bsl-1.0 | boost software | (?:distributed under the boost software LIC version 1 0|boost software LIC version 1 0 august 17th 2003 permission is hereby granted free of charge)
zlib | misrepresented origin | the origin of this software must not be misrepresented you must not claim that you wrote the original software
unlicense | unencumbered domain | this is free and unencumbered software released into the public domain
cc0-1.0 | dedicated waiving | has dedicated the work to the public domain by waiving all of (?:his or her|their) rights to the work worldwide under copyright law
cc0-1.0 | extent waived neighboring | to the extent possible under law(?: \\S+){1,20} waived all copyright and related or neighboring rights
wtfpl | fuck public | do what the fuck you want to public LIC
ofl-1.1 | sil font | this font software is licensed under the sil open font LIC version 1 1
ms-pl | governs accompanying accept | this LIC governs use of the accompanying software if you use the software you accept this LIC
artistic-2.0 | artistic copyright holder | this LIC establishes the terms under which a given free software package may be copied modified distributed and or redistributed the intent is that the copyright holder maintains some artistic control
artistic-1.0 | artistic package | the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
psf-2.0 | python foundation | python software foundation LIC version 2
php-3.01 | php freely | this product includes php software freely available from
openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
ncsa | illinois ncsa | university of illinois ncsa open source LIC
postgresql | postgresql database | postgresql database management system formerly known as postgres
upl-1.0 | universal permissive | the universal permissive LIC upl version 1 0
odbl-1.0 | open database | this(?: \\S+){1,8} is made available under the open database LIC
eupl-1.2 | eupl licensed | licensed under the eupl(?: version| v)? 1 2(?: or later)?
cecill | cecill governed | governed by the cecill(?: [abc])? LIC under french law
all-rights-reserved | reserved rights | all rights reserved
proprietary | confidential proprietary | (?:this (?:software|document|file) (?:is|contains) )?(?:proprietary and confidential|confidential and proprietary)
proprietary | unauthorized prohibited | unauthorized (?:copying|use|reproduction|distribution)(?: \\S+){0,12} strictly prohibited
public-domain | public domain | (?:is|are|been) (?:hereby )?(?:placed|released|put) (?:in|into|to) the public domain
"""

VERSIONED = """
apache-2.0 | apache 2 | apache(?: software)?(?: LIC)?(?: version| v)? 2(?: 0)?
apache-2.0 | apache v2 | apache(?: LIC)? v2(?: 0)?
apache-2.0 | asl 2 | asl 2 0
apache-1.1 | apache 1 | apache(?: software)? LIC(?: version| v)? 1 1
apache-1.0 | apache 1 | apache(?: software)? LIC(?: version| v)? 1 0
apache-2.0 | apache org | apache org licenses LIC 2 0
apache-1.1 | apache org | apache org licenses LIC 1 1
gpl-3.0-or-later | gnu 3 later | gnu general public LIC(?: as published by the free software foundation)?(?: either)? version 3(?: 0)?(?: of the LIC)? or(?: at your option)?(?: any)? later(?: version)?
gpl-2.0-or-later | gnu 2 later | gnu general public LIC(?: as published by the free software foundation)?(?: either)? version 2(?: 0)?(?: of the LIC)? or(?: at your option)?(?: any)? later(?: version)?
gpl-3.0 | gnu 3 | gnu general public LIC(?: gpl)?(?: version| v) 3(?: 0)?
gpl-2.0 | gnu 2 | gnu general public LIC(?: gpl)?(?: version| v) 2(?: 0)?
gpl-1.0 | gnu 1 | gnu general public LIC(?: gpl)?(?: version| v) 1(?: 0)?
gpl-3.0 | gnu v3 | gnu general public LIC(?: gpl)? v3
gpl-2.0 | gnu v2 | gnu general public LIC(?: gpl)? v2
gpl-3.0 | gplv3 | (?:gnu )?gplv3
gpl-2.0 | gplv2 | (?:gnu )?gplv2
gpl-3.0-or-later | gplv3 later | (?:gnu )?gplv3 or(?: any)? later
gpl-2.0-or-later | gplv2 later | (?:gnu )?gplv2 or(?: any)? later
gpl-3.0 | gpl 3 | (?:gnu )?gpl(?: version| v)? 3(?: 0)?
gpl-2.0 | gpl 2 | (?:gnu )?gpl(?: version| v)? 2(?: 0)?
gpl-3.0 | gnu org gpl | gnu org licenses gpl 3 0
gpl-2.0 | gnu org gpl | gnu org licenses (?:old licenses )?gpl 2 0
lgpl-3.0 | gnu lesser 3 | gnu lesser general public LIC(?: lgpl)?(?: version| v) 3(?: 0)?
lgpl-2.1 | gnu lesser 1 | gnu lesser general public LIC(?: lgpl)?(?: version| v) 2 1
lgpl-2.0 | gnu library 2 | gnu library general public LIC(?: version| v) 2(?: 0)?
lgpl-3.0 | lgplv3 | (?:gnu )?lgplv3
lgpl-2.1 | lgplv2 1 | (?:gnu )?lgplv2 1
lgpl-3.0 | lgpl 3 | (?:gnu )?lgpl(?: version| v)? 3(?: 0)?
lgpl-2.1 | lgpl 1 | (?:gnu )?lgpl(?: version| v)? 2 1
lgpl-3.0 | gnu org lgpl | gnu org licenses lgpl 3 0
lgpl-2.1 | gnu org lgpl | gnu org licenses (?:old licenses )?lgpl 2 1
agpl-3.0 | affero 3 | (?:gnu )?affero general public LIC(?: agpl)?(?: version| v) 3(?: 0)?
agpl-3.0 | agplv3 | (?:gnu )?agplv3
agpl-3.0 | agpl 3 | (?:gnu )?agpl(?: version| v)? 3(?: 0)?
agpl-3.0 | gnu org agpl | gnu org licenses agpl 3 0
gfdl-1.3 | gnu documentation 3 | gnu free documentation LIC(?: version| v) 1 3
gfdl-1.2 | gnu documentation 2 | gnu free documentation LIC(?: version| v) 1 2
gfdl-1.1 | gnu documentation 1 | gnu free documentation LIC(?: version| v) 1 1
bsd-2-clause | bsd clause | (?:2|two) clause bsd(?: LIC)?
bsd-3-clause | bsd clause | (?:3|three) clause bsd(?: LIC)?
bsd-4-clause | bsd clause | (?:4|four) clause bsd(?: LIC)?
bsd-2-clause | bsd clause | bsd (?:2|two) clause(?: LIC)?
bsd-3-clause | bsd clause | bsd (?:3|three) clause(?: LIC)?
bsd-4-clause | bsd clause | bsd (?:4|four) clause(?: LIC)?
bsd-2-clause | simplified bsd | simplified bsd(?: LIC)?
bsd-2-clause | freebsd | freebsd LIC
bsd-3-clause | bsd new | new bsd(?: LIC)?
bsd-3-clause | modified bsd | modified bsd(?: LIC)?
bsd-3-clause | revised bsd | revised bsd(?: LIC)?
bsd-4-clause | original bsd | original bsd(?: LIC)?
mpl-2.0 | mozilla 2 | mozilla public LIC(?: mpl)?(?: version| v)? 2(?: 0)?
mpl-1.1 | mozilla 1 | mozilla public LIC(?: mpl)?(?: version| v)? 1 1
mpl-1.0 | mozilla 1 | mozilla public LIC(?: mpl)?(?: version| v)? 1 0
mpl-2.0 | mpl 2 | mpl(?: version| v)? 2 0
mpl-1.1 | mpl 1 | mpl(?: version| v)? 1 1
mpl-2.0 | mozilla org | mozilla org mpl 2 0
epl-2.0 | eclipse 2 | eclipse public LIC(?: epl)?(?: version| v)? 2(?: 0)?
epl-1.0 | eclipse 1 | eclipse public LIC(?: epl)?(?: version| v)? 1(?: 0)?
epl-2.0 | epl 2 | epl(?: version| v)? 2 0
epl-1.0 | epl 1 | epl(?: version| v)? 1 0
cddl-1.1 | cddl 1 | (?:cddl|common development and distribution LIC(?: cddl)?)(?: version| v)? 1 1
cddl-1.0 | common development 0 | common development and distribution LIC(?: cddl)?(?: version| v)? 1 0
cpl-1.0 | common public 0 | common public LIC(?: version| v)? 1 0
bsl-1.0 | boost 1 | boost software LIC(?: version| v)? 1 0
busl-1.1 | business source | business source LIC(?: version| v)? 1 1
sspl-1.0 | server side | server side public LIC(?: version| v)? 1(?: 0)?
eupl-1.2 | european union 2 | european union public LIC(?: version| v)? 1 2
eupl-1.1 | european union 1 | european union public LIC(?: version| v)? 1 1
artistic-2.0 | artistic 2 | artistic LIC(?: version| v)? 2(?: 0)?
artistic-1.0 | artistic 1 | artistic LIC(?: version| v)? 1(?: 0)?
afl-3.0 | academic 3 | academic free LIC(?: version| v)? 3(?: 0)?
afl-2.1 | academic 2 | academic free LIC(?: version| v)? 2 1
osl-3.0 | open software 3 | open software LIC(?: version| v)? 3(?: 0)?
ecl-2.0 | educational community 2 | educational community LIC(?: version| v)? 2 0
ofl-1.1 | sil font 1 | sil open font LIC(?: version| v)? 1 1
lppl-1.3c | latex 1 | latex project public LIC(?: version| v)? 1 3c?
zpl-2.1 | zope 2 | zope public LIC(?: version| v)? 2 1
qpl-1.0 | public q 1 | q public LIC(?: version| v)? 1 0
mulanpsl-2.0 | mulan 2 | mulan(?: permissive software LIC| psl) v?2
mulanpsl-2.0 | mulan v2 | mulan(?: permissive software LIC| psl) v2
cc0-1.0 | cc0 | cc0 1 0(?: universal)?
cc0-1.0 | creativecommons zero | creativecommons org publicdomain zero 1 0
cc-by-4.0 | cc 4 | cc by 4 0(?: international)?
cc-by-3.0 | cc 3 | cc by 3 0(?: unported)?
cc-by-2.5 | cc 5 | cc by 2 5
cc-by-2.0 | cc 2 | cc by 2 0
cc-by-1.0 | cc 1 | cc by 1 0
cc-by-sa-4.0 | cc sa 4 | cc by sa 4 0(?: international)?
cc-by-sa-3.0 | cc sa 3 | cc by sa 3 0(?: unported)?
cc-by-sa-2.5 | cc sa 5 | cc by sa 2 5
cc-by-sa-2.0 | cc sa 2 | cc by sa 2 0
cc-by-nc-4.0 | cc nc 4 | cc by nc 4 0(?: international)?
cc-by-nc-3.0 | cc nc 3 | cc by nc 3 0(?: unported)?
cc-by-nc-2.0 | cc nc 2 | cc by nc 2 0
cc-by-nd-4.0 | cc nd 4 | cc by nd 4 0(?: international)?
cc-by-nd-3.0 | cc nd 3 | cc by nd 3 0
cc-by-nc-sa-4.0 | cc nc sa 4 | cc by nc sa 4 0(?: international)?
cc-by-nc-sa-3.0 | cc nc sa 3 | cc by nc sa 3 0(?: unported)?
cc-by-nc-nd-4.0 | cc nc nd 4 | cc by nc nd 4 0(?: international)?
cc-by-nc-nd-3.0 | cc nc nd 3 | cc by nc nd 3 0(?: unported)?
cc-by-4.0 | creativecommons 4 | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons 3 | creativecommons org licenses by 3 0
cc-by-sa-4.0 | creativecommons sa 4 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons sa 3 | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons nc 4 | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | creativecommons nc 3 | creativecommons org licenses by nc 3 0
cc-by-nc-sa-4.0 | creativecommons nc sa 4 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons nc nd 4 | creativecommons org licenses by nc nd 4 0
cc-by-nd-4.0 | creativecommons nd 4 | creativecommons org licenses by nd 4 0
cc-by-4.0 | creative attribution 4 | (?:creative commons )?attribution 4 0(?: international)?(?: LIC)?
cc-by-3.0 | creative attribution 3 | (?:creative commons )?attribution 3 0(?: unported)?(?: LIC)?
cc-by-sa-4.0 | attribution sharealike 4 | (?:creative commons )?attribution sharealike 4 0(?: international)?(?: LIC)?
cc-by-sa-3.0 | attribution sharealike 3 | (?:creative commons )?attribution sharealike 3 0(?: unported)?(?: LIC)?
cc-by-nc-4.0 | attribution noncommercial 4 | (?:creative commons )?attribution noncommercial 4 0(?: international)?(?: LIC)?
cc-by-nc-sa-4.0 | noncommercial sharealike 4 | (?:creative commons )?attribution noncommercial sharealike 4 0(?: international)?(?: LIC)?
cc-by-nc-nd-4.0 | noncommercial noderivatives 4 | (?:creative commons )?attribution noncommercial noderivatives 4 0(?: international)?(?: LIC)?
cc-by-nd-4.0 | attribution noderivatives 4 | (?:creative commons )?attribution noderivatives 4 0(?: international)?(?: LIC)?
ogl-uk-3.0 | open government 3 | open government LIC v?3 0
ogl-uk-3.0 | open government v3 | open government LIC v3 0
odbl-1.0 | odbl | (?:open database LIC )?odbl(?: v)? 1 0
odc-by-1.0 | odc | (?:odc by|open data commons attribution LIC)(?: v)? 1 0
mit | opensource mit | opensource org licenses mit(?: LIC)?
bsd-3-clause | opensource bsd | opensource org licenses bsd 3 clause
"""

NAMES = """
gpl | gnu general | gnu general public LIC
lgpl | gnu lesser | gnu lesser general public LIC
lgpl | gnu library | gnu library general public LIC
agpl | affero | (?:gnu )?affero general public LIC
gfdl | gnu documentation | gnu free documentation LIC
gpl | gnu gpl | gnu gpl
lgpl | gnu lgpl | gnu lgpl
apache | apache | apache(?: software)? LIC
mit | mit | mit LIC
mit | expat | expat LIC
x11 | x11 | x11 LIC
isc | isc | isc LIC
bsd | bsd | bsd(?: style)? LIC
mpl | mozilla | mozilla public LIC
epl | eclipse | eclipse public LIC
cddl | common development | common development and distribution LIC
cpl | common | common public LIC
bsl | boost | boost software LIC
eupl | european union | european union public LIC
artistic | artistic | artistic LIC
afl | academic | academic free LIC
osl | open software | open software LIC
ofl | font | (?:sil )?open font LIC
lppl | latex | latex project public LIC
zpl | zope | zope public LIC
zlib | zlib | zlib(?: libpng)? LIC
psf | python | python(?: software foundation)? LIC
php | php | php LIC
ruby | ruby | ruby LIC
vim | vim | vim LIC
w3c | w3c | w3c(?: software)?(?: notice and)? LIC
openssl | openssl | openssl LIC
postgresql | postgresql | postgresql LIC
ms-pl | microsoft | microsoft public LIC
ms-rl | microsoft reciprocal | microsoft reciprocal LIC
unlicense | unlicense | unlicense
wtfpl | wtfpl | wtfpl
sspl | server side | server side public LIC
busl | business source | business source LIC
upl | universal permissive | universal permissive LIC
beerware | beer ware | beer ware LIC
beerware | beerware | beerware LIC
jsr | jsr specification | jsr \\d+ specification LIC
cc0 | cc0 | (?:creative commons )?cc0
cc-by | cc | cc by
cc-by-sa | cc sa | cc by sa
cc-by-nc | cc nc | cc by nc
cc-by-nd | cc nd | cc by nd
cc-by-nc-sa | cc nc sa | cc by nc sa
cc-by-nc-nd | cc nc nd | cc by nc nd
cc-by | creative attribution | creative commons attribution(?: LIC)?
cc-by-sa | sharealike attribution | (?:creative commons )?attribution sharealike(?: LIC)?
cc-by-nc | noncommercial attribution | (?:creative commons )?attribution noncommercial(?: LIC)?
cc-by-nc-sa | noncommercial sharealike | (?:creative commons )?attribution noncommercial sharealike(?: LIC)?
cc-by-nd | noderivatives attribution | (?:creative commons )?attribution noderivatives(?: LIC)?
creative-commons | creative commons | (?:a )?creative commons LIC
odbl | open database | open database LIC
ogl-uk | open government | open government LIC
commercial | commercial | (?:a )?commercial LIC agreement
eula | end user | end user LIC agreement
"""

#: Priority, confidence, start of the patterns, rules. Of equal priority the longer detection counts, then the earlier rule.
SECTIONS = (
    (4, 0.99, "spdx LIC identifier ", "spdx", IDENTIFIERS),
    (3, 0.95, "", "", SENTENCES),
    (2, 0.8, "", "", VERSIONED),
    (1, 0.5, "", "", NAMES),
)


def compiled() -> list[Rule]:
    rules = []
    for priority, confidence, start, gate, section in SECTIONS:
        for line in section.strip().splitlines():
            label, words, pattern = (part.strip() for part in line.split(" | "))
            text = (start + pattern).replace("LIC", "licen[cs]e")
            gates = frozenset(f"{gate} {words}".encode().split())
            rules.append(Rule(len(rules), label, gates, re.compile(f" {text}(?= )".encode()), priority, confidence))
    return rules
