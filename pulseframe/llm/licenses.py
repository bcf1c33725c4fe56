"""License scans by ordered signature rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches

#: The base: a phrase's words in a row, and its label.
BASE = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}

#: A word is a run of digits, a-z and what is not ASCII, after lower-casing A-Z.
_WORDS = bytes(k + 32 if 65 <= k <= 90 else k if k >= 128 or 48 <= k <= 57 or 97 <= k <= 122 else 32 for k in range(256))

# Label | keywords, one of which any match holds | name | identifier after an SPDX tag | address.
# All are patterns over lower-case words with one space between them: "GPL-3.0" is "gpl 3 0".
_FAMILIES = r"""
mit | mit,expat | (?:the )?(?:mit|expat) licen[sc]e | mit | opensource org licenses? mit
mit-0 | mit | mit no attribution(?: licen[sc]e)?|mit 0 licen[sc]e | mit 0 | opensource org licenses? mit 0
apache-1.1 | apache | apache (?:software )?licen[sc]e (?:version |v ?)?1 1 | apache 1 1 | apache org licenses license 1 1
apache-2.0 | apache | apache (?:software )?licen[sc]e (?:version |v ?)?2(?: 0)? | apache 2 0 | apache org licenses license 2 0
apache | apache | apache (?:software |public )?licen[sc]e | apache | apache org licenses
gpl-1.0 | gnu | gnu general public licen[sc]e (?:version |v ?)?1(?: 0)? | gpl 1 0(?: only| or later)? | gnu org licenses old licenses gpl 1 0
gpl-2.0 | gnu | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v ?)?2(?: 0)? | gpl 2 0(?: only| or later)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | gnu | gnu general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v ?)?3(?: 0)? | gpl 3 0(?: only| or later)? | gnu org licenses gpl 3 0
gpl | general | (?:gnu )?general public licen[sc]e | gpl | gnu org licenses gpl
lgpl-2.0 | gnu | gnu library general public licen[sc]e (?:version |v ?)?2(?: 0)? | lgpl 2 0(?: only| or later)? | gnu org licenses old licenses lgpl 2 0
lgpl-2.1 | gnu | gnu lesser general public licen[sc]e (?:version |v ?)?2 1 | lgpl 2 1(?: only| or later)? | gnu org licenses old licenses lgpl 2 1
lgpl-3.0 | gnu | gnu lesser general public licen[sc]e (?:version |v ?)?3(?: 0)? | lgpl 3 0(?: only| or later)? | gnu org licenses lgpl 3 0
lgpl | general | (?:gnu )?(?:lesser|library) general public licen[sc]e | lgpl | gnu org licenses lgpl
agpl-3.0 | affero | (?:gnu )?affero general public licen[sc]e (?:version |v ?)?3(?: 0)? | agpl 3 0(?: only| or later)? | gnu org licenses agpl 3 0
agpl | affero | (?:gnu )?affero general public licen[sc]e | agpl | gnu org licenses agpl
gfdl-1.3 | documentation | gnu free documentation licen[sc]e (?:version |v ?)?1 3 | gfdl 1 3(?: only| or later)? | gnu org licenses fdl 1 3
gfdl | documentation | (?:gnu )?free documentation licen[sc]e | gfdl | gnu org (?:licenses|copyleft) fdl
bsd-1-clause | bsd | (?:bsd 1 clause|1 clause bsd)(?: licen[sc]e)? | bsd 1 clause | opensource org licenses? bsd 1 clause
bsd-2-clause | bsd,freebsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[sc]e)? | bsd 2 clause | opensource org licenses? bsd 2 clause
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)? | bsd 3 clause | opensource org licenses? bsd 3 clause
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: licen[sc]e)? | bsd 4 clause | spdx org licenses bsd 4 clause
0bsd | bsd | (?:bsd zero clause|zero clause bsd|bsd 0 clause)(?: licen[sc]e)? | 0bsd | opensource org licenses? 0bsd
bsd | bsd | bsd(?: style| like)? licen[sc]e | bsd | opensource org licenses? bsd licen[sc]e
mpl-1.0 | mozilla,mpl | (?:mozilla public licen[sc]e|mpl) (?:version |v ?)?1 0 | mpl 1 0 | mozilla org mpl mpl 1 0
mpl-1.1 | mozilla,mpl | (?:mozilla public licen[sc]e|mpl) (?:version |v ?)?1 1 | mpl 1 1 | mozilla org mpl (?:mpl )?1 1
mpl-2.0 | mozilla,mpl | (?:mozilla public licen[sc]e|mpl) (?:version |v ?)?2(?: 0)? | mpl 2 0 | mozilla org mpl 2 0
mpl | mozilla,mpl | mozilla public licen[sc]e|mpl licen[sc]e | mpl | mozilla org (?:en us )?mpl
epl-1.0 | eclipse | eclipse public licen[sc]e (?:version |v ?)?1(?: 0)? | epl 1 0 | eclipse org legal epl v10
epl-2.0 | eclipse | eclipse public licen[sc]e (?:version |v ?)?2(?: 0)? | epl 2 0 | eclipse org legal epl (?:2 0|v20)
epl | eclipse | eclipse public licen[sc]e | epl | eclipse org legal epl
edl | eclipse | eclipse distribution licen[sc]e | edl 1 0 | eclipse org (?:org )?documents edl v10
cddl-1.0 | distribution | common development and distribution licen[sc]e (?:version |v ?)?1 0 | cddl 1 0 | opensource org licenses? cddl 1 0
cddl-1.1 | distribution | common development and distribution licen[sc]e (?:version |v ?)?1 1 | cddl 1 1 | spdx org licenses cddl 1 1
cddl | distribution | common development and distribution licen[sc]e | cddl | sun com cddl
cpl-1.0 | common | common public licen[sc]e | cpl 1 0 | opensource org licenses? cpl 1 0
cpal-1.0 | attribution | common public attribution licen[sc]e | cpal 1 0 | opensource org licenses? cpal 1 0
ipl-1.0 | ibm | ibm public licen[sc]e | ipl 1 0 | opensource org licenses? ibmpl
isc | isc | isc licen[sc]e | isc | opensource org licenses? isc
zlib | zlib | zlib(?: libpng)? licen[sc]e | zlib | opensource org licenses? zlib
libpng | libpng | libpng licen[sc]e | libpng(?: 2 0)? | libpng org pub png src libpng license
bsl-1.0 | boost | boost software licen[sc]e(?: (?:version |v ?)?1 0)? | bsl 1 0 | boost org license 1 0
busl-1.1 | business | business source licen[sc]e | busl 1 1 | mariadb com bsl11
sspl-1.0 | server | server side public licen[sc]e | sspl 1 0 | mongodb com licensing server side public license
elastic-2.0 | elastic | elastic licen[sc]e(?: (?:version |v ?)?2(?: 0)?)? | elastic 2 0 | elastic co licensing elastic license
commons-clause | commons | commons clause(?: licen[sc]e condition)? | commons clause | commonsclause com
unlicense | unlicense | (?:the )?unlicense | unlicense | unlicense org
wtfpl | fuck | do what the fuck you want to public licen[sc]e | wtfpl | wtfpl net
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)? | cc0 1 0 | creativecommons org publicdomain zero 1 0
cc-by-1.0 | cc | cc by 1 0 | cc by 1 0 | creativecommons org licenses by 1 0
cc-by-2.0 | cc | cc by 2 0 | cc by 2 0 | creativecommons org licenses by 2 0
cc-by-2.5 | cc | cc by 2 5 | cc by 2 5 | creativecommons org licenses by 2 5
cc-by-3.0 | cc | cc by 3 0 | cc by 3 0 | creativecommons org licenses by 3 0
cc-by-4.0 | cc | cc by 4 0 | cc by 4 0 | creativecommons org licenses by 4 0
cc-by-sa-3.0 | sa | cc by sa 3 0 | cc by sa 3 0 | creativecommons org licenses by sa 3 0
cc-by-sa-4.0 | sa | cc by sa 4 0 | cc by sa 4 0 | creativecommons org licenses by sa 4 0
cc-by-nd-4.0 | nd | cc by nd 4 0 | cc by nd 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-3.0 | nc | cc by nc 3 0 | cc by nc 3 0 | creativecommons org licenses by nc 3 0
cc-by-nc-4.0 | nc | cc by nc 4 0 | cc by nc 4 0 | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | nc | cc by nc sa 4 0 | cc by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | nc | cc by nc nd 4 0 | cc by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
cc-by | creative | creative commons attribution(?: \d \d)?(?: international| unported| generic)? | cc by | creativecommons org licenses by
cc-by-sa | sharealike,alike | creative commons attribution share ?alike|creative commons sharealike | cc by sa | creativecommons org licenses by sa
cc-by-nd | noderivatives,derivatives | creative commons attribution no ?derivatives | cc by nd | creativecommons org licenses by nd
cc-by-nc | noncommercial,commercial | creative commons attribution non ?commercial | cc by nc | creativecommons org licenses by nc
cc-by-nc-sa | noncommercial,commercial | creative commons attribution non ?commercial share ?alike | cc by nc sa | creativecommons org licenses by nc sa
cc-by-nc-nd | noncommercial,commercial | creative commons attribution non ?commercial no ?deriv(?:atives|s) | cc by nc nd | creativecommons org licenses by nc nd
artistic-1.0 | artistic | artistic licen[sc]e (?:version |v ?)?1 0 | artistic 1 0(?: perl| cl8)? | opensource org licenses? artistic license 1 0
artistic-2.0 | artistic | artistic licen[sc]e (?:version |v ?)?2(?: 0)? | artistic 2 0 | opensource org licenses? artistic license 2 0
artistic | artistic | artistic licen[sc]e | artistic | perlfoundation org artistic license
psf-2.0 | python,psf | python software foundation licen[sc]e|psf licen[sc]e | psf 2 0 | docs python org 3 license
python-2.0 | python | python licen[sc]e(?: (?:version |v ?)?2(?: 0)?)? | python 2 0 | opensource org licenses? python 2 0
php-3.01 | php | php licen[sc]e(?: (?:version |v ?)?3 0?1)? | php 3 01 | php net license 3 01
ruby | ruby | ruby licen[sc]e | ruby | ruby lang org en about license
postgresql | postgresql | postgresql licen[sc]e | postgresql | postgresql org about licen[sc]e
openssl | openssl | openssl licen[sc]e | openssl | openssl org source license
curl | curl | curl licen[sc]e | curl | curl se docs copyright
ofl-1.1 | font | (?:sil )?open font licen[sc]e(?: (?:version |v ?)?1 1)? | ofl 1 1 | scripts sil org ofl
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[sc]e | ncsa | opensource org licenses? ncsa
ms-pl | microsoft | microsoft public licen[sc]e | ms pl | opensource org licenses? ms pl
ms-rl | microsoft | microsoft reciprocal licen[sc]e | ms rl | opensource org licenses? ms rl
eupl-1.1 | european | european union public licen[sc]e (?:version |v ?)?1 1 | eupl 1 1 | joinup ec europa eu software page eupl
eupl-1.2 | european | european union public licen[sc]e (?:version |v ?)?1 2 | eupl 1 2 | joinup ec europa eu collection eupl
eupl | european | european union public licen[sc]e | eupl | eupl eu
osl-3.0 | open | open software licen[sc]e(?: (?:version |v ?)?3(?: 0)?)? | osl 3 0 | opensource org licenses? osl 3 0
afl-3.0 | academic | academic free licen[sc]e(?: (?:version |v ?)?3(?: 0)?)? | afl 3 0 | opensource org licenses? afl 3 0
ecl-2.0 | educational | educational community licen[sc]e | ecl 2 0 | opensource org licenses? ecl 2 0
odbl-1.0 | database | open (?:data commons open )?database licen[sc]e | odbl 1 0 | opendatacommons org licenses odbl
odc-by-1.0 | commons | open data commons attribution licen[sc]e | odc by 1 0 | opendatacommons org licenses by
pddl-1.0 | domain | public domain dedication and licen[sc]e | pddl 1 0 | opendatacommons org licenses pddl
upl-1.0 | universal | universal permissive licen[sc]e | upl 1 0 | oss oracle com licenses upl
vim | vim | vim licen[sc]e | vim | vimhelp org uganda
w3c | w3c | w3c software (?:notice and )?licen[sc]e | w3c | w3 org consortium legal 2002 copyright software
x11 | x11 | x11 licen[sc]e | x11 | xfree86 org 3 3 6 copyright2
mulan-2.0 | mulan | mulan psl(?: (?:version |v ?)?2)?|mulan permissive software licen[sc]e | mulanpsl 2 0 | license coscl org cn mulanpsl2
cecill-2.1 | cecill | cecill(?: free software)? licen[sc]e(?: agreement)? | cecill 2 1 | cecill info licences
ngpl | nethack | nethack general public licen[sc]e | ngpl | opensource org licenses? ngpl
qpl-1.0 | q | q public licen[sc]e | qpl 1 0 | opensource org licenses? qpl
sleepycat | sleepycat | sleepycat licen[sc]e | sleepycat | opensource org licenses? sleepycat
llama | llama | llama (?:\d )*community licen[sc]e | llama | ai meta com llama license
openrail | openrail,rail | (?:creativeml |bigscience )?open ?rail (?:m )?licen[sc]e | openrail | huggingface co spaces bigscience license
public-domain | domain | (?:released into|dedicated to|placed in|in) the public domain | public domain | creativecommons org publicdomain mark
proprietary | reserved | all rights reserved | licenseref proprietary | -
"""


# Label | keywords | weight | signature: wording of notices, grants and conditions by which a license is told without its name.
_SIGNATURES = r"""
mit | hereby | 0.95 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | sublicense | 0.9 | rights to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | substantial | 0.85 | the above copyright notice and this permission notice (?:\([a-z ]+\) )?shall be included in all copies or substantial portions of the software
mit-0 | hereby | 0.95 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
x11 | consortium | 0.9 | except as contained in this notice the name of the x consortium shall not be used in advertising
bsl-1.0 | hereby | 0.95 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
unicode | hereby | 0.95 | permission is hereby granted free of charge to any person obtaining a copy of (?:the )?(?:unicode )?data files and any associated documentation
isc | hereby | 0.95 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd | hereby | 0.95 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
isc | disclaims | 0.8 | the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
hpnd | hereby | 0.9 | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
bsd | redistribution | 0.9 | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | binary | 0.85 | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
bsd-3-clause | endorse | 0.95 | neither the name of (?:[^ ]+ ){1,12}?nor the names of (?:its|any|other|the|specific|[^ ]+) ?(?:[^ ]+ ){0,4}?may be used to endorse or promote products derived from this software
bsd-3-clause | endorse | 0.9 | the names? of (?:the )?(?:[^ ]+ ){1,4}?may not be used to endorse or promote products derived from this software
bsd-4-clause | advertising | 0.95 | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause-clear | patent | 0.9 | no express or implied licenses to any part(?:y s|ies) patent rights are granted by this license
apache-2.0 | apache | 1.0 | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | compliance | 0.85 | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2.0 | agreed | 0.85 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1 | apache | 0.9 | this product includes software developed by the apache software foundation
gpl | redistribute | 0.9 | (?:this program|this software|it|[^ ]+) is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl-1.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 1
gpl-2.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2
gpl-3.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3
gpl-2.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu general public license version 2 (?:only )?as published by the free software foundation
gpl-2.0 | translated | 0.85 | a work containing the program or a portion of it either verbatim or with modifications and or translated into another language
gpl-3.0 | convey | 0.85 | to convey a work means any kind of propagation that enables other parties to make or receive copies
gpl | gnu | 0.75 | you should have received a copy of the gnu general public license along with this (?:program|software|library|package)
lgpl-2.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2
lgpl-2.1 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3.0 | redistribute | 0.95 | you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3
lgpl | redistribute | 0.9 | you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | lesser | 0.75 | you should have received a copy of the gnu lesser general public license along with this (?:program|software|library|package)
agpl-3.0 | affero | 0.95 | under the terms of the gnu affero general public license as published by the free software foundation either version 3
agpl-3.0 | remotely | 0.85 | if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network
agpl | affero | 0.75 | you should have received a copy of the gnu affero general public license along with this (?:program|software|library|package)
gfdl-1.3 | invariant | 0.9 | under the terms of the gnu free documentation license version 1 3 or any later version published by the free software foundation with no invariant sections
gfdl-1.2 | invariant | 0.9 | under the terms of the gnu free documentation license version 1 2 or any later version published by the free software foundation with no invariant sections
mpl-1.1 | contents | 0.95 | the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 | contents | 0.95 | the contents of this file are subject to the mozilla public license version 1 0
mpl-2.0 | form | 1.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | incompatible | 0.9 | this source code form is incompatible with secondary licenses as defined by the mozilla public license
npl-1.1 | netscape | 0.9 | the contents of this file are subject to the netscape public license version 1 1
epl-1.0 | accompanying | 0.95 | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | accompanying | 0.95 | this program and the accompanying materials are made available under the terms of the eclipse public license v? ?2 0
epl | accompanying | 0.9 | this program and the accompanying materials are made available under the terms of the eclipse public license
epl-1.0 | agreement | 0.85 | the accompanying program is provided under the terms of this eclipse public license agreement
cpl-1.0 | agreement | 0.85 | the accompanying program is provided under the terms of this common public license agreement
ipl-1.0 | agreement | 0.85 | the accompanying program is provided under the terms of this ibm public license agreement
cddl | contents | 0.9 | the contents of this file are subject to the terms of the common development and distribution license
cddl-1.0 | covered | 0.8 | you can obtain a copy of the license at (?:[^ ]+ ){1,12}?see the license for the specific language governing permissions and limitations under the license when distributing covered code
zlib | held | 0.9 | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
zlib | misrepresented | 0.9 | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered | 0.9 | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
libpng | png | 0.85 | the png reference library is supplied as is
unlicense | unencumbered | 0.95 | this is free and unencumbered software released into the public domain
unlicense | dedicate | 0.85 | the author or authors of this software dedicate any and all copyright interest in the software to the public domain
wtfpl | fuck | 0.95 | you just do what the fuck you want to
wtfpl | verbatim | 0.8 | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
beerware | beer | 0.95 | if we meet some day and you think this stuff is worth it you can buy me a beer in return
cc0-1.0 | waived | 0.9 | to the extent possible under law (?:[^ ]+ ){1,12}?has waived all copyright and related or neighboring rights
cc0-1.0 | affirmer | 0.9 | affirmer hereby overtly fully permanently irrevocably and unconditionally waives
cc-by | creative | 0.9 | this work is licensed under (?:a |the )?creative commons attribution
cc-by-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution 4 0 international(?: public)? license
cc-by-sa-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution share ?alike 4 0 international(?: public)? license
cc-by-nc-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution non ?commercial 4 0 international(?: public)? license
cc-by-nd-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution no ?derivatives 4 0 international(?: public)? license
cc-by-nc-sa-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution non ?commercial share ?alike 4 0 international(?: public)? license
cc-by-nc-nd-4.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution non ?commercial no ?derivatives 4 0 international(?: public)? license
cc-by-3.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution 3 0 (?:unported |united states )?license
cc-by-sa-3.0 | creative | 0.95 | licensed under (?:a |the )?creative commons attribution share ?alike 3 0 (?:unported |united states )?license
artistic-1.0 | artistic | 0.85 | the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
artistic-2.0 | artistic | 0.85 | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed the intent is that the copyright holder maintains some artistic control
artistic | perl | 0.9 | you can redistribute it and or modify it under the same terms as perl itself
psf-2.0 | psf | 0.9 | this license agreement is between the python software foundation psf and the individual or organization
php-3.01 | php | 0.85 | redistributions of any form whatsoever must retain the following acknowledgment this product includes php software
openssl | openssl | 0.9 | this product includes software developed by the openssl project for use in the openssl toolkit
ssleay | cryptographic | 0.9 | this product includes cryptographic software written by eric young
ruby | bsdl | 0.85 | you can redistribute it and or modify it under either the terms of the 2 clause bsdl
postgresql | agreement | 0.85 | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ofl-1.1 | font | 0.95 | this font software is licensed under the sil open font license version 1 1
ofl-1.1 | font | 0.85 | permission is hereby granted free of charge to any person obtaining a copy of the font software to use study copy merge embed modify redistribute and sell modified and unmodified copies
ncsa | disclaimers | 0.9 | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers
ms-pl | microsoft | 0.85 | this license governs use of the accompanying software if you use the software you accept this license if you do not accept the license do not use the software microsoft public license
eupl-1.2 | eupl | 0.9 | licensed under the eupl version 1 2
eupl-1.1 | eupl | 0.9 | licensed under the eupl version 1 1
osl-3.0 | licensed | 0.9 | licensed under the open software license version 3 0
afl-3.0 | academic | 0.9 | licensed under the academic free license version 3 0
ecl-2.0 | educational | 0.9 | licensed under the educational community license version 2 0
odbl-1.0 | database | 0.9 | is made available under the open database license
odc-by-1.0 | attribution | 0.9 | is made available under the open data commons attribution license
sspl-1.0 | service | 0.85 | if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available
busl-1.1 | production | 0.85 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0 | hosted | 0.85 | you may not provide the software to third parties as a hosted or managed service
commons-clause | sell | 0.9 | the license does not grant to you and you are not granted (?:[^ ]+ ){0,3}?the right to sell the software
vim | vim | 0.85 | there are no restrictions on distributing unmodified copies of vim except that they must include this license text
w3c | royalty | 0.85 | permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted provided that
curl | hereby | 0.85 | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
tcl | authors | 0.85 | the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose
json | evil | 0.95 | the software shall be used for good not evil
ijg | jpeg | 0.9 | this software is based in part on the work of the independent jpeg group
freetype | freetype | 0.9 | portions of this software are copyright (?:[^ ]+ ){1,4}?the freetype project
llama | llama | 0.9 | llama (?:\d ?){1,3}is licensed under the llama (?:\d ?){1,3}community license
openrail | restricted | 0.85 | you shall not use the model or derivatives of the model (?:[^ ]+ ){0,6}?for the restricted uses
public-domain | domain | 0.9 | (?:the author|this (?:file|code|software|work)|i)(?: [^ ]+){0,6}? (?:is|are|has been|hereby)(?: [^ ]+){0,3}? (?:placed|released|dedicated|put)(?: [^ ]+){0,2}? (?:in|into|to) the public domain
proprietary | confidential | 0.8 | (?:this (?:file|document|software) (?:is|contains) )?(?:proprietary and confidential|confidential and proprietary)(?: information)?
proprietary | prohibited | 0.8 | unauthorized (?:copying|use|reproduction|distribution)(?: (?:copying|use|reproduction|or|and|distribution))* of this (?:file|software|document)(?: via any medium)? is strictly prohibited
"""
#: Labels that say nothing beside another one: a notice of rights stands at the head of free licenses too.
_WEAK = frozenset(["proprietary"])


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int
    weight: float
    order: int  # in the table


def _rules() -> dict[bytes, list[Rule]]:
    """The rules by each of their keywords, in the order of the tables: the signatures, and four for a family."""
    out: dict[bytes, list[Rule]] = {}

    def add(label: str, keys: str, pattern: str, priority: int, weight: float, order: int) -> None:
        rule = Rule(label, tuple(keys.encode().split(b",")), re.compile(rf"(?<= )(?:{pattern})(?= )".encode()), priority, weight, order)
        for key in rule.keywords:
            out.setdefault(key, []).append(rule)

    for order, line in enumerate(_SIGNATURES.strip().splitlines()):
        label, keywords, weight, pattern = line.split(" | ")
        add(label, keywords, pattern, 3, float(weight), order)
    grant = r"(?:(?:re)?licen[sc]ed|released|distributed|available|published|provided|covered|governed|redistributed|made available) (?:[^ ]+ ){0,3}?(?:under|by|with) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
    for order, line in enumerate(_FAMILIES.strip().splitlines(), 1_000):
        label, keywords, name, spdx, url = line.split(" | ")
        tagged = rf"spdx licen[sc]e identifier (?:{spdx})"
        for keys, pattern, priority, weight in ((keywords, rf"{grant}(?:{name})", 3, 0.95), (keywords, rf"(?:{name})", 1, 0.8), ("spdx", tagged, 4, 1.0), (url.split()[0], url, 2, 0.9)):
            if pattern != "-":
                add(label, keys, pattern, priority, weight, order)
    return out


RULES = _rules()
KEYWORDS = frozenset(RULES)


def normalised(text: str | None) -> bytes:
    """The text's words with a space before, between and after them; a single space without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def detections(words: list[bytes], line: bytes) -> list[tuple[int, int, Rule]]:
    """What the rules find, in order: (first byte, end, rule). A rule is tried once, if one of its keywords is
    there. A detection goes that lies within a longer one, or within an equal one of a higher
    priority or of an earlier rule. Of two that overlap in part the one of higher priority stays, then the longer, then the first."""
    tried = {id(r): r for k in KEYWORDS.intersection(words) for r in RULES[k]}.values()
    found = [(m.start(), m.end(), r) for r in tried for m in r.pattern.finditer(line)]
    outer: list[tuple[int, int, Rule]] = []
    reach = -1
    # By start, the longest first: what a detection is within has come before it and reaches as far.
    for a, b, rule in sorted(found, key=lambda x: (x[0], -x[1], -x[2].priority, x[2].order)):
        if b > reach:
            outer.append((a, b, rule))
            reach = b
    # None is within another now, so starts and ends both ascend, and one that is taken can only cut neighbours.
    gone: set[int] = set()
    for k in sorted(range(len(outer)), key=lambda k: (-outer[k][2].priority, outer[k][0] - outer[k][1], k)):
        if k in gone:
            continue
        for step in (-1, 1):
            j = k + step
            while 0 <= j < len(outer) and outer[max(j, k)][0] < outer[min(j, k)][1]:
                gone.add(j)
                j += step
    return [x for k, x in enumerate(outer) if k not in gone]


def scanned(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    line = normalised(text)
    words = line.split()
    hits = []
    for phrase, label in BASE.items():
        wanted = b" " + phrase + b" "
        at = line.find(wanted)
        while at >= 0:
            hits.append((at, label))
            at = line.find(wanted, at + 1)
    first = last = None
    if hits:
        starts = [at for at, _ in hits]
        first = line.count(b" ", 0, min(starts))
        last = first + line.count(b" ", min(starts), max(starts))
    base = {label for _, label in hits}
    found = detections(words, line)
    own = {r.label for _, _, r in found}
    strong = own - _WEAK
    labels = base | (strong if strong or base else own)
    score = max([0.8 * bool(base), *(r.weight for _, _, r in found)])
    return len(words), len(hits), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(text: Column) -> Column:
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            frame = pd.DataFrame([scanned(t) for t in texts], columns=[c.split()[0] for c in FIELDS.split(", ")])
            yield frame.astype({"first_word": "Int64", "last_word": "Int64"})

    return F.pandas_udf(read, FIELDS)(text)


def license_scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Adds n_words, n_base, first_word, last_word, base_labels, labels and score to every row; columns of
    docs with these names are replaced. Null and empty texts have no words, no labels and score zero; texts of any length are
    scanned whole; repeated rows have equal results; an empty table gives no rows.

    Base phrases are counted wherever their words stand in a row. The labels add what the ordered rules find: wording of notices and
    grants, names, SPDX tags and addresses, with detections inside longer ones and those cut by one of higher priority
    suppressed. A notice of reserved rights counts only where no license is found. The score is the weight of the surest detection.
    """
    names = [c.split()[0] for c in FIELDS.split(", ")]
    docs = small_batches(docs).drop(*names)
    got = fresh(docs, "got")
    out = docs.withColumn(got, scan(F.col(f"`{text_col}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"{got}.{n}").alias(n) for n in names])
