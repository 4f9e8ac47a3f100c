"""Signature rules of license wordings, written by hand.

A line is ``label | priority | keys | expression``. Priority 1 is a grant or an identifier in full, 2 a name with its
version, 3 a name, 4 a hint. A rule is tried only where all its keys are words of the text (one with two letters in brackets stands for either word). An expression is matched
against words in lower case (only letters and digits are left of a text), and a blank in it stands between two words. Expressions
keep to what Java's and RE2's regular expressions have in common, and never match part of a word.
"""

from __future__ import annotations

from typing import NamedTuple

RULES_TEXT = r"""
cc-by | 3 | cc by | cc by
gpl | 3 | general public license | general public license
reserved | 4 | all rights reserved | all rights reserved

mit | 1 | spdx mit | spdx license identifier mit
mit | 1 | permission granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 2 | mit licen[cs]e | (?:released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 2 | mit licensed licen[cs]e | licensed under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
mit | 3 | mit licen[cs]e | mit licen[cs]e
mit | 3 | mit licensed | mit licensed
mit | 3 | expat licen[cs]e | (?:mit )?expat licen[cs]e
mit | 3 | mit lizenz | mit lizenz
mit | 3 | licence mit | licence mit
mit | 3 | licencia mit | licencia mit
mit-0 | 1 | spdx mit 0 | spdx license identifier mit 0
mit-0 | 2 | mit no attribution | mit no attribution(?: licen[cs]e)?
mit | 4 | software provided warranty | the software is provided as is without warranty of any kind express or implied

apache-2.0 | 1 | spdx apache | spdx license identifier apache 2 0
apache-2.0 | 1 | apache license compliance | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | 1 | apache licenses license | (?:https? )?www apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 2 | apache version 2 licen[cs]e | (?:licensed under )?(?:the )?apache(?: software)? licen[cs]e version 2(?: 0)?
apache-2.0 | 2 | apache 2 licen[cs]e | apache(?: software)? licen[cs]e 2(?: 0)?
apache-2.0 | 2 | apache v2 licen[cs]e | apache(?: software)? licen[cs]e v2(?: 0)?
apache-2.0 | 2 | apache 2 | apache 2(?: 0)?(?: licen[cs]ed?)?
apache-2.0 | 2 | asl 2 0 | asl 2 0
apache-2.0 | 2 | apache lizenz 2 | apache lizenz (?:version )?2(?: 0)?
apache-1.1 | 1 | spdx apache 1 | spdx license identifier apache 1 1
apache-1.1 | 2 | apache 1 licen[cs]e | apache(?: software)? licen[cs]e (?:version )?1 1
apache-1.0 | 2 | apache 1 licen[cs]e | apache(?: software)? licen[cs]e (?:version )?1 0
apache | 3 | apache licen[cs]e | apache(?: software)? licen[cs]e
apache | 3 | licence apache | licence apache
apache | 3 | licencia apache | licencia apache

gpl-3.0 | 1 | spdx gpl 3 | spdx license identifier gpl 3 0(?: only| or later)?
gpl-2.0 | 1 | spdx gpl 2 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 1 | gnu general public license | it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-2.0 | 1 | gnu general public license | it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0 | 2 | general public license 3 | (?:gnu )?general public license (?:version )?3(?: 0)?
gpl-3.0 | 2 | general public license v3 | (?:gnu )?general public license v3(?: 0)?
gpl-2.0 | 2 | general public license 2 | (?:gnu )?general public license (?:version )?2(?: 0)?
gpl-2.0 | 2 | general public license v2 | (?:gnu )?general public license v2(?: 0)?
gpl-1.0 | 2 | general public license 1 | (?:gnu )?general public license (?:version )?1(?: 0)?
gpl-3.0 | 2 | gpl 3 | (?:gnu )?gpl (?:version )?3(?: 0)?
gpl-3.0 | 2 | gpl v3 | (?:gnu )?gpl v3(?: 0)?
gpl-3.0 | 2 | gplv3 | (?:gnu )?gplv3
gpl-2.0 | 2 | gpl 2 | (?:gnu )?gpl (?:version )?2(?: 0)?
gpl-2.0 | 2 | gpl v2 | (?:gnu )?gpl v2(?: 0)?
gpl-2.0 | 2 | gplv2 | (?:gnu )?gplv2
gpl | 3 | gnu gpl | gnu gpl
gpl | 3 | gpl licen[cs]e | gpl licen[cs]e
gpl | 3 | gpl licensed | gpl licensed
gpl | 3 | gnu public licen[cs]e | gnu public licen[cs]e
gpl | 3 | licence publique generale gnu | licence publique generale gnu
gpl | 3 | licence publique générale gnu | licence publique générale gnu
gpl | 3 | licencia pública general gnu | licencia pública general (?:de )?gnu
gpl | 4 | www gnu org licenses | www gnu org licenses(?: gpl)?
gpl-classpath | 2 | gpl classpath exception | gpl (?:v2 |2 0 |2 )?with (?:the )?classpath exception

lgpl-3.0 | 1 | spdx lgpl 3 | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-2.1 | 1 | spdx lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 2 | lesser general public license 3 | (?:gnu )?lesser general public license (?:version )?3(?: 0)?
lgpl-3.0 | 2 | lesser general public license v3 | (?:gnu )?lesser general public license v3(?: 0)?
lgpl-2.1 | 2 | lesser general public license 2 1 | (?:gnu )?lesser general public license (?:version )?2 1
lgpl-2.1 | 2 | lesser general public license v2 1 | (?:gnu )?lesser general public license v2 1
lgpl-2.0 | 2 | library general public license | (?:gnu )?library general public license(?: version 2| v2)?(?: 0)?
lgpl-2.1 | 2 | lgpl 2 1 | lgpl (?:version )?2 1
lgpl-2.1 | 2 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | 2 | lgpl 3 | lgpl (?:version )?3(?: 0)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
lgpl | 3 | lesser general public license | (?:gnu )?lesser general public license
lgpl | 3 | gnu lgpl | gnu lgpl
lgpl | 3 | lgpl licen[cs]e | lgpl licen[cs]e

agpl-3.0 | 1 | spdx agpl | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 2 | affero general public license 3 | (?:gnu )?affero general public license (?:version )?3(?: 0)?
agpl-3.0 | 2 | affero general public license v3 | (?:gnu )?affero general public license v3(?: 0)?
agpl-3.0 | 2 | agpl 3 | agpl (?:version )?3(?: 0)?
agpl-3.0 | 2 | agplv3 | agplv3
agpl-1.0 | 2 | affero general public license 1 | affero general public license (?:version )?1(?: 0)?
agpl | 3 | affero general public license | (?:gnu )?affero general public license
agpl | 3 | gnu agpl | gnu agpl
gfdl-1.3 | 1 | spdx gfdl 3 | spdx license identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | 2 | free documentation 1 3 licen[cs]e | (?:gnu )?free documentation licen[cs]e (?:version )?1 3
gfdl-1.2 | 2 | free documentation 1 2 licen[cs]e | (?:gnu )?free documentation licen[cs]e (?:version )?1 2
gfdl-1.1 | 2 | free documentation 1 licen[cs]e | (?:gnu )?free documentation licen[cs]e (?:version )?1 1
gfdl | 3 | free documentation licen[cs]e | (?:gnu )?free documentation licen[cs]e
gfdl | 3 | gfdl | (?:gnu )?gfdl
free-art | 2 | free art licen[cs]e | free art licen[cs]e(?: 1 3)?
free-art | 2 | licence art libre | licence art libre(?: 1 3)?

bsd-2-clause | 1 | spdx bsd 2 clause | spdx license identifier bsd 2 clause
bsd-3-clause | 1 | spdx bsd 3 clause | spdx license identifier bsd 3 clause
bsd-3-clause | 1 | neither endorse | neither the name of (?:the )?[^ ]+(?: [^ ]+)? nor the names of its contributors may be used to endorse or promote products
bsd-2-clause | 1 | redistribution source binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd-2-clause | 2 | bsd 2 clause | bsd 2 clause(?: licen[cs]e)?
bsd-2-clause | 2 | 2 clause bsd | 2 clause bsd(?: licen[cs]e)?
bsd-2-clause | 2 | simplified bsd licen[cs]e | simplified bsd licen[cs]e
bsd-2-clause | 2 | freebsd licen[cs]e | freebsd licen[cs]e
bsd-3-clause | 2 | bsd 3 clause | bsd 3 clause(?: licen[cs]e)?
bsd-3-clause | 2 | 3 clause bsd | 3 clause bsd(?: licen[cs]e)?
bsd-3-clause | 2 | new bsd licen[cs]e | new bsd licen[cs]e
bsd-3-clause | 2 | modified bsd licen[cs]e | modified bsd licen[cs]e
bsd-3-clause | 2 | revised bsd licen[cs]e | revised bsd licen[cs]e
bsd-4-clause | 2 | bsd 4 clause | bsd 4 clause(?: licen[cs]e)?
bsd-4-clause | 2 | original bsd licen[cs]e | original bsd licen[cs]e
bsd-4-clause | 1 | advertising materials mentioning | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
0bsd | 1 | spdx 0bsd | spdx license identifier 0bsd
0bsd | 2 | zero clause bsd | zero clause bsd(?: licen[cs]e)?
bsd | 3 | bsd licen[cs]e | bsd licen[cs]e
bsd | 3 | bsd licensed | bsd licensed
bsd | 3 | bsd style licen[cs]e | bsd style licen[cs]e
bsd | 3 | bsd lizenz | bsd lizenz
bsd | 3 | licence bsd | licence bsd
bsd | 3 | licencia bsd | licencia bsd

mpl-2.0 | 1 | spdx mpl 2 | spdx license identifier mpl 2 0
mpl-2.0 | 1 | mozilla source form subject | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 2 | mozilla public 2 licen[cs]e | mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-2.0 | 2 | mozilla public v2 licen[cs]e | mozilla public licen[cs]e v2(?: 0)?
mpl-1.1 | 2 | mozilla public 1 licen[cs]e | mozilla public licen[cs]e (?:version )?1 1
mpl-1.0 | 2 | mozilla public 1 0 licen[cs]e | mozilla public licen[cs]e (?:version )?1 0
mpl-2.0 | 2 | mpl 2 0 | mpl 2 0
mpl-1.1 | 2 | mpl 1 | mpl 1 1
mpl | 3 | mozilla public licen[cs]e | mozilla public licen[cs]e
epl-2.0 | 1 | spdx epl 2 | spdx license identifier epl 2 0
epl-1.0 | 1 | spdx epl 1 | spdx license identifier epl 1 0
epl-2.0 | 2 | eclipse public 2 licen[cs]e | eclipse public licen[cs]e (?:version |v )?2(?: 0)?
epl-1.0 | 2 | eclipse public 1 licen[cs]e | eclipse public licen[cs]e (?:version |v )?1(?: 0)?
epl | 3 | eclipse public licen[cs]e | eclipse public licen[cs]e
edl-1.0 | 2 | eclipse distribution licen[cs]e | eclipse distribution licen[cs]e(?: (?:version |v )?1 0)?
cddl-1.0 | 1 | spdx cddl 1 0 | spdx license identifier cddl 1 0
cddl-1.1 | 1 | spdx cddl 1 | spdx license identifier cddl 1 1
cddl-1.0 | 2 | common development distribution 1 0 licen[cs]e | common development and distribution licen[cs]e (?:version )?1 0
cddl-1.1 | 2 | common development distribution 1 licen[cs]e | common development and distribution licen[cs]e (?:version )?1 1
cddl | 3 | common development distribution licen[cs]e | common development and distribution licen[cs]e
cddl | 3 | cddl | cddl
cpl-1.0 | 2 | common public 1 0 licen[cs]e | common public licen[cs]e (?:version )?1 0
cpl | 3 | common public licen[cs]e | common public licen[cs]e
ipl-1.0 | 2 | ibm public licen[cs]e | ibm public licen[cs]e(?: version 1 0)?
eupl-1.2 | 1 | spdx eupl 1 2 | spdx license identifier eupl 1 2
eupl-1.2 | 2 | european union public 1 2 licen[cs]e | european union public licen[cs]e (?:v |version )?1 2
eupl-1.1 | 2 | european union public 1 licen[cs]e | european union public licen[cs]e (?:v |version )?1 1
eupl | 3 | european union public licen[cs]e | european union public licen[cs]e
eupl | 3 | eupl | eupl
cecill-2.1 | 2 | cecill 2 1 | (?:licence )?cecill (?:version )?2 1
cecill-b | 2 | cecill b | (?:licence )?cecill b
cecill-c | 2 | cecill c | (?:licence )?cecill c
cecill | 3 | cecill | (?:licence )?cecill
osl-3.0 | 2 | open software 3 licen[cs]e | open software licen[cs]e (?:version |v )?3(?: 0)?
osl | 3 | open software licen[cs]e | open software licen[cs]e
afl-3.0 | 2 | academic free 3 licen[cs]e | academic free licen[cs]e (?:version |v )?3(?: 0)?
afl | 3 | academic free licen[cs]e | academic free licen[cs]e
artistic-2.0 | 1 | spdx artistic 2 | spdx license identifier artistic 2 0
artistic-2.0 | 2 | artistic 2 licen[cs]e | artistic licen[cs]e 2(?: 0)?
artistic-1.0 | 2 | artistic 1 licen[cs]e | artistic licen[cs]e 1(?: 0)?
artistic | 3 | artistic licen[cs]e | artistic licen[cs]e
perl | 3 | same terms perl | (?:under )?the same terms as perl(?: itself)?
ms-pl | 2 | microsoft public licen[cs]e | microsoft public licen[cs]e
ms-rl | 2 | microsoft reciprocal licen[cs]e | microsoft reciprocal licen[cs]e
ms-pl | 1 | spdx ms pl | spdx license identifier ms pl
apsl-2.0 | 2 | apple public source licen[cs]e | apple public source licen[cs]e(?: 2 0)?
npl | 2 | netscape public licen[cs]e | netscape public licen[cs]e(?: (?:version )?1 [01])?
nokia | 2 | nokia open source licen[cs]e | nokia open source licen[cs]e
qpl-1.0 | 2 | q public licen[cs]e | q public licen[cs]e(?: version 1 0)?
spl | 2 | sun public licen[cs]e | sun public licen[cs]e
lppl-1.3c | 2 | latex project public 1 3c licen[cs]e | latex project public licen[cs]e (?:version )?1 3c
lppl | 3 | latex project public licen[cs]e | latex project public licen[cs]e
erlpl | 2 | erlang public licen[cs]e | erlang public licen[cs]e
intel | 2 | intel open source licen[cs]e | intel open source licen[cs]e
upl-1.0 | 2 | universal permissive licen[cs]e | universal permissive licen[cs]e(?: (?:version |v )?1 0)?
ecl-2.0 | 2 | educational community licen[cs]e | educational community licen[cs]e(?: (?:version )?2 0)?
ncsa | 2 | illinois ncsa licen[cs]e | (?:university of )?illinois ncsa open source licen[cs]e
ncsa | 3 | ncsa licen[cs]e | ncsa licen[cs]e
isc | 1 | spdx isc | spdx license identifier isc
isc | 1 | permission purpose fee granted | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 3 | isc licen[cs]e | isc licen[cs]e
isc | 3 | isc licensed | isc licensed
zlib | 1 | spdx zlib | spdx license identifier zlib
zlib | 1 | altered source versions misrepresented | altered source versions must be plainly marked as such and must not be misrepresented
zlib | 3 | zlib licen[cs]e | zlib(?: libpng)? licen[cs]e
libpng | 3 | libpng licen[cs]e | libpng licen[cs]e
bsl-1.0 | 1 | spdx bsl 1 0 | spdx license identifier bsl 1 0
bsl-1.0 | 2 | boost software licen[cs]e | boost software licen[cs]e(?: version 1 0)?
busl-1.1 | 1 | spdx busl | spdx license identifier busl 1 1
busl-1.1 | 2 | business source licen[cs]e | business source licen[cs]e(?: (?:version )?1 1)?
sspl-1.0 | 1 | spdx sspl | spdx license identifier sspl 1 0
sspl-1.0 | 2 | server side public licen[cs]e | server side public licen[cs]e(?: (?:version |v )?1)?
elastic-2.0 | 2 | elastic 2 licen[cs]e | elastic licen[cs]e (?:version |v )?2(?: 0)?
elastic | 3 | elastic licen[cs]e | elastic licen[cs]e
commons-clause | 2 | commons clause | commons clause(?: licen[cs]e condition)?(?: v1 0)?
polyform-nc | 2 | polyform noncommercial licen[cs]e | polyform noncommercial licen[cs]e(?: 1 0 0)?
prosperity | 2 | prosperity public licen[cs]e | prosperity public licen[cs]e
parity | 2 | parity public licen[cs]e | parity public licen[cs]e
blueoak-1.0.0 | 2 | blue oak model licen[cs]e | blue oak model licen[cs]e(?: 1 0 0)?
mulan-2.0 | 2 | mulan psl v2 | mulan psl v2
mulan-2.0 | 2 | mulan permissive licen[cs]e | mulan permissive software licen[cs]e(?: (?:version )?2)?
unlicense | 1 | spdx unlicense | spdx license identifier unlicense
unlicense | 1 | free unencumbered released public | this is free and unencumbered software released into the public domain
unlicense | 3 | unlicense | (?:the )?unlicense
wtfpl | 3 | wtfpl | wtfpl
wtfpl | 2 | do want public licen[cs]e | do what the [^ ]+ you want to public licen[cs]e
beerware | 3 | beerware licen[cs]e | beerware licen[cs]e
beerware | 3 | beer ware licen[cs]e | beer ware licen[cs]e
x11 | 3 | x11 licen[cs]e | (?:mit )?x11 licen[cs]e
hpnd | 3 | historical permission notice disclaimer | historical permission notice and disclaimer
python-2.0 | 2 | python software foundation licen[cs]e | python software foundation licen[cs]e(?: (?:version )?2)?
python | 3 | python licen[cs]e | python licen[cs]e
psf | 3 | psf licen[cs]e | psf licen[cs]e
php-3.01 | 2 | php 3 01 licen[cs]e | php licen[cs]e (?:version )?3 01
php | 3 | php licen[cs]e | php licen[cs]e
ruby | 3 | ruby licen[cs]e | ruby licen[cs]e
zend-2.0 | 2 | zend licen[cs]e | zend licen[cs]e(?: (?:version )?2 0)?
openssl | 2 | openssl licen[cs]e | openssl licen[cs]e
ssleay | 3 | ssleay licen[cs]e | (?:original )?ssleay licen[cs]e
vim | 3 | vim licen[cs]e | vim licen[cs]e
tcl | 3 | tcl tk licen[cs]e | tcl tk licen[cs]e
postgresql | 2 | postgresql licen[cs]e | postgresql licen[cs]e
curl | 3 | curl licen[cs]e | curl licen[cs]e
icu | 3 | icu licen[cs]e | icu licen[cs]e
unicode | 2 | unicode agreement licen[cs]e | unicode inc licen[cs]e agreement
unicode | 3 | unicode licen[cs]e | unicode licen[cs]e(?: v3)?
w3c | 2 | w3c software notice licen[cs]e | w3c software(?: and document)? notice and licen[cs]e
w3c | 3 | w3c licen[cs]e | w3c licen[cs]e
ijg | 3 | independent jpeg group | independent jpeg group(?: licen[cs]e)?
ofl-1.1 | 1 | spdx ofl 1 | spdx license identifier ofl 1 1
ofl-1.1 | 2 | sil open font licen[cs]e | sil open font licen[cs]e(?: (?:version |v )?1 1)?
ofl | 3 | open font licen[cs]e | open font licen[cs]e
ofl | 3 | ofl | ofl
ubuntu-font | 2 | ubuntu font licen[cs]e | ubuntu font licen[cs]e(?: version 1 0)?
bitstream-vera | 2 | bitstream vera fonts copyright | bitstream vera fonts copyright

cc0-1.0 | 1 | spdx cc0 | spdx license identifier cc0 1 0
cc0-1.0 | 2 | cc0 1 0 | cc0 1 0(?: universal)?
cc0-1.0 | 2 | creative commons cc0 | creative commons cc0(?: 1 0)?(?: universal)?
cc0-1.0 | 2 | creativecommons publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | creative commons zero | creative commons zero(?: (?:v )?1 0)?(?: universal)?
cc0-1.0 | 3 | cc0 | cc0
cc-pdm | 2 | creativecommons publicdomain mark | creativecommons org publicdomain mark 1 0
cc-pdm | 3 | public domain mark | public domain mark(?: 1 0)?
cc-by-4.0 | 1 | creativecommons licenses by 4 0 | creativecommons org licenses by 4 0
cc-by-3.0 | 1 | creativecommons licenses by 3 0 | creativecommons org licenses by 3 0
cc-by-2.0 | 1 | creativecommons licenses by 2 0 | creativecommons org licenses by 2 0
cc-by-2.5 | 1 | creativecommons licenses by 2 5 | creativecommons org licenses by 2 5
cc-by-sa-4.0 | 1 | creativecommons licenses by sa 4 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 1 | creativecommons licenses by sa 3 | creativecommons org licenses by sa 3 0
cc-by-sa-2.0 | 1 | creativecommons licenses by sa 2 0 | creativecommons org licenses by sa 2 0
cc-by-sa-2.5 | 1 | creativecommons licenses by sa 2 5 | creativecommons org licenses by sa 2 5
cc-by-nc-4.0 | 1 | creativecommons licenses by nc 4 | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | 1 | creativecommons licenses by nc 3 | creativecommons org licenses by nc 3 0
cc-by-nc-2.0 | 1 | creativecommons licenses by nc 2 | creativecommons org licenses by nc 2 0
cc-by-nd-4.0 | 1 | creativecommons licenses by nd 4 | creativecommons org licenses by nd 4 0
cc-by-nd-3.0 | 1 | creativecommons licenses by nd 3 | creativecommons org licenses by nd 3 0
cc-by-nc-sa-4.0 | 1 | creativecommons licenses by nc sa 4 | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | 1 | creativecommons licenses by nc sa 3 | creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 | 1 | creativecommons licenses by nc nd 4 | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 | 1 | creativecommons licenses by nc nd 3 | creativecommons org licenses by nc nd 3 0
cc-by-4.0 | 2 | cc by 4 0 | cc by 4 0
cc-by-3.0 | 2 | cc by 3 0 | cc by 3 0
cc-by-2.5 | 2 | cc by 2 5 | cc by 2 5
cc-by-2.0 | 2 | cc by 2 0 | cc by 2 0
cc-by-sa-4.0 | 2 | cc by sa 4 0 | cc by sa 4 0
cc-by-sa-3.0 | 2 | cc by sa 3 0 | cc by sa 3 0
cc-by-sa-2.5 | 2 | cc by sa 2 5 | cc by sa 2 5
cc-by-sa-2.0 | 2 | cc by sa 2 0 | cc by sa 2 0
cc-by-nc-4.0 | 2 | cc by nc 4 0 | cc by nc 4 0
cc-by-nc-3.0 | 2 | cc by nc 3 0 | cc by nc 3 0
cc-by-nc-2.0 | 2 | cc by nc 2 0 | cc by nc 2 0
cc-by-nd-4.0 | 2 | cc by nd 4 0 | cc by nd 4 0
cc-by-nd-3.0 | 2 | cc by nd 3 0 | cc by nd 3 0
cc-by-nc-sa-4.0 | 2 | cc by nc sa 4 0 | cc by nc sa 4 0
cc-by-nc-sa-3.0 | 2 | cc by nc sa 3 0 | cc by nc sa 3 0
cc-by-nc-nd-4.0 | 2 | cc by nc nd 4 0 | cc by nc nd 4 0
cc-by-nc-nd-3.0 | 2 | cc by nc nd 3 0 | cc by nc nd 3 0
cc-by-sa | 3 | cc by sa | cc by sa
cc-by-nc | 3 | cc by nc | cc by nc
cc-by-nd | 3 | cc by nd | cc by nd
cc-by-nc-sa | 3 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 3 | cc by nc nd | cc by nc nd
cc-by-4.0 | 2 | creative commons attribution 4 | creative commons attribution 4 0(?: international)?(?: licen[cs]e)?
cc-by-3.0 | 2 | creative commons attribution 3 | creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
cc-by-sa-4.0 | 2 | creative commons attribution sharealike 4 | creative commons attribution sharealike 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa-4.0 | 2 | creative commons attribution share alike 4 | creative commons attribution share alike 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa-3.0 | 2 | creative commons attribution sharealike 3 | creative commons attribution sharealike 3 0(?: unported)?(?: licen[cs]e)?
cc-by-sa-3.0 | 2 | creative commons attribution share alike 3 | creative commons attribution share alike 3 0(?: unported)?(?: licen[cs]e)?
cc-by-nc-4.0 | 2 | creative commons attribution noncommercial 4 | creative commons attribution noncommercial 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-4.0 | 2 | creative commons attribution non commercial 4 | creative commons attribution non commercial 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-sa-4.0 | 2 | creative commons attribution noncommercial sharealike 4 | creative commons attribution noncommercial sharealike 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-nd-4.0 | 2 | creative commons attribution noncommercial 4 | creative commons attribution noncommercial noderiv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?
cc-by-nd-4.0 | 2 | creative commons attribution noderivatives 4 | creative commons attribution noderivatives 4 0(?: international)?(?: licen[cs]e)?
cc-by | 3 | creative commons attribution | creative commons attribution(?: licen[cs]e)?
cc-by-sa | 3 | creative commons attribution sharealike | creative commons attribution sharealike
cc-by-sa | 3 | creative commons attribution share alike | creative commons attribution share alike
cc-by-nc | 3 | creative commons attribution noncommercial | creative commons attribution noncommercial
cc | 3 | creative commons licen[cs]e | creative commons licen[cs]e
cc | 3 | creative commons lizenz | creative commons lizenz
cc | 3 | licence creative commons | licence creative commons
cc | 3 | licencia creative commons | licencia creative commons
cc | 4 | creative commons | creative commons

odbl-1.0 | 1 | spdx odbl | spdx license identifier odbl 1 0
odbl-1.0 | 2 | open database licen[cs]e | open database licen[cs]e(?: (?:v |version )?1 0)?
odbl-1.0 | 3 | odbl | odbl
odc-by-1.0 | 2 | open data commons attribution licen[cs]e | open data commons attribution licen[cs]e(?: (?:v |version )?1 0)?
pddl-1.0 | 2 | public domain dedication licen[cs]e | (?:open data commons )?public domain dedication and licen[cs]e
pddl-1.0 | 3 | pddl | pddl
cdla-permissive | 2 | community data permissive licen[cs]e | community data licen[cs]e agreement permissive(?: version)?(?: [12] 0)?
cdla-sharing | 2 | community data sharing licen[cs]e | community data licen[cs]e agreement sharing(?: version)?(?: 1 0)?
ogl-uk-3.0 | 2 | open government v3 licen[cs]e | open government licen[cs]e v3(?: 0)?
ogl-uk | 3 | open government licen[cs]e | open government licen[cs]e
ogl-canada | 2 | open government canada licen[cs]e | open government licen[cs]e canada
etalab-2.0 | 2 | etalab | (?:licence ouverte )?etalab(?: licence ouverte)?(?: (?:version )?2 0)?
dl-de-by-2.0 | 2 | datenlizenz deutschland namensnennung | datenlizenz deutschland namensnennung(?: (?:version )?2 0)?
dl-de-zero-2.0 | 2 | datenlizenz deutschland zero | datenlizenz deutschland zero(?: (?:version )?2 0)?
openrail | 2 | openrail licen[cs]e | (?:creativeml |bigscience )?openrail(?: m)? licen[cs]e
openrail | 2 | open rail licen[cs]e | (?:creativeml |bigscience )?open rail(?: m)? licen[cs]e
openrail | 3 | openrail | (?:creativeml |bigscience )?openrail(?: m)?
rail | 3 | responsible ai | responsible ai licen[cs]es?
llama-community | 2 | llama community licen[cs]e | llama (?:2 |3 |3 1 |3 2 )?community licen[cs]e(?: agreement)?
gemma-terms | 2 | gemma terms use | gemma terms of use

public-domain | 3 | public domain | public domain
public-domain | 2 | public domain | (?:dedicated|released|placed) (?:in)?to the public domain
public-domain | 3 | gemeinfrei | gemeinfrei(?:e|es|er|en)?
public-domain | 3 | domaine public | domaine public
public-domain | 3 | dominio público | dominio público
copyright | 4 | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
copyright | 4 | copyright by | copyright (?:c )?by
reserved | 4 | alle rechte vorbehalten | alle rechte vorbehalten
reserved | 4 | tous droits réservés | tous droits réservés
reserved | 4 | todos derechos reservados | todos los derechos reservados
reserved | 4 | tutti diritti riservati | tutti i diritti riservati
reserved | 4 | some rights reserved | some rights reserved
reserved | 4 | no rights reserved | no rights reserved
proprietary | 2 | proprietary confidential | proprietary and confidential
proprietary | 2 | copying prohibited | unauthori[sz]ed copying of this (?:file|document|work)(?: via any medium)? is strictly prohibited
proprietary | 3 | proprietary licen[cs]e | proprietary licen[cs]e
proprietary | 3 | commercial licen[cs]e | (?:under a )?commercial licen[cs]e
non-commercial | 3 | noncommercial use only | (?:for )?noncommercial use only
non-commercial | 3 | non commercial use only | (?:for )?non commercial use only
non-commercial | 3 | personal use only | (?:for )?personal use only
non-commercial | 3 | research purposes only | (?:for )?(?:academic |non commercial )?research purposes only
no-redistribution | 3 | may not redistributed | may not be (?:reproduced or )?redistributed
no-redistribution | 3 | reproduced without permission | (?:may not be )?reproduced without (?:the )?(?:prior )?(?:written )?permission
no-ai-training | 2 | training prohibited | (?:use|used) for (?:ai|machine learning|the) training is (?:strictly )?prohibited
reprinted | 4 | reprinted permission | reprinted (?:with|by) (?:kind )?permission
eula | 3 | end user agreement licen[cs]e | end user licen[cs]e agreement
open-source | 4 | open source licen[cs]e | open source licen[cs]e
open-source | 4 | free software licen[cs]e | free software licen[cs]e
dual | 3 | dual licensed | dual(?:ly)? licensed
"""

#: How sure a label is by the priority of the rule that gives it.
WEIGHTS = {1: 0.99, 2: 0.95, 3: 0.8, 4: 0.4}


class Rule(NamedTuple):
    order: int
    label: str
    priority: int
    keys: list[list[str]]
    expression: str
    base: bool


def rules_of(text: str = RULES_TEXT, base: int = 3) -> list[Rule]:
    """The rules in order; the first ``base`` of them are the phrases that are counted."""
    out = []
    for line in filter(None, map(str.strip, text.split("\n"))):
        label, priority, keys, expression = (x.strip() for x in line.split("|", 3))
        out.append(Rule(len(out), label, int(priority), [variants(k) for k in keys.split()], cells(expression), len(out) < base))
    return out


def variants(key: str) -> list[str]:
    """``licen[cs]e`` is licence or license."""
    head, bracket, rest = key.partition("[")
    letters, _, tail = rest.partition("]")
    return [f"{head}{x}{tail}" for x in letters] if bracket else [key]


def cells(expression: str) -> str:
    """The expression over words that each stand between two blanks of their own, so that no two matches share one."""
    return f" {expression.replace(' ', '  ')} "
