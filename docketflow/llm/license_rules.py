"""Signature rules of the license scan, by hand, most specific families first.

One rule a line: label ; priority ; score ; keyword ; pattern.  Patterns are regular
expressions over words joined by single spaces, as the scan normalises a text (letters
A-Z lower-cased, everything but letters and digits a border); they match whole words.
The keyword is a word that every match holds, so that a text without it needs no look at
the pattern.  ``<a,b>`` in a pattern makes one rule for each of its words, and the label's
and keyword's ``*`` then stands for it, spaces as dots (keyword: as written).

Priorities: 1 identifiers and whole grants, 2 a license with its version, 3 a license by
name, 4 a hint that needs a better rule to say more, 5 the opposite of a license.
"""

from __future__ import annotations

import re

#: The phrases that always count, whatever else is found there.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = {"cc-by": 0.7, "gpl": 0.7, "reserved": 0.6}

CC_VERSIONS = "<1 0,2 0,2 5,3 0,4 0>"

TABLE = f"""
# Creative Commons: short names, long names, deeds, dedications
cc-by-* ; 2 ; 0.95 ; cc ; cc by {CC_VERSIONS}
cc-by-sa-* ; 2 ; 0.95 ; cc ; cc by sa {CC_VERSIONS}
cc-by-nc-* ; 2 ; 0.95 ; cc ; cc by nc {CC_VERSIONS}
cc-by-nd-* ; 2 ; 0.95 ; cc ; cc by nd {CC_VERSIONS}
cc-by-nc-sa-* ; 2 ; 0.95 ; cc ; cc by nc sa {CC_VERSIONS}
cc-by-nc-nd-* ; 2 ; 0.95 ; cc ; cc by nc nd {CC_VERSIONS}
cc-by-sa ; 3 ; 0.85 ; cc ; cc by sa
cc-by-nc ; 3 ; 0.85 ; cc ; cc by nc
cc-by-nd ; 3 ; 0.85 ; cc ; cc by nd
cc-by-nc-sa ; 3 ; 0.85 ; cc ; cc by nc sa
cc-by-nc-nd ; 3 ; 0.85 ; cc ; cc by nc nd
cc-by-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution {CC_VERSIONS}(?: international| unported| generic)
cc-by-sa-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution share ?alike {CC_VERSIONS}(?: international| unported| generic)?
cc-by-nc-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution non ?commercial {CC_VERSIONS}(?: international| unported| generic)?
cc-by-nd-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution no ?deriv(?:ative)?s? {CC_VERSIONS}(?: international| unported| generic)?
cc-by-nc-sa-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution non ?commercial share ?alike {CC_VERSIONS}(?: international| unported| generic)?
cc-by-nc-nd-* ; 2 ; 0.95 ; attribution ; (?:creative commons )?attribution non ?commercial no ?deriv(?:ative)?s? {CC_VERSIONS}(?: international| unported| generic)?
cc-by ; 3 ; 0.85 ; attribution ; creative commons attribution(?: licen[cs]e)?
cc-by-sa ; 3 ; 0.85 ; attribution ; creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-nc ; 3 ; 0.85 ; attribution ; creative commons attribution non ?commercial(?: licen[cs]e)?
cc-by-nc-sa ; 3 ; 0.85 ; attribution ; creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?
cc-by-nc-nd ; 3 ; 0.85 ; attribution ; creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: licen[cs]e)?
cc-by ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by [1-4] [05]
cc-by-sa ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by sa [1-4] [05]
cc-by-nc ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by nc [1-4] [05]
cc-by-nd ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by nd [1-4] [05]
cc-by-nc-sa ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc-nd ; 1 ; 0.95 ; creativecommons ; creativecommons org licenses by nc nd [1-4] [05]
cc0-1.0 ; 1 ; 0.95 ; creativecommons ; creativecommons org publicdomain zero 1 0
cc0-1.0 ; 2 ; 0.95 ; cc0 ; cc0 1 0(?: universal)?
cc0 ; 3 ; 0.85 ; cc0 ; (?:under |by )?cc0
cc0 ; 3 ; 0.85 ; zero ; creative commons zero
cc-pdm-1.0 ; 1 ; 0.95 ; creativecommons ; creativecommons org publicdomain mark 1 0
cc-sampling-plus ; 3 ; 0.8 ; sampling ; creative commons sampling plus
creative-commons ; 4 ; 0.6 ; commons ; creative commons(?: public)? licen[cs]es?
creative-commons ; 4 ; 0.6 ; commons ; licensed under(?: an?| the)? creative commons

# GNU
gpl-*-only ; 1 ; 0.98 ; gpl ; gpl <1 0,2 0,3 0> only
gpl-*-or-later ; 1 ; 0.98 ; gpl ; gpl <1 0,2 0,3 0> or later
lgpl-*-only ; 1 ; 0.98 ; lgpl ; lgpl <2 0,2 1,3 0> only
lgpl-*-or-later ; 1 ; 0.98 ; lgpl ; lgpl <2 0,2 1,3 0> or later
agpl-*-only ; 1 ; 0.98 ; agpl ; agpl <1 0,3 0> only
agpl-*-or-later ; 1 ; 0.98 ; agpl ; agpl <1 0,3 0> or later
gfdl-*-only ; 1 ; 0.98 ; gfdl ; gfdl <1 1,1 2,1 3> only
gfdl-*-or-later ; 1 ; 0.98 ; gfdl ; gfdl <1 1,1 2,1 3> or later
gpl-* ; 2 ; 0.95 ; general ; (?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)? (?:version |v)<1,2,3>(?: 0)?
gpl-* ; 2 ; 0.95 ; gpl ; (?:gnu )?gpl (?:version |v ?)?<1,2,3>(?: 0)?
gpl-* ; 2 ; 0.95 ; gplv* ; (?:gnu )?gplv<1,2,3>(?: 0)?
lgpl-* ; 2 ; 0.95 ; lesser ; (?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)? (?:version |v)<2 1,3>(?: 0)?
lgpl-2.0 ; 2 ; 0.95 ; library ; (?:gnu )?library general public licen[cs]e(?: lgpl)?(?: (?:version |v)2(?: 0)?)?
lgpl-* ; 2 ; 0.95 ; lgpl ; (?:gnu )?lgpl (?:version |v ?)?<2 0,2 1,3 0,3>
lgpl-2.1 ; 2 ; 0.95 ; lgplv2 ; (?:gnu )?lgplv2 1
lgpl-3 ; 2 ; 0.95 ; lgplv3 ; (?:gnu )?lgplv3(?: 0)?
agpl-* ; 2 ; 0.95 ; affero ; (?:gnu )?affero general public licen[cs]e(?: agpl)?(?: as published by the free software foundation)?(?: either)? (?:version |v)<1,3>(?: 0)?
agpl-* ; 2 ; 0.95 ; agpl ; (?:gnu )?agpl (?:version |v ?)?<1,3>(?: 0)?
agpl-3 ; 2 ; 0.95 ; agplv3 ; (?:gnu )?agplv3(?: 0)?
gfdl-* ; 2 ; 0.95 ; documentation ; (?:gnu )?free documentation licen[cs]e (?:version |v)<1 1,1 2,1 3>
gpl ; 3 ; 0.85 ; gnu ; gnu general public licen[cs]e
gpl ; 3 ; 0.8 ; gpl ; (?:the |under |gnu )gpl(?: licen[cs]ed?)?
lgpl ; 3 ; 0.85 ; lesser ; (?:gnu )?lesser general public licen[cs]e
lgpl ; 3 ; 0.8 ; lgpl ; (?:the |under |gnu )lgpl
agpl ; 3 ; 0.85 ; affero ; (?:gnu )?affero general public licen[cs]e
agpl ; 3 ; 0.8 ; agpl ; (?:the |under |gnu )agpl
gfdl ; 3 ; 0.85 ; documentation ; gnu free documentation licen[cs]e
gpl-or-later ; 1 ; 0.95 ; redistribute ; redistribute it and or modify it under the terms of the gnu general public licen[cs]e
lgpl-or-later ; 1 ; 0.95 ; redistribute ; redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e
agpl-or-later ; 1 ; 0.95 ; redistribute ; redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e
gpl-classpath ; 2 ; 0.9 ; classpath ; (?:gpl(?:v?2)? with(?: the)? )?classpath exception
gpl-linking ; 2 ; 0.85 ; linking ; (?:gpl|general public licen[cs]e) (?:with|plus)(?: an?| the)? linking exception
gnu-all-permissive ; 1 ; 0.9 ; modification ; copying and distribution of this file with or without modification are permitted in any medium without royalty

# permissive: Apache, MIT, BSD, ISC and kin
apache-* ; 2 ; 0.95 ; apache ; apache (?:software )?licen[cs]e (?:version |v)?<1 0,1 1,2 0>
apache-* ; 1 ; 0.98 ; apache ; apache <1 0,1 1,2 0>
apache-2.0 ; 1 ; 0.95 ; apache ; apache org licenses license 2 0
apache-2.0 ; 2 ; 0.9 ; asl ; asl 2 0
apache-2.0 ; 2 ; 0.9 ; apache2 ; (?:under )?apache2
apache ; 3 ; 0.85 ; apache ; apache (?:software )?licen[cs]e
mit ; 2 ; 0.95 ; mit ; (?:the )?mit licen[cs]e
mit ; 2 ; 0.9 ; expat ; (?:the )?expat licen[cs]e
mit ; 3 ; 0.85 ; mit ; mit licensed
mit ; 1 ; 0.98 ; hereby ; permission is hereby granted free of charge to any person obtaining a copy of this software
mit ; 1 ; 0.95 ; opensource ; opensource org licenses mit
mit-0 ; 2 ; 0.95 ; attribution ; mit no attribution
mit-0 ; 1 ; 0.95 ; mit ; (?:spdx license identifier )?mit 0
x11 ; 2 ; 0.9 ; x11 ; (?:the )?x11 licen[cs]e
x11 ; 2 ; 0.9 ; consortium ; x consortium licen[cs]e
bsd-*-clause ; 1 ; 0.98 ; bsd ; bsd <0,1,2,3,4> clause
bsd-2-clause ; 2 ; 0.95 ; bsd ; simplified bsd licen[cs]e
bsd-2-clause ; 2 ; 0.95 ; freebsd ; freebsd licen[cs]e
bsd-2-clause ; 2 ; 0.95 ; bsd ; (?:2|two) clause bsd(?: licen[cs]e)?
bsd-3-clause ; 2 ; 0.95 ; bsd ; (?:3|three) clause bsd(?: licen[cs]e)?
bsd-4-clause ; 2 ; 0.95 ; bsd ; (?:4|four) clause bsd(?: licen[cs]e)?
bsd-3-clause ; 2 ; 0.95 ; bsd ; (?:new|modified|revised)? ?(?:or )?revised bsd licen[cs]e
bsd-3-clause ; 2 ; 0.95 ; bsd ; new bsd licen[cs]e
bsd-3-clause ; 2 ; 0.95 ; bsd ; modified bsd licen[cs]e
bsd-4-clause ; 2 ; 0.95 ; bsd ; original bsd licen[cs]e
bsd-0-clause ; 2 ; 0.95 ; 0bsd ; (?:spdx license identifier )?0bsd
bsd ; 3 ; 0.85 ; bsd ; bsd(?: style| like)? licen[cs]e[ds]?
bsd ; 1 ; 0.9 ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause ; 1 ; 0.9 ; endorse ; may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause ; 1 ; 0.9 ; advertising ; all advertising materials mentioning features or use of this software must display the following acknowledge?ment
isc ; 2 ; 0.95 ; isc ; (?:the )?isc licen[cs]e
isc ; 1 ; 0.9 ; modify ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc ; 2 ; 0.9 ; openbsd ; openbsd licen[cs]e
zlib ; 2 ; 0.95 ; zlib ; zlib(?: libpng)? licen[cs]e
zlib ; 1 ; 0.9 ; misrepresented ; the origin of this software must not be misrepresented
libpng ; 2 ; 0.9 ; libpng ; libpng licen[cs]e
boost-1.0 ; 2 ; 0.95 ; boost ; boost software licen[cs]e(?: (?:version |v)?1 0)?
boost-1.0 ; 1 ; 0.95 ; bsl ; bsl 1 0
python-2.0 ; 2 ; 0.9 ; python ; python software foundation licen[cs]e(?: (?:version |v)?2(?: 0)?)?
psf ; 2 ; 0.9 ; psf ; psf licen[cs]e(?: agreement)?
ruby ; 2 ; 0.85 ; ruby ; ruby licen[cs]e
perl-artistic ; 3 ; 0.8 ; perl ; same terms as perl itself
artistic-* ; 2 ; 0.95 ; artistic ; artistic licen[cs]e (?:version |v)?<1 0,2 0>
artistic ; 3 ; 0.85 ; artistic ; artistic licen[cs]e
php-* ; 2 ; 0.95 ; php ; php licen[cs]e (?:version |v)?<3 0,3 01>
php ; 3 ; 0.85 ; php ; php licen[cs]e
openssl ; 2 ; 0.9 ; openssl ; openssl licen[cs]e
ssleay ; 2 ; 0.9 ; ssleay ; (?:original )?ssleay licen[cs]e
curl ; 2 ; 0.85 ; curl ; curl licen[cs]e
postgresql ; 2 ; 0.9 ; postgresql ; postgresql licen[cs]e
ncsa ; 2 ; 0.9 ; ncsa ; (?:university of illinois )?ncsa(?: open source)? licen[cs]e
unicode ; 2 ; 0.85 ; unicode ; unicode licen[cs]e(?: agreement)?
icu ; 2 ; 0.85 ; icu ; icu licen[cs]e
w3c ; 2 ; 0.85 ; w3c ; w3c software(?: notice and)?(?: and document)? licen[cs]e
afl-* ; 2 ; 0.9 ; academic ; academic free licen[cs]e (?:version |v ?)?<1 1,1 2,2 0,2 1,3 0>
afl ; 3 ; 0.85 ; academic ; academic free licen[cs]e
ecl-* ; 2 ; 0.9 ; educational ; educational community licen[cs]e (?:version |v)?<1 0,2 0>
upl-1.0 ; 2 ; 0.9 ; universal ; universal permissive licen[cs]e(?: (?:version |v)?1 0)?
mulan-psl-* ; 2 ; 0.9 ; mulan ; mulan psl v<1,2>
blueoak-1.0.0 ; 2 ; 0.9 ; oak ; blue oak model licen[cs]e
fair ; 2 ; 0.8 ; fair ; (?:the )?fair licen[cs]e
beerware ; 2 ; 0.85 ; beerware ; (?:the )?beerware licen[cs]e
beerware ; 2 ; 0.85 ; beer ; beer ware licen[cs]e
wtfpl ; 2 ; 0.9 ; wtfpl ; (?:the )?wtfpl(?: licen[cs]e)?
unlicense ; 1 ; 0.95 ; unencumbered ; free and unencumbered software released into the public domain
unlicense ; 2 ; 0.9 ; unlicense ; (?:the |under the )unlicense
unlicense ; 1 ; 0.95 ; unlicense ; unlicense org
hpnd ; 2 ; 0.85 ; historical ; historical permission notice and disclaimer
ofl-* ; 2 ; 0.95 ; ofl ; (?:sil )?(?:open font licen[cs]e )?ofl (?:version |v)?<1 0,1 1>
ofl-* ; 2 ; 0.95 ; font ; (?:sil )?open font licen[cs]e (?:version |v)?<1 0,1 1>
ofl ; 3 ; 0.85 ; font ; (?:sil )?open font licen[cs]e
ubuntu-font ; 2 ; 0.85 ; ubuntu ; ubuntu font licen[cs]e
bitstream-vera ; 2 ; 0.85 ; vera ; bitstream vera (?:fonts? )?(?:licen[cs]e|copyright)

# weak and strong copyleft beside GNU
mpl-* ; 2 ; 0.95 ; mozilla ; mozilla public licen[cs]e(?: mpl)? (?:version |v ?)?<1 0,1 1,2 0>
mpl-* ; 1 ; 0.95 ; mpl ; mpl <1 0,1 1,2 0>
mpl-2.0 ; 1 ; 0.95 ; mozilla ; mozilla org mpl 2 0
mpl ; 3 ; 0.85 ; mozilla ; mozilla public licen[cs]e
npl-* ; 2 ; 0.9 ; netscape ; netscape public licen[cs]e (?:version |v)?<1 0,1 1>
epl-* ; 2 ; 0.95 ; eclipse ; eclipse public licen[cs]e(?: epl)? (?:version |v ?)?<1 0,2 0>
epl-* ; 1 ; 0.95 ; epl ; epl <1 0,2 0>
epl ; 3 ; 0.85 ; eclipse ; eclipse public licen[cs]e
edl-1.0 ; 2 ; 0.9 ; eclipse ; eclipse distribution licen[cs]e(?: (?:version |v)?1 0)?
cpl-1.0 ; 2 ; 0.9 ; public ; common public licen[cs]e(?: (?:version |v)?1 0)?
ipl-1.0 ; 2 ; 0.9 ; ibm ; ibm public licen[cs]e(?: (?:version |v)?1 0)?
cddl-* ; 2 ; 0.95 ; distribution ; common development and distribution licen[cs]e(?: cddl)? (?:version |v)?<1 0,1 1>
cddl-* ; 1 ; 0.95 ; cddl ; cddl <1 0,1 1>
cddl ; 3 ; 0.85 ; distribution ; common development and distribution licen[cs]e
cpal-1.0 ; 2 ; 0.9 ; attribution ; common public attribution licen[cs]e(?: (?:version |v)?1 0)?
eupl-* ; 2 ; 0.95 ; eupl ; eupl (?:version |v ?)?<1 0,1 1,1 2>
eupl ; 3 ; 0.85 ; european ; european union public licen[cs]e
osl-* ; 2 ; 0.9 ; software ; open software licen[cs]e (?:version |v ?)?<1 0,1 1,2 0,2 1,3 0>
cecill-* ; 2 ; 0.9 ; cecill ; cecill (?:version |v)?<1 0,1 1,2 0,2 1>
cecill-* ; 2 ; 0.9 ; cecill ; cecill <b,c>
ms-pl ; 2 ; 0.9 ; microsoft ; microsoft public licen[cs]e(?: ms pl)?
ms-rl ; 2 ; 0.9 ; microsoft ; microsoft reciprocal licen[cs]e(?: ms rl)?
qpl-1.0 ; 2 ; 0.85 ; q ; q public licen[cs]e(?: (?:version |v)?1 0)?
sleepycat ; 2 ; 0.85 ; sleepycat ; sleepycat licen[cs]e
apsl-* ; 2 ; 0.9 ; apple ; apple public source licen[cs]e (?:version |v)?<1 0,1 1,1 2,2 0>
lppl-* ; 2 ; 0.9 ; latex ; latex project public licen[cs]e (?:version |v)?<1 0,1 1,1 2,1 3>
lppl ; 3 ; 0.85 ; latex ; latex project public licen[cs]e
liliq ; 2 ; 0.85 ; liliq ; liliq (?:p|r|r\\+) 1 1
ncl ; 2 ; 0.8 ; nethack ; nethack general public licen[cs]e

# data, models, content
odbl-1.0 ; 2 ; 0.9 ; database ; open database licen[cs]e(?: odbl)?(?: (?:version |v)?1 0)?
odbl-1.0 ; 1 ; 0.95 ; odbl ; odbl 1 0
odc-by-1.0 ; 2 ; 0.9 ; attribution ; open data commons attribution licen[cs]e(?: (?:version |v)?1 0)?
pddl-1.0 ; 2 ; 0.9 ; dedication ; public domain dedication and licen[cs]e(?: (?:version |v)?1 0)?
cdla-permissive-* ; 2 ; 0.9 ; permissive ; community data licen[cs]e agreement permissive (?:version |v)?<1 0,2 0>
cdla-sharing-1.0 ; 2 ; 0.9 ; sharing ; community data licen[cs]e agreement sharing(?: (?:version |v)?1 0)?
ogl-* ; 2 ; 0.9 ; government ; open government licen[cs]e (?:version |v ?)?<1 0,2 0,3 0>
ogl ; 3 ; 0.85 ; government ; open government licen[cs]e
etalab-2.0 ; 2 ; 0.85 ; etalab ; (?:licence ouverte |open licen[cs]e )?etalab 2 0
dl-de-by-2.0 ; 2 ; 0.85 ; datenlizenz ; datenlizenz deutschland namensnennung(?: version)? 2 0
openrail ; 2 ; 0.85 ; openrail ; (?:creativeml )?openrail(?: m)?(?: licen[cs]e)?
bigscience-rail ; 2 ; 0.85 ; rail ; bigscience rail licen[cs]e
responsible-ai ; 3 ; 0.75 ; responsible ; responsible ai licen[cs]e
llama-community ; 2 ; 0.85 ; llama ; llama (?:[234] |3 [123] )?community licen[cs]e
free-art-1.3 ; 2 ; 0.85 ; art ; free art licen[cs]e(?: 1 3)?
open-game ; 2 ; 0.85 ; game ; open game licen[cs]e
public-domain ; 3 ; 0.75 ; domain ; (?:released |placed |dedicated )(?:in |into |to )?the public domain
public-domain ; 4 ; 0.6 ; domain ; (?:is |are )in the public domain
public-domain ; 3 ; 0.75 ; gemeinfrei ; (?:ist |sind )gemeinfrei
copyleft ; 4 ; 0.6 ; copyleft ; copyleft(?: licen[cs]e)?

# source available and commercial
sspl-1.0 ; 2 ; 0.9 ; server ; server side public licen[cs]e(?: (?:version |v)?1)?
sspl-1.0 ; 1 ; 0.9 ; sspl ; sspl (?:1 0|v1)
bsl-1.1 ; 2 ; 0.9 ; business ; business source licen[cs]e(?: (?:version |v)?1 1)?
busl-1.1 ; 1 ; 0.95 ; busl ; busl 1 1
elastic-2.0 ; 2 ; 0.9 ; elastic ; elastic licen[cs]e(?: (?:version |v)?2 0)?
confluent-community ; 2 ; 0.85 ; confluent ; confluent community licen[cs]e
commons-clause ; 2 ; 0.85 ; clause ; commons clause(?: licen[cs]e)?
polyform ; 2 ; 0.85 ; polyform ; polyform (?:noncommercial|small business|shield|strict|perimeter|internal use)(?: licen[cs]e)?
json ; 1 ; 0.85 ; evil ; the software shall be used for good not evil
non-commercial ; 4 ; 0.6 ; commercial ; (?:for )?non commercial (?:use|purposes) only
non-commercial ; 4 ; 0.6 ; noncommercial ; (?:for )?noncommercial (?:use|purposes) only
academic-only ; 4 ; 0.6 ; academic ; (?:for )?academic (?:use|purposes) only
research-only ; 4 ; 0.6 ; research ; (?:for )?research (?:use|purposes) only
personal-only ; 4 ; 0.6 ; personal ; (?:for )?personal(?: non commercial| noncommercial)? use only
eula ; 4 ; 0.6 ; eula ; (?:end user )?(?:licen[cs]e agreement )?eula
eula ; 4 ; 0.6 ; user ; end user licen[cs]e agreement
freeware ; 4 ; 0.5 ; freeware ; (?:this |the |is )?freeware
shareware ; 4 ; 0.5 ; shareware ; (?:this |the |is )?shareware
royalty-free ; 4 ; 0.5 ; royalty ; royalty free licen[cs]e
permissive ; 4 ; 0.5 ; redistribute ; free to (?:use )?(?:copy )?(?:modify )?(?:and )?redistribute
spdx ; 4 ; 0.6 ; spdx ; spdx licen[cs]e identifier [^ ]+
dual ; 4 ; 0.6 ; dual ; dual licen[cs]ed
licensed-under ; 4 ; 0.5 ; licensed ; (?:is |are )?licensed under(?: the terms of)?(?: the| an?)?
license-file ; 4 ; 0.5 ; license ; see(?: the)?(?: accompanying)? license(?: txt| md)?(?: file)? for (?:details|more information|terms)
license-terms ; 4 ; 0.5 ; terms ; under the terms of(?: the| this)? (?:[^ ]+ ){{0,3}}licen[cs]e

# the opposite
proprietary ; 5 ; 0.6 ; proprietary ; proprietary and confidential
proprietary ; 5 ; 0.6 ; proprietary ; (?:this is |contains )proprietary(?: information| software)
no-copying ; 5 ; 0.6 ; reproduced ; (?:may not|must not|no part of this [^ ]+ may) be (?:copied |distributed |or )*reproduced
no-copying ; 5 ; 0.6 ; prohibited ; (?:unauthorized |unauthorised )(?:copying|use|distribution|reproduction)(?: [^ ]+){{0,6}} is (?:strictly )?prohibited
permission-needed ; 5 ; 0.6 ; permission ; without(?: the)?(?: express)?(?: prior)?(?: written)? permission of the (?:author|publisher|owner|copyright)
copyright ; 5 ; 0.4 ; copyright ; copyright (?:c )?(?:19|20)[0-9][0-9]
copyright ; 5 ; 0.4 ; © ; © (?:copyright )?(?:19|20)[0-9][0-9]
reserved ; 5 ; 0.5 ; vorbehalten ; alle rechte vorbehalten
reserved ; 5 ; 0.5 ; droits ; tous droits réservés
reserved ; 5 ; 0.5 ; derechos ; todos los derechos reservados
reserved ; 5 ; 0.5 ; reserved ; some rights reserved
"""


def rules() -> list[tuple[str, int, float, bytes, bytes]]:
    """(label, priority, score, keyword, pattern) of every rule, in the order that settles ties."""
    found = []
    for line in TABLE.splitlines():
        if not line or line.startswith("#"):
            continue
        label, priority, score, keyword, pattern = line.split(" ; ")
        choice = re.search(r"<([^>]*)>", pattern)
        for words in choice[1].split(",") if choice else [""]:
            one = pattern.replace(choice[0], words) if choice else pattern
            found.append((label.replace("*", words.replace(" ", ".")), int(priority), float(score), keyword.replace("*", words).encode(), one.encode()))
    return found
