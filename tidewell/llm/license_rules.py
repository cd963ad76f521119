"""Signature rules for licence texts, hand-written: label | keyword | priority | pattern.

Patterns run on lower-cased words joined by one blank, so "2.0" reads "2 0" and "CC-BY" reads
"cc by". A rule is tried only where its keyword occurs. Priorities: 90 title with version, 80
title, 70 wording of the licence's own text, 60 short name with a cue, 50 short name with
version, 30 general cue. Groups don't capture.
"""

SIGNATURES = r"""
mit|mit license|80|(?:the )?mit license
mit|licensed under|60|licensed under (?:the )?(?:terms of (?:the )?)?mit
mit|spdx|60|spdx license identifier mit
mit|license mit|60|license mit
mit|expat|80|expat license
mit|permission is hereby granted|70|permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit|without restriction|70|to deal in the software without restriction
mit|substantial portions|70|copyright notice and this permission notice shall be included in all copies or substantial portions
mit-0|mit 0|90|mit 0
mit-0|no attribution|90|mit no attribution(?: license)?
x11|x11|80|x11 license
x11|x consortium|80|x consortium license
apache-2|apache|90|apache (?:software )?license (?:version )?v?2(?: 0)?
apache-2|apache 2|50|apache 2(?: 0)?(?: license)?
apache-2|apache|50|apache license v2(?: 0)?
apache-2|spdx|60|spdx license identifier apache 2 0
apache-2|www apache org|70|www apache org licenses license 2 0
apache-2|apache|60|asl 2(?: 0)? apache
apache-1.1|apache|90|apache (?:software )?license (?:version )?1 1
apache-1.0|apache|90|apache (?:software )?license (?:version )?1 0
apache|apache license|80|apache (?:software )?license
apache|asf|60|licensed to the apache software foundation asf
gpl-3|general public license|90|gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v ?)?3(?: 0)?
gpl-3|gpl|50|(?:gnu )?gpl (?:v ?)?3(?: 0)?(?: only| or later)?
gpl-3|gplv3|50|(?:gnu )?gplv3(?: 0)?(?: only| or later)?
gpl-3|gpl3|50|(?:gnu )?gpl3(?: 0)?(?: only| or later)?
gpl-3|spdx|60|spdx license identifier gpl 3 0(?: only| or later)?
gpl-2|general public license|90|gnu general public license (?:as published by the free software foundation )?(?:either )?(?:version |v ?)?2(?: 0)?
gpl-2|gpl|50|(?:gnu )?gpl (?:v ?)?2(?: 0)?(?: only| or later)?
gpl-2|gplv2|50|(?:gnu )?gplv2(?: 0)?(?: only| or later)?
gpl-2|gpl2|50|(?:gnu )?gpl2(?: 0)?(?: only| or later)?
gpl-2|spdx|60|spdx license identifier gpl 2 0(?: only| or later)?
gpl-1|general public license|90|gnu general public license (?:version |v ?)?1(?: 0)?
gpl-1|gpl|50|(?:gnu )?gpl (?:v ?)?1(?: 0)?
gpl-1|gplv1|50|(?:gnu )?gplv1(?: 0)?
gpl-1|gpl1|50|(?:gnu )?gpl1(?: 0)?
gpl|general public license|80|gnu general public license
gpl|gpl|60|(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:gnu )?gpl
gpl|free software|70|this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl|hope that it will be useful|70|distributed in the hope that it will be useful but without any warranty
lgpl-3|lesser general public|90|gnu lesser general public license (?:version |v ?)?3(?: 0)?
lgpl-3|lgpl|50|lgpl (?:v ?)?3(?: 0)?
lgpl-3|lgplv3|50|lgplv3(?: 0)?
lgpl-3|lgpl3|50|lgpl3(?: 0)?
lgpl-2.1|lesser general public|90|gnu lesser general public license (?:version |v ?)?2 1
lgpl-2.1|lgpl|50|lgpl (?:v ?)?2 1
lgpl-2.1|lgpl2|50|lgpl2 1
lgpl-2.1|lgplv2|50|lgplv2 1
lgpl-2|library general public|90|gnu library general public license (?:version |v ?)?2(?: 0)?
lgpl-2|lgpl|50|lgpl (?:v ?)?2(?: 0)?
lgpl-2|lgplv2|50|lgplv2(?: 0)?
lgpl-2|lgpl2|50|lgpl2(?: 0)?
lgpl|lesser general public|80|(?:gnu )?lesser general public license
lgpl|library general public|80|(?:gnu )?library general public license
lgpl|lgpl|60|under (?:the )?(?:gnu )?lgpl
agpl-3|affero|90|gnu affero general public license (?:version |v ?)?3(?: 0)?
agpl-3|agpl|50|agpl (?:v ?)?3(?: 0)?
agpl-3|agplv3|50|agplv3(?: 0)?
agpl-3|agpl3|50|agpl3(?: 0)?
agpl-1|affero|90|affero general public license (?:version |v ?)?1(?: 0)?
agpl|affero|80|(?:gnu )?affero general public license
agpl|agpl|60|under (?:the )?(?:gnu )?agpl
gfdl-1.3|free documentation|90|gnu free documentation license (?:version |v ?)?1 3
gfdl-1.2|free documentation|90|gnu free documentation license (?:version |v ?)?1 2
gfdl-1.1|free documentation|90|gnu free documentation license (?:version |v ?)?1 1
gfdl|free documentation|80|(?:gnu )?free documentation license
gfdl|gfdl|60|gfdl
gfdl|invariant sections|70|with no invariant sections no front cover texts and no back cover texts
gpl-exception|classpath exception|80|classpath exception
gpl-exception|runtime library exception|80|gcc runtime library exception
gpl-exception|linking exception|80|linking exception
bsd-3|3 clause|90|(?:bsd 3 clause|3 clause bsd)(?: license)?
bsd-3|three clause|90|three clause bsd(?: license)?
bsd-3|new bsd|80|new bsd license
bsd-3|modified bsd|80|modified bsd license
bsd-3|revised bsd|80|revised bsd license
bsd-3|endorse or promote|70|may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3|spdx|60|spdx license identifier bsd 3 clause
bsd-2|2 clause|90|(?:bsd 2 clause|2 clause bsd)(?: license)?
bsd-2|two clause|90|two clause bsd(?: license)?
bsd-2|simplified bsd|80|simplified bsd license
bsd-2|freebsd|80|freebsd license
bsd-2|spdx|60|spdx license identifier bsd 2 clause
bsd-4|4 clause|90|(?:bsd 4 clause|4 clause bsd)(?: license)?
bsd-4|original bsd|80|original bsd license
bsd-4|advertising materials|70|all advertising materials mentioning features or use of this software must display
bsd-0|zero clause|90|bsd zero clause license
bsd-0|0 clause|90|0 clause bsd(?: license)?
bsd-0|0bsd|50|0bsd
bsd-0|zero clause|90|zero clause bsd(?: license)?
bsd|bsd license|80|(?:the )?bsd license
bsd|bsd|60|(?:licensed|released) under (?:the )?bsd
bsd|redistribution and use|70|redistribution and use in source and binary forms with or without modification are permitted
isc|isc license|80|isc license
isc|permission to use copy|70|permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc|spdx|60|spdx license identifier isc
mpl-2|mozilla public|90|mozilla public license (?:version |v ?)?2(?: 0)?
mpl-2|mpl|50|mpl (?:v ?)?2(?: 0)?
mpl-2|mplv2|50|mplv2(?: 0)?
mpl-2|mpl2|50|mpl2(?: 0)?
mpl-1.1|mozilla public|90|mozilla public license (?:version |v ?)?1 1
mpl-1.1|mpl|50|mpl (?:v ?)?1 1
mpl-1.1|mplv1|50|mplv1 1
mpl-1.1|mpl1|50|mpl1 1
mpl-1.0|mozilla public|90|mozilla public license (?:version |v ?)?1 0
mpl|mozilla public|80|mozilla public license
mpl|mpl|60|under (?:the )?mpl
epl-2|eclipse public|90|eclipse public license (?:version |v ?)?2(?: 0)?
epl-2|epl|50|epl ?v? ?2(?: 0)?
epl-1|eclipse public|90|eclipse public license (?:version |v ?)?1(?: 0)?
epl-1|epl|50|epl ?v? ?1(?: 0)?
epl|eclipse public|80|eclipse public license
edl-1|eclipse distribution|90|eclipse distribution license (?:version |v ?)?1(?: 0)?
cpl-1|common public license|80|common public license(?: version| v)?(?: 1 0)?
ipl-1|ibm public|80|ibm public license(?: version| v)?(?: 1 0)?
cddl-1.1|cddl|50|cddl ?v? ?1 1
cddl-1.0|cddl|50|cddl ?v? ?1 0
cddl|common development and distribution|80|common development and distribution license
eupl-1.2|european union public|90|european union public licen[cs]e (?:version |v ?)?1 2
eupl-1.1|european union public|90|european union public licen[cs]e (?:version |v ?)?1 1
eupl|european union public|80|european union public licen[cs]e
eupl|eupl|50|eupl(?: v?1 [012])?
artistic-2|artistic license|90|artistic license (?:version |v ?)?2(?: 0)?
artistic-1|artistic license|90|artistic license (?:version |v ?)?1(?: 0)?
artistic|artistic license|80|artistic license
perl|same terms as perl|70|same terms as perl(?: itself)?
boost-1|boost software|90|boost software license (?:version |v ?)?1(?: 0)?
boost-1|bsl 1|50|bsl 1 0
boost|boost software|80|boost software license
zlib|zlib|80|zlib(?: libpng)? license
zlib|as is without any express|70|provided as is without any express or implied warranty in no event will the authors be held liable
libpng|libpng license|80|libpng license
unlicense|unlicense|80|(?:the )?unlicense
unlicense|unencumbered|70|free and unencumbered software released into the public domain
wtfpl|wtfpl|80|wtfpl
wtfpl|what the|80|do what the f[a-z]* you want to public license
cc0|cc0|80|cc0(?: 1 0)?(?: universal)?
cc0|creative commons zero|80|creative commons zero
cc0|no rights reserved|70|no rights reserved
public-domain|public domain|80|(?:released|placed|dedicated)(?: in)?(?:to| to) the public domain
public-domain|public domain|60|in the public domain
public-domain|public domain|60|public domain dedication
public-domain|public domain mark|80|public domain mark(?: 1 0)?
cc-by-nc-nd|cc by nc nd|50|cc by nc nd(?: [1234] [05])?
cc-by-nc-nd|noncommercial noderiv|90|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?
cc-by-nc-nd|commons attribution|90|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-nc-sa|cc by nc sa|50|cc by nc sa(?: [1234] [05])?
cc-by-nc-sa|commons attribution|90|creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc|cc by nc|40|cc by nc(?: [1234] [05])?
cc-by-nc|commons attribution|80|creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nd|cc by nd|50|cc by nd(?: [1234] [05])?
cc-by-nd|commons attribution|90|creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-sa|cc by sa|50|cc by sa(?: [1234] [05])?
cc-by-sa|commons attribution|90|creative commons attribution share ?alike(?: [1234] [05])?
cc-by|cc by|40|cc by [1234] [05]
cc-by|cc by|30|cc by
cc-by|commons attribution|70|creative commons attribution(?: [1234] [05])?
cc-by|creativecommons org|60|creativecommons org licenses by [1234] [05]
cc-by-sa|creativecommons org|60|creativecommons org licenses by sa [1234] [05]
cc-by-nc|creativecommons org|60|creativecommons org licenses by nc [1234] [05]
cc-by-nd|creativecommons org|60|creativecommons org licenses by nd [1234] [05]
cc-by-nc-sa|creativecommons org|60|creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-nd|creativecommons org|60|creativecommons org licenses by nc nd [1234] [05]
cc0|creativecommons org|60|creativecommons org publicdomain zero 1 0
cc|creative commons|30|(?:a )?creative commons licen[cs]e
cc|some rights reserved|30|some rights reserved
cc-sampling|sampling|80|creative commons sampling(?: plus)?(?: 1 0)?
odbl|open database|80|open database license
odbl|odbl|50|odbl(?: 1 0)?
odc-by|open data commons attribution|80|open data commons attribution license
odc-by|odc by|50|odc by(?: 1 0)?
pddl|public domain dedication and license|80|open data commons public domain dedication and license
pddl|pddl|50|pddl(?: 1 0)?
ogl|open government|80|open government licen[cs]e(?: v?[123] 0)?
etalab|licence ouverte|80|licence ouverte
etalab|etalab|80|etalab(?: 2 0)?
dl-de|datenlizenz|80|datenlizenz deutschland
ofl-1.1|open font|90|(?:sil )?open font license (?:version |v ?)?1 1
ofl|open font|80|(?:sil )?open font license
ofl|ofl|50|ofl 1 [01]
psf-2|python software foundation|80|python software foundation license(?: version| v)?(?: 2)?
psf-2|psf license|60|psf license
python-cnri|cnri|80|cnri(?: open source)? (?:python )?license
php-3|php license|80|php license(?: version| v)?(?: 3 0?1?)?
ruby|ruby license|80|ruby license
ruby|ruby s license|80|ruby s license
ncsa|ncsa|80|(?:university of illinois )?ncsa open source license
openssl|openssl|80|openssl license
ssleay|ssleay|80|(?:original )?ssleay license
curl|curl license|80|curl license
icu|icu license|80|icu license
unicode|unicode|80|unicode license agreement
w3c|w3c|80|w3c software(?: notice and)?(?: and document)? license
vim|vim license|80|vim license
tcl|tcl|80|tcl tk license
postgresql|postgresql|80|postgresql license
sleepycat|sleepycat|80|sleepycat license
osl-3|open software license|90|open software license (?:version |v ?)?3(?: 0)?
osl|open software license|80|open software license
afl-3|academic free|90|academic free license (?:version |v ?)?3(?: 0)?
afl|academic free|80|academic free license
ecl-2|educational community|80|educational community license(?: version| v)?(?: 2 0)?
ms-pl|microsoft public|80|microsoft public license
ms-pl|ms pl|50|ms pl
ms-rl|microsoft reciprocal|80|microsoft reciprocal license
cpal-1|common public attribution|80|common public attribution license(?: version| v)?(?: 1 0)?
rpl|reciprocal public|80|reciprocal public license
qpl|q public|80|q public license
apsl|apple public|80|apple public source license
nasa|nasa open|80|nasa open source agreement
cecill|cecill|80|cecill(?: [abc])?(?: version| v)?(?: 2 [01])?
mulan-2|mulan|80|mulan (?:psl|permissive software license)(?: v?2)?
upl-1|universal permissive|80|universal permissive license(?: v?1 0)?
blueoak-1|blue oak|80|blue oak model license(?: 1 0 0)?
hpnd|historical permission|80|historical permission notice and disclaimer
beerware|beer ware|80|the beer ware license
beerware|beerware|80|beerware(?: license)?
json|good not evil|70|shall be used for good not evil
sspl-1|server side public|80|server side public license(?: v?1)?
sspl-1|sspl|50|sspl(?: v?1)?
busl-1.1|business source|80|business source license(?: 1 1)?
elastic-2|elastic license|80|elastic license(?: v?2 0)?
commons-clause|commons clause|80|commons clause(?: license condition)?
polyform|polyform|80|polyform (?:noncommercial|small business|strict|shield)(?: license)?
rail|responsible ai|80|(?:open )?responsible ai license
openrail|openrail|80|(?:bigscience |creativeml )?openrail ?(?:m)?
llama|llama|80|llama [23]? ?(?:1 )?community license
fair|fair license|80|fair license
eiffel|eiffel forum|80|eiffel forum license
intel|intel open source|80|intel open source license
naist|nara institute|80|nara institute of science and technology license
proprietary|all rights reserved|30|all rights reserved
proprietary|confidential and proprietary|60|confidential and proprietary
proprietary|proprietary|60|proprietary licen[cs]e
proprietary|end user|60|end user licen[cs]e agreement
proprietary|eula|50|eula
no-commercial|non commercial use only|60|(?:for )?non commercial use only
no-commercial|noncommercial use only|60|(?:for )?noncommercial use only
no-commercial|personal use only|60|(?:for )?personal use only
research-only|research purposes only|60|(?:for )?(?:academic )?research purposes only
no-derivatives|may not be modified|60|may not be modified or redistributed
as-is|without warranties|30|without warranties or conditions of any kind
as-is|as is|30|(?:software|work) is provided as is(?: without warranty of any kind)?
copyright-notice|copyright|30|copyright c? ?(?:19|20)[0-9][0-9]
copyleft|copyleft|30|copyleft
spdx-other|spdx|20|spdx license identifier [a-z0-9]+
license-cue|license|10|(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?
""".strip()


def rules() -> list[tuple[str, str, int, str]]:
    out = [tuple(line.split("|", 3)) for line in SIGNATURES.splitlines()]
    return [(label, keyword, int(priority), pattern) for label, keyword, priority, pattern in out]
