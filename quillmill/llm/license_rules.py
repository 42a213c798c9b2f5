"""Signature rules: licence | priority | keywords | regex, in order.

A blank in a regex stands for a gap between words, also across a line break with comment marks. Keywords are plain
lower-case strings, joined by +, which every match holds however it is spelt ("licen" for licence and license), once
gaps are blanks; they decide which rules are tried at all. Priorities: 100 a
machine-readable tag, 90 a passage of the licence's text, 80 a grant that names it, 70 its full name, 60 an address,
50 a short name, 30 a family without a version, 10 a notice without a licence.
"""

RULES = r"""
MIT | 90 | free of charge+obtaining a copy | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files(?: \(the .?software.?\))?(?:, to deal in the software without restriction)?
MIT | 90 | copyright notice and this permission notice | the above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software
MIT | 90 | provided "as is"+noninfringement | the software is provided "as is", without warranty of any kind, express or implied,.{0,160}? noninfringement
MIT | 80 | mit license | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?mit license
MIT | 80 | mit licence | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?mit licence
MIT | 70 | the mit license | \bthe mit license(?: \(mit\))?
MIT | 70 | mit+license | \bmit[- ]license\b
MIT | 70 | license: mit | \blicense: mit\b
MIT | 60 | opensource.org/licenses/mit | https?://(?:www\.)?opensource\.org/licenses/mit(?:-license(?:\.php)?)?
MIT | 50 | mit-style | \bmit-style licen[cs]e
MIT-0 | 80 | mit no attribution | \bmit no attribution\b
MIT-0 | 50 | mit-0 | \bmit-0\b
X11 | 70 | x11 licen | \b(?:mit/)?x11 licen[cs]e
X11 | 90 | x consortium | except as contained in this notice, the name of the x consortium shall not be used in advertising
ISC | 90 | use, copy, modify, and/or distribute | permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted
ISC | 80 | isc license | (?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?isc license
ISC | 70 | isc license | \b(?:the )?isc license\b
ISC | 60 | opensource.org/licenses/isc | https?://(?:www\.)?opensource\.org/licenses/isc
0BSD | 70 | zero-clause bsd | \b(?:bsd )?zero-clause bsd(?: license)?
0BSD | 50 | 0bsd | \b0bsd\b
BSD-2-Clause | 90 | redistribution and use+forms, with or without | redistribution and use in source and binary forms, with or without modification, are permitted provided that the following (?:2 |two )?conditions are met
BSD-2-Clause | 70 | bsd | \b(?:bsd[- ]2-clause|2-clause bsd|simplified bsd)(?: licen[cs]e)?
BSD-2-Clause | 70 | simplified bsd | \b(?:the )?simplified bsd licen[cs]e
BSD-2-Clause | 70 | freebsd license | \bfreebsd license\b
BSD-3-Clause | 90 | endorse or promote products derived | (?:the name of the .{1,80}?|names of its contributors|nor the names of its contributors) may (?:not )?be used to endorse or promote products derived from this software
BSD-3-Clause | 90 | neither the name+endorse or promote | neither the names? of .{1,120}? may be used to endorse or promote products
BSD-3-Clause | 70 | 3-clause | \b(?:bsd[- ]3-clause|3-clause bsd)(?: licen[cs]e)?
BSD-3-Clause | 70 | new bsd | \b(?:the )?new bsd licen[cs]e
BSD-3-Clause | 70 | ed bsd licen | \b(?:the )?(?:modified|revised) bsd licen[cs]e
BSD-3-Clause | 70 | revised bsd | \b(?:the )?revised bsd licen[cs]e
BSD-3-Clause | 60 | opensource.org/licenses/bsd-3-clause | https?://(?:www\.)?opensource\.org/licenses/bsd-3-clause
BSD-2-Clause | 60 | opensource.org/licenses/bsd-2-clause | https?://(?:www\.)?opensource\.org/licenses/bsd-2-clause
BSD-4-Clause | 90 | advertising materials mentioning features | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
BSD-4-Clause | 70 | 4-clause | \b(?:bsd[- ]4-clause|4-clause bsd)(?: licen[cs]e)?
BSD-4-Clause | 70 | original bsd | \boriginal bsd licen[cs]e
BSD | 30 | bsd licen | \b(?:the )?bsd licen[cs]e
BSD | 30 | bsd-style | \bbsd-style (?:licen[cs]e|source)
BSD | 60 | opensource.org/licenses/bsd-license | https?://(?:www\.)?opensource\.org/licenses/bsd-license(?:\.php)?
Apache-2.0 | 90 | licensed under the apache license, version 2.0 | licensed under the apache license, version 2\.0 \(the .?license.?\)(?:; you may not use this file except in compliance with the license)?
Apache-2.0 | 90 | you may not use this file except in compliance | you may not use this file except in compliance with the license
Apache-2.0 | 90 | as is" basis, without warranties | distributed under the license is distributed on an "as is" basis, without warranties or conditions of any kind
Apache-2.0 | 80 | apache+licen | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?apache(?: software)? licen[cs]e,?(?: version)? 2(?:\.0)?
Apache-2.0 | 70 | apache license+2.0 | \bapache license,?(?: \(?version| v\.?)? ?2\.0\)?
Apache-2.0 | 70 | apache 2 | \bapache 2(?:\.0)?(?: licen[cs]e)?\b
Apache-2.0 | 60 | apache.org/licenses/license-2.0 | https?://(?:www\.)?apache\.org/licenses/license-2\.0(?:\.txt|\.html)?
Apache-2.0 | 60 | opensource.org/licenses/apache-2.0 | https?://(?:www\.)?opensource\.org/licenses/apache-2\.0
Apache-2.0 | 50 | apache-2.0 | \bapache-2\.0\b
Apache-1.1 | 70 | apache+license+1.1 | \bapache(?: software)? license,?(?: version)? 1\.1
Apache-1.0 | 70 | apache+license+1.0 | \bapache(?: software)? license,?(?: version)? 1\.0
Apache-1.1 | 90 | this product includes software developed by+apache | this product includes software developed by the apache (?:software foundation|group)
Apache | 30 | apache licen | \b(?:the )?apache licen[cs]e
Apache | 30 | apache software licen | \b(?:the )?apache software licen[cs]e
GPL-1.0-or-later | 80 | general public licen+version 1 | gnu general public licen[cs]e(?: as published by the free software foundation;?)?,? (?:either )?version 1,? or (?:\(at your option\) )?any later version
GPL-2.0-or-later | 90 | either version 2 of the license | (?:under the terms of the gnu general public license as published by the free software foundation; )?either version 2 of the license, or \(at your option\) any later version
GPL-2.0-or-later | 80 | general public licen+version 2 | gnu general public licen[cs]e,?(?: as published by the free software foundation;?)?(?: either)? version 2(?:\.0)? or (?:\(at your option\) )?(?:any )?later(?: version)?
GPL-2.0-only | 90 | general public license+version 2+as published | gnu general public license,? version 2,? as published by the free software foundation
GPL-2.0-only | 80 | general public license+version 2 only | gnu general public license,? version 2 only
GPL-2.0-only | 70 | gpl+version 2 | \b(?:gnu )?gpl,? version 2\b
GPL-2.0-only | 70 | general public licen+2 | \bgnu general public licen[cs]e,?(?: \(gpl\))?,? \(?(?:version|v\.?) ?2(?:\.0)?\b\)?
GPL-2.0-only | 50 | gplv2 | \bgplv2(?:\.0)?\b(?!\+)
GPL-2.0-only | 50 | gpl-2.0 | \bgpl-2\.0(?:-only)?\b(?!-or|\+)
GPL-2.0-or-later | 50 | gplv2 | \bgplv2(?:\.0)?\+
GPL-2.0-or-later | 50 | gpl-2.0 | \bgpl-2\.0(?:-or-later|\+)
GPL-2.0-only | 60 | gnu.org/licenses/old-licenses/gpl-2.0 | https?://(?:www\.)?gnu\.org/licenses/old-licenses/gpl-2\.0(?:\.[a-z.]+)?
GPL-3.0-or-later | 90 | either version 3 of the license | (?:under the terms of the gnu general public license as published by the free software foundation, )?either version 3 of the license, or \(at your option\) any later version
GPL-3.0-or-later | 80 | general public licen+version 3 | gnu general public licen[cs]e,?(?: as published by the free software foundation;?)?(?: either)? version 3(?:\.0)? or (?:\(at your option\) )?(?:any )?later(?: version)?
GPL-3.0-only | 70 | gpl+version 3 | \b(?:gnu )?gpl,? version 3\b
GPL-3.0-only | 70 | general public licen+3 | \bgnu general public licen[cs]e,?(?: \(gpl\))?,? \(?(?:version|v\.?) ?3(?:\.0)?\b\)?
GPL-3.0-only | 50 | gplv3 | \bgplv3(?:\.0)?\b(?!\+)
GPL-3.0-only | 50 | gpl-3.0 | \bgpl-3\.0(?:-only)?\b(?!-or|\+)
GPL-3.0-or-later | 50 | gplv3 | \bgplv3(?:\.0)?\+
GPL-3.0-or-later | 50 | gpl-3.0 | \bgpl-3\.0(?:-or-later|\+)
GPL-3.0-only | 60 | gnu.org/licenses/gpl-3.0 | https?://(?:www\.)?gnu\.org/licenses/gpl-3\.0(?:\.[a-z.]+)?
GPL | 90 | without even the implied warranty | (?:this|the) (?:program|library|software|file) is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose
GPL | 80 | you should have received a copy of the gnu general public license | you should have received a copy of the gnu general public license along with (?:this|the) [a-z]+
GPL | 60 | gnu.org/licenses/gpl | https?://(?:www\.)?gnu\.org/licenses/gpl(?:\.html)?
GPL | 60 | gnu.org/copyleft/gpl | https?://(?:www\.)?gnu\.org/copyleft/gpl(?:\.html)?
GPL | 30 | general public licen | \b(?:gnu )?general public licen[cs]e
GPL | 30 | gnu gpl | \bgnu gpl\b
GPL | 30 | under the gpl | \bunder the gpl\b
GPL-2.0-with-classpath-exception | 90 | classpath+exception | \bclasspath.? exception\b
GPL-2.0-with-classpath-exception | 90 | linking this library statically or dynamically | linking this library statically or dynamically with other modules is making a combined work
GCC-exception | 80 | gcc runtime library exception | \bgcc runtime library exception
Autoconf-exception | 80 | script generated by autoconf | a configuration? script generated by autoconf|configure script generated by autoconf
LGPL-2.0-or-later | 80 | library general public license+version 2 | gnu library general public license.{0,80}? version 2(?: of the license)?,? or \(at your option\) any later version
LGPL-2.0-only | 70 | library general public licen | \bgnu library general public licen[cs]e
LGPL-2.1-or-later | 90 | lesser general public license+version 2.1 | lesser general public license.{0,80}? version 2\.1(?: of the license)?,? or \(at your option\) any later version
LGPL-2.1-only | 70 | lesser general public licen+2.1 | \bgnu lesser general public licen[cs]e,? \(?(?:version|v\.?) ?2\.1\b\)?
LGPL-2.1-only | 50 | lgplv2.1 | \blgplv2\.1\b(?!\+)
LGPL-2.1-only | 50 | lgpl-2.1 | \blgpl-2\.1(?:-only)?\b(?!-or|\+)
LGPL-2.1-or-later | 50 | lgpl-2.1 | \blgpl-2\.1(?:-or-later|\+)
LGPL-2.1-only | 60 | gnu.org/licenses/old-licenses/lgpl-2.1 | https?://(?:www\.)?gnu\.org/licenses/old-licenses/lgpl-2\.1(?:\.[a-z.]+)?
LGPL-3.0-or-later | 90 | lesser general public license+version 3 | lesser general public license.{0,80}? version 3(?: of the license)?,? or \(at your option\) any later version
LGPL-3.0-only | 70 | lesser general public licen+3 | \bgnu lesser general public licen[cs]e,? \(?(?:version|v\.?) ?3(?:\.0)?\b\)?
LGPL-3.0-only | 50 | lgplv3 | \blgplv3\b(?!\+)
LGPL-3.0-only | 50 | lgpl-3.0 | \blgpl-3\.0(?:-only)?\b(?!-or|\+)
LGPL-3.0-or-later | 50 | lgpl-3.0 | \blgpl-3\.0(?:-or-later|\+)
LGPL-3.0-only | 60 | gnu.org/licenses/lgpl-3.0 | https?://(?:www\.)?gnu\.org/licenses/lgpl-3\.0(?:\.[a-z.]+)?
LGPL | 60 | gnu.org/licenses/lgpl | https?://(?:www\.)?gnu\.org/licenses/lgpl(?:\.html)?
LGPL | 30 | lesser general public licen | \b(?:gnu )?lesser general public licen[cs]e
LGPL | 30 | gnu lgpl | \bgnu lgpl\b
AGPL-3.0-or-later | 90 | affero general public license+version 3 | affero general public license.{0,80}? version 3(?: of the license)?,? or \(at your option\) any later version
AGPL-3.0-only | 70 | affero general public licen+3 | \bgnu affero general public licen[cs]e,? \(?(?:version|v\.?) ?3(?:\.0)?\b\)?
AGPL-3.0-only | 50 | agplv3 | \bagplv3\b
AGPL-3.0-only | 50 | agpl-3.0 | \bagpl-3\.0(?:-only)?\b(?!-or|\+)
AGPL-3.0-or-later | 50 | agpl-3.0 | \bagpl-3\.0(?:-or-later|\+)
AGPL-3.0-only | 60 | gnu.org/licenses/agpl | https?://(?:www\.)?gnu\.org/licenses/agpl(?:-3\.0)?(?:\.[a-z.]+)?
AGPL-1.0 | 70 | affero general public licen+version 1 | \baffero general public licen[cs]e,? version 1
AGPL | 30 | affero general public licen | \b(?:gnu )?affero general public licen[cs]e
GFDL-1.1 | 80 | free documentation license+1.1 | \bgnu free documentation license,? version 1\.1
GFDL-1.2 | 80 | free documentation license+1.2 | \bgnu free documentation license,? version 1\.2
GFDL-1.3 | 80 | free documentation license+1.3 | \bgnu free documentation license,? version 1\.3
GFDL | 90 | no invariant sections | with no invariant sections,(?: with)? no front-cover texts,? and(?: with)? no back-cover texts
GFDL | 30 | free documentation licen | \b(?:gnu )?free documentation licen[cs]e
MPL-1.0 | 80 | mozilla public licen+1.0 | \bmozilla public licen[cs]e,? (?:version|v\.?) ?1\.0
MPL-1.1 | 80 | mozilla public licen+1.1 | \bmozilla public licen[cs]e,?(?: \(mpl\))?,? (?:version|v\.?) ?1\.1
MPL-1.1 | 60 | mozilla.org/mpl/mpl-1.1 | https?://(?:www\.)?mozilla\.org/mpl/mpl-1\.1(?:\.html)?
MPL-2.0 | 90 | source code form is subject to the terms of the mozilla | this source code form is subject to the terms of the mozilla public license, v\. 2\.0(?:\. if a copy of the mpl was not distributed with this file)?
MPL-2.0 | 80 | mozilla public licen+2.0 | \bmozilla public licen[cs]e,?(?: \(mpl\))?,? (?:version|v\.?) ?2\.0
MPL-2.0 | 60 | mozilla.org/+mpl/2.0 | https?://(?:www\.)?mozilla\.org/(?:en-us/)?mpl/2\.0/?
MPL-2.0 | 50 | mpl-2.0 | \bmpl-2\.0\b
MPL-1.1 | 50 | mpl-1.1 | \bmpl-1\.1\b
MPL-1.1 | 90 | mpl 1.1/gpl 2.0/lgpl 2.1 | \bmpl 1\.1/gpl 2\.0/lgpl 2\.1
MPL | 30 | mozilla public licen | \bmozilla public licen[cs]e
NPL-1.1 | 80 | netscape public licen+1.1 | \bnetscape public licen[cs]e,? version 1\.1
NPL | 30 | netscape public licen | \bnetscape public licen[cs]e
EPL-1.0 | 80 | eclipse public licen+1.0 | \beclipse public licen[cs]e,? ?-? ?(?:version |v ?\.?)?1\.0
EPL-2.0 | 80 | eclipse public licen+2.0 | \beclipse public licen[cs]e,? ?-? ?(?:version |v ?\.?)?2\.0
EPL-1.0 | 60 | eclipse.org/legal/epl-v10 | https?://(?:www\.)?eclipse\.org/legal/epl-v10(?:\.html)?
EPL-2.0 | 60 | eclipse.org/legal/epl-2.0 | https?://(?:www\.)?eclipse\.org/legal/epl-2\.0/?
EPL-1.0 | 50 | epl-1.0 | \bepl-1\.0\b
EPL-2.0 | 50 | epl-2.0 | \bepl-2\.0\b
EPL | 30 | eclipse public licen | \beclipse public licen[cs]e
EDL-1.0 | 80 | eclipse distribution licen | \beclipse distribution licen[cs]e
CPL-1.0 | 80 | common public licen | \bcommon public licen[cs]e(?:,? ?-? ?(?:version |v ?)?1\.0)?
IPL-1.0 | 80 | ibm public licen | \bibm public licen[cs]e(?:,? (?:version )?1\.0)?
CDDL-1.0 | 80 | common development and distribution license+1.0 | \bcommon development and distribution license,?(?: \(cddl\))?,? (?:version )?1\.0
CDDL-1.1 | 80 | common development and distribution license+1.1 | \bcommon development and distribution license,?(?: \(cddl\))?,? (?:version )?1\.1
CDDL-1.0 | 50 | cddl-1.0 | \bcddl-1\.0\b
CDDL | 30 | common development and distribution license | \bcommon development and distribution license
CPAL-1.0 | 80 | common public attribution licen | \bcommon public attribution licen[cs]e
APSL-2.0 | 80 | apple public source licen | \bapple public source licen[cs]e(?:,? version 2\.0)?
EUPL-1.1 | 80 | european union public licence+1.1 | \beuropean union public licence,?(?: \(eupl\))?,? (?:version |v\.? ?)?1\.1
EUPL-1.2 | 80 | european union public licence+1.2 | \beuropean union public licence,?(?: \(eupl\))?,? (?:version |v\.? ?)?1\.2
EUPL-1.2 | 50 | eupl+1.2 | \beupl[- ]1\.2\b
EUPL | 30 | european union public | \beuropean union public licen[cs]e
OSL-3.0 | 80 | open software licen | \bopen software licen[cs]e,? (?:version |v\.? ?)?3\.0
AFL-3.0 | 80 | academic free licen | \bacademic free licen[cs]e,? (?:version |v\.? ?)?3\.0
AFL-2.1 | 80 | academic free licen+2.1 | \bacademic free licen[cs]e,? (?:version |v\.? ?)?2\.1
Artistic-1.0 | 80 | artistic licen+1.0 | \bartistic licen[cs]e,? (?:version )?1\.0
Artistic-2.0 | 80 | artistic licen+2.0 | \bartistic licen[cs]e,? (?:version )?2\.0
Artistic | 30 | artistic licen | \b(?:the )?(?:perl )?artistic licen[cs]e
Artistic-1.0-Perl | 80 | same terms as perl | under the same terms as perl itself
BSL-1.0 | 90 | boost software license | distributed under the boost software license, version 1\.0
BSL-1.0 | 70 | boost software licen | \bboost software licen[cs]e(?: ?-? ?version 1\.0)?
BSL-1.0 | 60 | boost.org/license_1_0 | https?://(?:www\.)?boost\.org/license_1_0\.txt
Zlib | 90 | altered source versions must be plainly marked | altered source versions must be plainly marked as such, and must not be misrepresented as being the original software
Zlib | 90 | provided 'as-is', without any express | this software is provided 'as-is', without any express or implied warranty
Zlib | 70 | zlib+licen | \b(?:the )?zlib(?:/libpng)? licen[cs]e
Libpng | 70 | libpng licen | \blibpng licen[cs]e
Unlicense | 90 | free and unencumbered software | this is free and unencumbered software released into the public domain
Unlicense | 70 | the unlicense | \bthe unlicense\b
Unlicense | 60 | unlicense.org | https?://(?:www\.)?unlicense\.org
WTFPL | 70 | you want to public licen | \bdo what the f[a-z*]+ you want to public licen[cs]e
WTFPL | 50 | wtfpl | \bwtfpl\b
CC0-1.0 | 80 | cc0 1.0 | \bcc0 1\.0(?: universal)?
CC0-1.0 | 60 | creativecommons.org/publicdomain/zero | https?://creativecommons\.org/publicdomain/zero/1\.0/?
CC0-1.0 | 50 | cc0-1.0 | \bcc0-1\.0\b
CC0-1.0 | 80 | creative commons zero | \bcreative commons zero\b
PDDL-1.0 | 80 | public domain dedication and licen | \bpublic domain dedication and licen[cs]e
Public-Domain-Mark | 60 | creativecommons.org/publicdomain/mark | https?://creativecommons\.org/publicdomain/mark/1\.0/?
CC-BY-4.0 | 80 | attribution 4.0 international | \b(?:creative commons )?attribution 4\.0 international
CC-BY-SA-4.0 | 80 | sharealike 4.0 international | \b(?:creative commons )?attribution-sharealike 4\.0 international
CC-BY-NC-4.0 | 80 | noncommercial 4.0 international | \b(?:creative commons )?attribution-noncommercial 4\.0 international
CC-BY-ND-4.0 | 80 | noderivatives 4.0 international | \b(?:creative commons )?attribution-noderivatives 4\.0 international
CC-BY-NC-SA-4.0 | 80 | noncommercial-sharealike 4.0 | \b(?:creative commons )?attribution-noncommercial-sharealike 4\.0 international
CC-BY-NC-ND-4.0 | 80 | noncommercial-noderivatives 4.0 | \b(?:creative commons )?attribution-noncommercial-noderivatives 4\.0 international
CC-BY-3.0 | 80 | attribution 3.0 | \b(?:creative commons )?attribution 3\.0 (?:unported|united states)
CC-BY-SA-3.0 | 80 | attribution-share+alike 3.0 | \b(?:creative commons )?attribution-share ?alike 3\.0 (?:unported|united states)
CC-BY-SA-2.5 | 80 | attribution-share+alike 2.5 | \b(?:creative commons )?attribution-share ?alike 2\.5(?: generic)?
CC-BY-4.0 | 60 | creativecommons.org/licenses/by/4.0 | https?://creativecommons\.org/licenses/by/4\.0/?
CC-BY-3.0 | 60 | creativecommons.org/licenses/by/3.0 | https?://creativecommons\.org/licenses/by/3\.0/?
CC-BY-2.0 | 60 | creativecommons.org/licenses/by/2.0 | https?://creativecommons\.org/licenses/by/2\.0/?
CC-BY-SA-4.0 | 60 | creativecommons.org/licenses/by-sa/4.0 | https?://creativecommons\.org/licenses/by-sa/4\.0/?
CC-BY-SA-3.0 | 60 | creativecommons.org/licenses/by-sa/3.0 | https?://creativecommons\.org/licenses/by-sa/3\.0/?
CC-BY-NC-4.0 | 60 | creativecommons.org/licenses/by-nc/4.0 | https?://creativecommons\.org/licenses/by-nc/4\.0/?
CC-BY-NC-3.0 | 60 | creativecommons.org/licenses/by-nc/3.0 | https?://creativecommons\.org/licenses/by-nc/3\.0/?
CC-BY-ND-4.0 | 60 | creativecommons.org/licenses/by-nd/4.0 | https?://creativecommons\.org/licenses/by-nd/4\.0/?
CC-BY-NC-SA-4.0 | 60 | creativecommons.org/licenses/by-nc-sa/4.0 | https?://creativecommons\.org/licenses/by-nc-sa/4\.0/?
CC-BY-NC-SA-3.0 | 60 | creativecommons.org/licenses/by-nc-sa/3.0 | https?://creativecommons\.org/licenses/by-nc-sa/3\.0/?
CC-BY-NC-ND-4.0 | 60 | creativecommons.org/licenses/by-nc-nd/4.0 | https?://creativecommons\.org/licenses/by-nc-nd/4\.0/?
CC-BY-NC-ND-3.0 | 60 | creativecommons.org/licenses/by-nc-nd/3.0 | https?://creativecommons\.org/licenses/by-nc-nd/3\.0/?
CC-BY-4.0 | 50 | cc by 4.0 | \bcc by 4\.0\b
CC-BY-4.0 | 50 | cc-by-4.0 | \bcc-by-4\.0\b
CC-BY-3.0 | 50 | cc by 3.0 | \bcc by 3\.0\b
CC-BY-SA-4.0 | 50 | cc by-sa 4.0 | \bcc by-sa 4\.0\b
CC-BY-SA-4.0 | 50 | cc-by-sa-4.0 | \bcc-by-sa-4\.0\b
CC-BY-SA-3.0 | 50 | cc by-sa 3.0 | \bcc by-sa 3\.0\b
CC-BY-NC-4.0 | 50 | cc by-nc 4.0 | \bcc by-nc 4\.0\b
CC-BY-NC-SA-4.0 | 50 | cc by-nc-sa 4.0 | \bcc by-nc-sa 4\.0\b
CC-BY-NC-ND-4.0 | 50 | cc by-nc-nd 4.0 | \bcc by-nc-nd 4\.0\b
CC-BY-NC-SA | 30 | cc by-nc-sa | \bcc by-nc-sa\b
CC-BY-NC-ND | 30 | cc by-nc-nd | \bcc by-nc-nd\b
CC-BY-SA | 30 | by-sa | \bcc[- ]by-sa\b
CC-BY-NC | 30 | by-nc | \bcc[- ]by-nc\b
CC-BY-SA | 30 | attribution-sharealike | \b(?:creative commons )?attribution-sharealike\b
CC-BY-NC | 30 | attribution-noncommercial | \b(?:creative commons )?attribution-noncommercial\b
Creative-Commons | 30 | creative commons | \bcreative commons(?: attribution)?(?: licen[cs]e)?
ODbL-1.0 | 80 | database licen | \bopen (?:data commons open )?database licen[cs]e
ODC-By-1.0 | 80 | open data commons attribution | \bopen data commons attribution licen[cs]e
OGL-UK-3.0 | 80 | open government licence | \bopen government licence(?: v?3\.0)?
Etalab-2.0 | 80 | licence ouverte | \blicence ouverte(?: ?/ ?open licence)?(?: (?:version )?2\.0)?
DL-DE-BY-2.0 | 80 | datenlizenz deutschland | \bdatenlizenz deutschland\b
Python-2.0 | 80 | python software foundation licen | \bpython software foundation licen[cs]e
PSF-2.0 | 50 | psf licen | \bpsf licen[cs]e
PHP-3.01 | 80 | php licen | \bphp licen[cs]e,?(?: version)? 3\.01
PHP-3.0 | 70 | the php licen | \bthe php licen[cs]e
Ruby | 70 | ruby+licen | \bruby(?:'s)? licen[cs]e
Ruby | 80 | same terms as ruby | under the same terms as ruby
Vim | 70 | vim licen | \bvim licen[cs]e
PostgreSQL | 70 | postgresql licen | \bpostgresql licen[cs]e
OpenSSL | 70 | openssl licen | \bopenssl licen[cs]e
OpenSSL | 90 | openssl toolkit | includes software developed by the openssl project for use in the openssl toolkit
SSLeay | 90 | eric young | includes cryptographic software written by eric young
curl | 70 | curl licen | \bcurl licen[cs]e
NCSA | 70 | university of illinois+open source licen | \buniversity of illinois(?:/ncsa)? open source licen[cs]e
NTP | 70 | ntp licen | \bntp licen[cs]e
ICU | 70 | icu licen | \bicu licen[cs]e
Unicode-DFS-2016 | 70 | unicode+inc+licen | \bunicode,? inc\.? licen[cs]e agreement
W3C | 70 | w3c software | \bw3c software(?: notice and)? licen[cs]e
OFL-1.1 | 90 | sil open font license | licensed under the sil open font license, version 1\.1
OFL-1.1 | 70 | open font licen | \b(?:sil )?open font licen[cs]e
OFL-1.1 | 60 | scripts.sil.org/ofl | https?://scripts\.sil\.org/ofl
LPPL-1.3c | 80 | latex project public licen | \blatex project public licen[cs]e(?:,? version 1\.3c?)?
QPL-1.0 | 70 | q public licen | \bq public licen[cs]e
Sleepycat | 70 | sleepycat licen | \bsleepycat licen[cs]e
MS-PL | 80 | microsoft public licen | \bmicrosoft public licen[cs]e
MS-RL | 80 | microsoft reciprocal licen | \bmicrosoft reciprocal licen[cs]e
MulanPSL-2.0 | 80 | mulan psl | \bmulan psl ?v?2
UPL-1.0 | 80 | universal permissive licen | \buniversal permissive licen[cs]e
BlueOak-1.0.0 | 80 | blue oak model licen | \bblue oak model licen[cs]e
ECL-2.0 | 80 | educational community licen | \beducational community licen[cs]e
HPND | 70 | historical permission notice and disclaimer | \bhistorical permission notice and disclaimer
AAL | 70 | attribution assurance licen | \battribution assurance licen[cs]e
Beerware | 90 | beer+ware licen | \bthe beer-?ware licen[cs]e
JSON | 90 | used for good, not evil | the software shall be used for good, not evil
SSPL-1.0 | 80 | server side public licen | \bserver side public licen[cs]e
Elastic-2.0 | 80 | elastic licen+2.0 | \belastic licen[cs]e 2\.0
Elastic | 30 | elastic licen | \belastic licen[cs]e
BUSL-1.1 | 80 | business source licen | \bbusiness source licen[cs]e(?: 1\.1)?
PolyForm-NC-1.0.0 | 80 | polyform noncommercial | \bpolyform noncommercial licen[cs]e
PolyForm-SB-1.0.0 | 80 | polyform small business | \bpolyform small business licen[cs]e
Commons-Clause | 80 | commons clause | \bcommons clause\b
Llama-Community | 80 | llama+community licen | \bllama(?: \d(?:\.\d)?)? community licen[cs]e
OpenRAIL | 80 | responsible ai licen | \b(?:open )?responsible ai licen[cs]e
Public-Domain | 50 | public domain | \b(?:released|placed|dedicated) (?:in|in)?to the public domain
Public-Domain | 30 | in the public domain | \bin the public domain\b
Proprietary | 50 | proprietary and confidential | \bproprietary and confidential\b
Proprietary | 50 | unauthori+ed copying | unauthori[sz]ed copying of this (?:file|software|document)
Proprietary | 50 | may not be reproduced | may not be reproduced,?(?: distributed,?)?.{0,40}? without(?: the)?(?: prior)?(?: express)?(?: written)? (?:permission|consent)
Proprietary | 30 | user licen+agreement | \bend[- ]user licen[cs]e agreement
Proprietary | 30 | all rights reserved | \ball rights reserved\b
Proprietary | 30 | tous droits | \btous droits(?: de reproduction)? r[ée]serv[ée]s\b
Proprietary | 30 | alle rechte vorbehalten | \balle rechte vorbehalten\b
Proprietary | 30 | todos los derechos reservados | \btodos los derechos reservados\b
License-Notice | 10 | licensed under | \blicensed under (?:the )?[a-z0-9][\w.+-]*(?: [\w.+-]+){0,4}? licen[cs]e
License-Notice | 10 | see+licen | \bsee (?:the )?licen[cs]e(?: file)? for (?:more )?details\b
License-Notice | 10 | subject to the licen | \bsubject to the licen[cs]e\b
Copyright-Notice | 10 | copyright | \bcopyright(?: ?(?:\(c\)|©|&copy;))? ?(?:19|20)\d\d(?: ?[-–,] ?(?:19|20)?\d\d)*
Copyright-Notice | 10 | (c) | \(c\) ?(?:19|20)\d\d(?: ?[-–,] ?(?:19|20)?\d\d)*
Copyright-Notice | 10 | © | © ?(?:19|20)\d\d(?: ?[-–,] ?(?:19|20)?\d\d)*
"""

#: Identifiers that a tag may name; each becomes a rule of priority 100.
TAGGED = """
0BSD AFL-2.1 AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0
BlueOak-1.0.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0
CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CPL-1.0 ECL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2 GFDL-1.3
GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-2.0 GPL-3.0-only GPL-3.0-or-later GPL-3.0 HPND ICU IPL-1.0 ISC JSON LGPL-2.0-only LGPL-2.1-only
LGPL-2.1-or-later LGPL-2.1 LGPL-3.0-only LGPL-3.0-or-later LGPL-3.0 Libpng LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA NTP ODbL-1.0
OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib
"""
