"""What licences and their notices say, as patterns over lower-case words with one blank between them.

Each was written by hand for one passage by which a licence is known even where
its name isn't given, or for a notice that says more than a name in it.
Patterns may hold what ``licenses.keywords`` reads.
"""

from __future__ import annotations

_GNU = "this (?:program|software|library|file|package|module|work|code|project|script) is free software you can redistribute it and or modify it under the terms of the gnu"
_FSF = "licen[cs]e as published by the free software foundation"
_LATER = "(?: of the licen[cs]e)? or (?:at your option )?any later version"
_CC = "(?:[1234] [05])(?: international| unported| generic)?"
_THING = "(?:work|file|code|software|document|content|dataset|article|book|image|material|text|site|page)"

#: Notices that name a licence in full, and its version.
NOTICES: dict[str, list[str]] = {
    "gpl-3": [
        f"{_GNU} general public {_FSF} either version 3{_LATER}",
        f"{_GNU} general public {_FSF} version 3",
    ],
    "gpl-2": [
        f"{_GNU} general public {_FSF} either version 2{_LATER}",
        f"{_GNU} general public {_FSF} version 2",
        "this (?:program|software|file|code) may be used and distributed according to the terms of the gnu general public licen[cs]e version 2",
    ],
    "agpl-3": [
        f"{_GNU} affero general public {_FSF} either version 3{_LATER}",
        f"{_GNU} affero general public {_FSF} version 3",
    ],
    "lgpl-3": [f"{_GNU} lesser general public {_FSF} either version 3{_LATER}", f"{_GNU} lesser general public {_FSF} version 3"],
    "lgpl-2.1": [f"{_GNU} lesser general public {_FSF} either version 2 1{_LATER}", f"{_GNU} lesser general public {_FSF} version 2 1"],
    "lgpl-2": [f"{_GNU} library general public {_FSF} either version 2{_LATER}", f"{_GNU} lesser general public {_FSF} either version 2{_LATER}"],
    "gfdl-1.2": ["permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2"],
    "gfdl-1.3": ["permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3"],
    "apache-2": [
        "licensed under the apache license version 2 0 the license you may not use this (?:file|work|project|software) except in compliance with the license",
        "licensed to the apache software foundation asf under one or more contributor license agreements",
        "licensed under either of apache license version 2 0",
    ],
    "mpl-2": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "if a copy of the mpl was not distributed with this file you can obtain one at",
    ],
    "mpl-2-no-copyleft-exception": ["this source code form is incompatible with secondary licenses as defined by the mozilla public license v 2 0"],
    "mpl-1.1": ["the contents of this file are subject to the mozilla public license version 1 1"],
    "mpl": ["the contents of this file are subject to the mozilla public license version 1 0"],
    "npl-1.1": ["the contents of this file are subject to the netscape public license version 1 [01]"],
    "cddl": [
        "the contents of this file are subject to the terms of the common development and distribution license",
        "include this cddl header in each file",
    ],
    "epl-2": ["this program and the accompanying materials are made available under the terms of the eclipse public license(?: v| version)? ?2 0"],
    "epl-1": [
        "this program and the accompanying materials are made available under the terms of the eclipse public license(?: v| version)? ?1 0",
    ],
    "cc-by": [f"under (?:a|the) creative commons attribution {_CC} licen[cs]e"],
    "cc-by-sa": [f"under (?:a|the) creative commons attribution share ?alike {_CC} licen[cs]e"],
    "cc-by-nd": [f"under (?:a|the) creative commons attribution no ?deriv(?:s|atives|ative works) {_CC} licen[cs]e"],
    "cc-by-nc": [f"under (?:a|the) creative commons attribution non ?commercial {_CC} licen[cs]e"],
    "cc-by-nc-sa": [f"under (?:a|the) creative commons attribution non ?commercial share ?alike {_CC} licen[cs]e"],
    "cc-by-nc-nd": [f"under (?:a|the) creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works) {_CC} licen[cs]e"],
    "bsl-1": ["distributed under the boost software license version 1 0 see accompanying file license 1 0 txt"],
    "ofl-1.1": ["this font software is licensed under the sil open font license version 1 1"],
    "eupl-1.2": ["licensed under the eupl(?: version)? 1 2"],
    "eupl-1.1": ["licensed under the eupl(?: version)? 1 1"],
    "lppl-1.3": ["this work may be distributed and or modified under the conditions of the latex project public license either version 1 3"],
    "lppl": ["under the conditions of the latex project public license"],
    "afl-3": ["licensed under the academic free license version 3 0"],
    "afl-2.1": ["licensed under the academic free license version 2 [01]"],
    "osl-3": ["licensed under the open software license version 3 0"],
    "perl": ["you can redistribute it and or modify it under the same terms as perl(?: 5)? itself"],
    "python-2": ["licensed to psf under a contributor agreement"],
    "cecill": ["governed by the cecill(?: [abc])? license under french law and abiding by the rules of distribution of free software"],
    "mulan-2": ["licensed under mulan psl v2"],
    "llama": ["llama [23] is licensed under the llama [23] community license"],
    "gemma": ["gemma is provided under and subject to the gemma terms of use"],
    "ijg": ["this software is based in part on the work of the independent jpeg group"],
    "freetype": ["portions of this software are copyright [0-9]{4} the freetype project"],
    "cdla-permissive-2": ["community data license agreement permissive version 2 0"],
    "cdla-permissive-1": ["community data license agreement permissive version 1 0"],
    "cdla-sharing-1": ["community data license agreement sharing version 1 0"],
    "polyform-noncommercial-1": ["polyform noncommercial license 1 0 0"],
    "polyform-small-business-1": ["polyform small business license 1 0 0"],
    "polyform-shield-1": ["polyform shield license 1 0 0"],
    "hippocratic": ["hippocratic license(?: version)? [123] [01]"],
    "qpl-1": ["the q public license version 1 0"],
    "w3c": ["w3c software (?:notice and|and document) license"],
    "upl-1": ["the universal permissive license upl(?: version)? 1 0"],
    "ecl-2": ["licensed under the educational community license version 2 0"],
    "intel-simplified": ["intel simplified software license"],
    "public-domain-us-gov": ["work of the (?:u s|united states) government and is not subject to copyright protection"],
    "public-domain": [f"this {_THING} (?:is in|has been (?:dedicated to|released into|placed in)) the public domain"],
    "all-rights-reserved": ["alle rechte vorbehalten", "todos los derechos reservados"],
}

#: Passages by which one licence is known.
BODIES: dict[str, list[str]] = {
    "mit": [
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies",
    ],
    "mit-0": ["and to permit persons to whom the software is furnished to do so the software is provided as is without warranty of any kind"],
    "x11": ["shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"],
    "hpnd": ["permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"],
    "ntp": ["permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"],
    "isc": ["for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd": ["for any purpose with or without fee is hereby granted the software is provided as is and the author disclaims all warranties"],
    "postgresql": ["for any purpose without fee and without a written agreement is hereby granted"],
    "unicode": [
        "any person obtaining a copy of the unicode data files and any associated documentation",
        "any person obtaining a copy of data files and any associated documentation",
    ],
    "apache-2": [
        "apache license version 2 0 january 2004",
        "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable",
        "patent license to make have made use offer to sell sell import and otherwise transfer the work",
        "you must give any other recipients of the work or derivative works a copy of this license",
        "you must cause any modified files to carry prominent notices stating that you changed the files",
    ],
    "apache-1.1": ["the end user documentation included with the redistribution if any must include the following acknowledg(?:e)?ment this product includes software developed by the apache"],
    "apache": ["must display the following acknowledg(?:e)?ment this product includes software developed by the apache group"],
    "bsd-2-clause-views": ["the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"],
    "bsd-3-clause": [
        "neither the names? of(?: [a-z0-9]+){1,12} nor the names? of (?:its|their|the) contributors may be used to endorse or promote products derived from this software",
        "neither the names? of(?: [a-z0-9]+){1,12} may be used to endorse or promote products derived from this software without specific prior written permission",
        "the names? of(?: [a-z0-9]+){1,6} may not be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "bsd-3-clause-clear": ["no express or implied licenses to any party s patent rights are granted by this license"],
    "bsd-4-clause": ["all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment"],
    "ncsa": ["must retain the above copyright notice this list of conditions and the following disclaimers"],
    "sleepycat": ["redistributions in any form must be accompanied by information on how to obtain complete source code for"],
    "gpl-3": [
        "the gnu general public licen[cs]e is a free copyleft license for software and other kinds of works",
        "by contrast the gnu general public licen[cs]e is intended to guarantee your freedom to share and change all versions of a program",
        "no covered work shall be deemed part of an effective technological measure",
        "gnu general public licen[cs]e version 3 29 june 2007",
    ],
    "gpl-2": [
        "by contrast the gnu general public licen[cs]e is intended to guarantee your freedom to share and change free software",
        "this license applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this general public license",
        "gnu general public licen[cs]e version 2 june 1991",
    ],
    "gpl-1": ["gnu general public licen[cs]e version 1 february 1989"],
    "agpl-3": [
        "specifically designed to ensure cooperation with the community in the case of network server software",
        "must prominently offer all users interacting with it remotely through a computer network",
        "gnu affero general public licen[cs]e version 3 19 november 2007",
    ],
    "lgpl-3": [
        "this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3 of the gnu general public",
        "gnu lesser general public licen[cs]e version 3 29 june 2007",
    ],
    "lgpl-2.1": [
        "this license the lesser general public license applies to some specially designated software packages",
        "gnu lesser general public licen[cs]e version 2 1 february 1999",
    ],
    "lgpl-2": [
        "this license the library general public license applies to some specially designated free software foundation software",
        "gnu library general public licen[cs]e version 2 june 1991",
    ],
    "gfdl": [
        "the purpose of this license is to make a manual textbook or other(?: functional and useful| written)? document free in the sense of freedom",
        "with no invariant sections no front cover texts and no back cover texts",
    ],
    "gpl-classpath-exception": ["linking this library statically or dynamically with other modules is making a combined work based on this library"],
    "gcc-runtime-exception": ["gcc runtime library exception"],
    "gpl-bison-exception": ["you may create a larger work that contains part or all of the bison parser skeleton"],
    "gpl-autoconf-exception": ["as part of a program that contains a configuration script generated by autoconf"],
    "gpl-font-exception": ["if you create a document which uses this font and embed this font"],
    "gpl-linking-exception": ["as a special exception the copyright holders of this library give you permission to link this library with independent modules"],
    "linux-syscall-note": ["this copyright does not cover user programs that use kernel services by normal system calls"],
    "mpl-2": ["each contributor hereby grants you a world wide royalty free non exclusive license under intellectual property rights other than patent or trademark licensable by such contributor"],
    "mpl-1.1": ["the initial developer hereby grants you a world wide royalty free non exclusive license subject to third party intellectual property claims"],
    "epl-2": ["eclipse public license as published by the eclipse foundation with secondary licenses"],
    "epl": ["the accompanying program is provided under the terms of this eclipse public license"],
    "cpl-1": ["the accompanying program is provided under the terms of this common public license"],
    "ipl-1": ["the accompanying program is provided under the terms of this ibm public license"],
    "creative-commons": [
        "the work as defined below is provided under the terms of this creative commons public license",
        "creative commons corporation (?:creative commons )?is not a law firm and does not provide legal services",
    ],
    "cc-by": ["terms and conditions of this creative commons attribution 4 0 international public license"],
    "cc-by-sa": ["terms and conditions of this creative commons attribution sharealike 4 0 international public license"],
    "cc-by-nd": ["terms and conditions of this creative commons attribution noderivatives 4 0 international public license"],
    "cc-by-nc": ["terms and conditions of this creative commons attribution noncommercial 4 0 international public license"],
    "cc-by-nc-sa": ["terms and conditions of this creative commons attribution noncommercial sharealike 4 0 international public license"],
    "cc-by-nc-nd": ["terms and conditions of this creative commons attribution noncommercial noderivatives 4 0 international public license"],
    "cc0": [
        "has dedicated the work to the public domain by waiving all of his or her rights",
        "affirmer hereby overtly fully permanently irrevocably and unconditionally waives abandons and surrenders",
        "has waived all copyright and related or neighboring rights",
    ],
    "unlicense": [
        "this is free and unencumbered software released into the public domain",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary",
    ],
    "wtfpl": ["everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"],
    "zlib": [
        "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
    ],
    "libpng": ["the png reference library is supplied as is", "the origin of this source code must not be misrepresented"],
    "bsl-1": [
        "any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        "unless such copies or derivative works are solely in the form of machine executable object code",
    ],
    "artistic": ["such that the copyright holder maintains some semblance of artistic control over the development of the package"],
    "artistic-2": ["this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"],
    "python-2": [
        "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly",
        "this license agreement is between the python software foundation psf and the individual or organization licensee",
    ],
    "ofl-1.1": [
        "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects",
        "neither the font software nor any of its individual components in original or modified versions may be sold by itself",
    ],
    "odbl": ["the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"],
    "odc-by": ["the open data commons attribution license is a license agreement intended to allow users to freely share modify and use this database"],
    "pddl": ["the open data commons public domain dedication and licen[cs]e is a document intended to allow you to freely share modify and use this work"],
    "eupl-1.2": ["this european union public licence the eupl applies to the work as defined below"],
    "ms-pl": ["this license governs use of the accompanying software if you use the software you accept this license"],
    "ms-rl": ["for any file you distribute that contains code from the software in source code or binary format you must provide recipients the source code to that file"],
    "openssl": [
        "this product includes software developed by the openssl project for use in the openssl toolkit",
        "this product includes cryptographic software written by eric young",
    ],
    "php-3": ["this product includes php software freely available from"],
    "ruby": ["you may make and give away verbatim copies of the source form of the software without restriction"],
    "beerware": ["if we meet some day and you think this stuff is worth it you can buy me a beer in return"],
    "json": ["the software shall be used for good not evil"],
    "lppl": ["the work has the lppl maintenance status"],
    "sspl-1": ["available to third parties as a service you must make the service source code available via network download"],
    "busl-1.1": ["the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"],
    "elastic-2": ["you may not provide the software to third parties as a hosted or managed service"],
    "commons-clause": ["the grant of rights under the license will not include and the license does not grant to you the right to sell the software"],
    "polyform": ["copyright license for the software to do everything you might do with the software that would otherwise infringe the licensor s copyright"],
    "blueoak-1": ["each contributor licenses you to do everything with this software that would otherwise infringe that contributor s copyright"],
    "openrail": [
        "you agree not to use the model or derivatives of the model in any way that violates any applicable national federal state local or international law",
        "use based restrictions as referenced in paragraph 5",
    ],
    "llama": ["the monthly active users of the products or services made available by or for licensee"],
    "w3c": ["this work is being provided by the copyright holders under the following license"],
    "proprietary": [
        "unauthorized copying of this file via any medium is strictly prohibited",
        "this software is the confidential and proprietary information of",
        "no part of this (?:publication|book|document|work|website) may be reproduced",
        "you may not reverse engineer decompile or disassemble the software",
    ],
}

#: Passages that several licences share; the label is the family that says them most.
SHARED: dict[str, list[str]] = {
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability",
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability",
    ],
    "bsd": [
        "redistribution and use in source and binary forms",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
        "this software is provided by(?: [a-z0-9]+){1,12} as is and any express or implied warranties",
        "be liable for any direct indirect incidental special exemplary or consequential damages",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software",
        "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    ],
    "apache-2": [
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "see the license for the specific language governing permissions and limitations under the license",
    ],
    "mpl-1.1": ["see the license for the specific language governing rights and limitations under the license"],
    "gpl": [
        "you should have received a copy of the gnu general public licen[cs]e along with this",
        "see the gnu general public licen[cs]e for more details",
        "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",
        "the licenses for most software are designed to take away your freedom to share and change it",
    ],
    "lgpl": [
        "you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with this",
        "see the gnu (?:lesser|library) general public licen[cs]e for more details",
    ],
    "agpl": [
        "you should have received a copy of the gnu affero general public licen[cs]e along with this",
        "see the gnu affero general public licen[cs]e for more details",
    ],
    "zlib": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "creative-commons": ["some rights reserved"],
}
