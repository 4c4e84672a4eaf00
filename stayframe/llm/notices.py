"""Signature sentences of license texts, notices and headers, written by hand license by license.

Each is (label, priority, confidence, pattern over lower-cased words, keywords of which one must be in the text).
A text's own sentence (95 and more) is surer than a name; a statement that several licenses share comes late.
"""

from __future__ import annotations

_YEAR = r"(?: (?:19|20)\d\d)*"

NOTICES = (
    # permissive: MIT family
    ("mit", 95, 1.0, r"permission is hereby granted free of charge to any person obtaining a copy", ("hereby granted",)),
    ("mit", 94, 0.95, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions", ("substantial portions",)),
    ("mit", 94, 0.95, r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", ("merchantability",)),
    ("mit", 93, 0.95, r"use of this source code is governed by an mit style licen[cs]e", ("governed by",)),
    ("mit", 92, 0.9, r"dual licensed under (?:the )?mit (?:and|or) (?:the )?(?:gpl|apache)", ("dual licensed",)),
    ("mit-0", 96, 1.0, r"mit no attribution", ("attribution",)),
    ("mit-0", 97, 0.9, r"mit 0(?: licen[cs]e)", ("mit",)),
    ("x11", 96, 0.95, r"except as contained in this notice the name of the x consortium shall not be used", ("consortium",)),
    ("ncsa", 96, 1.0, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software", ("deal with",)),
    ("isc", 95, 1.0, r"permission to use copy modify and or distribute this software for any purpose with or without fee", ("without fee",)),
    ("isc", 94, 0.95, r"the software is provided as is and the author disclaims all warranties with regard to this software", ("disclaims all",)),
    ("0bsd", 97, 1.0, r"bsd zero clause licen[cs]e", ("zero clause",)),
    ("0bsd", 97, 1.0, r"zero clause bsd(?: licen[cs]e)?", ("zero clause",)),
    ("0bsd", 97, 1.0, r"free public licen[cs]e 1 0 0", ("free public",)),
    ("0bsd", 96, 1.0, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", ("without fee",)),
    ("curl", 96, 1.0, r"copyright c" + _YEAR + r" daniel stenberg", ("stenberg",)),
    ("hpnd", 95, 0.95, r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted", ("without fee",)),
    ("hpnd", 94, 0.9, r"the name of .{1,60}? not be used in advertising or publicity pertaining to distribution of the software without specific(?: written)? prior", ("publicity",)),
    ("postgresql", 96, 1.0, r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", ("written agreement",)),
    ("postgresql", 95, 1.0, r"postgresql is released under the postgresql licen[cs]e", ("postgresql",)),
    ("ntp", 96, 0.95, r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided that the above copyright notice appears? in all copies", ("without fee",)),
    ("boost", 96, 1.0, r"distributed under the boost software licen[cs]e version 1 0", ("boost",)),
    ("boost", 95, 1.0, r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", ("accompanying documentation",)),
    ("zlib", 95, 1.0, r"this software is provided as is without any express or implied warranty in no event", ("express or implied",)),
    ("zlib", 95, 1.0, r"the origin of this software must not be misrepresented", ("misrepresented",)),
    ("zlib", 94, 1.0, r"altered source versions must be plainly marked as such", ("plainly",)),
    ("libpng", 95, 1.0, r"the png reference library is supplied as is", ("png",)),
    ("beerware", 96, 1.0, r"if we meet some day and you think this stuff is worth it you can buy me a beer in return", ("stuff",)),
    ("wtfpl", 96, 1.0, r"you just do what the fuck you want to", ("fuck",)),
    ("unlicense", 95, 1.0, r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("unlicense", 94, 1.0, r"anyone is free to copy modify publish use compile sell or distribute this software", ("compile sell",)),
    ("jsonlicense", 97, 1.0, r"the software shall be used for good not evil", ("evil",)),
    ("fsfap", 95, 0.95, r"copying and distribution of this file with or without modification are permitted in any medium without royalty", ("royalty",)),
    ("blue oak", 95, 1.0, r"this license gives everyone as much permission to work with this software as possible", ("everyone",)),
    ("upl", 95, 1.0, r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data", ("condition set",)),
    ("mulan", 95, 1.0, r"you can use this software according to the terms and conditions of the mulan psl", ("mulan",)),
    ("ecl", 95, 1.0, r"licensed under the educational community licen[cs]e version [12] 0", ("educational",)),
    ("afl", 95, 1.0, r"licensed under the academic free licen[cs]e version [123] [01]", ("academic",)),
    # BSD family
    ("bsd", 95, 1.0, r"redistribution and use in source and binary forms with or without modification are permitted", ("source and binary",)),
    ("bsd", 94, 0.95, r"redistributions of source code must retain the above copyright notice this list of conditions", ("redistributions of",)),
    ("bsd", 94, 0.95, r"redistributions in binary form must reproduce the above copyright notice this list of conditions", ("redistributions in",)),
    ("bsd", 93, 0.9, r"use of this source code is governed by a bsd style licen[cs]e", ("governed by",)),
    ("bsd 3-clause", 96, 1.0, r"neither the name of .{1,80}? may be used to endorse or promote products", ("endorse or promote",)),
    ("bsd 3-clause", 96, 1.0, r"neither the names? of .{1,60}? nor the names of its contributors", ("contributors",)),
    ("bsd 4-clause", 97, 1.0, r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", ("advertising",)),
    ("bsd 2-clause", 96, 0.9, r"the views and conclusions contained in the software and documentation are those of the authors", ("conclusions",)),
    ("bsd 3-clause clear", 97, 1.0, r"no express or implied licen[cs]es to any party s patent rights are granted by this licen[cs]e", ("party",)),
    ("openssl", 96, 1.0, r"this product includes software developed by the openssl project", ("openssl",)),
    ("openssl", 96, 1.0, r"this product includes cryptographic software written by eric young", ("cryptographic",)),
    ("php", 96, 1.0, r"this product includes php software freely available from", ("php",)),
    ("php", 95, 1.0, r"products derived from this software may not be called php", ("php",)),
    # Apache, Mozilla, Eclipse, Sun and others
    ("apache 2.0", 95, 1.0, r"you may not use this file except in compliance with the license", ("in compliance with",)),
    ("apache 2.0", 94, 1.0, r"licensed to the apache software foundation asf under one or more contributor licen[cs]e agreements", ("contributor",)),
    ("apache 2.0", 94, 0.95, r"unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", ("applicable law",)),
    ("apache 2.0", 94, 0.95, r"www apache org licenses licen[cs]e 2 0", ("apache",)),
    ("apache 1.1", 96, 1.0, r"this product includes software developed by the apache software foundation", ("apache",)),
    ("mpl", 95, 1.0, r"this source code form is subject to the terms of the mozilla public license", ("source code form",)),
    ("mpl 2.0", 96, 1.0, r"subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0", ("mozilla",)),
    ("mpl 1.1", 96, 1.0, r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", ("mozilla",)),
    ("mpl 2.0", 95, 1.0, r"mozilla org mpl 2 0", ("mozilla",)),
    ("epl 1.0", 96, 1.0, r"terms of the eclipse public licen[cs]e v(?:ersion)? ?1 0", ("eclipse",)),
    ("epl 2.0", 96, 1.0, r"terms of the eclipse public licen[cs]e v(?:ersion)? ?2 0", ("eclipse",)),
    ("epl", 94, 0.95, r"www eclipse org (?:legal|org documents) epl", ("eclipse",)),
    ("cddl", 95, 1.0, r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", ("common development",)),
    ("cpl", 95, 1.0, r"the accompanying program is provided under the terms of this common public licen[cs]e", ("common public",)),
    ("ipl", 95, 1.0, r"the accompanying program is provided under the terms of this ibm public licen[cs]e", ("ibm",)),
    ("apsl", 95, 1.0, r"this file contains original code and or modifications of original code as defined in and that are subject to the apple public source licen[cs]e", ("apple",)),
    ("artistic 2.0", 95, 1.0, r"this licen[cs]e establishes the terms under which a given free software package may be copied modified distributed and or redistributed", ("establishes",)),
    ("artistic", 94, 0.95, r"same terms as perl itself", ("perl",)),
    ("artistic", 94, 0.95, r"under the same terms as the perl \d programming language", ("perl",)),
    ("ruby", 94, 0.9, r"same terms as ruby(?: itself)?", ("ruby",)),
    ("psf", 95, 1.0, r"psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e", ("nonexclusive",)),
    ("zpl", 95, 1.0, r"this software is subject to the provisions of the zope public licen[cs]e", ("zope",)),
    ("qpl", 95, 1.0, r"this file may be distributed under the terms of the q public licen[cs]e", ("q public",)),
    ("ms-pl", 95, 1.0, r"this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e", ("accompanying software",)),
    ("w3c", 95, 1.0, r"by obtaining using and or copying this work you the licensee agree that you have read understood and will comply", ("licensee agree",)),
    ("vim", 95, 1.0, r"vim is charityware you can use and copy it as much as you like", ("charityware",)),
    ("unicode", 95, 1.0, r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files", ("unicode",)),
    ("lppl", 95, 1.0, r"this work may be distributed and or modified under the conditions of the latex project public licen[cs]e", ("latex",)),
    ("ofl", 95, 1.0, r"this font software is licensed under the sil open font licen[cs]e", ("font",)),
    ("ofl", 94, 1.0, r"the goals of the open font licen[cs]e ofl are to stimulate worldwide development", ("stimulate",)),
    ("bitstream vera", 95, 1.0, r"the bitstream vera fonts", ("bitstream",)),
    # GNU
    ("gpl", 95, 1.0, r"you can redistribute it and or modify it under the terms of the gnu general public license", ("redistribute it",)),
    ("gpl", 94, 0.95, r"you should have received a copy of the gnu general public licen[cs]e", ("received a copy",)),
    ("gpl", 93, 0.95, r"www gnu org licenses gpl", ("gnu",)),
    ("gpl 2.0", 97, 1.0, r"under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 2", ("free software foundation",)),
    ("gpl 2.0 only", 98, 1.0, r"under the terms of the gnu general public licen[cs]e version 2 (?:only )?as published by the free software foundation", ("free software foundation",)),
    ("gpl 3.0", 97, 1.0, r"under the terms of the gnu general public licen[cs]e as published by the free software foundation either version 3", ("free software foundation",)),
    ("gpl 2.0", 94, 0.95, r"gnu general public licen[cs]e version 2 june 1991", ("june 1991",)),
    ("gpl 3.0", 94, 0.95, r"gnu general public licen[cs]e version 3 29 june 2007", ("june 2007",)),
    ("gpl with classpath exception", 98, 1.0, r"as a special exception the copyright holders of this library give you permission to link", ("special exception",)),
    ("gpl with classpath exception", 97, 0.95, r"classpath exception", ("classpath",)),
    ("gpl with bison exception", 97, 1.0, r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton", ("bison",)),
    ("gpl with autoconf exception", 97, 1.0, r"if you distribute this file as part of a program that contains a configuration script generated by autoconf", ("autoconf",)),
    ("lgpl", 96, 1.0, r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", ("redistribute it",)),
    ("lgpl", 95, 0.95, r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", ("received a copy",)),
    ("lgpl 2.0", 97, 1.0, r"gnu library general public licen[cs]e(?: as published by the free software foundation either)? version 2", ("library general",)),
    ("lgpl 2.1", 98, 1.0, r"gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1", ("lesser",)),
    ("lgpl 3.0", 98, 1.0, r"gnu lesser general public licen[cs]e as published by the free software foundation either version 3", ("lesser",)),
    ("agpl", 96, 1.0, r"you can redistribute it and or modify it under the terms of the gnu affero general public license", ("redistribute it",)),
    ("agpl", 95, 0.95, r"you should have received a copy of the gnu affero general public licen[cs]e", ("affero",)),
    ("agpl 3.0", 98, 1.0, r"gnu affero general public licen[cs]e as published by the free software foundation either version 3", ("affero",)),
    ("gfdl", 95, 1.0, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", ("documentation",)),
    ("gfdl", 94, 0.9, r"no invariant sections no front cover texts and no back cover texts", ("invariant",)),
    # European and national
    ("eupl", 95, 1.0, r"licensed under the eupl(?: version 1 [0-2])?", ("eupl",)),
    ("cecill", 95, 1.0, r"this software is governed by the cecill(?: [bc])? licen[cs]e under french law", ("cecill",)),
    ("ogl", 95, 1.0, r"contains public sector information licensed under the open government licen[cs]e", ("public sector",)),
    ("ogl", 90, 0.9, r"open government licen[cs]e(?: v[123] 0)?", ("government",)),
    ("dl-de", 92, 0.9, r"datenlizenz deutschland (?:namensnennung|zero)", ("datenlizenz",)),
    ("etalab", 92, 0.9, r"licence ouverte open licence", ("ouverte",)),
    # Creative Commons and data
    ("cc", 93, 0.95, r"this work is licensed under (?:a|the) creative commons", ("creative",)),
    ("cc0", 96, 1.0, r"to the extent possible under law .{1,80}? (?:has|have) (?:waived|dedicated) all copyright", ("extent possible",)),
    ("cc0", 95, 1.0, r"creativecommons org publicdomain zero 1 0", ("creativecommons",)),
    ("cc by", 95, 1.0, r"creativecommons org licenses by [1-4] [05]", ("creativecommons",)),
    ("cc by-sa", 96, 1.0, r"creativecommons org licenses by sa [1-4] [05]", ("creativecommons",)),
    ("cc by-nc", 96, 1.0, r"creativecommons org licenses by nc [1-4] [05]", ("creativecommons",)),
    ("cc by-nd", 96, 1.0, r"creativecommons org licenses by nd [1-4] [05]", ("creativecommons",)),
    ("cc by-nc-sa", 97, 1.0, r"creativecommons org licenses by nc sa [1-4] [05]", ("creativecommons",)),
    ("cc by-nc-nd", 97, 1.0, r"creativecommons org licenses by nc nd [1-4] [05]", ("creativecommons",)),
    ("odbl", 95, 1.0, r"this .{1,40}? is made available under the open database licen[cs]e", ("open database",)),
    ("odc-by", 95, 1.0, r"open data commons attribution licen[cs]e", ("commons attribution",)),
    ("pddl", 95, 1.0, r"open data commons public domain dedication and licen[cs]e", ("dedication",)),
    ("public domain", 92, 0.9, r"no known copyright restrictions", ("known copyright",)),
    ("public domain", 40, 0.7, r"(?:released|placed|dedicated) (?:in|into|to) the public domain", ("public domain",)),
    ("public domain", 40, 0.7, r"this (?:file|work|code|software) is in the public domain", ("public domain",)),
    # source available and models
    ("busl", 95, 1.0, r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", ("non production",)),
    ("sspl", 95, 1.0, r"if you make the functionality of the program or a modified version available to third parties as a service", ("functionality",)),
    ("elastic", 95, 1.0, r"elastic licen[cs]e(?: 2 0| v2)", ("elastic",)),
    ("elastic", 94, 0.95, r"you may not provide the software to third parties as a hosted or managed service", ("managed service",)),
    ("commons clause", 96, 1.0, r"commons clause licen[cs]e condition", ("clause",)),
    ("polyform", 95, 1.0, r"polyform (?:noncommercial|shield|strict|small business|perimeter)(?: licen[cs]e)?", ("polyform",)),
    ("openrail", 94, 0.95, r"(?:creativeml |bigscience )?open ?rail(?: m)?(?: licen[cs]e)?", ("rail",)),
    ("llama", 94, 0.9, r"llama (?:2|3|3 1|3 2)? ?community licen[cs]e(?: agreement)?", ("llama",)),
    ("hippocratic", 95, 1.0, r"hippocratic licen[cs]e", ("hippocratic",)),
    # statements
    ("proprietary", 40, 0.7, r"all rights reserved", ("all rights",)),
    ("proprietary", 45, 0.8, r"proprietary and confidential", ("proprietary",)),
    ("proprietary", 45, 0.8, r"confidential and proprietary(?: information)?", ("proprietary",)),
    ("proprietary", 45, 0.8, r"unauthori[sz]ed (?:copying|reproduction|distribution|use) (?:of this (?:file|software|document|work) )?.{0,40}?is (?:strictly )?prohibited", ("prohibited",)),
    ("proprietary", 44, 0.75, r"may not be (?:copied|reproduced|redistributed) (?:or distributed )?without (?:the )?(?:prior |express |written )+(?:permission|consent)", ("permission", "consent")),
    ("proprietary", 44, 0.75, r"this software is licensed not sold", ("not sold",)),
    ("evaluation", 44, 0.8, r"for evaluation purposes only", ("evaluation",)),
    ("non-commercial", 44, 0.8, r"for non ?commercial (?:use|purposes|research)(?: only)?", ("commercial", "noncommercial")),
    ("research only", 44, 0.8, r"for (?:academic|research)(?: and (?:academic|research|educational))? (?:use|purposes) only", ("research", "academic")),
)
