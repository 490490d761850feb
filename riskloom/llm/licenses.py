"""License scans by ordered signature rules.

A text is lower-cased (A-Z) and read as words (runs of letters, digits and
characters beyond ASCII), so markup, comment signs and line ends don't matter;
rules are regexes over the words joined by one space and match whole words.

Keyword prefilter: every rule names words that each of its matches contains.
The words of a batch are hashed at once and looked up among the keywords; a
text is given to a rule only if it has all of the rule's.

Overlaps: a match is suppressed if its interval of words lies within the
interval of another match of higher priority, or of the same priority and
longer (of equal ones, the earlier rule's stays). Within is transitive, so one
sweep a priority decides. Matches that overlap without lying within each
other both stay. Base phrases take part and can be suppressed, but are
reported in any case.

Priorities: 4 identifier tags, 3 licence texts and addresses, 2 names with
a version or an exact title, 1 generic names, 0 notices and base phrases. The
score of a text is the highest confidence among its remaining matches.

Defined results: null text counts as empty; a text without match has empty
labels, null places and score 0; repeated rows get equal results; other
columns pass through, and ones named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from riskloom.llm.common import buffers, byte_hashes, python_stage, slices, word_bounds
from riskloom.session import table_path

#: Base phrases and their labels (fixed values of the query's contract).
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

LICENCE = "licen[cs]e"
ANY = "(?:[^ ]+ ){0,%d}?"  # up to so many words between


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]  # words that every match holds; the first should be the rarest
    pattern: str
    base: bool = False


# Licences by name: label, keywords, exact title as a regex over words, identifiers, addresses (words in the path of
# opensource.org/licenses or of the steward's site). Titles without a version are generic names.
NAMED: list[tuple[str, str, str, list[str], list[str]]] = [
    ("apache-1.0", "apache", rf"apache (?:software )?{LICENCE} (?:version |v)?1 0", ["apache 1 0"], ["apache org licenses license 1 0"]),
    ("apache-1.1", "apache", rf"apache (?:software )?{LICENCE} (?:version |v)?1 1", ["apache 1 1"], ["apache org licenses license 1 1"]),
    ("apache-2.0", "apache", rf"apache (?:software )?(?:{LICENCE} )?(?:version |v)?(?:2 0|2|v2|asl2)", ["apache 2 0"], ["apache org licenses license 2 0", "opensource org licenses apache 2 0"]),
    ("mit", "mit", rf"(?:the )?mit (?:expat )?{LICENCE}", ["mit"], ["opensource org licenses mit", "opensource org licenses mit license"]),
    ("mit-0", "mit", rf"mit no attribution(?: {LICENCE})?", ["mit 0"], []),
    ("bsd-2-clause", "bsd", rf"(?:(?:simplified|freebsd|2 clause|two clause) bsd {LICENCE}|bsd (?:2|two) clause(?: {LICENCE})?)", ["bsd 2 clause"], ["opensource org licenses bsd 2 clause"]),
    ("bsd-3-clause", "bsd", rf"(?:(?:new|modified|revised|3 clause|three clause) bsd {LICENCE}|bsd (?:3|three) clause(?: {LICENCE})?)", ["bsd 3 clause"], ["opensource org licenses bsd 3 clause"]),
    ("bsd-4-clause", "bsd", rf"(?:(?:original|old|4 clause|four clause) bsd {LICENCE}|bsd (?:4|four) clause(?: {LICENCE})?)", ["bsd 4 clause"], []),
    ("0bsd", "bsd", rf"(?:zero clause bsd|bsd zero clause)(?: {LICENCE})?", ["0bsd"], ["opensource org licenses 0bsd"]),
    ("gpl-1.0", "gpl", r"(?:gnu )?gpl (?:version |v)?1(?: 0)?", ["gpl 1 0", "gpl 1 0 only", "gpl 1 0 or later"], []),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl (?:version |v )?(?:2|v2)(?: 0)?", ["gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later"], ["gnu org licenses gpl 2 0", "gnu org licenses old licenses gpl 2 0"]),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl (?:version |v )?(?:3|v3)(?: 0)?", ["gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later"], ["gnu org licenses gpl 3 0"]),
    ("lgpl-2.0", "lgpl", r"(?:gnu )?lgpl (?:version |v )?(?:2|v2)(?: 0)?", ["lgpl 2 0", "lgpl 2 0 only", "lgpl 2 0 or later"], []),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl (?:version |v )?(?:2|v2) 1", ["lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"], ["gnu org licenses lgpl 2 1"]),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl (?:version |v )?(?:3|v3)(?: 0)?", ["lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"], ["gnu org licenses lgpl 3 0"]),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl (?:version |v )?(?:3|v3)(?: 0)?", ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"], ["gnu org licenses agpl 3 0"]),
    ("gfdl-1.3", "documentation", rf"gnu free documentation {LICENCE} (?:version |v)?1 3", ["gfdl 1 3"], ["gnu org licenses fdl 1 3"]),
    ("gfdl-1.2", "documentation", rf"gnu free documentation {LICENCE} (?:version |v)?1 2", ["gfdl 1 2"], ["gnu org licenses fdl 1 2"]),
    ("mpl-1.0", "mozilla", rf"mozilla public {LICENCE} (?:version |v)?1 0", ["mpl 1 0"], []),
    ("mpl-1.1", "mozilla", rf"mozilla public {LICENCE} (?:version |v)?1 1", ["mpl 1 1"], ["mozilla org mpl mpl 1 1"]),
    ("mpl-2.0", "mozilla", rf"mozilla public {LICENCE} (?:version |v)?2(?: 0)?", ["mpl 2 0"], ["mozilla org mpl 2 0", "mozilla org en us mpl 2 0"]),
    ("epl-1.0", "eclipse", rf"eclipse public {LICENCE} (?:version |v)?1(?: 0)?", ["epl 1 0"], ["eclipse org legal epl v10"]),
    ("epl-2.0", "eclipse", rf"eclipse public {LICENCE} (?:version |v)?2(?: 0)?", ["epl 2 0"], ["eclipse org legal epl 2 0"]),
    ("edl-1.0", "eclipse", rf"eclipse distribution {LICENCE}(?: (?:version |v)?1 0)?", [], ["eclipse org org documents edl v10"]),
    ("cddl-1.0", "cddl", rf"(?:common development and distribution {LICENCE} )?cddl (?:version |v)?1(?: 0)?", ["cddl 1 0"], ["opensource org licenses cddl 1 0"]),
    ("cddl-1.1", "cddl", rf"(?:common development and distribution {LICENCE} )?cddl (?:version |v)?1 1", ["cddl 1 1"], []),
    ("cpl-1.0", "common", rf"common public {LICENCE}(?: (?:version |v)?1 0)?", ["cpl 1 0"], ["opensource org licenses cpl1 0"]),
    ("cpal-1.0", "attribution", rf"common public attribution {LICENCE}(?: version)?(?: 1 0)?", ["cpal 1 0"], []),
    ("ipl-1.0", "ibm", rf"ibm public {LICENCE}(?: (?:version |v)?1 0)?", ["ipl 1 0"], []),
    ("artistic-1.0", "artistic", rf"artistic {LICENCE} (?:version |v)?1(?: 0)?", ["artistic 1 0"], []),
    ("artistic-2.0", "artistic", rf"artistic {LICENCE} (?:version |v)?2(?: 0)?", ["artistic 2 0"], ["opensource org licenses artistic 2 0"]),
    ("bsl-1.0", "boost", rf"boost software {LICENCE}(?: (?:version |v)?1 0)?", ["bsl 1 0"], ["boost org license 1 0"]),
    ("busl-1.1", "business", rf"business source {LICENCE}(?: (?:version |v)?1 1)?", ["busl 1 1"], ["mariadb com bsl11"]),
    ("isc", "isc", rf"isc {LICENCE}", ["isc"], ["opensource org licenses isc"]),
    ("zlib", "zlib", rf"zlib(?: libpng)? {LICENCE}", ["zlib"], ["opensource org licenses zlib"]),
    ("libpng", "libpng", rf"libpng {LICENCE}(?: version 2)?", ["libpng", "libpng 2 0"], []),
    ("unlicense", "unlicense", r"the unlicense", ["unlicense"], ["unlicense org"]),
    ("wtfpl", "wtfpl", r"wtfpl(?: version 2| v2)?", ["wtfpl"], ["wtfpl net"]),
    ("postgresql", "postgresql", rf"postgresql {LICENCE}", ["postgresql"], ["opensource org licenses postgresql"]),
    ("python-2.0", "python", rf"python software foundation {LICENCE}(?: agreement)?(?: version 2)?", ["python 2 0", "psf 2 0"], ["docs python org 3 license"]),
    ("php-3.01", "php", rf"php {LICENCE}(?: (?:version |v)?3 01)?", ["php 3 01", "php 3 0"], ["php net license 3 01"]),
    ("ruby", "ruby", rf"ruby {LICENCE}", ["ruby"], []),
    ("zpl-2.1", "zope", rf"zope public {LICENCE}(?: (?:version |v)?2 [01])?", ["zpl 2 1", "zpl 2 0"], []),
    ("ofl-1.1", "sil", rf"sil open font {LICENCE}(?: (?:version |v)?1 1)?", ["ofl 1 1"], ["scripts sil org ofl"]),
    ("ms-pl", "microsoft", rf"microsoft public {LICENCE}(?: ms pl)?", ["ms pl"], ["opensource org licenses ms pl"]),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {LICENCE}(?: ms rl)?", ["ms rl"], []),
    ("eupl-1.1", "european", rf"european union public {LICENCE}(?: eupl)? (?:version |v)?1 1", ["eupl 1 1"], []),
    ("eupl-1.2", "european", rf"european union public {LICENCE}(?: eupl)? (?:version |v)?1 2", ["eupl 1 2"], []),
    ("osl-3.0", "open", rf"open software {LICENCE}(?: (?:version |v)?3 0)?", ["osl 3 0"], ["opensource org licenses osl 3 0"]),
    ("afl-3.0", "academic", rf"academic free {LICENCE}(?: (?:version |v)?3 0)?", ["afl 3 0"], ["opensource org licenses afl 3 0"]),
    ("ecl-2.0", "educational", rf"educational community {LICENCE}(?: (?:version |v)?2 0)?", ["ecl 2 0"], []),
    ("ncsa", "ncsa", rf"(?:university of illinois )?ncsa (?:open source )?{LICENCE}", ["ncsa"], []),
    ("upl-1.0", "universal", rf"universal permissive {LICENCE}(?: (?:version |v)?1 0)?", ["upl 1 0"], []),
    ("vim", "vim", rf"vim {LICENCE}", ["vim"], []),
    ("w3c", "w3c", rf"w3c software(?: notice)?(?: and)? {LICENCE}", ["w3c"], []),
    ("x11", "x11", rf"x11 {LICENCE}", ["x11"], []),
    ("openssl", "openssl", rf"openssl {LICENCE}", ["openssl"], []),
    ("sleepycat", "sleepycat", rf"sleepycat {LICENCE}", ["sleepycat"], []),
    ("sspl-1.0", "server", rf"server side public {LICENCE}(?: (?:version |v)?1)?", ["sspl 1 0"], []),
    ("elastic-2.0", "elastic", rf"elastic {LICENCE}(?: 2 0)?", ["elastic 2 0"], ["elastic co licensing elastic license"]),
    ("commons-clause", "commons", rf"commons clause {LICENCE} condition(?: v1 0)?", [], ["commonsclause com"]),
    ("odbl-1.0", "database", rf"open (?:data commons open )?database {LICENCE}(?: odbl)?(?: v?1 0)?", ["odbl 1 0"], ["opendatacommons org licenses odbl"]),
    ("odc-by-1.0", "attribution", rf"open data commons attribution {LICENCE}(?: v?1 0)?", ["odc by 1 0"], ["opendatacommons org licenses by"]),
    ("pddl-1.0", "domain", rf"(?:open data commons )?public domain dedication and {LICENCE}", ["pddl 1 0"], ["opendatacommons org licenses pddl"]),
    ("ogl-uk-3.0", "government", rf"open government {LICENCE}(?: v?3 0)?", ["ogl uk 3 0", "ogl uk 2 0"], ["nationalarchives gov uk doc open government licence"]),
    ("lppl-1.3c", "latex", rf"latex project public {LICENCE}(?: (?:version |v)?1 3c?)?", ["lppl 1 3c", "lppl 1 3a"], ["latex project org lppl"]),
    ("cecill-2.1", "cecill", rf"cecill(?: free software)? {LICENCE}(?: (?:version |v)?2 [01])?", ["cecill 2 1", "cecill b", "cecill c"], ["cecill info"]),
    ("apsl-2.0", "apple", rf"apple public source {LICENCE}(?: (?:version |v)?2 0)?", ["apsl 2 0"], ["opensource apple com apsl"]),
    ("nasa-1.3", "nasa", rf"nasa open source agreement(?: (?:version |v)?1 3)?", ["nasa 1 3"], []),
    ("openrail-m", "rail", rf"(?:creativeml |bigscience )?open rail(?: m)?(?: {LICENCE})?", ["openrail", "creativeml openrail m"], []),
    ("llama", "llama", rf"llama (?:2|3|3 1|3 2|4) community {LICENCE}(?: agreement)?", ["llama2", "llama3"], ["ai meta com llama license"]),
    ("hippocratic-2.1", "hippocratic", rf"hippocratic {LICENCE}(?: (?:version |v)?[23] [01])?", ["hippocratic 2 1"], []),
    ("mulan-psl-2.0", "mulan", rf"mulan (?:permissive software|psl)(?: {LICENCE})?(?: (?:version |v)?2)?", ["mulanpsl 2 0"], []),
    ("blueoak-1.0.0", "oak", rf"blue oak model {LICENCE}(?: 1 0 0)?", ["blueoak 1 0 0"], ["blueoakcouncil org license"]),
    ("curl", "curl", rf"curl {LICENCE}", ["curl"], []),
    ("ijg", "jpeg", rf"independent jpeg group (?:s )?{LICENCE}", ["ijg"], []),
    ("freetype", "freetype", rf"freetype (?:project )?{LICENCE}", ["ftl"], []),
    ("imagemagick", "imagemagick", rf"imagemagick {LICENCE}", ["imagemagick"], []),
    ("ntp", "ntp", rf"ntp {LICENCE}", ["ntp"], []),
    ("unicode-dfs", "unicode", rf"unicode (?:inc )?{LICENCE} agreement", ["unicode dfs 2016", "unicode 3 0"], ["unicode org copyright"]),
]

# Generic names: label, priority, confidence, keywords, regex.
GENERIC: list[tuple[str, int, float, str, str]] = [
    ("apache", 1, 0.8, "apache", rf"(?:the )?apache (?:software )?{LICENCE}"),
    ("bsd", 1, 0.8, "bsd", rf"bsd(?: style| like)? {LICENCE}"),
    ("gpl", 2, 0.9, "gnu public", rf"gnu general public {LICENCE}"),
    ("gpl-1.0", 3, 0.95, "general public", rf"(?:gnu )?general public {LICENCE} {ANY % 4}(?:version|v) ?1(?: 0)?"),
    ("gpl-2.0", 3, 0.95, "general public", rf"(?:gnu )?general public {LICENCE} {ANY % 4}(?:version 2|v2|v 2|2 0)(?: 0)?"),
    ("gpl-3.0", 3, 0.95, "general public", rf"(?:gnu )?general public {LICENCE} {ANY % 4}(?:version 3|v3|v 3|3 0)(?: 0)?"),
    ("gpl", 1, 0.7, "gpl", r"(?:gnu )?gpl"),
    ("gpl-2.0", 2, 0.9, "gplv2", r"gplv2"),
    ("gpl-3.0", 2, 0.9, "gplv3", r"gplv3"),
    ("lgpl", 1, 0.7, "lgpl", r"(?:gnu )?lgpl"),
    ("lgpl-2.1", 2, 0.9, "lgplv2", r"lgplv2(?: 1)?"),
    ("lgpl-3.0", 2, 0.9, "lgplv3", r"lgplv3"),
    ("lgpl", 2, 0.9, "lesser public", rf"(?:gnu )?lesser general public {LICENCE}"),
    ("lgpl", 2, 0.9, "library public", rf"(?:gnu )?library general public {LICENCE}"),
    ("lgpl-2.1", 3, 0.95, "lesser public", rf"(?:gnu )?lesser general public {LICENCE} {ANY % 4}(?:version 2 1|v2 1|2 1)"),
    ("lgpl-3.0", 3, 0.95, "lesser public", rf"(?:gnu )?lesser general public {LICENCE} {ANY % 4}(?:version 3|v3|3 0)(?: 0)?"),
    ("agpl", 1, 0.7, "agpl", r"(?:gnu )?agpl"),
    ("agpl-3.0", 2, 0.9, "agplv3", r"agplv3"),
    ("agpl", 2, 0.9, "affero public", rf"(?:gnu )?affero general public {LICENCE}"),
    ("agpl-3.0", 3, 0.95, "affero public", rf"(?:gnu )?affero general public {LICENCE} {ANY % 4}(?:version 3|v3|3 0)(?: 0)?"),
    ("gfdl", 1, 0.8, "documentation free", rf"(?:gnu )?free documentation {LICENCE}"),
    ("mpl", 1, 0.8, "mozilla public", rf"mozilla public {LICENCE}"),
    ("epl", 1, 0.8, "eclipse public", rf"eclipse public {LICENCE}"),
    ("cddl", 1, 0.8, "distribution development", rf"common development and distribution {LICENCE}"),
    ("artistic", 1, 0.8, "artistic", rf"(?:perl )?artistic {LICENCE}"),
    ("eupl", 1, 0.8, "european public", rf"european union public {LICENCE}"),
    ("mit", 2, 0.9, "mit", rf"released under (?:the )?mit {LICENCE}"),
    ("mit", 2, 0.85, "mit licensed", r"mit licensed"),
    ("bsd", 2, 0.85, "bsd licensed", r"bsd licensed"),
    ("gpl", 2, 0.85, "gpl licensed", r"gpl licensed"),
    ("apache", 2, 0.85, "apache licensed", r"apache licensed"),
    ("cc", 1, 0.7, "creative commons", rf"creative commons(?: {LICENCE})?"),
    ("cc0-1.0", 2, 0.9, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", 3, 0.95, "creative zero", r"creative commons zero(?: v?1 0)?(?: universal)?"),
    ("public-domain", 1, 0.7, "domain public", r"(?:in|into|to) the public domain"),
    ("public-domain", 2, 0.85, "domain dedicated", rf"dedicated to {ANY % 2}public domain"),
    ("public-domain", 2, 0.85, "domain public", r"public domain (?:mark|work|dedication)"),
    ("proprietary", 1, 0.7, "proprietary", r"proprietary and confidential"),
    ("proprietary", 1, 0.7, "proprietary", r"confidential and proprietary"),
    ("proprietary", 1, 0.6, "proprietary", rf"proprietary (?:software )?{LICENCE}"),
    ("reserved", 0, 0.5, "rights reserved", r"some rights reserved"),
    ("reserved", 0, 0.5, "rights reserved", r"no rights reserved"),
    ("copyright", 0, 0.4, "copyright", r"copyright (?:c |© )?(?:19|20)\d\d(?: (?:19|20)\d\d)*"),
    ("copyright", 0, 0.4, "copyright", r"(?:19|20)\d\d copyright"),
]

# Passages of licence texts: label, regex; the keywords are the longest words that every match holds.
TEXTS: list[tuple[str, str]] = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions"),
    ("mit", r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", r"merchantability fitness for a particular purpose and noninfringement"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", r"the software is provided as is and the author disclaims all warranties"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", rf"neither the names? of {ANY % 12}may be used to endorse or promote products"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", r"licensed under the apache license version 2 0"),
    ("apache-2.0", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("gpl", rf"redistribute it and or modify it under the terms of the gnu general public license as published by"),
    ("gpl-2.0", rf"under the terms of the gnu general public license {ANY % 12}either version 2 of the license"),
    ("gpl-3.0", rf"under the terms of the gnu general public license {ANY % 12}either version 3 of the license"),
    ("gpl", r"you should have received a copy of the gnu general public license"),
    ("gpl", r"the gnu general public license is a free copyleft license"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license"),
    ("lgpl", r"under the terms of the gnu lesser general public license as published by"),
    ("lgpl", r"under the terms of the gnu library general public license as published by"),
    ("agpl", r"you should have received a copy of the gnu affero general public license"),
    ("agpl", r"under the terms of the gnu affero general public license as published by"),
    ("gfdl", rf"under the terms of the gnu free documentation license {ANY % 14}with no invariant sections"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl", r"if a copy of the mpl was not distributed with this file you can obtain one"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("bsl-1.0", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", r"the origin of this software must not be misrepresented"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", r"do what the fuck you want to public license"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("python-2.0", r"psf is making python available to licensee on an as is basis"),
    ("php-3.01", r"this source file is subject to version 3 01 of the php license"),
    ("ofl-1.1", r"this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", r"no modified version of the font software may use the reserved font name s"),
    ("artistic-2.0", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("openssl", r"this product includes software developed by the openssl project"),
    ("x11", r"except as contained in this notice the name of the x consortium shall not be used"),
    ("ncsa", rf"developed by {ANY % 10}university of illinois"),
    ("cc0-1.0", rf"to the extent possible under law {ANY % 12}has waived all copyright"),
    ("cc0-1.0", r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc", r"this work is licensed under (?:a|the) creative commons"),
    ("cc", r"to view a copy of this license visit (?:https? )?(?:www )?creativecommons org"),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("commons-clause", r"the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service"),
    ("odbl-1.0", r"made available under the open database license"),
    ("pddl-1.0", r"made available under the public domain dedication and license"),
    ("ogl-uk-3.0", r"contains public sector information licensed under the open government licence"),
    ("lppl-1.3c", r"this work has the lppl maintenance status"),
    ("lppl-1.3c", r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("ms-pl", r"each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution"),
    ("w3c", r"by obtaining (?:using )?and or copying this work you the licensee agree"),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("freetype", rf"portions of this software are copyright {ANY % 4}the freetype project"),
    ("ijg", r"this software is based in part on the work of the independent jpeg group"),
    ("llama", r"llama (?:2|3|3 1|3 2) is licensed under the llama"),
    ("openrail-m", r"use restrictions as referenced in paragraph 5"),
    ("proprietary", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", r"no part of this (?:publication|book|document|work) may be reproduced"),
    ("proprietary", r"redistribution (?:or reproduction )?(?:in whole or in part )?is (?:strictly )?prohibited"),
    ("proprietary", r"contains trade secrets and (?:proprietary|confidential) information"),
]

#: Members of the family of six attribution licences, in the order of their names.
CC_PARTS = ["by", "by nc", "by nc nd", "by nc sa", "by nd", "by sa"]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
CC_WORDS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}


def sure_words(pattern: str) -> list[str]:
    """Words that every match of a pattern holds, longest first: what stands outside its groups, classes and options."""
    groups = 1
    while groups:  # innermost groups first
        pattern, groups = re.subn(r"\(\?:[^()]*\)", "~", pattern)
    return sorted({w for w in pattern.replace(" ?", "~").split(" ") if re.fullmatch("[a-z0-9]+", w)}, key=lambda w: (-len(w), w))


def _named(label: str, keywords: str, title: str, ids: list[str], addresses: list[str]) -> Iterator[Rule]:
    words = tuple(keywords.split())
    yield Rule(label, 2, 0.85, words, title)
    yield Rule(label, 2, 0.9, (*words, "licensed"), rf"(?:dual )?licensed under (?:the )?(?:terms of (?:the )?)?{title}")
    for i in ids:
        yield Rule(label, 4, 1.0, ("spdx", "identifier", *i.split()), f"spdx {LICENCE} identifier {i}")
    for a in addresses:
        yield Rule(label, 3, 0.95, tuple(a.split()), a)


def _creative_commons() -> Iterator[Rule]:
    for part in CC_PARTS:
        codes = part.split()
        full = " ".join(CC_WORDS[c] for c in codes)
        label = "cc-" + "-".join(codes)
        yield Rule(label, 1, 0.8, ("cc", *codes), f"cc {part}")
        yield Rule(label, 1, 0.8, ("commons", "attribution"), f"creative commons {full}")
        yield Rule(label, 3, 0.9, ("creativecommons", *codes), f"creativecommons org licenses {part}")
        for v in CC_VERSIONS:
            yield Rule(f"{label}-{v.replace(' ', '.')}", 2, 0.9, ("cc", *codes, *v.split()), f"cc {part} (?:v |version )?{v}")
            yield Rule(f"{label}-{v.replace(' ', '.')}", 2, 0.9, ("commons", "attribution", *v.split()), f"creative commons {full} {v}(?: international| unported| generic)?")
            yield Rule(f"{label}-{v.replace(' ', '.')}", 3, 0.95, ("creativecommons", *codes, *v.split()), f"creativecommons org licenses {part} {v}")
            yield Rule(f"{label}-{v.replace(' ', '.')}", 4, 1.0, ("spdx", "cc", *codes, *v.split()), f"spdx {LICENCE} identifier cc {part} {v}")
    yield Rule("cc0-1.0", 3, 0.95, ("creativecommons", "zero"), "creativecommons org publicdomain zero 1 0")
    yield Rule("cc0-1.0", 4, 1.0, ("spdx", "cc0"), f"spdx {LICENCE} identifier cc0 1 0")
    yield Rule("public-domain", 3, 0.95, ("creativecommons", "mark"), "creativecommons org publicdomain mark 1 0")


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules in order: of equal intervals and priorities, the earlier rule's match stays."""
    out = [rule for entry in NAMED for rule in _named(*entry)]
    out += _creative_commons()
    out += [Rule(label, 3, 0.95, tuple(sure_words(p)[:2]), p) for label, p in TEXTS]
    out += [Rule(label, priority, confidence, tuple(k.split()), p) for label, priority, confidence, k, p in GENERIC]
    return out + [Rule(label, 0, 0.6, tuple(reversed(phrase.split())), phrase, base=True) for phrase, label in BASE]


@dataclass(frozen=True)
class Match:
    rule: int
    first: int  # words, from 0
    last: int  # the word after
    kept: bool = True


def suppress(found: list[tuple[int, int, int]], priority: list[int]) -> list[bool]:
    """Whether each (first, last, rule) stays."""
    stays = [True] * len(found)
    order = sorted(range(len(found)), key=lambda i: (found[i][0], -found[i][1], -priority[found[i][2]], found[i][2]))
    for level in {priority[r] for _, _, r in found}:
        reach = -1
        for i in order:
            if priority[found[i][2]] >= level:
                if found[i][1] <= reach and priority[found[i][2]] == level:
                    stays[i] = False
                reach = max(reach, found[i][1])
    return stays


_TABLE = np.full(256, 0x20, dtype=np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _TABLE[_lo:_hi] = np.arange(_lo, _hi)
_TABLE[0x41:0x5B] = np.arange(0x61, 0x7B)


class Scanner:
    """Compiled rules and their keyword table."""

    def __init__(self, own: list[Rule] | None = None) -> None:
        self.rules = rules() if own is None else own
        self.patterns = [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])".encode()) for r in self.rules]
        words = sorted({w for r in self.rules for w in r.keywords})
        flat = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
        end = np.cumsum([len(w) + 1 for w in words]) - 1
        hashes = byte_hashes(flat, end - [len(w) for w in words], end)
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        at = {w: i for i, w in enumerate(words)}
        self.needs = [frozenset(at[w] for w in r.keywords) for r in self.rules]
        self.by_first: dict[int, list[int]] = {}
        for i, r in enumerate(self.rules):
            self.by_first.setdefault(at[r.keywords[0]], []).append(i)
        self.priority = [r.priority for r in self.rules]

    def matches(self, words: bytes, among: list[int]) -> list[Match]:
        """Matches of some rules in one text's words, by place."""
        spaces = np.flatnonzero(np.frombuffer(words, dtype=np.uint8) == 0x20)
        found = []
        for r in among:
            for m in self.patterns[r].finditer(words):
                first, last = np.searchsorted(spaces, m.span())
                found.append((int(first), int(last) + 1, r))
        stays = suppress(found, self.priority)
        return sorted((Match(r, first, last, kept) for (first, last, r), kept in zip(found, stays, strict=True)), key=lambda m: (m.first, m.last, m.rule))

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list[Match]]]:
        """Words of each text, and the matches of those that have any."""
        data = _TABLE[data]
        start, end, before = word_bounds(data, offsets)
        hashes = byte_hashes(data, start, end)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        text = np.searchsorted(before, hit, "right") - 1
        pairs = np.unique(text * len(self.hashes) + self.number[at[hit]])
        out: dict[int, list[Match]] = {}
        owner, word = pairs // len(self.hashes), pairs % len(self.hashes)
        cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)) if len(owner) else np.zeros(1, np.int64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            have = set(word[lo:hi].tolist())
            among = [r for w in have for r in self.by_first.get(w, ()) if self.needs[r] <= have]
            if among:
                i = int(owner[lo])
                own = b" ".join(data[offsets[i] : offsets[i + 1]].tobytes().split())
                found = self.matches(own, among)
                if found:
                    out[i] = found
        return np.diff(before), out


@lru_cache(maxsize=1)
def _scanner() -> Scanner:
    return Scanner()


HIT = StructType(
    [
        StructField("label", StringType()),
        StructField("rule", IntegerType()),
        StructField("priority", IntegerType()),
        StructField("confidence", DoubleType()),
        StructField("first", LongType()),
        StructField("last", LongType()),
        StructField("kept", BooleanType()),
        StructField("base", BooleanType()),
    ]
)


def detect(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with n_words and hits: every match with its interval of words and whether it stays."""
    python_stage(docs.sparkSession)
    new = [("n_words", LongType()), ("hits", ArrayType(HIT))]
    docs = docs.select(*[c for c in docs.columns if c not in {n for n, _ in new}])
    fields = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    at = docs.columns.index(text_col)
    arrow_hit = pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("confidence", pa.float64()), ("first", pa.int64()), ("last", pa.int64()), ("kept", pa.bool_()), ("base", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        own_rules = scanner.rules

        def hit(m: Match) -> dict:
            r = own_rules[m.rule]
            return {"label": r.label, "rule": m.rule, "priority": r.priority, "confidence": r.confidence, "first": m.first, "last": m.last, "kept": m.kept, "base": r.base}

        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for lo, hi in slices(offsets):
                n_words, found = scanner.scan(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                own = batch.slice(lo, hi - lo)
                hits = pa.array([[hit(m) for m in found.get(i, ())] for i in range(hi - lo)], pa.list_(arrow_hit))
                columns = [own.column(f.name) for f in fields] + [pa.array(n_words.astype(np.int64)), hits]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields] + [n for n, _ in new])

    return docs.mapInArrow(rows, StructType([*fields, *[StructField(n, t) for n, t in new]]))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    base = F.filter("hits", lambda h: h["base"])
    kept = F.filter("hits", lambda h: h["kept"] | h["base"])
    starts = F.transform(base, lambda h: h["first"])
    labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    sure = F.array_max(F.transform(F.filter("hits", lambda h: h["kept"]), lambda h: h["confidence"]))
    return detect(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(kept).alias("labels"),
        F.coalesce(sure, F.lit(0.0)).alias("score"),
    )
