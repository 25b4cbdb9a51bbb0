"""Operator 3: licence recognition by sentence rules.

A text is cut into sentences, sentences are normalised (case, punctuation, white space, comment
marks and numbering go) and looked up among known licence sentences, each with an identifier. The
identifiers of a text, in order, are matched against ordered rules: at each place the first rule
whose identifiers follow one another there names a licence and uses them up; identifiers that no
rule takes are counted as loose.

Texts are cut into pieces at the finest marks: line breaks, and sentence marks before white space. A
known sentence is any number of pieces that follow one another, the longest first, so it may go over
several lines, blank ones too, and hold sentence marks itself ("free software: you can ...",
"v. 2.0"). A ``*`` in a known sentence stands for a name of one to ``NAME_WORDS`` words. The known
sentences and rules are a fixed table inside the code; per-row work, no shuffle, any table size.

Edge cases: NULL and empty texts have no licence; repeated rows give equal rows; repeated sentences
count each time, a licence is listed once; an empty table gives an empty result; texts without any
keyword of the known sentences are not cut at all, which cannot change the result; long texts are
read whole; of several known sentences that begin at a place the longest is taken (two of equal
length are the same); columns other than ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from carlot.llm.common import map_texts

FIELDS = [("n_sentences", "bigint"), ("n_loose", "bigint"), ("licenses", "string"), ("sentence_ids", "string")]

#: Most words that a ``*`` stands for.
NAME_WORDS = 8

# Identifiers of the SPDX list that notices name most.
SPDX = ("0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
        "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CDDL-1.0", "CECILL-2.1", "EPL-1.0", "EPL-2.0",
        "EUPL-1.2", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
        "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "NCSA", "OFL-1.1", "PostgreSQL", "Unlicense",
        "UPL-1.0", "WTFPL", "X11", "Zlib")

# Normalised sentences of public licence texts, by identifier.
SENTENCES = {
    "mit-name": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "mit license", "the mit license"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "as-is": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "mit-liability": ("in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",),
    "apache2-name": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "apache license version 2 0"),
    "apache2-comply": ("you may not use this file except in compliance with the license",),
    "apache2-copy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "apache2-law": ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "apache2-see": ("see the license for the specific language governing permissions and limitations under the license",),
    "gpl3-name": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"),
    "gpl2-name": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2"),
    "gpl3-later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl2-later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "gpl-hope": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "gpl-details": ("see the gnu general public license for more details",),
    "gpl-copy": ("you should have received a copy of the gnu general public license along with this program",),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd-names": ("neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
                  "neither the name of * nor the names of * may be used to endorse or promote products derived from this software without specific prior written permission"),
    "bsd-advertising": ("all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by *",),
    "bsd-as-is": ("this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",),
    "bsd-liability": ("in no event shall * be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    "isc-as-is": ("the software is provided as is and * disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",),
    "isc-liability": ("in no event shall * be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",),
    "zero-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "lgpl21-later": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "lgpl3-later": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
                    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "lgpl-hope": ("this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "lgpl-details": ("see the gnu lesser general public license for more details",),
    "lgpl-copy": ("you should have received a copy of the gnu lesser general public license along with this library", "you should have received a copy of the gnu lesser general public license along with this program"),
    "agpl3-later": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "agpl-details": ("see the gnu affero general public license for more details",),
    "agpl-copy": ("you should have received a copy of the gnu affero general public license along with this program",),
    "epl1-name": ("all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
                  "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html"),
    "epl2-name": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",),
    "boost-name": ("distributed under the boost software license version 1 0", "use modification and distribution are subject to the boost software license version 1 0"),
    "boost-copy": ("see accompanying file license 1 0 txt or copy at http www boost org license 1 0 txt", "see accompanying file license 1 0 txt or copy at https www boost org license 1 0 txt"),
    "zlib-as-is": ("this software is provided as is without any express or implied warranty",),
    "zlib-liability": ("in no event will the authors be held liable for any damages arising from the use of this software",),
    "zlib-grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "zlib-origin": ("the origin of this software must not be misrepresented you must not claim that you wrote the original software",),
    "zlib-thanks": ("if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required",),
    "zlib-altered": ("altered source versions must be plainly marked as such and must not be misrepresented as being the original software",),
    "zlib-notice": ("this notice may not be removed or altered from any source distribution",),
    "artistic2-name": ("licensed under the artistic license 2 0", "this program is free software you can redistribute it and or modify it under the terms of the artistic license version 2 0"),
    "cddl-name": ("the contents of this file are subject to the terms of the common development and distribution license the license", "the contents of this file are subject to the terms of the common development and distribution license"),
    "ofl-name": ("this font software is licensed under the sil open font license version 1 1",),
    "mpl2-name": ("this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"),
    "mpl2-copy": ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "cc0-name": ("licensed under cc0 1 0", "this work is licensed under cc0 1 0 universal"),
    "cc-by-name": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "cc-by-sa-name": ("licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "cc-by-nc-name": ("licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "cc-by-nd-name": ("licensed under cc by nd 4 0", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
}

#: Rules in order: licence, identifiers that follow one another. Longer ones come before their parts.
RULES = (
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-name", "apache2-comply", "apache2-copy", "apache2-law", "apache2-see")),
    ("Apache-2.0", ("apache2-name", "apache2-comply", "apache2-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope", "gpl-details", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-details", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope")),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-hope", "agpl-details", "agpl-copy")),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-hope")),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-hope", "lgpl-details", "lgpl-copy")),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-hope")),
    ("LGPL-3.0-or-later", ("lgpl3-later", "lgpl-hope", "lgpl-details", "lgpl-copy")),
    ("LGPL-3.0-or-later", ("lgpl3-later", "lgpl-hope")),
    ("LGPL-3.0-or-later", ("lgpl3-later", "gpl-hope", "lgpl-details", "lgpl-copy")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names", "bsd-as-is", "bsd-liability")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability")),
    ("Zlib", ("zlib-as-is", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-thanks", "zlib-altered", "zlib-notice")),
    ("Zlib", ("zlib-grant", "zlib-origin")),
    ("CDDL-1.0", ("cddl-name", "apache2-comply")),
    ("ISC", ("isc-grant", "isc-as-is", "isc-liability")),
    ("0BSD", ("zero-grant", "isc-as-is", "isc-liability")),
    ("BSL-1.0", ("boost-name", "boost-copy")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MPL-2.0", ("mpl2-name", "mpl2-copy")),
    ("ISC", ("isc-grant",)),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("EPL-1.0", ("epl1-name",)),
    ("EPL-2.0", ("epl2-name",)),
    ("BSL-1.0", ("boost-name",)),
    ("Artistic-2.0", ("artistic2-name",)),
    ("CDDL-1.0", ("cddl-name",)),
    ("OFL-1.1", ("ofl-name",)),
    ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache2-name",)),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("GPL-2.0-only", ("gpl2-name",)),
    ("MPL-2.0", ("mpl2-name",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-name",)),
    ("CC-BY-4.0", ("cc-by-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-name",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-name",)),
    *((identifier, (f"spdx-{identifier}",)) for identifier in SPDX),
)

#: Every known sentence holds one of these.
KEYWORDS = ("licen", "copyright", "permi", "warrant", "liable", "redistribut", "public", "mpl", "misrepresented", "acknowledg", "distribution")
KEYWORD = re.compile("|".join(KEYWORDS), re.IGNORECASE)
PIECE_END = re.compile(r"\n|[.!?;:](?=\s)")
#: List marks before the first word of a piece; those with a full stop are pieces of their own.
NUMBERING = re.compile(r"^[^a-z0-9]*[0-9a-z]\)[ \t]")
WORD = re.compile(r"[a-z0-9]+")
LINE_MARKS = re.compile(r"^[ \t]*(?:[#/*;>-]+|\(?[0-9a-z][.)])[ \t]+", re.MULTILINE)
NOT_WORD = re.compile(r"[^a-z0-9]+")

IDENTIFIERS = {sentence: name for name, sentences in SENTENCES.items() for sentence in sentences}
IDENTIFIERS |= {f"spdx license identifier {NOT_WORD.sub(' ', identifier.lower())}": f"spdx-{identifier}" for identifier in SPDX}


def normalised(sentence: str) -> str:
    return NOT_WORD.sub(" ", LINE_MARKS.sub(" ", sentence).lower()).strip()


def word_tree() -> dict:
    """The known sentences word by word; the identifier of one that ends is under "", what follows
    a name under "*"."""
    tree: dict = {}
    for sentence, name in IDENTIFIERS.items():
        node = tree
        for word in sentence.split(" "):
            node = node.setdefault(word, {})
        node[""] = name
    return tree


TREE = word_tree()


def sentence_at(pieces: list[str], at: int) -> tuple[int, str] | None:
    """(piece behind it, identifier) of the longest known sentence that begins with a piece."""
    # (node, words that the name before it has, 0 if none goes on): a word leads from each at most two ways
    states, longest = [(TREE, 0)], None
    for k in range(at, len(pieces)):
        for word in WORD.finditer(pieces[k]):
            states = [after for node, name in states for after in _steps(node, name, word[0])]
            if not states:
                return longest
        for node, _ in states:
            if "" in node:
                longest = (k + 1, node[""])
                break
    return longest


def _steps(node: dict, name: int, word: str) -> list[tuple[dict, int]]:
    out = []
    if word in node:
        out.append((node[word], 0))
    if "*" in node:
        out.append((node["*"], 1))
    if 0 < name < NAME_WORDS:
        out.append((node, name + 1))
    return out


def identifiers(text: str) -> list[str]:
    """Identifiers of the known sentences of a text, in order."""
    if not KEYWORD.search(text):
        return []
    cut = (NUMBERING.sub("", piece) for piece in PIECE_END.split(text.lower()))
    pieces = [piece for piece in cut if WORD.search(piece)]
    found, at = [], 0
    while at < len(pieces):
        known = sentence_at(pieces, at)
        if known:
            found.append(known[1])
        at = known[0] if known else at + 1
    return found


def matched(names: list[str]) -> tuple[list[str], int]:
    """Licences in the order of their first match, and the number of identifiers in no match."""
    licenses, loose, at = [], 0, 0
    while at < len(names):
        for license_, sequence in RULES:
            if tuple(names[at:at + len(sequence)]) == sequence:
                if license_ not in licenses:
                    licenses.append(license_)
                at += len(sequence)
                break
        else:
            loose += 1
            at += 1
    return licenses, loose


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: known sentences, loose ones, licences (joined by ;), identifiers (joined by ,)."""

    def make():
        def columns(texts: list[str]) -> list[list]:
            out: list[list] = [[], [], [], []]
            for text in texts:
                names = identifiers(text)
                licenses, loose = matched(names)
                for column, value in zip(out, (len(names), loose, ";".join(licenses), ",".join(names)), strict=True):
                    column.append(value)
            return out

        return columns

    return map_texts(docs, make, FIELDS)
