import pytest
from helpers import all_docs, edge_docs, empty_docs, inputs

from carlot.llm import licenses as lic

MIT = """// Copyright (c) someone
//
// Permission is hereby granted, free of charge, to any person obtaining a copy
// of this software and associated documentation files (the "Software"), to deal
// in the Software without restriction, including without limitation the rights
// to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
// copies of the Software, and to permit persons to whom the Software is
// furnished to do so, subject to the following conditions:
//
// The above copyright notice and this permission notice shall be included in all
// copies or substantial portions of the Software.
"""


def test_every_known_sentence_has_a_keyword_and_a_rule():
    assert all(lic.KEYWORD.search(s) and lic.normalised(s) == " ".join(s.replace("*", "").split()) for s in lic.IDENTIFIERS)
    assert {i for _, sequence in lic.RULES for i in sequence} <= set(lic.IDENTIFIERS.values())
    assert not any(s.startswith("*") for s in lic.IDENTIFIERS)


@pytest.mark.parametrize(("text", "licenses", "loose"), [
    (MIT, ["MIT"], 0),
    ("prose without a stop\nReleased under the MIT License.", ["MIT"], 0),
    ("Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", ["Apache-2.0", "CC-BY-NC-4.0"], 0),
    ("See the GNU General Public License for more details.", [], 1),
    ("This license is not known. Public things", [], 0),
    ("* Redistribution and use in source and binary forms, with or without\n* modification, are permitted provided that the following conditions are met:\n"
     "* 1. Redistributions of source code must retain the above copyright notice, this\n*    list of conditions and the following disclaimer.\n"
     "* 2. Redistributions in binary form must reproduce the above copyright notice,\n*    this list of conditions and the following disclaimer in the documentation\n"
     "*    and/or other materials provided with the distribution.", ["BSD-2-Clause"], 0),
    ("", [], 0),
])
def test_texts(text, licenses, loose):
    assert lic.matched(lic.identifiers(text)) == (licenses, loose)


@pytest.mark.parametrize("table", [edge_docs, all_docs])
def test_against_lines(spark, table):
    """In these tables each licence sentence is a line of its own."""
    known = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    docs = table(spark)
    got = sorted(((r["doc_id"], r["licenses"]) for r in lic.scan_licenses(docs).collect()), key=repr)
    want = [(i, ";".join(dict.fromkeys(known[x] for x in t.split("\n") if x in known))) for i, t in inputs(docs)]
    assert got == sorted(want, key=repr)


# The standard notices, as they stand in sources and licence files. {identifiers: notice}
NOTICES = {
    "gpl3-later,gpl-hope,gpl-details,gpl-copy": """
    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
    "gpl2-later,gpl-hope,gpl-details,gpl-copy": """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License along
 * with this program; if not, write to the Free Software Foundation, Inc.,
 * 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.
 */""",
    "mpl2-name,mpl2-copy": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */""",
    "apache2-name,apache2-comply,apache2-copy,apache2-law,apache2-see": """# Copyright 2020 Someone
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
""",
    "mit-name,mit-grant,mit-notice,as-is,mit-liability": """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
""",
    "bsd-grant,bsd-source,bsd-binary,bsd-names": """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

(b) Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "bsd-grant,bsd-source,bsd-binary,bsd-names,bsd-as-is,bsd-liability": """Copyright (c) 2001, The Widget Project
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.
* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
* Neither the name of The Widget Project nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
""",
    "bsd-grant,bsd-source,bsd-binary,bsd-advertising,bsd-names": """
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the Example Institute.
4. Neither the name of the Example Institute nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
""",
    "lgpl21-later,lgpl-hope,lgpl-details,lgpl-copy": """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * This library is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * Lesser General Public License for more details.
 *
 * You should have received a copy of the GNU Lesser General Public
 * License along with this library; if not, write to the Free Software
 * Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301  USA
 */""",
    "lgpl3-later,gpl-hope,lgpl-details,lgpl-copy": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Lesser General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU Lesser General Public License for more details.
#
# You should have received a copy of the GNU Lesser General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
    "lgpl3-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 3 of the License, or (at your option) any later version.""",
    "agpl3-later,gpl-hope,agpl-details,agpl-copy": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU Affero General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU Affero General Public License for more details.

    You should have received a copy of the GNU Affero General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
""",
    "epl1-name": """All rights reserved. This program and the accompanying materials
are made available under the terms of the Eclipse Public License v1.0
which accompanies this distribution, and is available at
http://www.eclipse.org/legal/epl-v10.html""",
    "epl2-name": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "boost-name,boost-copy": """// Distributed under the Boost Software License, Version 1.0.
//    (See accompanying file LICENSE_1_0.txt or copy at
//          https://www.boost.org/LICENSE_1_0.txt)""",
    "zlib-as-is,zlib-liability,zlib-grant,zlib-origin,zlib-thanks,zlib-altered,zlib-notice": """
This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    "cddl-name,apache2-comply": """/* The contents of this file are subject to the terms of the
 * Common Development and Distribution License (the "License").
 * You may not use this file except in compliance with the License. */""",
    "isc-grant,isc-as-is,isc-liability": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "zero-grant,isc-as-is,isc-liability": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
""",
    "isc-grant": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy",
}

# Short forms of one line: known sentence, the form.
SHORT = {
    **{f"spdx license identifier {lic.normalised(i)}": f"SPDX-License-Identifier: {i}" for i in lic.SPDX},
    **{lic.normalised(s): s for s in (
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the MIT License.", "MIT License", "The MIT License",
        "Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License");', "Released under the Apache License, Version 2.0.", "Apache License, Version 2.0",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2.",
        "Licensed under the Mozilla Public License, version 2.0.", "Licensed under CC0 1.0.", "This work is licensed under CC0 1.0 Universal.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Artistic License 2.0.", "The contents of this file are subject to the terms of the Common Development and Distribution License.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License, Version 2.0.",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "Use, modification, and distribution are subject to the Boost Software License, Version 1.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "(See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
        *(f"Licensed under CC {x} 4.0." for x in ("BY", "BY-SA", "BY-NC", "BY-ND")),
        *(f"This work is licensed under a Creative Commons Attribution{x} 4.0 International License." for x in ("", "-ShareAlike", "-NonCommercial", "-NoDerivatives")))},
}


@pytest.mark.parametrize(("names", "notice"), NOTICES.items())
def test_standard_notices(names, notice):
    assert ",".join(lic.identifiers(notice)) == names
    assert ",".join(lic.identifiers(f"prose before it\n{notice}\nprose behind it: more. And more")) == names
    licenses, loose = lic.matched(lic.identifiers(notice))
    assert len(licenses) == 1 and loose == 0


@pytest.mark.parametrize(("sentence", "form"), SHORT.items())
def test_short_forms(sentence, form):
    name = lic.IDENTIFIERS[sentence]
    for text in (form, f"// {form}\n// prose", f"prose: more\n<!-- {form} -->", f"  * {form.replace(' ', chr(10) + '  * ')}\n"):
        assert lic.identifiers(text) == [name], text


def test_each_known_sentence_has_a_standard_notice():
    notices = " ".join(lic.normalised(x) for x in NOTICES.values())
    notices = " ".join(w for w in notices.split(" ") if w)
    names = [s for s in lic.IDENTIFIERS if "*" in s]
    assert [s for s in lic.IDENTIFIERS if s not in SHORT and s not in notices and s not in names] == []
    assert {lic.IDENTIFIERS[s] for s in names} <= {i for x in NOTICES for i in x.split(",")}


def test_other_words_beside_a_sentence_do_not_match():
    for text in ("SPDX-License-Identifier: MIT OR Apache-2.0", "Not the MIT License", "Licensed under the Apache License, Version 2.0 or later", "the mit licenses"):
        assert lic.identifiers(text) == []


def test_empty_table(spark):
    assert lic.scan_licenses(empty_docs(spark)).count() == 0


@pytest.mark.parametrize(("name", "known"), [
    ("the copyright holder", True), ("X", True), ("A B C D E F G H", True), ("A B C D E F G H I", False),
    ("Acme, Inc. nor the names of its friends", True), ("", False)])
def test_names_of_holders(name, known):
    for end in ("its contributors", "any contributors"):
        text = (f"Neither the name of {name} nor the names of {end} may be used to endorse or promote products\n"
                "derived from this software without specific prior written permission.")
        assert (lic.identifiers(text) == ["bsd-names"]) is known, text


ODD = ["a) mit license\nx", "; (2) The MIT License.\n\nMIT license", "mit\nlicense: mit license! spdx-license-identifier: mit; x",
       "Licensed under the Apache License, Version 2.0 (the\nLicense)", "licensed under the apache license version 2. 0\nthe license",
       "MIT License\u00a0", "mit license;\u2003x", "MIT licence", "The\u0130 MIT License", "see the license for the specific language\n\n",
       "mit license\n" * 5 + "apache license version 2.0", None, "", "neither the name of a\nnor the names of its", "1) MIT License", "1. MIT License"]


def test_sql_on_documents_and_notices(spark):
    """The oracle and the operator agree on every notice and short form, alone, in prose and in comments, beside the table's documents."""
    import duckdb
    import pandas as pd

    from carlot.llm.queries import QUERIES
    texts = [*NOTICES.values(), *SHORT.values(), *ODD, MIT]
    texts += [f"prose before it\n{t}\nprose behind it: more. And more" for t in [*NOTICES.values(), *SHORT.values()]]
    texts += ["// " + t.replace("\n", "\n// ") for t in NOTICES.values()]
    texts += [f"{a}\n{b}" for a, b in zip(NOTICES.values(), [*NOTICES.values()][::-1])]
    rows = [(1_000_000 + k, t) for k, t in enumerate(texts)] + inputs(all_docs(spark))
    frame = pd.DataFrame(rows, columns=["doc_id", "text"])
    db = duckdb.connect()
    db.register("documents", frame)
    want = db.execute(QUERIES["op3_licenses"][1]).fetchall()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = lic.scan_licenses(docs).select("doc_id", "n_sentences", "n_loose", "licenses", "sentence_ids").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
