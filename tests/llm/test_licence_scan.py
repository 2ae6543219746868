"""Licences by sentence rules."""

import random
import re

import pytest

from medallion_marts.llm import licence_scan
from medallion_marts.llm.queries import QUERIES

GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
REST = """
The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BOOST = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT
SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE
FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""
MIT = "MIT License\n\nCopyright (c) 2020 A. Person\n\n" + GRANT + REST
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""


def names(text):
    return [n for n, _, _ in licence_scan.licences(text)[0]]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Some words.\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        ("a | b |\nThis work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("Released under the MIT Licence", ["MIT"]),
        ("# SPDX-License-Identifier: LGPL-2.1-or-later", ["LGPL-2.1-or-later"]),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0", "MIT"]),
        ("This file is licensed\n * under the terms of\n * the Mozilla Public License, v. 2.0.", ["MPL-2.0"]),
        (MIT, ["MIT"]),
        ("\n".join(" * " + line for line in MIT.splitlines()), ["MIT"]),
        (GPL, ["GPL-2.0-or-later"]),
        ("Released under Apache 2.0.", ["Apache-2.0"]),
        ("                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/\n", ["Apache-2.0"]),
        ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n", ["GPL-3.0-only"]),
        ("This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", ["MPL-2.0"]),
        ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/", ["EPL-2.0"]),
        (BOOST, ["BSL-1.0"]),
        ("mit und ohne", []),
        (None, []),
    ],
)
def test_licences(text, expected):
    assert names(text) == expected


def test_sequence_counts():
    """A part of a licence is no licence and stays in the rest."""
    found, rest = licence_scan.licences(GRANT)
    assert found == [] and [n for n, _, _ in rest] == ["mit_grant"]
    found, rest = licence_scan.licences(REST + GRANT)
    assert found == [] and [n for n, _, _ in rest] == ["mit_notice", "mit_as_is", "mit_liability", "mit_grant"]
    assert [n for n, _, _ in licence_scan.licences("Licensed under the Frobnicate License.")[1]] == ["unknown"]


def test_whole_text():
    """Licences at the end of a long text, with their places."""
    text = "Words and more words. " * 100_000 + "\n" + MIT + "tail\nLicensed under CC BY-NC 4.0."
    found, rest = licence_scan.licences(text)
    assert [n for n, _, _ in found] == ["MIT", "CC-BY-NC-4.0"] and rest == []
    assert text[found[0][1] :].startswith("MIT License") and text[: found[0][2]].endswith("SOFTWARE")
    assert text[found[1][1] : found[1][2]] == "Licensed under CC BY-NC 4.0"


def test_op6(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet").collect()}
    known = {"Apache": "Apache-2.0", "MIT": "MIT", "GNU": "GPL-3.0-only", "CC BY-NC": "CC-BY-NC-4.0"}
    got = {r.doc_id: r for r in QUERIES["op6_licence_scan"](spark, small.replace("sf0.001", "sf0.01")).collect()}
    assert set(got) == set(texts)
    assert sum(len(r.licences) for r in got.values()) > 0
    for i, text in texts.items():
        lines = [m for m in re.findall(r"(?m)^(?:This work is licensed|Licensed|Released) under .*$", text or "")]
        assert got[i].licences == sorted({name for part in lines for key, name in known.items() if key in part})
        assert bool(got[i].matches) == bool(lines) and not got[i].rest


def test_null_and_repeated_rows(spark):
    rows = [(1, None), (1, None), (None, "Licensed under CC BY-NC 4.0."), (2, "")]
    got = licence_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.licences) for r in got) == [(False, []), (False, []), (False, []), (True, ["CC-BY-NC-4.0"])]


def test_no_known_sentence_is_filtered():
    """Every known sentence has a stem in its plain words, outside of groups; these have one in each branch of a group, or are neutral."""
    within = {"ref", "title", "gnu_where", "free", "reserved", "copyright"}
    for sid, pattern in licence_scan.SENTENCES:
        plain = pattern
        while (less := re.sub(r"\([^()]*\)(?:[?*]\??|\{\d+,\d+\}\??)?", " ", plain)) != plain:
            plain = less
        assert sid in within or licence_scan.STEMS.search(plain.replace("~", " ").replace("\\", "")), sid


#: Sentences by their ids, for the plain recogniser.
SAID = {
    "mit_grant": GRANT.replace("\n", " ").strip(),
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit_as_is": "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
    "mit_liability": "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.",
    "zlib_as_is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib_liability": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    "zlib_notice": "This notice may not be removed or altered from any source distribution.",
    "apache_may": "You may not use this file except in compliance with the License.",
    "apache_see": "See the License for the specific language governing permissions and limitations under the License.",
    "gnu_warranty": "This program is distributed in the hope that it will be useful, but without any warranty.",
    "ref": "Licensed under the Apache License, Version 2.0.",
    "title": "Zlib License",
    "mpl_subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unknown": "Licensed under the Frobnicate License.",
}
NAMED = {"ref": "Apache-2.0", "title": "Zlib"}


def recognised(ids):
    """Licences and what is left, rule after rule, by trying every place and every choice."""
    left, out = list(enumerate(ids)), []

    def ways(rule, k):
        if not rule:
            yield k
            return
        name, may_miss = rule[0].rstrip("?"), rule[0].endswith("?")
        if k < len(ids) and (k, name) in here:
            yield from ways(rule[1:], k + 1)
        if may_miss:
            yield from ways(rule[1:], k)

    for licence, rule in licence_scan.RULES:
        at = 0
        while at < len(ids):
            here = set(left)
            end = next((e for e in ways(rule.split(), at) if e > at), None)
            if end is None:
                at += 1
                continue
            said = [licence] if licence else [NAMED[i] for k, i in left if at <= k < end and i in NAMED]
            out += [(at, name) for name in said]
            left = [(k, i) for k, i in left if not at <= k < end]
            at = end
    return [n for _, n in sorted(out)], [i for _, i in left]


def test_against_a_plain_recogniser():
    rng = random.Random(5)
    whole = [["mit_grant", "mit_notice", "mit_as_is", "mit_liability"], ["zlib_as_is", "zlib_liability", "zlib_grant", "zlib_notice"], ["ref", "apache_may", "apache_see"], ["title", "zlib_as_is", "zlib_liability", "zlib_grant"]]
    found = 0
    for _ in range(300):
        ids = []
        while len(ids) < rng.randint(1, 10):
            ids += rng.choice(whole) if rng.random() < 0.5 else [rng.choice(list(SAID))]
            if rng.random() < 0.2 and len(ids) > 1:
                ids.pop(rng.randrange(len(ids)))
        licences, rest = licence_scan.licences("\n\n".join(SAID[i] for i in ids))
        assert ([n for n, _, _ in licences], [n for n, _, _ in rest]) == recognised(ids), ids
        found += len(licences)
    assert found > 200


def test_empty_table_and_other_columns(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0.", 5, "x"), (2, "w " * 200_000 + "\nReleased under the MIT License", 6, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, licences string")
    assert sorted((r.doc_id, r.licences) for r in licence_scan.scan(docs).collect()) == [(1, ["CC-BY-NC-4.0"]), (2, ["MIT"])]
    assert licence_scan.scan(docs.limit(0)).count() == 0
