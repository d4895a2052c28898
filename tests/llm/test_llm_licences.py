"""Licences of whole files as they are shipped, and the scan against a brute-force version over the whole table."""

import math
import re
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from shardfold.llm import licence_scan, licence_texts

SF = "/root/testdata/sf0.001"
CODE = "\n".join(f"def step_{k}(x):\n    return x + {k}" for k in range(60))

# fixed values: heads and whole texts of licence files
BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer."
BSD_2 = ("2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n"
         "   and/or other materials provided with the distribution.")
BSD_3 = ("3. Neither the name of Example Corp nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
         "   this software without specific prior written permission.")
BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\n'
           "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE\n"
           "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL\nDAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR\n"
           "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER\nCAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,\n"
           "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE\nOF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
BSD_HEAD = ("Copyright (c) 2019, Example Corp\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
            "modification, are permitted provided that the following conditions are met:")
APACHE = ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n"
          "   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n\n"
          '      "License" shall mean the terms and conditions for use, reproduction,\n      and distribution as defined by Sections 1 through 9 of this document.')
GPL = ("                    GNU GENERAL PUBLIC LICENSE\n                       Version {}\n\n Everyone is permitted to copy and distribute verbatim copies\n"
       " of this license document, but changing it is not allowed.\n\n                            Preamble\n")
ISC = ("Copyright (c) 2021 A. Person\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
       "copyright notice and this permission notice appear in all copies.")
MIT = ("The MIT License\n\nCopyright (c) 2020 Some Body. All rights reserved.\n\n"
       'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\n'
       "in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
       "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:")
FILES = [
    ("bsd3/LICENSE", "\n\n".join((BSD_HEAD, BSD_1, BSD_2, BSD_3, BSD_END)), "BSD-3-Clause"),
    ("bsd3-tight/COPYING", "\n".join((BSD_HEAD, BSD_1, BSD_2, BSD_3, BSD_END)), "BSD-3-Clause"),
    ("bsd2/LICENSE", "\n\n".join((BSD_HEAD, BSD_1, BSD_2, BSD_END)), "BSD-2-Clause"),
    ("bsd2-tight/LICENSE.txt", "\n".join((BSD_HEAD, BSD_1, BSD_2, BSD_END)), "BSD-2-Clause"),
    ("apache/LICENSE", APACHE, "Apache-2.0"),
    ("gpl3/COPYING", GPL.format("3, 29 June 2007"), "GPL-3.0"),
    ("gpl2/COPYING", GPL.format("2, June 1991"), "GPL-2.0"),
    ("agpl/COPYING", GPL.replace("GENERAL", "AFFERO GENERAL").format("3, 19 November 2007"), "AGPL-3.0"),
    ("lgpl/COPYING", GPL.replace("GENERAL", "LESSER GENERAL").format("3, 29 June 2007"), "LGPL-3.0"),
    ("isc/LICENSE", ISC, "ISC"),
    ("mit/LICENSE", MIT, "MIT"),
    ("closed/LICENSE", "Copyright (c) 2022 Example Corp\nAll rights reserved.", "Proprietary"),
    ("heads/bsd3.py", f'"""A module.\n\n{BSD_HEAD}\n\n{BSD_1}\n\n{BSD_2}\n\n{BSD_3}\n"""\n\n{CODE}', "BSD-3-Clause"),
    ("heads/bsd2.c", "/*\n" + "\n".join(f" * {x}" for x in "\n".join((BSD_HEAD, BSD_1, BSD_2, BSD_END)).split("\n")) + f"\n */\n\n{CODE}", "BSD-2-Clause"),
    ("heads/code.py", CODE, None),
    ("heads/prose.txt", "The software was free of charge, and the conditions of the road were not met.\nAny person may copy this.", None),
]


def test_files_as_they_are_shipped(spark):
    rows = [(p, t) for p, t, _ in FILES] + [(p.split("/")[0] + "/src/x.py", CODE) for p, _, _ in FILES if not p.startswith("heads/")]
    got = {r.path: (r.licence, r.origin) for r in licence_scan.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    for path, _, licence in FILES:
        assert got[path] == (licence, "own" if licence else "none"), path
        if not path.startswith("heads/"):
            assert got[path.split("/")[0] + "/src/x.py"] == (licence, "inherited"), path


def terms(text):
    # letters that only become ASCII when lower-cased are of no concern to these texts
    return re.findall(r"[a-z0-9]+(?:[.][0-9]+)*", text.lower())


def lines(text):
    return [x for x in text.split("\n") if x.strip(" ")]


def brute_own(texts):
    """Per text that declares one: (licence, score, lines of the notices), with every line, paragraph and text compared."""
    n = len(texts)
    df = Counter(t for text in texts for t in set(terms(text)))
    templates = [(l, terms(t)) for l, ts in licence_texts.TEMPLATES.items() for t in ts]
    known = {t for _, ts in templates for t in ts}

    def vector(words):
        return {t: (1 + math.log(c)) * (math.log((n + 1) / (df[t] + 1 if t in known else 1)) + 1) for t, c in Counter(words).items()}

    def norm(v):
        return math.sqrt(sum(w * w for w in v.values()))

    vectors = [(l, vector(ts)) for l, ts in templates]
    vectors = [(l, v, norm(v)) for l, v in vectors]
    out = {}
    for text in set(texts):
        blocks = {b for b in [*re.split(r"\n[ \t\r]*\n", text), text] if "\n" in b}
        best, in_lines, in_blocks = {}, 0, 0
        for unit, is_line in [(x, True) for x in lines(text)] + [(b, False) for b in blocks]:
            u = vector(terms(unit))
            size = norm(u)
            scored = [(l == licence_texts.RESERVED, -round(sum(w * v.get(t, 0) for t, w in u.items()) / size / m, 9), l) for l, v, m in vectors] if size else []
            scored = [x for x in scored if -x[1] >= licence_scan.MIN_SCORE]
            if scored:
                found = min(scored)
                best[found[2]] = min(found, best.get(found[2], found))
                in_lines, in_blocks = in_lines + is_line, max(in_blocks, 0 if is_line else len(lines(unit)))
        for longer, shorter in licence_texts.EXTENDS.items():
            if longer in best:
                best.pop(shorter, None)
        if best:
            _, score, licence = min(best.values())
            out[text] = (licence, -score, max(in_lines, in_blocks))
    return out


def brute_scan(files):
    """Per id: licence, score, origin, directory it comes from."""
    own = brute_own([t for _, _, t in files])
    covering = defaultdict(list)
    for _, path, text in files:
        if text in own and 10 * own[text][2] >= len(lines(text)):
            covering["/".join(path.split("/")[:-1])].append((own[text][0] == licence_texts.RESERVED, -own[text][1], own[text][0]))
    out = {}
    for i, path, text in files:
        up = path.split("/")[:-1]
        above = next((d for d in ("/".join(up[:k]) for k in range(len(up), -1, -1)) if d in covering), None)
        if text in own:
            out[i] = (own[text][0], own[text][1], "own", None)
        else:
            out[i] = (min(covering[above])[2], None, "inherited", above) if above is not None else (None, None, "none", None)
    return out


def test_op8_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, source, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()
    files = [(i, "/".join([s or "none", *(str(i // n) for n in (1000, 100, 10, 1))]), t) for i, s, t in docs]
    want = brute_scan(files)
    got = {r.doc_id: (r.licence, r.score, r.origin, r.from_dir) for r in E.queries()["op8_licence_scan"](spark, SF).collect()}
    assert set(got) == set(want)
    for i, (licence, score, origin, from_dir) in want.items():
        assert got[i][0] == licence and got[i][2:] == (origin, from_dir), i
        assert got[i][1] == score or abs(got[i][1] - score) < 1e-6
    assert {o for _, _, o, _ in want.values()} >= {"own", "none"}


def test_scan_equals_brute_force_on_a_tree(spark):
    files = [(k, p, t) for k, (p, t, _) in enumerate(FILES)]
    files += [(100 + k, f"{p.split('/')[0]}/deep/er/x{k}", CODE[k:]) for k, (p, _, _) in enumerate(FILES)]
    files += [(200, "bsd3/deep/NOTES", "Released under the MIT License."), (201, "z/y", ""), (203, "alone/x", "code"), (202, "z/LICENSE", "Licensed under CC BY 4.0.\n\nReleased under the MIT License.")]
    want = brute_scan(files)
    df = spark.createDataFrame(files, "id int, path string, text string")
    got = {r.id: (r.licence, r.origin, r.from_dir) for r in licence_scan.scan(df, is_licence_file=F.lit(False), lines_per_notice=10).collect()}
    assert got == {i: (l, o, d) for i, (l, _, o, d) in want.items()}
    assert {o for _, o, _ in got.values()} == {"own", "inherited", "none"}
