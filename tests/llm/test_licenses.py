"""Licence notices by example, and against plain search for the short ones."""

import random
import re
import textwrap

from haulmark.llm import licenses

SHORT = {name: wording for name, wording, _ in licenses.TEMPLATES if len(licenses.words_of(wording)) < licenses.LONG}
LONG = {name: wording for name, wording, _ in licenses.TEMPLATES if len(licenses.words_of(wording)) >= licenses.LONG}


def names(text):
    return [x[0] for x in licenses.scan(text)]


def test_every_template_finds_itself():
    for name, wording, _ in licenses.TEMPLATES:
        assert name in names(f"Some words before.\n{wording}.\nSome words after."), wording


def test_every_template_in_any_case():
    for name, wording, _ in licenses.TEMPLATES:
        for form in (wording.upper(), wording.title(), wording.lower()):
            assert names(f"Some words before.\n{form}.\nSome words after.") == [name], form
    assert names("Copyright 2020 Foo Inc. All Rights Reserved.") == ["All-rights-reserved"]
    assert names("COPYRIGHT 2020 FOO INC. ALL RIGHTS RESERVED.") == ["All-rights-reserved"]
    assert names("RELEASED UNDER THE MIT LICENSE") == ["MIT"]
    assert names("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0") == ["Apache-2.0"]


def test_long_templates_wrapped_with_numbered_clauses():
    for name, wording, _ in licenses.TEMPLATES:
        if len(licenses.words_of(wording)) < licenses.LONG:
            continue
        clauses = re.split(r"(?<=:) (?=Redis|The above)|(?<=[.]) (?=Redis|Neither)", wording)
        head, rest = clauses[0], [f"{i}. {c}" for i, c in enumerate(clauses[1:], 1)]
        for mark in ("", "# ", " * "):
            lines = [x for c in [head, *rest] for x in [*textwrap.wrap(c, 72, subsequent_indent="   "), ""]]
            notice = "\n".join(mark + x for x in lines).strip()
            text = f"Some text before.\nAnd more\n\n{notice}\n\nint main;\n"
            assert names(text) == [name], text
            # The whole wording is covered.
            (_, a, b, _, missing, _), = licenses.scan(text)
            assert missing == 0 and licenses.words_of(text[a:b])[-1] == licenses.words_of(wording)[-1]
            assert names(text + "And some more words.\n" * 200 + text) == [name, name]
    assert names("All rights\nreserved.") == ["All-rights-reserved"]


def test_relatives_are_told_apart():
    assert names(LONG["BSD-2-Clause"]) == ["BSD-2-Clause"]
    assert names(LONG["BSD-3-Clause"]) == ["BSD-3-Clause"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("licensed under the GNU Lesser General Public License, version 3") == ["LGPL-3.0"]


def test_wording_differences():
    text = LONG["MIT"]
    assert names(text.replace("merge, ", "").replace("deal in", "trade in")) == ["MIT"]
    assert "MIT" not in names(text.replace("sublicense, ", ""))
    assert "MIT" not in names(" ".join(w for i, w in enumerate(text.split()) if i % 4))


def test_short_notices_in_prose():
    rng = random.Random(6)
    filler = ["Lorem ipsum dolor.", "sit amet", "consectetur, adipiscing elit;", "sed do."]
    for _ in range(200):
        parts, want = [], []
        for _ in range(rng.randint(1, 6)):
            if rng.random() < 0.4:
                name = rng.choice(["MIT", "CC-BY-NC-4.0", "All-rights-reserved"])
                want.append(name)
                parts.append(SHORT[name] + ".")
            parts += [rng.choice(filler) for _ in range(rng.randint(0, 5))]
        text = "\n".join(parts)
        found = licenses.scan(text)
        assert sorted(x[0] for x in found) == sorted(want), text
        assert all(text[a:b] in SHORT.values() for _, a, b, *_ in found)


def test_unknown_and_none():
    assert names("Licensed under some odd licence, v9.") == ["unknown"]
    assert names("without warranty of any kind") == []
    assert names("") == []


def test_long_text():
    text = "word " * 100_000 + "\nReleased under the MIT License.\n" + "word " * 1000
    assert names(text) == ["MIT"]


def test_frames(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.", 1), (2, None, 2), (3, "", 3)], "doc_id bigint, text string, notices int")
    got = sorted(map(tuple, licenses.find(docs).select("doc_id", "n_notices", "licences", "notices").collect()))
    assert got == [(1, 1, "MIT", "MIT:0:30:0:0"), (2, 0, "", ""), (3, 0, "", "")]
    assert licenses.find(docs.limit(0)).count() == 0
