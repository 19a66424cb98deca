from __future__ import annotations

import json
import random
import re
import textwrap
from collections import Counter

import pytest
import zstandard

from oreflow.llm import licenses
from oreflow.llm.licenses import TEMPLATES, Scanner, blocks, scan, words

DOCS = "doc_id long, text string, license string, findings string"
PROSE = "Some text about rivers and hills.\nAnother line of it.\n"


@pytest.mark.parametrize("template", sorted(TEMPLATES))
def test_own_wording_is_exact(template):
    found = Scanner(TEMPLATES)(TEMPLATES[template].upper().replace(" ", "\n  "))
    assert found.exact and found.template == template


def saved_bytes(template, data):
    content = zstandard.ZstdCompressionDict(" ".join(words(TEMPLATES[template])).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    options = {"level": 19, "write_content_size": False, "write_dict_id": False}
    return len(zstandard.ZstdCompressor(**options).compress(data)) - len(zstandard.ZstdCompressor(dict_data=content, **options).compress(data))


def test_ranking_equals_plain_compression():
    own, scanner = words("This file is released under the MIT License, see below."), Scanner(TEMPLATES)
    shares = {k: saved_bytes(k, " ".join(own).encode()) / saved_bytes(k, " ".join(words(t)).encode()) for k, t in TEMPLATES.items()}
    ranked = scanner.ranked(own)
    assert sorted(shares, key=lambda k: (-shares[k], k)) == [k for k, _ in ranked] and ranked[0][0] == "MIT"
    assert all(share == shares[k] for k, share in ranked)


def test_only_what_compression_ranks_is_confirmed(monkeypatch):
    monkeypatch.setattr(licenses, "LEAST_SAVED", 2.0)
    assert not Scanner(TEMPLATES).document(TEMPLATES["MIT text"])[1]


WRONG = [
    "This work is licensed under the GNU General Public License, version 4.",
    "This work is licensed under the GNU Library General Public License, version 3.",
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Apache License, Version 2.1.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY-SA 3.0.",
    "This code is not released under the MIT License.",
    "It was never released under the MIT License.",
    "It isn't, by any means, released under the MIT License.",
    "Released under the BSD License.",
    "SPDX-License-Identifier: GPL-4.0-only",
    TEMPLATES["GPL-3.0 header"].replace("version 3", "version 4"),
    TEMPLATES["MIT text"].replace("is hereby granted", "is hereby not granted"),
]


@pytest.mark.parametrize("text", WRONG)
def test_another_license_is_never_confirmed(text):
    assert not [f for _, _, f in Scanner(TEMPLATES).document(PROSE + text + "\n" + PROSE)[1] if f.confirmed]


@pytest.mark.parametrize(
    "text, template",
    [
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Attribution is not needed. Released under the MIT License.", "MIT"),
        (TEMPLATES["AGPL-3.0 header"], "AGPL-3.0 header"),
        (TEMPLATES["BSD-2-Clause"], "BSD-2-Clause"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later tag"),
    ],
)
def test_the_right_license_is(text, template):
    assert [f.template for _, _, f in Scanner(TEMPLATES).document(PROSE + text + "\n" + PROSE)[1] if f.confirmed] == [template]


def test_decisions_equal_brute_force():
    """Exact notices by search at every word, changed ones by how many words were changed and which."""
    draw, scanner = random.Random(11), Scanner(TEMPLATES)
    long = [k for k in sorted(TEMPLATES) if len(words(TEMPLATES[k])) > 25]
    for _ in range(60):
        text, want = "", []
        for _ in range(draw.randrange(1, 5)):
            text += " ".join(draw.choice(["river", "hill", "a", "copyright", "licence", "of", "use"]) for _ in range(draw.randrange(9, 60))) + ". "
            name = draw.choice(sorted(TEMPLATES))
            notice = TEMPLATES[name]
            if draw.random() < 0.5:
                name = draw.choice(long)
                own = TEMPLATES[name].split()
                for at in draw.sample(range(3, len(own) - 3), draw.randrange(1, 4)):
                    own[at] = "other"
                notice = " ".join(own)
            want.append((name, words(notice)))
            text += notice + " "
        text += ". river river river"
        whole, places, exact = words(text), [], []
        for k, t in TEMPLATES.items():
            own = words(t)
            places += [(x, x + len(own), k) for x in range(len(whole) - len(own) + 1) if whole[x : x + len(own)] == own]
        exact = sorted((x, k) for x, y, k in places if not any((a, b) != (x, y) and a <= x and y <= b for a, b, _ in places))
        got = scanner.document(text)[1]
        starts = [m.start() for m in licenses._WORD.finditer(text)]
        inside = lambda x: any(a <= starts[x] < b for a, b, f in got if f.confirmed and not f.exact)  # noqa: E731  of a longer notice with a changed word
        assert [(starts.index(a), f.template) for a, _, f in got if f.exact] == [(x, k) for x, k in exact if not inside(x)]
        changed = []
        for name, own in want:
            full = words(TEMPLATES[name])
            gone = [w for w, x in zip(full, own, strict=False) if w != x]
            if gone and len(own) == len(full) and not any(map(licenses.decides, gone)):
                changed.append(name)
        mine = Counter(f.template for _, _, f in got if f.confirmed and not f.exact)
        assert not Counter(changed) - mine, (changed, mine)


def test_differences():
    changed = TEMPLATES["MIT text"].replace("free of charge", "free of any charge").replace("merge, publish", "publish")
    found = Scanner(TEMPLATES)("Copyright 2001 Somebody. " + changed + " More prose here.")
    assert (found.template, found.confirmed, found.exact) == ("MIT text", True, False)
    assert (found.missing, found.added) == (("merge",), ("any",))
    other = Scanner(TEMPLATES)("The fishing licence of the village was sold twice under the old law.")
    assert other is None or not other.confirmed


def test_blocks_cover_long_lines():
    text = "word " * 50_000 + "Released under the MIT License. " + "word " * 50_000
    (a, b), = blocks(text)
    assert "Released under the MIT License." in text[a:b] and b - a <= 1_000


def test_scan(spark):
    rows = [(1, PROSE + "Released under the MIT License."), (2, PROSE), (3, None), (4, ""), (None, TEMPLATES["Apache-2.0"]), (5, PROSE + "Licensed under CC BY-NC 4.0.\n" + PROSE * 3 + TEMPLATES["GPL-3.0"]), (6, "x" * 300_000 + " license"), (7, TEMPLATES["MIT"]), (7, TEMPLATES["MIT"])]
    rows += [(8, "Licensed under the Apache License, Version 2.1."), (9, "We lost our license to kill joy")]
    got = {r.doc_id: r for r in scan(spark.createDataFrame([(i, t, "l", "f") for i, t in rows], DOCS)).collect()}
    assert [got[k].license for k in (1, 2, 3, 4, None, 6, 7)] == ["MIT", None, None, None, "Apache-2.0", None, "MIT"]
    assert got[5].n_confirmed == 2 and [f.template for f in got[5].findings] == ["CC-BY-NC-4.0", "GPL-3.0"] and all(f.exact for f in got[5].findings)
    assert got[8].license is None and got[8].n_confirmed == 0
    assert (got[8].findings[0].template, json.loads(got[8].findings[0].differences)) == ("Apache-2.0", {"missing": ["2.0"], "added": []})
    assert got[9].license is None
    assert scan(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("before", [100, 200, 900, 5_000])
@pytest.mark.parametrize("template", sorted(TEMPLATES))
def test_exact_notice_inside_a_long_line(template, before):
    prose = ("The river rises in the hills and the people of the valley know its use, free for all who ask. " * 60)[:before]
    text = prose + " " + TEMPLATES[template] + " " + prose
    found = [(f.template, f.exact) for _, _, f in Scanner(TEMPLATES).document(text)[1] if f.confirmed]
    assert found == [(template, True)]


@pytest.mark.parametrize("template", ["Apache-2.0 header", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0 header", "ISC", "MIT text", "MPL-2.0", "Zlib"])
@pytest.mark.parametrize("lead", ["", "# ", " * "])
def test_wrapped_notices(template, lead):
    # A paragraph for each sentence, lines of 72 characters, as licence files have them.
    parts = [textwrap.fill(p, 72 - len(lead)) for p in re.split(r"(?<=[.:]) (?=[A-Z])", TEMPLATES[template])]
    notice = "\n".join(lead + line for line in "\n\n".join(parts).split("\n"))
    text = "Copyright (c) 2020 Somebody\n\n" + notice + "\n\n" + "THE SOFTWARE IS PROVIDED AS IT STANDS.\n" + PROSE
    (a, b, found), = [x for x in Scanner(TEMPLATES).document(text)[1] if x[2].confirmed]
    assert found.template == template and found.exact and words(text[a:b]) == words(TEMPLATES[template])


def test_every_notice_of_a_place(spark):
    short = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under the Apache License, Version 2.0.", TEMPLATES["ISC"]]
    rows = [(1, "\n".join(short[:2])), (2, PROSE + " ".join(short) + " " + PROSE), (3, TEMPLATES["Apache-2.0 header"]), (4, short[0] + " " + short[0])]
    got = {r.doc_id: r for r in scan(spark.createDataFrame([(i, t, "l", "f") for i, t in rows], DOCS)).collect()}
    told = {k: [f.template for f in r.findings if f.exact] for k, r in got.items()}
    assert told == {1: ["MIT", "CC-BY-NC-4.0"], 2: ["MIT", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "Apache-2.0", "ISC"], 3: ["Apache-2.0 header"], 4: ["MIT", "MIT"]}
    assert [got[k].n_confirmed for k in (1, 2, 3, 4)] == [2, 5, 1, 2]
