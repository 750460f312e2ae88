from support import docs, prose  # noqa: F401
from marketflow.llm import licences
from marketflow.llm.licences import TEMPLATES, Scanner

MIT = TEMPLATES[3][1]


def names(text):
    return sorted({h[1] for h in Scanner(TEMPLATES).scan(text)[1]})


def test_wordings():
    assert names("Some text.\nReleased under the MIT License.\nmore") == ["MIT"]
    assert names("Licensed under the  Apache License, Version 2.0.") == ["Apache-2.0"]
    assert names("Licensed under CC BY-NC 4.0.") == ["CC-BY-NC-4.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("intro\n" + MIT.replace("person obtaining", "person\nobtaining").replace("deal in", "deal\nin") + "\nrest") == ["MIT"]
    assert names(prose(1, 500) + " Released under the MIT License. " + prose(2, 500)) == ["MIT"]


def test_other_wordings_are_no_licence():
    for text in (None, "", "He lost his driving licence.", "Licensed under the Apache helicopter rules, Version 2.0 of ours.", "warranty " * 2000, "licence\n" * 500):
        assert names(text) == []


def test_all_planted_lines_are_found(spark):
    lines = {TEMPLATES[k][1]: TEMPLATES[k][0] for k in (0, 2, 4, 6)}
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()
    scanner = Scanner(TEMPLATES)
    for r in rows:
        want = sorted(name for line, name in lines.items() if line in (r["text"] or ""))
        assert sorted({h[1] for h in scanner.scan(r["text"])[1]}) == want


def test_frame(spark, docs):
    frame = docs([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, None), (2, "")])
    got = sorted(((r["doc_id"], r["n_blocks"], [h["licence"] for h in r["hits"]]) for r in licences.scan(frame).collect()), key=repr)
    assert got == [(1, 1, ["MIT"]), (1, 1, ["MIT"]), (2, 0, []), (None, 0, [])]
    assert licences.scan(docs([])).count() == 0


def test_neighbours_are_told_apart():
    for title, name in (
        ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0"),
        ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC-BY-NC-ND-4.0"),
        ("Creative Commons Attribution-ShareAlike 3.0 Unported License", "CC-BY-SA-3.0"), ("Creative Commons Attribution 4.0 International License", "CC-BY-4.0"),
    ):
        assert names(f"This work is licensed under a {title}.") == [name]
    assert names("Licensed under the Apache License, Version 1.1.") == ["Apache-1.1"]
    assert names("Licensed under the Apache License, Version 3.0.") == []
    for title, name in (
        ("General Public License, version 2", "GPL-2.0"), ("Lesser General Public License, version 3", "LGPL-3.0"), ("General Public License, version 3.0", "GPL-3.0"),
        ("Affero General Public License, version 3", "AGPL-3.0"), ("Lesser General Public License, version 2.1", "LGPL-2.1"), ("Free Documentation License, version 3", None),
    ):
        assert names(f"This work is licensed under the GNU {title}.") == ([name] if name else [])
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0"]
    assert names("SPDX-License-Identifier: MIT-0") == ["MIT-0"] and names("SPDX-License-Identifier: MIT") == ["MIT"]
    both = licences._BSD + " " + licences._BSD_AS_IS
    assert names(both) == ["BSD-2-Clause"] and names(both.replace("THIS SOFTWARE", licences._BSD_THIRD + " THIS SOFTWARE", 1)) == ["BSD-3-Clause"]
    assert names(TEMPLATES[8][1]) == ["BSD"]


def test_every_template_is_its_own_licence():
    for name, text in TEMPLATES:
        assert names(text) == [name], text
    full = {name: text for name, text in TEMPLATES if text.startswith(licences._GRANT)}
    assert names(full["MIT-0"].replace("do so.", "do so. ")) == ["MIT-0"]


def test_all_licences_of_a_block_and_whole_notices():
    assert names("Released under the MIT License. Docs: Licensed under the Apache License, Version 2.0.") == ["Apache-2.0", "MIT"]
    authors = "Copyright (c) 2019 Ann Example, Bob Example, Carl Example and Dora Example of the example working group, all rights. "
    assert names(prose(1, 300) + " " + authors + MIT + " " + prose(2, 300)) == ["MIT"]
    gpl = TEMPLATES[5][1]
    for k in range(8, len(gpl.split()), 6):
        cut = gpl.split()
        wrapped = " ".join(cut[:6]) + "\n" + " ".join(cut[6:k]) + "\n\n" + " ".join(cut[k:])
        assert names("intro\n\n" + wrapped + "\n\nrest") == ["GPL-3.0"]
        assert Scanner(TEMPLATES).scan("intro\n\n" + wrapped)[1][0][0] == 2
    paragraphs = (licences._BSD + " " + licences._BSD_THIRD + " " + licences._BSD_AS_IS).replace(". ", ".\n\n")
    assert names(prose(3, 200) + "\n\n" + paragraphs) == ["BSD-3-Clause"]


def test_notices_of_long_blocks():
    text = "\n".join(("warranty " * 300, "Released under the MIT License.")[k % 2] for k in range(40))
    assert [h[:2] for h in Scanner(TEMPLATES).scan(text)[1]] == [(k, "MIT") for k in range(1, 40, 2)]
