"""Licenses that differ by a word or a number."""

import pytest

from strandloom.llm import licenses

SCANNER = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."


@pytest.mark.parametrize(
    "text, name",
    [
        ("Licensed under the BSD License.", "BSD"), ("Released under the X11 License.", "X11"), ("Released under the MIT License.", "MIT"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), (GPL.format("General Public License", 3), "GPL-3.0"), (GPL.format("General Public License", 2), "GPL-2.0"),
        (GPL.format("Affero General Public License", 3), "AGPL-3.0"), (GPL.format("Lesser General Public License", "2.1"), "LGPL-2.1"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GPL-3.0"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ],
)
def test_the_license_that_is_named(text, name):
    assert [f[0] for f in SCANNER.scan(f"some words before. {text} And some after.")] == [name]


@pytest.mark.parametrize("text", ["Released under the Zlib License.", "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-XX 4.0.", "Licensed under CC BY NC 4.0."])
def test_other_licenses_are_not_taken_for_known_ones(text):
    assert SCANNER.scan(text) == []
