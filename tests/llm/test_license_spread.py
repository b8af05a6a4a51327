"""Notices with text put in, many notices, and the choice where notices overlap."""

import random
import time

import pytest

from strandloom.llm import licenses

PROSE = "the of and to in a story that was told by garden window planet people very often under some without any person would have".split()


@pytest.mark.parametrize("gap", [1, 5, 40])
@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD"])
def test_any_amount_of_text_between_the_words(name, gap):
    r = random.Random(gap)
    long = max(licenses.TEMPLATES[name], key=len)
    text = " ".join(w + " " + " ".join(r.choice(PROSE) for _ in range(gap)) for w in long.split())
    found = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE).scan("before it " + text + " after it")
    assert [f[0] for f in found] == [name]


def test_prose_holds_no_license():
    r = random.Random(1)
    text = " ".join(r.choice(PROSE + ["permission", "software", "license", "copy", "rights", "notice", "conditions"]) for _ in range(20000))
    assert licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE).scan(text) == []


def test_many_notices_in_linear_time():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    took = []
    for n in (1000, 4000):
        began = time.perf_counter()
        assert len(scanner.scan("Released under the MIT License. Some words between. " * n)) == n
        took.append(time.perf_counter() - began)
    assert took[1] < 8 * took[0] + 0.5


def test_overlaps_against_a_loop():
    """Where notices overlap, the one with the most aligned words stays, then the earlier: chosen here by a plain loop."""
    r = random.Random(9)
    parts = [t for texts in licenses.TEMPLATES.values() for t in texts]
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    for _ in range(20):
        text = " ".join(r.choice([*parts, "some words"]) for _ in range(6))
        found = scanner.scan(text)
        ws = licenses.clean_words(text)
        every = []
        for k, (name, words) in enumerate(scanner.items):
            if len(words) <= licenses.SHORT:  # whole: look at every place
                every += [(-float(len(words)), i, name, i + len(words)) for i in range(len(ws)) if ws[i : i + len(words)] == words]
        for _, a, name, b in every:  # each place where a short notice stands word for word is inside some notice
            assert any(x <= a and b <= y or a < y and x < b for _, x, y, _ in found), (name, text)
        assert all(found[i][2] <= found[i + 1][1] for i in range(len(found) - 1))
