"""Every passage with a disguise is found by itself, and none because of what stands elsewhere in the text."""

import pytest

from tillstream.llm import pii

FOUND = [
    ("call plus 49 170 1234567 now", "phone", "plus 49 170 1234567"), ("write to bob at example.com today", "email", "bob at example.com"),
    ("ask ann.lee at mail.example.org.", "email", "ann.lee at mail.example.org"), ("info at example.com", "email", "info at example.com"),
    ("to bob\tat\texample\tdot\tcom now", "email", "bob\tat\texample\tdot\tcom"), ("at 10\tdot\t0\tdot\t0\tdot\t1 x", "ip", "10\tdot\t0\tdot\t0\tdot\t1"),
    ("card ৪১১১ ১১১১ ১১১১ ১১১১ x", "card", "৪১১১ ১১১১ ১১১১ ১১১১"), ("x ℬob@example.com y", "email", "ℬob@example.com"),
    ("bob at example (dot) com", "email", "bob at example (dot) com"), ("bob\t@\texample.com", "email", "bob\t@\texample.com"),
    ("see bob [at]\texample.com", "email", "bob [at]\texample.com"), ("plus fıve one two three four five six seven eight nıne", "phone", "plus fıve one two three four five six seven eight nıne"),
]
CLEAN = [
    "look at www.example.com", "read more at example.com", "contact us at example.com", "docs at example.com/path", "it sold at 3.5 dollars",
    "he arrived at noon.Then he left", "it's at example.com", "bob at 10.5",
]
ELSEWHERE = ["", "the dot com years. ", "soft\u00adhyphen. ", "mail (at) noon. ", "１ wide. "]


@pytest.mark.parametrize("before", ELSEWHERE)
@pytest.mark.parametrize(("text", "kind", "part"), FOUND)
def test_found_wherever_it_stands(before, text, kind, part):
    text = f"{before}{text}"
    every = pii.spans(text)[1]
    a = text.index(part)
    assert (a, pii.KINDS.index(kind), a + len(part)) in every
    assert all(a <= s and e <= a + len(part) for s, _, e in every)  # base spans inside it stay
    assert pii.masked(text, every) == text.replace(part, f"[{kind.upper()}]")


@pytest.mark.parametrize("before", ELSEWHERE)
@pytest.mark.parametrize("text", CLEAN)
def test_clean_wherever_it_stands(before, text):
    assert pii.spans(before + text)[1] == []
