"""Tagged licence expressions of any length are read whole, and the one pass agrees with trying every length."""

import random

import pytest

from tillstream.llm import licenses

TAG = "x\nSPDX-License-Identifier: "


@pytest.mark.parametrize("n", [10, 300, 5000])
def test_long_expressions(n):
    text = TAG + "MIT AND " * n + "GPL-3.0-only */\nISC OR MIT"
    row = licenses.scan(text.encode())
    assert row[5] == "gpl-3.0-only,mit" and row[8] is False
    assert row[7].split() == ["mit", "mit", "AND"] + ["mit", "AND"] * (n - 2) + ["gpl-3.0-only", "AND"]
    row = licenses.scan(f"{TAG}({'MIT OR ' * n}GPL-3.0-only)".encode())
    assert row[5] == "gpl-3.0-only,mit" and row[8] is True
    assert licenses.scan(f"{TAG}({'MIT OR ' * n}GPL-3.0-only".encode())[5:] == ("", 0.0, "", None)


def every_length(tokens):
    for n in range(len(tokens), 0, -1):
        try:
            return licenses.postfix(" ".join(tokens[:n]))
        except ValueError:
            continue
    return []


def test_one_pass(monkeypatch):
    draw = random.Random(14)
    monkeypatch.setattr(licenses, "FIRST_READ", 5)
    for _ in range(5000):
        tokens = draw.choices(["MIT", "isc", "(", ")", "AND", "or", "with", "é", "GPL-2.0+"], [6, 6, 4, 4, 6, 6, 2, 1, 3], k=draw.randint(0, 14))
        raw = " ".join(tokens).encode() + draw.choice([b"", b"\nMIT", b" */", b"\r AND ISC"])
        assert licenses.expression_after(raw, 0) == every_length(tokens)
