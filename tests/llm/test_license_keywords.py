"""The keyword filter of the licence scan switches off no rule on a text that the rule matches."""

import random
import re
from re import _constants as C, _parser

import pytest

from quillmill.llm import licenses


def spelt(tree, rng):
    """A random text that a parsed regex may match; assertions are left out."""
    out = []
    for op, arg in tree:
        if op is C.LITERAL:
            out.append(chr(arg))
        elif op is C.ANY:
            out.append("q")
        elif op is C.IN:
            kind, of = rng.choice(arg)
            if kind is C.CATEGORY:
                out.append(rng.choice({C.CATEGORY_DIGIT: "07", C.CATEGORY_WORD: "w_", C.CATEGORY_SPACE: " \n\t\xa0"}[of]))
            else:
                out.append(chr(of if kind is C.LITERAL else rng.randint(*of)))
        elif op is C.BRANCH:
            out.append(spelt(rng.choice(arg[1]), rng))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, part = arg
            out += [spelt(part, rng) for _ in range(rng.randint(least, min(most, least + 2)))]
        elif op is C.SUBPATTERN:
            out.append(spelt(arg[3], rng))
        else:
            assert op in (C.AT, C.ASSERT, C.ASSERT_NOT)
    return "".join(out)


class Everything:
    def iter(self, _):
        return [(0, 0)]


@pytest.fixture
def unfiltered(monkeypatch):
    def scan(text):
        with monkeypatch.context() as m:
            m.setattr(licenses, "_keywords", lambda: (Everything(), ((),) * len(licenses.rules())))
            return licenses.scan(text)

    return scan


def test_variants_of_every_rule(unfiltered):
    rng = random.Random(7)
    cases = (str, str.upper, str.title, lambda t: "".join(rng.choice({"i": "iıİI", "s": "sſS", "k": "kKK"}.get(c, c)) for c in t))
    for rule in licenses.rules():
        tree, matched = _parser.parse(rule.pattern.pattern, re.I | re.S), 0
        for k in range(24):
            text = f"before {cases[k % 4](spelt(tree, rng))} after"
            matched += bool(rule.pattern.search(text))
            assert licenses.scan(text) == unfiltered(text), (rule.rule_id, text)
        assert matched >= 6, rule.rule_id


@pytest.mark.parametrize(
    "text, license",
    [
        ("End-User License Agreement", "Proprietary"), ("CC-BY-SA-3.0", "CC-BY-SA"), ("CC-BY-NC-4.0", "CC-BY-NC"), ("Attribution-Share Alike 3.0 Unported", "CC-BY-SA-3.0"), ("EUPL 1.2", "EUPL-1.2"), ("MIT-License", "MIT"),
        ("the Apache Licence", "Apache"), ("GNU General Public Licence, version 2", "GPL-2.0-only"), ("GNU General Public License v2", "GPL-2.0-only"), ("all rights * reserved", "Proprietary"), ("all rights\xa0reserved", "Proprietary"),
    ],
)
def test_spellings(text, license, unfiltered):
    assert [x[1] for x in licenses.scan(text)] == [x[1] for x in unfiltered(text)] == [license]
